"""Caps, ties, nulls, state by additions, oversampling and readers: the cases found wanting before."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import ledgerline.operators.encode as enc_mod
import ledgerline.operators.graph as graph_mod
from ledgerline import compact_state, load_state, update_state
from ledgerline.operators import eda, quality
from ledgerline.operators.encode import add_index, encode_transactions
from ledgerline.operators.enrich import enrich
from ledgerline.operators.graph import build_edges, node_features
from ledgerline.operators.resample import oversample_latent
from ledgerline.operators.smote import knn, smote
from ledgerline.session import freeze, release_scratch, scratch_path
from ledgerline.sinks.writers import to_records
from ledgerline.sources.readers import RAW_SCHEMA, parse_records
from ledgerline.sources.registry import _free_version
from ledgerline.streaming.score_stream import stream_score


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_quantiles_of_one_value_are_one_row(spark):
    df = spark.range(20_000).select(F.lit("a").alias("g"), F.when(F.col("id") < 19_990, F.lit(7.0)).otherwise(
        F.col("id").cast("double")).alias("v"))
    got = {r["q"]: r["value"] for r in eda.exact_quantiles(df, ["g"], "v", [0.0, 0.5, 1.0]).collect()}
    assert got == {0.0: 7.0, 0.5: 7.0, 1.0: 19_999.0}
    # The value that fills the column is combined before anything is ranged or sorted.
    counts = df.groupBy("g", "v").count()
    assert counts.count() == 11


def test_quantiles_against_numpy(spark):
    import numpy as np
    r = np.random.default_rng(3)
    rows = [(int(g), float(v)) for g, v in zip(r.integers(0, 4, 3000), r.integers(-40, 40, 3000))]
    got = eda.exact_quantiles(spark.createDataFrame(rows, "g long, v double"), ["g"], "v", [0.1, 0.25, 0.5, 0.99]).collect()
    for x in got:
        assert x["value"] == pytest.approx(np.quantile([v for g, v in rows if g == x["g"]], x["q"]))


@pytest.mark.parametrize("limit", [0, 10**6])
def test_features_do_not_depend_on_broadcast_limits(spark, raw, monkeypatch, limit):
    t, n = raw
    monkeypatch.setattr(graph_mod, "MAX_BROADCAST_EDGES", limit)
    monkeypatch.setattr(graph_mod, "MAX_BROADCAST_NODES", limit)
    monkeypatch.setattr(enc_mod, "BROADCAST_DIM_ROWS", limit)
    monkeypatch.setattr(eda, "MAX_BROADCAST_GROUPS", limit)
    e, _ = encode_transactions(t, index_offset=0, n_rows=n)
    f = node_features(build_edges(e))
    out = enrich(e, f, broadcast=True, max_broadcast_rows=limit)
    total = out.agg(F.sum("from_degree"), F.sum("to_in_degree"), F.round(F.sum("from_clustering_coeff"), 6)).first()
    assert out.count() == n
    seen = test_features_do_not_depend_on_broadcast_limits.__dict__.setdefault("seen", tuple(total))
    assert tuple(total) == seen


def test_wide_domains_are_reported(spark):
    train = spark.range(300).select(F.concat(F.lit("v"), F.col("id")).alias("many"), F.lit("x").alias("one"))
    exp = quality.infer_expectations(quality.profile(train), train, max_domain=100)
    assert {r["feature"]: r["domain_size"] for r in exp.collect()} == {"many": None, "one": 1}
    new = spark.createDataFrame([("q", "y")], "many string, one string")
    got = {(r["feature"], r["anomaly"], r["count"]) for r in
           quality.validate(new, exp, quality.domains(train, exp)).collect()}
    assert got == {("many", "no_domain", 300), ("one", "unexpected_value", 1)}


def test_top_values(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("c",), (None,)], "x string")
    assert [tuple(r) for r in quality.top_values(df, 2).orderBy("rank").collect()] == [("x", 1, "a", 2), ("x", 2, "b", 1)]


def test_transfers_without_a_key_are_rejected(spark, raw):
    t, n = raw
    holed = t.withColumn("Account", F.when(F.col("row_id") % 100 == 0, None).otherwise(F.col("Account")))
    with pytest.raises(Exception, match="unparseable transfer"):
        encode_transactions(holed, index_offset=0, n_rows=n)[0].collect()
    kept, _, rejects = encode_transactions(holed, index_offset=0, n_rows=n, on_error="quarantine")
    assert rejects.count() == -(-n // 100) and kept.count() == n - rejects.count()
    assert kept.where("From_ID IS NULL OR To_ID IS NULL").count() == 0


def test_edges_without_an_end_are_no_edges(spark):
    e = spark.createDataFrame([(0, 1, None), (1, None, 2), (2, 1, 3)], "Index long, From_ID long, To_ID long")
    for x in ("Timestamp", "Amount_Paid", "Amount_Received", "Receiving_Currency", "Payment_Format"):
        e = e.withColumn(x, F.lit(1.0))
    assert [(r["src"], r["dst"]) for r in build_edges(e).collect()] == [(1, 3)]


@pytest.mark.parametrize("ids", [[0, 0, 2], [5, None, 7], [1, 1 << 40, 3], [4, 5, 6]])
def test_index_is_dense_whatever_the_ids(spark, ids):
    df = spark.createDataFrame([(i, str(k)) for k, i in enumerate(ids)], "row_id long, v string")
    out, n = add_index(df)
    assert n == 3 and sorted(r["Index"] for r in out.collect()) == [0, 1, 2]


@pytest.mark.parametrize("change", ["drop", "repeat"])
def test_row_index_is_dense_after_post(spark, change):
    from ledgerline.operators.rank import with_row_index

    def post(d):
        return d.where("id % 3 <> 1") if change == "drop" else d.unionByName(d.where("id % 5 = 0"))

    out, n = with_row_index(spark.range(666), ["id"], name="i", num_partitions=5, return_count=True, post=post)
    rows = out.orderBy("i").collect()
    assert [r["i"] for r in rows] == list(range(n)) and [r["id"] for r in rows] == sorted(r["id"] for r in rows)


def test_empty_table_freezes_with_its_schema(spark):
    df = spark.createDataFrame([], "domain string, value string, code long")
    assert freeze(df, "empty", partition_by=["domain"]).count() == 0


def test_records_with_blanks_in_names(spark, raw):
    t, _ = raw
    text = to_records(t.drop("row_id")).limit(5)
    got = parse_records(text, "record", RAW_SCHEMA)
    assert got.columns == [f.name for f in RAW_SCHEMA.fields] and got.where(F.col("`Amount Paid`").isNull()).count() == 0


def test_latent_rows_keep_constant_columns_and_means(spark):
    rows = [(i, 1 if i % 3 == 0 else 0, 0.8, (i % 10) / 10, ((i * 7) % 10) / 10) for i in range(300)]
    df = spark.createDataFrame(rows, "Index long, Is_Laundering long, a double, b double, c double")
    got = oversample_latent(df, ["a", "b", "c"], key="Index", noise=0.0).toPandas()
    mine = df.where("Is_Laundering = 1").toPandas().set_index("Index").loc[got.Index]
    assert len(got) == 100 and abs(got.a - 0.8).max() < 1e-9
    assert abs(got.b.to_numpy() - mine.b.to_numpy()).max() < 1e-9  # every direction kept, no noise: the row itself


@pytest.mark.parametrize("block_rows", [512, 7])
def test_neighbours_against_brute_force(spark, block_rows):
    import numpy as np
    r = np.random.default_rng(5)
    x = np.concatenate([r.random((120, 3)), np.full((60, 3), 0.5), r.random((20, 3)) * 0.01])
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "k long, a double, b double, c double")
    got = {}
    for row in knn(df, "k", ["a", "b", "c"], k=4, block_rows=block_rows).collect():
        got.setdefault(row["key"], {})[row["nn_rank"]] = (row["nn_key"], row["dist"])
    for i in range(len(x)):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        order = [j for j in sorted(range(len(x)), key=lambda j: (round(d[j], 12), j)) if j != i][:4]
        assert [round(got[i][k][1], 9) for k in (1, 2, 3, 4)] == [round(d[j], 9) for j in order]
        if d[order[-1]] == 0:
            assert [got[i][k][0] for k in (1, 2, 3, 4)] == order


def test_smote_balances_and_stays_between(spark):
    rows = [(i, 1 if i < 7 else 0, i / 10.0, (i * 3 % 7) / 7.0) for i in range(60)]
    df = spark.createDataFrame(rows, "Index long, Is_Laundering long, a double, b double")
    got = smote(df, ["a", "b"], key="Index", k=3).toPandas()
    assert len(got) == 53 - 7 and set(got.Is_Laundering) == {1}
    assert got.a.between(0, 0.6).all() and got.b.between(0, 6 / 7).all()
    sizes = got.groupby("Index").size()
    assert sizes.max() - sizes.min() <= 1 and len(sizes) == 7
    again = smote(df.repartition(5), ["a", "b"], key="Index", k=3).toPandas()
    assert sorted(map(tuple, got.round(9).to_numpy())) == sorted(map(tuple, again.round(9).to_numpy()))


def files_size(spark, path):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def test_state_commits_write_additions_only(spark, raw):
    t, n = raw
    sdir = scratch_path(spark, "state")
    k = 4
    sizes = []
    for i in range(k):
        part = t.where((F.col("row_id") >= i * n // k) & (F.col("row_id") < (i + 1) * n // k))
        update_state(spark, part, sdir, i)
        sizes.append(files_size(spark, f"{sdir}/batch_id={i}"))
    assert max(sizes[1:]) <= 1.2 * sizes[0]
    before = load_state(spark, sdir)
    assert len(before.parts) == k
    edges = sorted(tuple(r) for r in before.edges.collect())
    dims = sorted(tuple(r) for r in before.dims["account"].collect())
    after = compact_state(spark, sdir)
    assert len(after.parts) == 1
    assert sorted(tuple(r) for r in after.edges.select(*before.edges.columns).collect()) == edges
    assert sorted(tuple(r) for r in after.dims["account"].collect()) == dims
    assert load_state(spark, sdir, batch_id=1).edges.count() < len(edges)


def test_stream_takes_eleven_column_files_and_empty_ones(spark, raw, tmp_path):
    t, n = raw
    lines = [r[0] for r in t.where("row_id < 40").orderBy("row_id").select(
        F.concat_ws(",", *[F.col(f"`{f.name}`") for f in RAW_SCHEMA.fields])).collect()]
    head = ",".join(x.replace("Account.1", "Account") for x in RAW_SCHEMA.fieldNames())
    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "a.csv").write_text("\n".join([head, *lines]) + "\n")
    empty = tmp_path / "none"
    empty.mkdir()
    (empty / "b.csv").write_text(head + "\n")
    sdir, out = scratch_path(spark, "state"), scratch_path(spark, "scored")
    seen = []

    def score(df):
        seen.append(df.columns)
        return df.withColumn("Is_Laundering_Prediction", (F.col("from_degree") > 2).cast("long"))

    stream_score(spark, str(landing), sdir, out, score, keep=["row_id"])
    stream_score(spark, str(empty), sdir, out, score, keep=["row_id"])
    rows = spark.read.parquet(out).orderBy("row_id").collect()
    assert [r["row_id"] for r in rows] == list(range(40)) == [r["Index"] for r in rows]
    want = t.where("row_id < 40").orderBy("row_id").select(F.col("`Amount Paid`").cast("double")).collect()
    assert [r["Amount_Paid"] for r in rows] == [r[0] for r in want]
    assert {"from_degree", "to_clustering_coeff"} <= set(seen[0]) and len(seen) == 1


def test_model_versions_do_not_collide(spark):
    root = scratch_path(spark, "registry")
    versions = []
    for _ in range(3):
        versions.append(_free_version(root))
        spark.range(1).write.parquet(f"{root}/model_{versions[-1]}")
    assert len(set(versions)) == 3


def test_no_window_over_a_whole_table(spark, raw):
    """A single-partition exchange may only hold aggregates and offsets, never the rows of a table."""
    t, n = raw
    e, _ = encode_transactions(t, index_offset=0, n_rows=n)
    for df in (e, build_edges(e)):
        assert "Window" not in plan(df)


def test_cluster_needs_a_shared_folder(spark, monkeypatch):
    from ledgerline import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_scratch_is_released(spark):
    other = scratch_path(spark, "gone")
    spark.range(1).write.parquet(other)
    assert other.rsplit("/", 1)[0].endswith(spark.sparkContext.applicationId)
    assert callable(release_scratch)
    assert T.StructType(RAW_SCHEMA.fields) == RAW_SCHEMA


def test_principal_directions_are_those_of_the_library(spark):
    import numpy as np
    from pyspark.ml.feature import PCA, VectorAssembler

    from ledgerline.operators.resample import principal_directions
    rng = np.random.default_rng(5)
    rows = (rng.random((500, 4)) * [1, 0.5, 0.2, 0] + [0, 3, -2, 0.25]).tolist()
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(7)
    mean = list(df.agg(*[F.avg(x) for x in df.columns]).first())
    got = principal_directions(df, df.columns, mean, 3)
    want = PCA(k=3, inputCol="x", outputCol="z").fit(VectorAssembler(inputCols=df.columns, outputCol="x").transform(df)).pc.toArray()
    assert np.allclose(got, want, atol=1e-9)
    for bad in (df.limit(1), df.limit(0), df.unionByName(df.limit(1).withColumn("b", F.lit(None).cast("double")))):
        with pytest.raises(Exception, match="two rows|null or NaN"):
            principal_directions(bad, df.columns, mean, 3)
