"""DuckDB oracle SQL, one statement per registered query.

Each statement inlines the fixture CTEs of :mod:`checks.fixture_sql`, so it runs on the
driver's pre-registered base tables only. The oracle uses simple textbook forms
(global ``row_number()``, id-ordered triangle listing) that the Spark engine avoids at scale.
"""

from __future__ import annotations

from .fixture_sql import CUT, with_ctes

TS = "strptime({x}, '%Y/%m/%d %H:%M')"


def _ts(x: str) -> str:
    return TS.format(x=x)


def dict_ctes(src: str = "transactions", prefix: str = "") -> list[tuple[str, str]]:
    """First-seen dictionaries over ``src`` (which must have row_id)."""
    return [
        (f"{prefix}cur", f"""SELECT value, row_number() OVER (ORDER BY min(pos)) - 1 AS code FROM (
            SELECT "Receiving Currency" AS value, 2 * row_id AS pos FROM {src}
            UNION ALL SELECT "Payment Currency", 2 * row_id + 1 FROM {src}) GROUP BY value"""),
        (f"{prefix}fmt", f"""SELECT value, row_number() OVER (ORDER BY min(pos)) - 1 AS code FROM (
            SELECT "Payment Format" AS value, row_id AS pos FROM {src}) GROUP BY value"""),
        (f"{prefix}acct", f"""SELECT value, row_number() OVER (ORDER BY min(pos)) - 1 AS code FROM (
            SELECT "From Bank" || "Account" AS value, 2 * row_id AS pos FROM {src}
            UNION ALL SELECT "To Bank" || "Account.1", 2 * row_id + 1 FROM {src}) GROUP BY value"""),
    ]


ANCHOR = f"""(SELECT CAST(epoch(date_trunc('day', {_ts('"Timestamp"')})) AS BIGINT) - 10
              FROM transactions WHERE row_id = 0)"""


def enc_cte(src: str = "transactions", index: str = "t.row_id", batch: str = "0",
            cur: str = "cur", fmt: str = "fmt", acct: str = "acct") -> str:
    return f"""SELECT CAST({index} AS BIGINT) AS "Index", fa.code AS From_ID, ta.code AS To_ID,
      CAST(CAST(epoch({_ts('t."Timestamp"')}) AS BIGINT) - {ANCHOR} AS DOUBLE) AS "Timestamp",
      CAST(t."Amount Paid" AS DOUBLE) AS Amount_Paid, pc.code AS Payment_Currency,
      CAST(t."Amount Received" AS DOUBLE) AS Amount_Received, rc.code AS Receiving_Currency,
      pf.code AS Payment_Format, CAST(t."Is Laundering" AS BIGINT) AS Is_Laundering,
      CAST({batch} AS BIGINT) AS batch_id
    FROM {src} t
      LEFT JOIN {acct} fa ON fa.value = t."From Bank" || t."Account"
      LEFT JOIN {acct} ta ON ta.value = t."To Bank" || t."Account.1"
      LEFT JOIN {cur} rc ON rc.value = t."Receiving Currency"
      LEFT JOIN {cur} pc ON pc.value = t."Payment Currency"
      LEFT JOIN {fmt} pf ON pf.value = t."Payment Format" """


ENCODED_SELECT = """SELECT "Index", From_ID, To_ID, "Timestamp", Amount_Paid, Payment_Currency, Amount_Received,
  Receiving_Currency, Payment_Format, Is_Laundering"""


def graph_ctes(enc: str = "enc") -> list[tuple[str, str]]:
    return [
        ("edges", f"SELECT DISTINCT From_ID AS src, To_ID AS dst FROM {enc}"),
        ("pairs", """SELECT least(src, dst) AS u, greatest(src, dst) AS v, count(*) AS w
                     FROM edges WHERE src <> dst GROUP BY 1, 2"""),
        ("io", """SELECT node, CAST(sum(o) AS BIGINT) AS out_degree, CAST(sum(i) AS BIGINT) AS in_degree FROM (
                    SELECT src AS node, 1 AS o, 0 AS i FROM edges UNION ALL SELECT dst, 0, 1 FROM edges)
                  GROUP BY node"""),
        ("und", """SELECT node, sum(w) AS dt, sum(CASE WHEN w = 2 THEN 1 ELSE 0 END) AS db FROM (
                     SELECT u AS node, w FROM pairs UNION ALL SELECT v, w FROM pairs) GROUP BY node"""),
        ("tri", """SELECT p1.u AS a, p1.v AS b, p2.v AS c, p1.w * p2.w * p3.w AS p
                   FROM pairs p1 JOIN pairs p2 ON p1.u = p2.u AND p1.v < p2.v
                   JOIN pairs p3 ON p3.u = p1.v AND p3.v = p2.v"""),
        ("trisum", """SELECT node, sum(p) AS t FROM (
                        SELECT a AS node, p FROM tri UNION ALL SELECT b, p FROM tri UNION ALL SELECT c, p FROM tri)
                      GROUP BY node"""),
        ("nn", "SELECT count(*) AS n FROM io"),
        ("feat", """SELECT io.node AS "Node", io.in_degree + io.out_degree AS degree, io.in_degree, io.out_degree,
                      CASE WHEN coalesce(trisum.t, 0) > 0
                           THEN CAST(trisum.t AS DOUBLE) / CAST(und.dt * (und.dt - 1) - 2 * und.db AS DOUBLE)
                           ELSE 0.0 END AS clustering_coefficient,
                      CASE WHEN nn.n <= 1 THEN 1.0
                           ELSE CAST(io.in_degree + io.out_degree AS DOUBLE) / CAST(nn.n - 1 AS DOUBLE) END
                        AS degree_centrality
                    FROM io CROSS JOIN nn LEFT JOIN und ON und.node = io.node
                      LEFT JOIN trisum ON trisum.node = io.node"""),
    ]


def core(body: str, extra: list[tuple[str, str]] | None = None, graph: bool = False) -> str:
    ctes = dict_ctes() + [("enc", enc_cte())]
    if graph:
        ctes += graph_ctes()
    return with_ctes(body, *ctes, *(extra or []))


ENRICH_SELECT = """SELECT e."Index", e.From_ID, e.To_ID, e."Timestamp", e.Amount_Paid, e.Payment_Currency,
  e.Amount_Received, e.Receiving_Currency, e.Payment_Format, e.Is_Laundering,
  f.degree AS from_degree, f.in_degree AS from_in_degree, f.out_degree AS from_out_degree,
  f.clustering_coefficient AS from_clustering_coeff, f.degree_centrality AS from_degree_centrality,
  g.degree AS to_degree, g.in_degree AS to_in_degree, g.out_degree AS to_out_degree,
  g.clustering_coefficient AS to_clustering_coeff, g.degree_centrality AS to_degree_centrality
FROM enc e LEFT JOIN feat f ON f."Node" = e.From_ID LEFT JOIN feat g ON g."Node" = e.To_ID"""

# Two batches: train = row_id < CUT (Index = row_id), score = the rest (Index = row_id - CUT).
TWO_BATCH = [
    ("tr", f"SELECT * FROM transactions WHERE row_id < {CUT}"),
    ("sc", f"SELECT * FROM transactions WHERE row_id >= {CUT}"),
]


def ext_dict_ctes(domain_occ: str, prefix: str = "") -> list[tuple[str, str]]:
    """Extended dictionary: codes of the train batch, then new values in score-batch first-seen order."""
    return [
        (f"{prefix}occ", domain_occ),
        (f"{prefix}base", f"""SELECT value, row_number() OVER (ORDER BY min(pos)) - 1 AS code
                             FROM {prefix}occ WHERE b = 0 GROUP BY value"""),
        (f"{prefix}newv", f"""SELECT value, (SELECT max(code) + 1 FROM {prefix}base) + row_number() OVER (ORDER BY min(pos)) - 1 AS code
               FROM {prefix}occ WHERE b = 1 AND value NOT IN (SELECT value FROM {prefix}base) GROUP BY value"""),
        (f"{prefix}dict", f"SELECT * FROM {prefix}base UNION ALL SELECT * FROM {prefix}newv"),
    ]


ACCT_OCC_2B = f"""SELECT "From Bank" || "Account" AS value, CASE WHEN row_id < {CUT} THEN 0 ELSE 1 END AS b,
        2 * (row_id - CASE WHEN row_id < {CUT} THEN 0 ELSE {CUT} END) AS pos FROM transactions
      UNION ALL SELECT "To Bank" || "Account.1", CASE WHEN row_id < {CUT} THEN 0 ELSE 1 END,
        2 * (row_id - CASE WHEN row_id < {CUT} THEN 0 ELSE {CUT} END) + 1 FROM transactions"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["row_index"] = with_ctes("SELECT * FROM transactions")
    q["head_positive"] = with_ctes(
        """SELECT * FROM transactions WHERE row_id < 40000 AND "Is Laundering" = '1'""")
    q["encode_first_seen"] = core(ENCODED_SELECT + ", batch_id FROM enc")
    q["anchor_elapsed"] = with_ctes(f"""SELECT row_id,
        CAST(day({_ts('"Timestamp"')}) AS INTEGER) AS day, CAST(month({_ts('"Timestamp"')}) AS INTEGER) AS month,
        CAST(year({_ts('"Timestamp"')}) AS INTEGER) AS year,
        CAST(epoch({_ts('"Timestamp"')}) AS BIGINT) AS epoch_s,
        CAST(epoch(date_trunc('day', {_ts('"Timestamp"')})) AS BIGINT) AS midnight_s,
        CAST(epoch({_ts('"Timestamp"')}) AS BIGINT) - {ANCHOR} AS elapsed_s
        FROM transactions""")
    q["dict_extend"] = with_ctes("SELECT value, code FROM dict", *ext_dict_ctes(ACCT_OCC_2B))
    q["edges_last_wins"] = core("""SELECT From_ID AS src, To_ID AS dst,
        max_by("Timestamp", "Index") AS "timestamp", max_by(Amount_Paid, "Index") AS amount_sent,
        max_by(Amount_Received, "Index") AS amount_received, max_by(Receiving_Currency, "Index") AS received_currency,
        max_by(Payment_Format, "Index") AS payment_format, max(batch_id) AS batch_id, max("Index") AS "Index"
        FROM enc GROUP BY From_ID, To_ID""")
    q["graph_counts"] = core("""SELECT (SELECT count(*) FROM (SELECT src FROM edges UNION SELECT dst FROM edges)) AS n_nodes,
        (SELECT count(*) FROM edges) AS n_edges""", graph=True)
    q["degrees"] = core('SELECT "Node", in_degree, out_degree, degree FROM feat', graph=True)
    q["degree_centrality"] = core('SELECT "Node", degree_centrality FROM feat', graph=True)
    q["clustering"] = core('SELECT "Node", clustering_coefficient FROM feat', graph=True)
    q["node_features"] = core(
        'SELECT "Node", degree, in_degree, out_degree, clustering_coefficient, degree_centrality FROM feat',
        graph=True)
    q["enrich"] = core(ENRICH_SELECT, graph=True)
    q["enrich_broadcast"] = q["enrich"]
    q["edge_list_sorted"] = core("""SELECT "Index" AS EdgeID, From_ID AS from_id, To_ID AS to_id,
        CAST(trunc("Timestamp") AS BIGINT) AS "Timestamp", Amount_Paid AS "Amount Sent",
        Payment_Currency AS "Sent Currency", Amount_Received AS "Amount Received",
        Receiving_Currency AS "Received Currency", Payment_Format AS "Payment Format",
        Is_Laundering AS "Is Laundering",
        printf('%d,%d,%d,%d,%f,%d,%f,%d,%d,%d', "Index", CAST(trunc("Timestamp") AS BIGINT), From_ID, To_ID,
               Amount_Paid, Payment_Currency, Amount_Received, Receiving_Currency, Payment_Format, Is_Laundering)
          AS line
        FROM enc""")
    eda_sql(q)
    ml_sql(q)
    state_sql(q)
    io_sql(q)
    quality_sql(q)
    return q


# --- exploration and data quality ---------------------------------------------------------

RAW = ["Timestamp", "From Bank", "Account", "To Bank", "Account.1", "Amount Received",
       "Receiving Currency", "Amount Paid", "Payment Currency", "Payment Format", "Is Laundering"]
AMOUNTS = ["Amount Paid", "Amount Received"]
CATEGORICAL = ["Payment Format", "Payment Currency", "Receiving Currency"]


def _q(x: str) -> str:
    return '"' + x.replace('"', '""') + '"'


def _lit(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def eda_sql(q: dict[str, str]) -> None:
    q["cardinality"] = with_ctes(_union([
        f"SELECT {_lit(x)} AS \"column\", CAST(count(DISTINCT {_q(x)}) AS BIGINT) AS n_distinct FROM transactions"
        for x in ["From Bank", "Account", "To Bank", "Account.1"]]))
    q["value_counts_by_label"] = with_ctes(_union([
        f"""SELECT "Is Laundering", {_lit(x)} AS "column", {_q(x)} AS value, count(*) AS count
            FROM transactions WHERE {_q(x)} IS NOT NULL GROUP BY "Is Laundering", {_q(x)}""" for x in CATEGORICAL]))
    q["positive_slice"] = with_ctes("""SELECT * FROM transactions WHERE "Is Laundering" = '1'""")
    q["amount_summary"] = with_ctes(_union([
        f"""SELECT "Is Laundering" AS label, {_lit(x)} AS "column",
              round(min(CAST({_q(x)} AS DOUBLE)), 6) AS min, round(max(CAST({_q(x)} AS DOUBLE)), 6) AS max,
              round(avg(CAST({_q(x)} AS DOUBLE)), 6) AS mean,
              round(quantile_cont(CAST({_q(x)} AS DOUBLE), 0.5), 6) AS median
            FROM transactions GROUP BY "Is Laundering" """ for x in AMOUNTS]))
    q["group_size"] = with_ctes('SELECT "Payment Format", count(*) AS count FROM transactions GROUP BY 1')
    q["describe_all"] = with_ctes(_union([
        f"""SELECT {_lit(x)} AS "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique",
              first(v ORDER BY n DESC, v ASC) AS top, max(n) AS freq
            FROM (SELECT {_q(x)} AS v, count(*) AS n FROM transactions WHERE {_q(x)} IS NOT NULL GROUP BY 1)"""
        for x in RAW]))
    num = ["From_ID", "To_ID", "Timestamp", "Amount_Paid", "Payment_Currency", "Amount_Received",
           "Receiving_Currency", "Payment_Format", "Is_Laundering"]
    q["describe_numeric"] = core(_union([
        f"""SELECT {_lit(x)} AS "column", count({_q(x)}) AS count,
              round(avg(CAST({_q(x)} AS DOUBLE)), 6) AS mean, round(stddev_samp(CAST({_q(x)} AS DOUBLE)), 6) AS std,
              round(min(CAST({_q(x)} AS DOUBLE)), 6) AS min, round(max(CAST({_q(x)} AS DOUBLE)), 6) AS max,
              round(quantile_cont(CAST({_q(x)} AS DOUBLE), 0.25), 6) AS p25,
              round(quantile_cont(CAST({_q(x)} AS DOUBLE), 0.5), 6) AS p50,
              round(quantile_cont(CAST({_q(x)} AS DOUBLE), 0.75), 6) AS p75
            FROM enc""" for x in num]))
    cols = ["row_id"] + RAW
    q["null_counts"] = with_ctes(_union([
        f"SELECT {_lit(x)} AS \"column\", count(*) FILTER (WHERE {_q(x)} IS NULL) AS n_null FROM transactions_dirty"
        for x in cols]), dirty=True)
    q["table_info"] = with_ctes(_union([
        f"""SELECT CAST({i} AS INTEGER) AS position, {_lit(x)} AS "column", {_lit('bigint' if x == 'row_id' else 'string')} AS type,
              count({_q(x)}) AS non_null FROM transactions_dirty""" for i, x in enumerate(cols)]), dirty=True)
    q["class_counts"] = with_ctes('SELECT "Is Laundering", count(*) AS count FROM transactions GROUP BY 1')
    q["negative_rows"] = with_ctes(_union([
        f"""SELECT row_id, {_lit(x)} AS "column", {_q(x)} AS value FROM transactions_dirty
            WHERE TRY_CAST({_q(x)} AS DOUBLE) < 0""" for x in AMOUNTS]), dirty=True)
    q["null_rows"] = with_ctes(_union([
        f"""SELECT row_id, {_lit(x)} AS "column" FROM transactions_dirty WHERE {_q(x)} IS NULL""" for x in RAW]),
        dirty=True)
    q["drop_missing"] = with_ctes(
        "SELECT * FROM transactions_dirty WHERE " + " AND ".join(f"{_q(x)} IS NOT NULL" for x in cols), dirty=True)
    parts = []
    for x in RAW:
        if x in AMOUNTS:
            neg = f"count(*) FILTER (WHERE TRY_CAST({_q(x)} AS DOUBLE) < 0)"
            bad = f"count(*) FILTER (WHERE {_q(x)} IS NOT NULL AND TRY_CAST({_q(x)} AS DOUBLE) IS NULL)"
        elif x == "Timestamp":
            neg = "CAST(0 AS BIGINT)"
            bad = f"count(*) FILTER (WHERE {_q(x)} IS NOT NULL AND try_strptime({_q(x)}, '%Y/%m/%d %H:%M') IS NULL)"
        else:
            neg, bad = "CAST(0 AS BIGINT)", "CAST(0 AS BIGINT)"
        parts.append(f"""SELECT {_lit(x)} AS "column", count(*) FILTER (WHERE {_q(x)} IS NULL) AS n_null,
                           {neg} AS n_negative, {bad} AS n_malformed FROM transactions_dirty""")
    q["quality_report"] = with_ctes(_union(parts), dirty=True)
    q["ingest_checked"] = q["quality_report"]


# --- splits, scaling, evaluation ----------------------------------------------------------

FEATURES = ["From_ID", "To_ID", "Timestamp", "Amount_Paid", "Payment_Currency", "Amount_Received",
            "Receiving_Currency", "Payment_Format", "from_degree", "from_in_degree", "from_out_degree",
            "from_clustering_coeff", "from_degree_centrality", "to_degree", "to_in_degree", "to_out_degree",
            "to_clustering_coeff", "to_degree_centrality"]

SCORED = ("scored", """SELECT *, CAST(CASE WHEN Amount_Received * 10 < Amount_Paid * 9.05 THEN 1 ELSE 0 END AS BIGINT)
                         AS Is_Laundering_Prediction FROM enc""")
CONF = ("conf", """SELECT Is_Laundering AS label, Is_Laundering_Prediction AS prediction, count(*) AS n
                   FROM scored GROUP BY 1, 2""")
PER_CLASS = ("pc", """SELECT cls, tp, support, npred,
      CASE WHEN npred = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(npred AS DOUBLE) END AS precision,
      CASE WHEN support = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(support AS DOUBLE) END AS recall
    FROM (SELECT c.cls,
            coalesce((SELECT sum(n) FROM conf WHERE label = c.cls AND prediction = c.cls), 0) AS tp,
            coalesce((SELECT sum(n) FROM conf WHERE label = c.cls), 0) AS support,
            coalesce((SELECT sum(n) FROM conf WHERE prediction = c.cls), 0) AS npred
          FROM (SELECT label AS cls FROM conf UNION SELECT prediction FROM conf) c)""")
PER_CLASS_F1 = ("pcf", """SELECT *, CASE WHEN precision + recall = 0 THEN 0.0
                       ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM pc""")


def _scaled_expr(i: int, x: str) -> str:
    return (f"CASE WHEN r.hi_{i} = r.lo_{i} THEN 0.0 ELSE (CAST(x.{_q(x)} AS DOUBLE) - r.lo_{i}) / (r.hi_{i} - r.lo_{i}) END")


def ml_sql(q: dict[str, str]) -> None:
    q["split_random"] = with_ctes(f"""SELECT row_id,
        CAST(row_number() OVER (ORDER BY md5(concat('42:', CAST(row_id AS VARCHAR))), row_id)
             <= (SELECT (count(*) * 2 + 9) // 10 FROM transactions) AS INTEGER) AS is_test FROM transactions""")
    q["split_stratified"] = with_ctes("""SELECT row_id, "Is Laundering",
        CAST(row_number() OVER (PARTITION BY "Is Laundering" ORDER BY md5(concat('42:', CAST(row_id AS VARCHAR))), row_id)
             <= (count(*) OVER (PARTITION BY "Is Laundering") * 2 + 9) // 10 AS INTEGER) AS is_test FROM transactions""")
    rng = ", ".join(f"min(CAST({_q(x)} AS DOUBLE)) AS lo_{i}, max(CAST({_q(x)} AS DOUBLE)) AS hi_{i}"
                    for i, x in enumerate(FEATURES))
    scaled = ", ".join(f"""CASE WHEN r.hi_{i} = r.lo_{i} THEN 0.0
        ELSE (CAST(x.{_q(x)} AS DOUBLE) - r.lo_{i}) / (r.hi_{i} - r.lo_{i}) END AS {_q(x)}"""
                       for i, x in enumerate(FEATURES))
    q["minmax"] = core(f'SELECT x."Index", {scaled} FROM ({ENRICH_SELECT}) x CROSS JOIN (SELECT {rng} FROM ({ENRICH_SELECT})) r',
                       graph=True)
    keep = f'SELECT x."Index", x.Is_Laundering, [{", ".join(_scaled_expr(i, x) for i, x in enumerate(FEATURES))}] AS v '
    keep += f'FROM ({ENRICH_SELECT}) x CROSS JOIN (SELECT {rng} FROM ({ENRICH_SELECT})) r'
    q["smote_knn"] = core(f"""SELECT "Index", CAST(nn_rank AS INTEGER) AS nn_rank, round(dist, 6) AS dist FROM (
          SELECT a."Index", list_distance(a.v, b.v) AS dist,
            row_number() OVER (PARTITION BY a."Index" ORDER BY list_distance(a.v, b.v), b."Index") AS nn_rank
          FROM sc a JOIN sc b ON a."Index" <> b."Index") WHERE nn_rank <= 5""",
        [("sc", f"SELECT * FROM ({keep}) WHERE Is_Laundering = 1")], graph=True)
    q["smote_rows"] = with_ctes("""SELECT CAST(1 AS BIGINT) AS Is_Laundering,
          count(*) FILTER (WHERE "Is Laundering" = '0') - count(*) FILTER (WHERE "Is Laundering" = '1') AS n_rows,
          CAST(0 AS BIGINT) AS n_outside FROM transactions""")
    q["confusion"] = core("SELECT label, prediction, n AS count FROM conf", [SCORED, CONF])
    r9 = "round({x}, 9)"
    q["classification_report"] = core(f"""
        SELECT CAST(cls AS VARCHAR) AS class, {r9.format(x='precision')} AS precision, {r9.format(x='recall')} AS recall,
               {r9.format(x='f1')} AS f1, CAST(support AS BIGINT) AS support FROM pcf
        UNION ALL SELECT 'accuracy', NULL, NULL,
               round(CASE WHEN sum(support) = 0 THEN 0.0 ELSE CAST(sum(tp) AS DOUBLE) / CAST(sum(support) AS DOUBLE) END, 9),
               CAST(sum(support) AS BIGINT) FROM pcf
        UNION ALL SELECT 'macro avg', round(sum(precision) / count(*), 9), round(sum(recall) / count(*), 9),
               round(sum(f1) / count(*), 9), CAST(sum(support) AS BIGINT) FROM pcf
        UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9),
               round(sum(recall * support) / sum(support), 9), round(sum(f1 * support) / sum(support), 9),
               CAST(sum(support) AS BIGINT) FROM pcf""", [SCORED, CONF, PER_CLASS, PER_CLASS_F1])
    q["binary_metrics"] = core("""SELECT round(precision, 9) AS precision, round(recall, 9) AS recall,
          round(f1, 9) AS f1,
          round((SELECT CAST(sum(n) FILTER (WHERE label = prediction) AS DOUBLE) / CAST(sum(n) AS DOUBLE) FROM conf), 9)
            AS accuracy
        FROM pcf WHERE cls = 1""", [SCORED, CONF, PER_CLASS, PER_CLASS_F1])
    q["score_summary"] = core("""SELECT count(*) FILTER (WHERE Is_Laundering_Prediction = 1) AS n_flagged,
        count(*) AS n_rows FROM scored""", [SCORED])
    q["flagged_rows"] = core("SELECT * FROM scored WHERE Is_Laundering_Prediction = 1", [SCORED])


# --- label encoding, graph merge, run state -------------------------------------------------

LABEL_ENCODED = ["Account", "Account.1", "Receiving Currency", "Payment Currency", "Payment Format"]
BATCH_OF = f"CASE WHEN t.row_id < {CUT} THEN 0 ELSE 1 END"
INDEX_OF = f"t.row_id - CASE WHEN t.row_id < {CUT} THEN 0 ELSE {CUT} END"


def state_sql(q: dict[str, str]) -> None:
    cols = []
    for x in ["row_id", "From Bank", "Account", "To Bank", "Account.1", "Amount Received", "Receiving Currency",
              "Amount Paid", "Payment Currency", "Payment Format", "Is Laundering"]:
        if x in LABEL_ENCODED:
            cols.append(f"CAST(dense_rank() OVER (ORDER BY {_q(x)}) - 1 AS BIGINT) AS {_q(x)}")
        else:
            cols.append(_q(x))
    q["label_encode"] = with_ctes(f"SELECT {', '.join(cols)} FROM transactions")
    enc2 = ("enc2", enc_cte(index=INDEX_OF, batch=BATCH_OF))
    q["graph_merge"] = core("""SELECT From_ID AS src, To_ID AS dst,
        arg_max("Timestamp", batch_id * 1000000000 + "Index") AS "timestamp",
        arg_max(Amount_Paid, batch_id * 1000000000 + "Index") AS amount_sent,
        arg_max(Amount_Received, batch_id * 1000000000 + "Index") AS amount_received,
        arg_max(Receiving_Currency, batch_id * 1000000000 + "Index") AS received_currency,
        arg_max(Payment_Format, batch_id * 1000000000 + "Index") AS payment_format,
        arg_max(batch_id, batch_id * 1000000000 + "Index") AS batch_id,
        arg_max("Index", batch_id * 1000000000 + "Index") AS "Index"
        FROM enc2 GROUP BY From_ID, To_ID""", [enc2])
    q["state_roundtrip"] = core(f"SELECT value, code, {ANCHOR} AS anchor FROM acct")
    q["state_graph"] = q["graph_merge"]
    q["score_batch_enriched"] = core(f"""SELECT x.* REPLACE (x."Index" - {CUT} AS "Index")
        FROM ({ENRICH_SELECT}) x WHERE x."Index" >= {CUT}""", graph=True)
    q["state_update"] = core("""SELECT 'currency' AS domain, value, code FROM cur
        UNION ALL SELECT 'payment_format', value, code FROM fmt
        UNION ALL SELECT 'account', value, code FROM acct""")


# --- sources and sinks -----------------------------------------------------------------------

def io_sql(q: dict[str, str]) -> None:
    q["read_typed"] = with_ctes(f"""SELECT row_id, CAST(epoch({_ts('"Timestamp"')}) AS BIGINT) AS "Timestamp",
        CAST("From Bank" AS INTEGER) AS "From Bank", "Account", CAST("To Bank" AS INTEGER) AS "To Bank", "Account.1",
        CAST("Amount Received" AS DOUBLE) AS "Amount Received", "Receiving Currency",
        CAST("Amount Paid" AS DOUBLE) AS "Amount Paid", "Payment Currency", "Payment Format",
        CAST("Is Laundering" AS INTEGER) AS "Is Laundering" FROM transactions""")
    q["read_inferred"] = q["read_typed"]
    q["read_strings"] = with_ctes("SELECT * FROM transactions_dirty", dirty=True)
    q["snapshot_roundtrip"] = core("SELECT * FROM scored", [SCORED])
    q["json_records"] = core(
        'SELECT "Node", degree, in_degree, out_degree, clustering_coefficient, degree_centrality FROM feat',
        graph=True)
    q["graph_increment"] = core(
        'SELECT "Node", degree, in_degree, out_degree, clustering_coefficient, degree_centrality FROM feat',
        graph=True)
    q["csv_export"] = core("SELECT * FROM scored WHERE Is_Laundering_Prediction = 1", [SCORED])
    q["append_training"] = core(ENCODED_SELECT + ", batch_id FROM enc2",
                                [("enc2", enc_cte(index=INDEX_OF, batch=BATCH_OF))])
    hh = "lpad(CAST((o_orderkey % 86400) // 3600 AS VARCHAR), 2, '0') || lpad(CAST((o_orderkey % 3600) // 60 AS VARCHAR), 2, '0') || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0')"
    q["latest_model"] = f"""WITH l AS (
        SELECT o_custkey AS registry, strftime(o_orderdate, '%Y%m%d') || '_' || {hh} AS version,
               '/registry/' || CAST(o_custkey AS VARCHAR) || '/model_' || strftime(o_orderdate, '%Y%m%d') || '_' || {hh} AS path
        FROM orders)
      SELECT registry, arg_max(path, version) AS latest_path, max(version) AS version FROM l GROUP BY registry"""
    q["stream_score"] = core("""SELECT "Index" AS row_id, From_ID, To_ID, "Timestamp", Amount_Paid, Payment_Currency,
        Amount_Received, Receiving_Currency, Payment_Format, Is_Laundering, Is_Laundering_Prediction
        FROM scored""", [SCORED])
    q["forest_score"] = with_ctes("""SELECT row_id AS "Index", CAST("Is Laundering" AS BIGINT) AS Is_Laundering, true AS has_class
        FROM (SELECT *, row_number() OVER (ORDER BY md5(concat('42:', CAST(row_id AS VARCHAR))), row_id) AS k FROM transactions)
        WHERE k <= (SELECT (count(*) * 2 + 9) // 10 FROM transactions)""")
    q["retrain"] = with_ctes(f"""SELECT CAST(b AS BIGINT) AS batch_id, count(*) AS n_rows, CAST(2 AS BIGINT) AS n_models
        FROM (SELECT CASE WHEN row_id < {CUT} THEN 0 ELSE 1 END AS b FROM transactions) GROUP BY b""")
    q["stream_model"] = with_ctes("""SELECT row_id, CAST("Is Laundering" AS BIGINT) AS Is_Laundering, true AS as_saved FROM transactions""")
    test_rows = """SELECT CAST("Is Laundering" AS VARCHAR) AS y FROM (SELECT *, row_number() OVER (
        ORDER BY md5(concat('42:', CAST(row_id AS VARCHAR))), row_id) AS k FROM transactions)
        WHERE k <= (SELECT (count(*) * 2 + 9) // 10 FROM transactions)"""
    q["model_report"] = with_ctes(f"""SELECT y AS class, count(*) AS support, true AS stored FROM ({test_rows}) GROUP BY y
        UNION ALL SELECT 'accuracy', count(*), true FROM ({test_rows})""")
    q["latent_oversample"] = with_ctes("""SELECT row_id AS "Index", CAST(1 AS BIGINT) AS Is_Laundering,
        CAST(1 AS INTEGER) AS is_synthetic, true AS in_range FROM transactions WHERE "Is Laundering" = '1'""")


# --- data validation ---------------------------------------------------------------------------

NUMERIC_T = {"Timestamp": "INT", "From Bank": "INT", "To Bank": "INT", "Amount Received": "FLOAT",
             "Amount Paid": "FLOAT", "Is Laundering": "INT"}
TEXT_T = ["Account", "Account.1", "Receiving Currency", "Payment Currency", "Payment Format"]
TYPED_COLS = {"Timestamp": f"CAST(epoch(try_strptime(\"Timestamp\", '%Y/%m/%d %H:%M')) AS BIGINT)",
              "From Bank": 'TRY_CAST("From Bank" AS INTEGER)', "To Bank": 'TRY_CAST("To Bank" AS INTEGER)',
              "Amount Received": 'TRY_CAST("Amount Received" AS DOUBLE)',
              "Amount Paid": 'TRY_CAST("Amount Paid" AS DOUBLE)',
              "Is Laundering": 'TRY_CAST("Is Laundering" AS INTEGER)'}


def typed(src: str) -> str:
    cols = ", ".join(f"{TYPED_COLS[x]} AS {_q(x)}" if x in TYPED_COLS else _q(x) for x in RAW)
    return f"SELECT {cols} FROM {src}"


def profile_sql(src: str, numeric: list[str], text: list[str]) -> str:
    parts = []
    for x in numeric:
        v = f"CAST({_q(x)} AS DOUBLE)"
        stats = {"count": f"count({v})", "missing": f"count(*) FILTER (WHERE {v} IS NULL)",
                 "mean": f"round(avg({v}), 6)", "std_dev": f"round(stddev_pop({v}), 6)",
                 "num_zeros": f"count(*) FILTER (WHERE {v} = 0)", "min": f"min({v})",
                 "median": f"round(quantile_cont({v}, 0.5), 6)", "max": f"max({v})"}
        for s, e in stats.items():
            parts.append(f"SELECT {_lit(x)} AS feature, {_lit(s)} AS stat, CAST({e} AS DOUBLE) AS num_value, "
                         f"CAST(NULL AS VARCHAR) AS str_value FROM {src}")
    for x in text:
        vc = f"(SELECT {_q(x)} AS v, count(*) AS n FROM {src} GROUP BY 1)"
        stats = {"count": "sum(n) FILTER (WHERE v IS NOT NULL)", "missing": "coalesce(sum(n) FILTER (WHERE v IS NULL), 0)",
                 "unique": "count(v)", "top_freq": "max(n) FILTER (WHERE v IS NOT NULL)",
                 "avg_length": "round(sum(length(v) * n) / sum(n) FILTER (WHERE v IS NOT NULL), 6)"}
        for s, e in stats.items():
            parts.append(f"SELECT {_lit(x)} AS feature, {_lit(s)} AS stat, CAST({e} AS DOUBLE) AS num_value, "
                         f"CAST(NULL AS VARCHAR) AS str_value FROM {vc}")
        parts.append(f"SELECT {_lit(x)} AS feature, 'top_value' AS stat, CAST(NULL AS DOUBLE) AS num_value, "
                     f"first(v ORDER BY n DESC, v ASC) FILTER (WHERE v IS NOT NULL) AS str_value FROM {vc}")
    return _union(parts)


def hist_sql(src: str, numeric: list[str], ranges: str | None = None) -> str:
    parts = []
    for x in numeric:
        v = f"CAST({_q(x)} AS DOUBLE)"
        rng = ranges.format(f=_lit(x)) if ranges else f"(SELECT min({v}) AS lo, max({v}) AS hi FROM {src})"
        parts.append(f"""SELECT {_lit(x)} AS feature, CAST(CASE WHEN r.hi = r.lo THEN 0
              ELSE least(floor(({v} - r.lo) / (r.hi - r.lo) * 10), 9) END AS INTEGER) AS bucket, count(*) AS count
            FROM {src} CROSS JOIN {rng} r WHERE {v} IS NOT NULL GROUP BY 2""")
    return _union(parts)


def quality_sql(q: dict[str, str]) -> None:
    num = list(NUMERIC_T)
    tv = ("tv", typed("transactions"))
    trv = ("trv", typed(f"(SELECT * FROM transactions WHERE row_id < {CUT})"))
    nwv = ("nwv", typed(f"(SELECT * FROM transactions WHERE row_id >= {CUT})"))
    dnv = ("dnv", typed(f"(SELECT * FROM transactions_dirty WHERE row_id >= {CUT})"))
    q["profile_stats"] = with_ctes(profile_sql("tv", num, TEXT_T), tv)
    q["profile_running"] = with_ctes(f"""SELECT feature, stat, CASE WHEN stat IN ('unique', 'median') THEN 1.0 ELSE num_value END AS num_value
          FROM ({profile_sql("tv", num, TEXT_T)}) WHERE stat NOT IN ('top_freq', 'top_value')
          UNION ALL """ + _union([f"SELECT {_lit(x)} AS feature, 'unique' AS stat, CAST(1.0 AS DOUBLE) AS num_value" for x in num]), tv)
    q["profile_top_values"] = with_ctes(_union([f"""SELECT {_lit(x)} AS feature, CAST(k AS INTEGER) AS rank, value, count FROM (
          SELECT {_q(x)} AS value, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, {_q(x)}) AS k
          FROM tv WHERE {_q(x)} IS NOT NULL GROUP BY 1) WHERE k <= 10""" for x in TEXT_T]), tv)
    q["profile_quantiles"] = with_ctes(_union([f"""SELECT {_lit(x)} AS feature, CAST({i / 10} AS DOUBLE) AS q,
          round(quantile_cont(CAST({_q(x)} AS DOUBLE), {i / 10}), 6) AS value FROM tv""" for x in num for i in range(11)]), tv)
    q["profile_slice"] = with_ctes(profile_sql("tv", [], ["Payment Currency", "Receiving Currency"]), tv)
    q["histograms"] = with_ctes(hist_sql("tv", num), tv)
    trs = ("trs", profile_sql("trv", num, TEXT_T))
    exp_body = """SELECT feature,
          CASE feature {types} END AS type,
          max(num_value) FILTER (WHERE stat = 'missing') = 0 AS required,
          max(num_value) FILTER (WHERE stat = 'min') AS min, max(num_value) FILTER (WHERE stat = 'max') AS max,
          CAST(max(num_value) FILTER (WHERE stat = 'unique') AS BIGINT) AS n_values,
          CAST(CASE WHEN max(num_value) FILTER (WHERE stat = 'unique') <= 100
               THEN max(num_value) FILTER (WHERE stat = 'unique') END AS BIGINT) AS domain_size
        FROM {{src}} GROUP BY feature""".format(types=" ".join(
        f"WHEN {_lit(k)} THEN {_lit(v)}" for k, v in {**NUMERIC_T, **{t: "BYTES" for t in TEXT_T}}.items()))
    q["schema_inferred"] = with_ctes(exp_body.format(src="tvs"), tv, ("tvs", profile_sql("tv", num, TEXT_T)))
    exp = ("exp", exp_body.format(src="trs"))
    parts = []
    for x in num + TEXT_T:
        parts.append(f"""SELECT {_lit(x)} AS feature, 'missing_values' AS anomaly, CAST(NULL AS VARCHAR) AS value,
              count(*) AS count FROM dnv WHERE {_q(x)} IS NULL
              AND (SELECT required FROM exp WHERE feature = {_lit(x)}) HAVING count(*) > 0""")
    for x in num:
        v = f"CAST({_q(x)} AS DOUBLE)"
        parts.append(f"""SELECT {_lit(x)}, 'below_min', CAST(NULL AS VARCHAR), count(*) FROM dnv
              WHERE {v} < (SELECT min FROM exp WHERE feature = {_lit(x)}) HAVING count(*) > 0""")
        parts.append(f"""SELECT {_lit(x)}, 'above_max', CAST(NULL AS VARCHAR), count(*) FROM dnv
              WHERE {v} > (SELECT max FROM exp WHERE feature = {_lit(x)}) HAVING count(*) > 0""")
    for x in TEXT_T:
        parts.append(f"""SELECT {_lit(x)}, 'unexpected_value', {_q(x)}, count(*) FROM dnv
              WHERE {_q(x)} IS NOT NULL AND (SELECT domain_size FROM exp WHERE feature = {_lit(x)}) IS NOT NULL
              AND {_q(x)} NOT IN (SELECT {_q(x)} FROM trv WHERE {_q(x)} IS NOT NULL) GROUP BY {_q(x)}""")
        parts.append(f"""SELECT {_lit(x)}, 'no_domain', CAST(NULL AS VARCHAR), n_values FROM exp
              WHERE feature = {_lit(x)} AND domain_size IS NULL""")
    q["anomalies"] = with_ctes(_union(parts), trv, dnv, trs, exp, dirty=True)
    nws = ("nws", profile_sql("nwv", num, TEXT_T))
    q["compare_profiles"] = with_ctes("""SELECT coalesce(a.feature, b.feature) AS feature, coalesce(a.stat, b.stat) AS stat,
          a.num_value AS lhs_num, a.str_value AS lhs_str, b.num_value AS rhs_num, b.str_value AS rhs_str
        FROM trs a FULL OUTER JOIN nws b ON a.feature = b.feature AND a.stat = b.stat""", trv, nwv, trs, nws)
    parts = []
    for x in TEXT_T:
        parts.append(f"""SELECT {_lit(x)} AS feature, 'linf' AS metric, round(max(abs(coalesce(p, 0) - coalesce(qq, 0))), 9) AS value
            FROM (SELECT {_q(x)} AS v, count(*) / sum(count(*)) OVER () AS p FROM trv WHERE {_q(x)} IS NOT NULL GROUP BY 1) a
            FULL OUTER JOIN (SELECT {_q(x)} AS v, count(*) / sum(count(*)) OVER () AS qq FROM nwv WHERE {_q(x)} IS NOT NULL GROUP BY 1) b
            USING (v)""")
    for x in num:
        v = f"CAST({_q(x)} AS DOUBLE)"
        rng = f"(SELECT min(x) AS lo, max(x) AS hi FROM (SELECT {v} AS x FROM trv UNION ALL SELECT {v} FROM nwv))"
        hb = """(SELECT CASE WHEN r.hi = r.lo THEN 0 ELSE least(floor(({v} - r.lo) / (r.hi - r.lo) * 10), 9) END AS b,
                   count(*) AS n FROM {src} CROSS JOIN {rng} r WHERE {v} IS NOT NULL GROUP BY 1)"""
        ha, hbb = hb.format(v=v, src="trv", rng=rng), hb.format(v=v, src="nwv", rng=rng)
        parts.append(f"""SELECT {_lit(x)} AS feature, 'js_divergence' AS metric, round(sum(
              (CASE WHEN p > 0 THEN p * log2(p / ((p + qq) / 2)) ELSE 0 END
             + CASE WHEN qq > 0 THEN qq * log2(qq / ((p + qq) / 2)) ELSE 0 END) / 2), 9) AS value
            FROM (SELECT coalesce(a.n, 0) / sum(coalesce(a.n, 0)) OVER () AS p,
                         coalesce(c.n, 0) / sum(coalesce(c.n, 0)) OVER () AS qq
                  FROM {ha} a FULL OUTER JOIN {hbb} c USING (b))""")
    q["drift"] = with_ctes(_union(parts), trv, nwv)
