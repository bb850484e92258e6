"""Registered queries against their DuckDB oracle SQL on the smallest scale factor."""

import duckdb
import pytest

from tools.compare import digest

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]
SF = "/root/testdata/sf0.001"
CHECKED = ["encode_first_seen", "clustering", "node_features", "enrich", "dict_extend", "graph_merge",
           "describe_all", "amount_summary", "quality_report", "split_stratified", "classification_report",
           "drift", "anomalies", "read_strings", "label_encode", "schema_inferred", "profile_top_values", "profile_quantiles",
           "state_graph", "state_update", "score_batch_enriched", "smote_knn", "smote_rows", "latent_oversample",
           "describe_numeric", "head_positive"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_oracle(spark, con, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SF)
    rows, cols = [tuple(r) for r in df.collect()], df.columns
    cur = con.execute(E.oracle_sql()[name])
    ocols, orows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(cols, rows)[0] == digest(ocols, orows)[0]


def test_every_oracle_key_is_a_query():
    import __spark_entry__ as E
    assert set(E.oracle_sql()) <= set(E.queries())
