"""Plan checks: pushdown, no Python on the hot path, no single-task sort of whole tables."""

from ledgerline.sources.fixtures import table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_has_no_python_udf(spark):
    import __spark_entry__ as E
    p = plan(E.entry(spark))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_scan_prunes_columns_and_pushes_filters(spark):
    from pyspark.sql import functions as F
    li = table(spark, "/root/testdata/sf0.001", "lineitem")
    s = plan(li.where(F.col("l_discount") >= 0.1).select("l_orderkey"))
    assert "PushedFilters" in s and "l_discount" in s
    assert "ReadSchema: struct<l_orderkey:bigint,l_discount:double>" in s


def test_entry_schema_is_stable(spark):
    import __spark_entry__ as E
    from ledgerline.plans.pipeline import ENRICHED_COLUMNS
    df = E.entry(spark)
    assert df.columns == ENRICHED_COLUMNS and len(df.columns) == 20
    kinds = dict(df.dtypes)
    assert kinds["from_degree"] == "bigint" and kinds["to_clustering_coeff"] == "double" and kinds["Is_Laundering"] == "bigint"


def test_registered_forests_are_whole(spark, monkeypatch):
    """The registered queries grow the operator's own forest: 100 trees to depth 30."""
    import inspect

    import pytest

    from ledgerline.operators import model
    from ledgerline.plans import catalog, jobs

    class Asked(Exception):
        pass

    signature = inspect.signature(model.train_forest)

    def asked(*args, **kw):
        bound = signature.bind(*args, **kw)
        bound.apply_defaults()
        raise Asked(bound.arguments["num_trees"], bound.arguments["max_depth"])

    monkeypatch.setattr(catalog, "_REGISTRIES", {})
    monkeypatch.setattr(model, "train_forest", asked)
    monkeypatch.setattr(jobs, "smote", lambda rows, *args, **kw: rows.limit(0).selectExpr("*", "1 AS is_synthetic"))
    for query in (catalog.q_forest_score, catalog.q_retrain):
        with pytest.raises(Asked) as got:
            query(spark, "/root/testdata/sf0.001")
        assert got.value.args == (100, 30)
