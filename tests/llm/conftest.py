import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def _code(spark):
    from ledgerline.llm.common import ship_code
    ship_code(spark)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank, tiny and very long texts, repeated rows, clashing extra columns."""
    long_text = " ".join(f"word{i % 997} and{i % 13}" for i in range(30_000))
    rows = [
        (1, None, None, None, None, "x"), (2, "", "en", "s", 0, None), (3, " \t\n\x0b ", "en", "s", 5, "x"),
        (4, "a", "en", "s", 1, "x"), (5, "one two three", None, "s", 13, "x"), (6, long_text, "en", "s", len(long_text), "x"),
        (6, long_text, "en", "s", len(long_text), "x"), (None, "no id here at all, but words", "en", None, None, "x"),
        (None, None, None, None, None, None), (7, "one two three", "en", "t", 13, "y"), (8, "***", "de", "s", 3, "x"),
        (9, "l one a\nl two b\nl three c\nend", "en", "s", 30, "x"), (10, "l one a\nl two b\nl three c\nother end", "en", "s", 36, "x"),
    ]
    names = "doc_id long, text string, lang string, source string, n_chars long, "
    clash = ("score", "lang_pred", "held_out", "n_lines", "n_removed", "fp", "h", "id", "words", "part", "kept", "shard")
    df = spark.createDataFrame(rows, names + "extra string")
    return df.selectExpr("*", *[f"concat('keep ', extra) AS {c}" for c in clash])
