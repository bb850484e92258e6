"""The ``transactions`` fixture: raw transfer records derived from the driver tables.

Customers and suppliers share one account namespace, so the derived graph has
triangles, two-way pairs and self-loops. ``row_id`` is the file order of the raw
records; it comes from the distributed index, never from a single-task window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rank import with_row_index
from ..session import shuffle_partitions

# Transfers of one task where they are joined and ordered: partitions grow in number, not in size.
TASK_ROWS = 400_000
# Orders up to this many are broadcast to their lines.
BROADCAST_ORDERS = 200_000

# Raw column names of the transfer records, in file order.
RAW_COLUMNS = [
    "Timestamp", "From Bank", "Account", "To Bank", "Account.1", "Amount Received",
    "Receiving Currency", "Amount Paid", "Payment Currency", "Payment Format", "Is Laundering",
]

# The total order that defines row_id.
ORDER_COLUMNS = [
    "o_orderdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
    "l_quantity", "l_shipdate", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]

# Currency names by nation key mod 5.
CURRENCY_CASE = ("CASE {k} % 5 WHEN 0 THEN 'US Dollar' WHEN 1 THEN 'Euro' WHEN 2 THEN 'Yuan' "
                 "WHEN 3 THEN 'Yen' ELSE 'Bitcoin' END")

RAW_EXPRS = {
    "Timestamp": "date_format(o_orderdate, 'yyyy/MM/dd HH:mm')",
    "From Bank": "lpad(CAST(o_custkey % 10 AS STRING), 3, '0')",
    "Account": "concat('8', lpad(hex(o_custkey), 8, '0'))",
    "To Bank": "lpad(CAST(l_suppkey % 10 AS STRING), 3, '0')",
    "Account.1": "concat('8', lpad(hex(l_suppkey), 8, '0'))",
    "Amount Received": ("CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (CAST(1 AS DECIMAL(4,2)) "
                        "- CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS STRING)"),
    "Receiving Currency": CURRENCY_CASE.format(k="s_nationkey"),
    "Amount Paid": "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING)",
    "Payment Currency": CURRENCY_CASE.format(k="c_nationkey"),
    "Payment Format": "o_orderpriority",
    "Is Laundering": "CASE WHEN l_returnflag = 'R' AND l_discount >= 0.1 THEN '1' ELSE '0' END",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row_id (long) + the 11 raw string columns."""
    return transactions_n(spark, sf_dir)[0]


_MEMO: dict[tuple[str, str], tuple[DataFrame, int, str]] = {}


def transactions_n(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """(transactions, number of rows); the count comes free with the row index.

    The table stands in for the raw input file, so it is built once per Spark application
    and scale factor and then read from its written copy in the shared checkpoint folder.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key in _MEMO:
        df, n, path = _MEMO[key]
        if _exists(spark, path):
            return df, n
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    tasks = max(shuffle_partitions(spark), -(-li.count() // TASK_ROWS))
    small = o.count() <= BROADCAST_ORDERS
    # Customers meet the orders, a quarter of the rows; only what the order needs goes through the range
    # exchange; suppliers are joined after it, and the text columns built, in the parallel write stage.
    o = o.join(c, o.o_custkey == c.c_custkey).drop("c_custkey")
    if small:
        o = F.broadcast(o)
    else:  # a join that shuffles gets partitions of a bounded size
        li, o = li.repartition(tasks, "l_orderkey"), o.repartition(tasks, "o_orderkey")
    src = li.join(o, li.l_orderkey == o.o_orderkey).select(*ORDER_COLUMNS, "o_custkey", "o_orderpriority", "c_nationkey")

    def text(d: DataFrame) -> DataFrame:
        d = d.join(s, F.col("l_suppkey") == s.s_suppkey)
        return d.select("_ll_pid", "_ll_pos", *[F.expr(e).alias(k) for k, e in RAW_EXPRS.items()])

    indexed, n = with_row_index(src, ORDER_COLUMNS, name="row_id", num_partitions=tasks, return_count=True, post=text)
    out = _select_raw(indexed)
    path = _source_path(indexed)
    if path:
        _MEMO[key] = (out, n, path)
    return out, n


def _select_raw(df: DataFrame) -> DataFrame:
    return df.select("row_id", *[F.col(f"`{c}`") for c in RAW_COLUMNS])


def _source_path(df: DataFrame) -> str | None:
    files = df.inputFiles()
    return files[0].rsplit("/", 1)[0] if files else None


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def dirty(df: DataFrame) -> DataFrame:
    """``transactions_dirty``: NULL amount paid, negative amount received, bad timestamps."""
    return df.select(
        "row_id",
        F.when(F.col("row_id") % 83 == 0, F.concat(F.lit("bad:"), F.col("Timestamp")))
         .otherwise(F.col("Timestamp")).alias("Timestamp"),
        *[F.col(f"`{c}`") for c in RAW_COLUMNS[1:5]],
        F.when(F.col("row_id") % 89 == 0, F.concat(F.lit("-"), F.col("`Amount Received`")))
         .otherwise(F.col("`Amount Received`")).alias("Amount Received"),
        F.col("`Receiving Currency`"),
        F.when(F.col("row_id") % 97 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("`Amount Paid`")).alias("Amount Paid"),
        *[F.col(f"`{c}`") for c in RAW_COLUMNS[8:]],
    )


def transactions_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty(transactions(spark, sf_dir))


def train_cut(n_rows: int) -> int:
    """Rows with row_id below this belong to the training batch (first 20 % in time order)."""
    return (n_rows * 2 + 9) // 10  # ceil(0.2 * n)


def batches(df: DataFrame, n_rows: int | None = None) -> tuple[DataFrame, DataFrame, int, int]:
    """Split by time order: (train batch, score batch, cut, n_rows)."""
    if n_rows is None:
        n_rows = df.count()
    cut = train_cut(n_rows)
    return df.where(F.col("row_id") < cut), df.where(F.col("row_id") >= cut), cut, n_rows
