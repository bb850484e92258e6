"""Readers (S1, S2, S3, S5, P1, P3): transfer files, table snapshots, JSON records.

Raw transfer files carry two columns both named ``Account``; Spark would rename them, so
files are always read with an explicit positional schema (the header line is skipped,
names come from the schema). Short rows are padded with NULLs (PERMISSIVE mode).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import TS_FORMAT, c, parse_ts
from .fixtures import RAW_COLUMNS

RAW_SCHEMA = T.StructType([T.StructField(x, T.StringType()) for x in RAW_COLUMNS])

# Column types of a typed read (banks are numeric codes, label is 0/1).
TYPED = {
    "From Bank": "int", "To Bank": "int", "Amount Received": "double", "Amount Paid": "double",
    "Is Laundering": "int",
}


def read_transactions(spark: SparkSession, path: str, typed: bool = False, with_row_id: bool = False) -> DataFrame:
    """S1 (typed) / S2 (all strings). ``with_row_id`` expects a leading ``row_id`` column."""
    fields = ([T.StructField("row_id", T.LongType())] if with_row_id else []) + list(RAW_SCHEMA.fields)
    df = (spark.read.schema(T.StructType(fields)).option("header", True).option("enforceSchema", True)
          .option("mode", "PERMISSIVE").csv(path))
    return cast_typed(df) if typed else df


def cast_typed(df: DataFrame) -> DataFrame:
    """Cast map for a typed read; the timestamp text becomes a timestamp."""
    out = []
    for x in df.columns:
        if x == "Timestamp":
            out.append(parse_ts(x).alias(x))
        elif x in TYPED:
            out.append(F.expr(f"try_cast(`{x}` AS {TYPED[x]})").alias(x))
        else:
            out.append(c(x))
    return df.select(*out)


# Candidate types of a text column, narrowest first; a column gets the first that all its values fit.
NUMBER_TYPES = ["int", "bigint", "double"]
# Candidate patterns of dates and times, tried in this order.
TIME_FORMATS = [
    "yyyy/MM/dd HH:mm", "yyyy/MM/dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd'T'HH:mm:ss",
    "MM/dd/yyyy HH:mm", "dd/MM/yyyy HH:mm", "dd.MM.yyyy HH:mm", "yyyy/MM/dd", "yyyy-MM-dd", "MM/dd/yyyy", "dd/MM/yyyy", "dd.MM.yyyy",
]

# What every text that is read as a number looks like; only such texts are tried, a failed try is a costly exception.
_BLANK = r"[\x00-\x20\x7F]*"
NUMBER_SHAPES = {
    "int": f"^{_BLANK}[+-]?0*[0-9]{{1,10}}{_BLANK}$", "bigint": f"^{_BLANK}[+-]?0*[0-9]{{1,19}}{_BLANK}$",
    "double": f"^{_BLANK}[+-]?([0-9.]+([eE][+-]?[0-9]+)?[dDfF]?|0[xX].*|[iInN].*){_BLANK}$",
}
# What the letters of a time pattern can stand for at most; the other fields have two digits.
FIELD_SHAPES = {"y": "[+-]?[0-9]{4,}", "M": "[+-]?0*(?:1[0-2]|[0-9])"}


def time_shape(pattern: str) -> str:
    """A regular expression that every text of this time pattern matches (and some others may)."""
    def part(m: re.Match) -> str:
        quoted, letters = m.group(1), m.group(2)
        if quoted is not None:
            return re.escape(quoted)
        return FIELD_SHAPES.get(letters[0], "[+-]?0*[0-9]{1,2}") if letters else re.escape(m.group(0))

    return re.sub(r"'([^']*)'|([A-Za-z]+)|.", part, pattern)


def infer_types(df: DataFrame) -> dict[str, tuple[str, str | None]]:
    """(type, time pattern) of every column of a table of texts, from one aggregate over all its rows.

    Counts say how many values fit each candidate, and the narrowest that fits all of them is taken: int, bigint,
    double, boolean, timestamp with its pattern, else string. Blank texts count as missing; a column without any
    value is a string. Where day and month could be swapped, the values decide and the order of the
    patterns breaks ties.
    """
    df = as_strings(df)
    # Only a text of the right shape is parsed: a failed parse costs a hundred times as much as the look.
    shapes = {p: time_shape(p) for p in TIME_FORMATS}
    any_shape = "^(?:" + "|".join(shapes.values()) + ")$"
    texts = df.select(*[F.when(F.trim(c(x)) != "", F.trim(c(x))).alias(f"_ll_t{i}") for i, x in enumerate(df.columns)])
    texts = texts.select("*", *[F.when(c(x).rlike(any_shape), c(x)).alias(x.replace("_ll_t", "_ll_d")) for x in texts.columns])
    aggs = []
    for i in range(len(df.columns)):
        text, dated = F.col(f"_ll_t{i}"), F.col(f"_ll_d{i}")
        aggs.append(F.count(text).alias(f"{i}|n"))
        aggs += [F.count(F.when(text.rlike(NUMBER_SHAPES[t]), text.try_cast(t))).alias(f"{i}|{t}") for t in NUMBER_TYPES]
        aggs.append(F.count_if(F.lower(text).isin("true", "false")).alias(f"{i}|boolean"))
        aggs += [F.count(F.when(dated.rlike(f"^{s}$"), parse_ts(dated, p))).alias(f"{i}|{p}") for p, s in shapes.items()]
    got = texts.agg(*aggs).first().asDict()  # a few counts per column
    out: dict[str, tuple[str, str | None]] = {}
    for i, x in enumerate(df.columns):
        n = got[f"{i}|n"]
        fits = [t for t in [*NUMBER_TYPES, "boolean", *TIME_FORMATS] if n and got[f"{i}|{t}"] == n]
        first = fits[0] if fits else "string"
        out[x] = ("timestamp", first) if first in TIME_FORMATS else (first, None)
    return out


def cast_columns(df: DataFrame, types: dict[str, tuple[str, str | None]]) -> DataFrame:
    """Cast text columns to inferred or given (type, time pattern); other columns stay."""
    def cast(x: str):
        kind, pattern = types[x]
        if kind == "string":
            return c(x)
        text = F.when(F.trim(c(x)) != "", F.trim(c(x)))
        return (parse_ts(text, pattern) if pattern else text.try_cast(kind)).alias(x)

    return df.select(*[cast(x) if x in types else c(x) for x in df.columns])


def read_inferred(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A delimited file whose types nobody declared: all rows are read as text, types inferred, then cast.

    ``columns``: names by position (the raw transfer columns by default; their header repeats a name).
    """
    schema = T.StructType([T.StructField(x, T.StringType()) for x in columns or RAW_COLUMNS])
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)
    return cast_columns(df, infer_types(df))


def as_strings(df: DataFrame) -> DataFrame:
    """Every column as text (NULL stays NULL)."""
    return df.select(*[c(x).cast("string").alias(x) for x in df.columns])


def read_snapshot(spark: SparkSession, uri: str) -> DataFrame:
    """S3: a table snapshot on any Hadoop file system."""
    return spark.read.parquet(uri)


def parse_records(df: DataFrame, col: str, schema: T.StructType | str, single_quotes: bool = False) -> DataFrame:
    """A column of JSON record arrays (or single records) -> one row per record."""
    opts = {"allowSingleQuotes": "true"} if single_quotes else {}
    if not isinstance(schema, T.StructType):
        schema = T.StructType.fromDDL(schema)
    arr = F.from_json(c(col), T.ArrayType(schema), opts)
    one = F.from_json(c(col), schema, opts)
    parsed = F.when(F.trim(c(col)).startswith("["), arr).otherwise(F.array(one))
    return df.select(F.inline(parsed))


__all__ = ["read_transactions", "read_snapshot", "parse_records", "cast_typed", "cast_columns", "as_strings",
           "infer_types", "read_inferred",
           "RAW_SCHEMA", "TS_FORMAT"]
