"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingles.

Method, all in DataFrame functions: benchmark items are partitioned by their number of distinct
five-word shingles (powers of two). An item's sketch is its smallest shingle hashes; a partition's
sketch size comes from its upper size bound, so that a document holding at least ``threshold`` of
any item's shingles cannot miss the sketch: if k shingles may be absent, one of any k + 1 is there.
The search is therefore complete for short items inside documents of any length. Candidates are
verified by counting the item's shingles, as text, in the candidate document.

Words are runs of letters and digits of the lower-cased text. The sketches are broadcast after they
were counted, and joined by a shuffle beyond that bound; every document's shingles are read in
place and only hits travel.

Defined results: items with fewer than five words have no shingle and match nothing; null or empty
documents have none; documents are told apart by (id, text), repeated rows give one row; null ids
are kept; two items with equal shingles are both reported; extra columns are ignored; empty
tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import counted_broadcast, materialize, order_hash, require

SHINGLE = 5
THRESHOLD = 0.8
MARKS = "[^\\p{L}\\p{N}]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), MARKS), "")


def _places(w: Column, shingle: int) -> Column:
    return F.when(F.size(w) >= shingle, F.sequence(F.lit(0), F.size(w) - shingle)).otherwise(F.array().cast("array<int>"))


def shingle_hashes(w: Column, shingle: int = SHINGLE) -> Column:
    return F.array_distinct(F.transform(_places(w, shingle), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(shingle)])))


def shingle_texts(w: Column, shingle: int = SHINGLE) -> Column:
    return F.array_distinct(F.transform(_places(w, shingle), lambda i: F.concat_ws(" ", *[F.get(w, i + k) for k in range(shingle)])))


def item_shingles(items: DataFrame, item_id: str, text: str, shingle: int) -> DataFrame:
    """(item_id, item_hash, n, h, s): one row per distinct shingle of an item; n is their number."""
    rows = items.select(F.col(f"`{item_id}`").alias("item_id"), order_hash(F.col(f"`{text}`")).alias("item_hash"),
                        words(F.col(f"`{text}`")).alias("w")).distinct()
    rows = rows.withColumn("sh", shingle_texts(F.col("w"), shingle))
    rows = rows.select("item_id", "item_hash", F.size("sh").alias("n"), F.explode("sh").alias("s"))
    return rows.withColumn("h", F.xxhash64(*[F.get(F.split("s", " "), F.lit(k)) for k in range(shingle)]))


def sketches(shingles: DataFrame, threshold: float) -> DataFrame:
    """The smallest hashes of every item; as many as its size partition's upper bound asks for."""
    part = F.floor(F.log2(F.col("n"))).cast("int")
    upper = F.pow(F.lit(2.0), part + 1) - 1
    size = F.floor(upper * (1 - threshold) + 1e-9).cast("int") + 1
    w = Window.partitionBy("item_id", "item_hash").orderBy("h", "s")
    return shingles.withColumn("k", F.row_number().over(w)).where(F.col("k") <= size).select("item_id", "item_hash", "h")


def contaminated(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id",
                 item_id: str = "item_id", item_text: str = "text", shingle: int = SHINGLE,
                 threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, text_hash, item_id, n_shingles, n_found, containment) of every leak."""
    require(docs, text, doc_id)
    require(items, item_id, item_text)
    items = materialize(item_shingles(items, item_id, item_text, shingle), "leaks-items")
    sketch = counted_broadcast(materialize(sketches(items, threshold), "leaks-sketches"))
    body = F.col(f"`{text}`").cast("string")
    keyed = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), order_hash(body).alias("text_hash"), body.alias("body"))
    split = keyed.select("doc_id", "text_hash", words(F.col("body")).alias("w"))
    hashed = split.select("doc_id", "text_hash", F.explode(shingle_hashes(F.col("w"), shingle)).alias("h"))
    found = materialize(hashed.join(sketch, "h").select("doc_id", "text_hash", "item_id", "item_hash").distinct(),
                        "leaks-candidates")
    # Exact check, on the candidate documents only.
    pairs = counted_broadcast(found.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("t")).distinct(), 20_000)
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t"))
    texts = keyed.join(pairs, same, "left_semi").select("doc_id", "text_hash", words(F.col("body")).alias("w"))
    texts = texts.select("doc_id", "text_hash", F.explode(shingle_texts(F.col("w"), shingle)).alias("s"))
    hits = texts.join(counted_broadcast(items), "s").groupBy("doc_id", "text_hash", "item_id", "item_hash", "n").agg(
        F.count_distinct("s").alias("n_found"))
    hits = hits.where(F.col("n_found") >= threshold * F.col("n") - 1e-9)
    return hits.select("doc_id", "text_hash", "item_id", F.col("n").cast("long").alias("n_shingles"), "n_found",
                       (F.col("n_found") / F.col("n")).alias("containment")).distinct()


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", **kw) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    hits = contaminated(docs, items, text, doc_id, **kw)
    hits = materialize(hits.select(F.col("doc_id").alias("_ll_id"), F.col("text_hash").alias("_ll_hash")).distinct(), "leaks")
    body = F.col(f"`{text}`").cast("string")
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col("_ll_id")) & (order_hash(body) == F.col("_ll_hash"))
    return docs.join(counted_broadcast(hits, 20_000), same, "left_anti")


ORACLE_SQL = f"""
WITH iw AS (
  SELECT item_id, [x FOR x IN regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+') IF x <> ''] AS w FROM benchmark
), its AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + {SHINGLE - 1}], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - {SHINGLE - 2})) AS i FROM iw WHERE len(w) >= {SHINGLE})
), n AS (
  SELECT item_id, count(*) AS n FROM its GROUP BY item_id
), dw AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+') IF x <> ''] AS w FROM documents
), ds AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + {SHINGLE - 1}], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {SHINGLE - 2})) AS i FROM dw WHERE len(w) >= {SHINGLE})
)
SELECT doc_id, item_id, n AS n_shingles, count(*) AS n_found, count(*) / n AS containment
FROM ds JOIN its USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n HAVING count(*) >= {THRESHOLD} * n - 1e-9
"""
