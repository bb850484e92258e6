"""Line dedup by winnowing: later repeats of runs of lines are deleted.

Method, all in DataFrame functions: every line with a word (trimmed) is hashed; of each window of
``WINDOW`` consecutive lines the smallest hash (the rightmost on ties) is selected, so any run of
``WINDOW`` lines that two places share gives both the same fingerprint. Fingerprints that occur
once in the corpus are dropped; around the others the match is extended both ways: every window
that the fingerprint stands for is compared, by all its line hashes, with the first place of the
same lines. A line covered by a window that also starts earlier (smaller id, or same document and
earlier line) is deleted, so what goes is exactly the later repeats of runs of WINDOW lines or more.

A place is compared with the first place of its lines only, never pair by pair: counts and first
places are pre-aggregated before the shuffle and joined back from a written table, whose hot
keys Spark's skew join can split.

Defined results: null text: stays null, no lines; text without lines of words, or with fewer than
WINDOW: unchanged; lines without a word do not count, and go from texts that lose lines; documents are
told apart by (id, text): repeated rows count once and get the same result; null ids come first;
extra columns pass through; an input column named like an output column is replaced; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import counted_broadcast, materialize, order_hash, require

#: Consecutive lines of a guaranteed match.
WINDOW = 3
SPACES = " \t\n\x0b\f\r"


def word_lines(text: Column) -> Column:
    """The lines that have a word, trimmed."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(SPACES)))
    return F.array_remove(lines, "")


def selected(hashes: Column, window: int) -> Column:
    """Places of the window minima (the rightmost of equal ones), each once."""

    def lowest(i: Column) -> Column:
        return F.array_min(F.transform(F.sequence(i, i + window - 1), lambda j: F.struct(
            F.get(hashes, j).alias("h"), (-j).alias("j"))))

    starts = F.when(F.size(hashes) >= window, F.sequence(F.lit(0), F.size(hashes) - window)).otherwise(
        F.array().cast("array<int>"))
    return F.array_distinct(F.transform(F.transform(starts, lowest), lambda m: -m["j"]))


def repeated_windows(docs: DataFrame, window: int) -> DataFrame:
    """(id, text_hash, starts): starts of the windows whose lines also start earlier. ``docs``: id, text_hash, text."""
    lined = docs.select("id", "text_hash", F.transform(word_lines(F.col("text")), lambda x: F.xxhash64(x)).alias("h"))
    lined = lined.select("id", "text_hash", "h", selected(F.col("h"), window).alias("at"))
    # explode_outer: explode() would add a filter that works out the array a second time, per element.
    marks = lined.select("id", "text_hash", "h", F.explode_outer("at").alias("p")).where("p IS NOT NULL")
    lo = F.greatest(F.lit(0), F.col("p") - (window - 1))
    marks = materialize(marks.select(
        "id", "text_hash", "p", F.get("h", F.col("p")).alias("mark"), lo.alias("lo"),
        F.slice("h", lo + 1, F.lit(2 * window - 1) - F.greatest(F.lit(0), F.lit(window - 1) - F.col("p"))).alias("around"),
    ), "lines-marks")
    often = marks.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("mark")
    often = counted_broadcast(materialize(often, "lines-often"))
    found = marks.join(often, "mark", "left_semi")
    # Extend both ways: the windows with the mark inside, each by its line hashes.
    begin = F.sequence(F.col("lo"), F.least(F.col("p"), F.col("lo") + F.size("around") - window))
    inside = found.where(F.least(F.col("p"), F.col("lo") + F.size("around") - window) >= F.col("lo")).select(
        "id", "text_hash", F.explode_outer(F.transform(begin, lambda s: F.struct(
            s.alias("s"), F.slice("around", s - F.col("lo") + 1, window).alias("run")))).alias("w"))
    places = materialize(inside.select("id", "text_hash", F.col("w.s").alias("s"), F.col("w.run").alias("run")).distinct(),
                         "lines-places")
    where = F.struct(F.coalesce(F.col("id"), F.lit(-(1 << 63))).alias("i"), F.col("text_hash").alias("t"), F.col("s"))
    first = places.groupBy("run").agg(F.min(where).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = counted_broadcast(materialize(first.select(F.col("run").alias("run_"), "first"), "lines-first"))
    later = places.join(first, F.col("run") == F.col("run_")).where(where > F.col("first"))
    return later.groupBy("id", "text_hash").agg(F.collect_set("s").alias("starts"))


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """All input columns with the text deduplicated, plus ``n_lines`` and ``n_removed``."""
    require(docs, text, doc_id)
    body = F.col(f"`{text}`").cast("string")
    keyed = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), order_hash(body).alias("text_hash"), body.alias("text"))
    later = repeated_windows(keyed, window)
    gone = F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(s, s + window - 1))))
    later = materialize(later.select(F.col("id").alias("_ll_id"), F.col("text_hash").alias("_ll_hash"),
                                     gone.alias("_ll_gone")), "lines-later")
    same = F.col(f"`{doc_id}`").cast("long").eqNullSafe(F.col("_ll_id")) & (order_hash(body) == F.col("_ll_hash"))
    # One way at every size: documents that lose lines grow with the corpus, so they are never broadcast.
    out = docs.join(later.hint("merge"), same, "left")
    lines = word_lines(body)
    # One lambda call binds the lines once per row.
    left = F.get(F.transform(F.array(lines), lambda x: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("_ll_gone")), lambda i: F.get(x, i)), "\n")), F.lit(0))
    fresh = F.when(F.col("_ll_gone").isNull(), body).otherwise(left)
    keep = [fresh.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_removed")]
    return out.select(*keep, F.size(lines).cast("long").alias("n_lines"),
                      F.coalesce(F.size("_ll_gone"), F.lit(0)).cast("long").alias("n_removed"))


ORACLE_SQL = f"""
WITH d AS (
  SELECT doc_id, text, [trim(x, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))
    FOR x IN string_split(coalesce(text, ''), chr(10))] AS raw
  FROM documents
), l AS (
  SELECT doc_id, text, [x FOR x IN raw IF x <> ''] AS l FROM d
), w AS (
  SELECT doc_id, s, l[s:s + {WINDOW - 1}] AS run
  FROM (SELECT doc_id, l, unnest(range(1, len(l) - {WINDOW - 2})) AS s FROM l WHERE len(l) >= {WINDOW})
), later AS (
  SELECT doc_id, s FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, s) AS k FROM w) WHERE k > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + {WINDOW})) AS p FROM later
), n AS (
  SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id
)
SELECT l.doc_id, CAST(len(l) AS BIGINT) AS n_lines, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
  CASE WHEN ps IS NULL THEN text
    ELSE coalesce(array_to_string([l[i] FOR i IN range(1, len(l) + 1) IF NOT list_contains(ps, i)], chr(10)), '') END AS text
FROM l LEFT JOIN n ON n.doc_id = l.doc_id
"""
