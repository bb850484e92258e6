"""Quality rules: a threshold table compiled into one native Spark projection.

Every figure is a column expression of the row's own text (no user function, no shuffle), and
the table of thresholds becomes one boolean conjunction. Words are ``[^\\x20\\x09-\\x0D]+``.

Defined results: a null or empty text has no words, all figures 0, and is rejected by the
base rule; rows are judged one by one, so repeated rows and null ids pass through; an empty
table gives an empty result; extra input columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import require, words_of

#: Characters counted as symbols and the white space removed to count word characters.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"
#: Frequent function words of the four corpus languages, as written inside and at the start of sentences.
STOP_WORDS = [
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "with", "on", "this", "are", "be", "as", "by",
    "der", "die", "das", "und", "zu", "den", "mit", "von", "ist", "ein", "eine", "auf", "für", "im", "nicht", "des",
    "le", "la", "les", "de", "et", "des", "un", "une", "du", "en", "est", "que", "qui", "dans", "pour", "pas",
    "el", "los", "las", "y", "que", "se", "por", "con", "una", "para", "no", "lo", "es",
]


@dataclass(frozen=True)
class Rule:
    """``low <= figure <= high`` (None: open); figures that are null pass."""

    name: str
    figure: str
    low: float | None = None
    high: float | None = None


#: The production thresholds.
RULES = [
    Rule("mean_word_length", "mean_word_chars", 2.0, 12.0),
    Rule("symbol_ratio", "symbol_ratio", None, 0.25),
    Rule("dup_line_ratio", "dup_line_ratio", None, 0.5),
    Rule("stop_words", "n_stop_words", 2.0, None),
    Rule("line_length", "words_per_line", 1.5, None),
]


def repeated_window_words(words: Column, windows: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text (first included).

    ``windows`` holds the 64-bit hash of the window starting at each word. Sorted by hash,
    equal windows stand side by side, so one comparison with both neighbours finds them;
    texts whose windows are all different skip the sort.
    """
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def covered(p: Column) -> Column:
        again = F.filter(p, lambda x, i: (F.get(p, i - 1)["h"] == x["h"]) | (F.get(p, i + 1)["h"] == x["h"]))
        again = F.filter(F.transform(again, lambda x: x["i"]), lambda x: x.isNotNull())
        return F.size(F.array_distinct(F.flatten(F.transform(again, lambda i: F.array(i, i + 1, i + 2)))))

    # transform() over a one-element array binds the sorted array once per row.
    heavy = F.get(F.transform(F.array(placed), covered), F.lit(0))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), heavy).otherwise(F.lit(0)).cast("long")


def figures(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The base figures and the ratios the rules look at, one row per input row."""
    require(docs, text, *keep)
    ids = [F.col(f"`{k}`") for k in keep]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    d = docs.select(
        *ids,
        F.length(F.translate(body, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        words_of(body).alias("words"),
        lines.alias("lines"),
    )
    windows = F.when(F.size("words") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("words") - 3),
        lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)),
    )).otherwise(F.array().cast("array<bigint>"))
    d = d.withColumn("windows", windows)
    stop = F.array(*[F.lit(w) for s in dict.fromkeys(STOP_WORDS) for w in (s, s.capitalize())])
    n_words, n_lines = F.size("words").cast("long"), F.size("lines").cast("long")
    d = d.select(
        *ids,
        n_words.alias("n_words"), "word_chars", "n_symbols",
        (n_lines - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_window_words(F.col("words"), F.col("windows")).alias("n_repeat_words"),
        n_lines.alias("n_lines"),
        F.size(F.array_intersect("words", stop)).cast("double").alias("n_stop_words"),
    )
    return d.select(
        "*",
        F.try_divide("word_chars", "n_words").alias("mean_word_chars"),
        F.try_divide("n_symbols", "n_words").alias("symbol_ratio"),
        F.try_divide("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        F.try_divide("n_words", "n_lines").alias("words_per_line"),
    )


def compile_rules(rules: list[Rule]) -> Column:
    """The threshold table as one boolean expression over the figures."""
    ok = F.lit(True)
    for r in rules:
        if r.low is not None:
            ok = ok & F.coalesce(F.col(r.figure) >= r.low, F.lit(True))
        if r.high is not None:
            ok = ok & F.coalesce(F.col(r.figure) <= r.high, F.lit(True))
    return ok


def quality_rules(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                  rules: list[Rule] | None = None) -> DataFrame:
    """``keep`` columns, the base figures, ``base_failed`` and ``kept`` for every row."""
    f = figures(docs, text, keep)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return f.select(
        *[F.col(f"`{k}`") for k in keep], "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & compile_rules(RULES if rules is None else rules)).alias("kept"),
    )


def _sql_list(words: list[str]) -> str:
    return "[" + ", ".join("'" + w + "'" for w in words) + "]"


ORACLE_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), b AS (
  SELECT rid, doc_id, t,
    [x FOR x IN regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w,
    [x FOR x IN string_split(t, chr(10)) IF regexp_replace(x, '[\\x20\\x09-\\x0D]+', '', 'g') <> ''] AS l
  FROM d
), win AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM b)
), again AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1
), rep AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY rid
), f AS (
  SELECT b.doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines,
    len(list_distinct([x FOR x IN w IF list_contains({_sql_list([w for s in dict.fromkeys(STOP_WORDS) for w in (s, s.capitalize())])}, x)])) AS n_stop
  FROM b LEFT JOIN rep USING (rid)
), j AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars / n_words BETWEEN 2.0 AND 12.0 AND n_symbols / n_words <= 0.25
  AND n_dup_lines / n_lines <= 0.5 AND n_stop >= 2 AND n_words / n_lines >= 1.5 AS kept
FROM j
"""
