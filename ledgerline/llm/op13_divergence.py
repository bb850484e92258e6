"""Source divergence audit: how differently the sources of a language use its terms.

Every (language, source) group and every language gives each kept term a smoothed probability in
billionths; two of them differ by the sum over all kept terms of f = floor((p - q)^2 / (p + q)).

Count-level bitmaps. Terms with equal counts in a group have equal p, so f is worked out per pair of
counts and not per term: a group's terms are stored as one bitset of term ids per count. For two groups and
two counts, AND plus popcount gives the number of terms in that joint cell, which is multiplied by f. Terms
that a group lacks have no bitset: with F(x, y) the f of counts x and y, the sum over all V terms is

    V F(0, 0) + sum_x |x| (F(x, 0) - F(0, 0)) + sum_y |y| (F(0, y) - F(0, 0))
      + sum_xy |x and y| (F(x, y) - F(x, 0) - F(0, y) + F(0, 0)),

which is the complement of the stored levels written out. A language's terms are dealt by hash into
shards; in a shard ids follow the term's count in the language, so terms with few different counts share the words
of a bitset, and 64 ids are one word. Shards add up; a shard's rows are bounded by its size, and a
group's frequent terms are one row however often they occur, since tasks count before the shuffle.

All arithmetic is on whole numbers: counts as 64-bit, quotients as decimals of 38 digits or Python integers.

Defined results: null text, language and source count as ''; a group without terms has V = 0 or all counts 0
and still appears; a language with one source has no pairs; repeated rows count as documents of
their own; terms keep all letters but A-Z as they are; extra columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize, order_hash, require

#: Documents of the language that a kept term occurs in.
MIN_DOCUMENTS = 10
TOP_TERMS = 10
UNIT = 1_000_000_000
#: Different terms a task counts before it sends them on, and (term, group) rows of a shard.
HELD_TERMS, SHARD_ROWS = 300_000, 200_000
#: Cells of two lists of bitsets compared at a time.
CELLS = 1_000_000

#: A-Z become a-z; other bytes below 128 that are no letters become spaces.
_FOLD = bytes((c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32) for c in range(256))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, pre-counted per task; the term '' stands for the group itself.

    ``docs``: lang, source, text, without nulls.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, inside) in seen.items():
                terms = list(n)
                for lo in range(0, len(terms), 50_000):
                    some = terms[lo:lo + 50_000]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * len(some), pa.string()), pa.array([source] * len(some), pa.string()),
                        pa.array([t.decode("utf-8") for t in some], pa.string()),
                        pa.array([n[t] for t in some], pa.int64()), pa.array([inside[t] for t in some], pa.int64())],
                        names=["lang", "source", "term", "n", "docs"])

        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                n, inside = seen.setdefault((lang, source), (Counter({b"": 0}), Counter()))
                words = Counter(text.as_buffer().to_pybytes().translate(_FOLD).split())
                held -= len(n)
                n.update(words)
                inside.update(words.keys())
                held += len(n)
                if held > HELD_TERMS:
                    yield from flush()
                    seen, held = {}, 0
        yield from flush()

    return docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, n long, docs long")


def kept_counts(docs: DataFrame, min_documents: int) -> DataFrame:
    """(lang, source, term, n, lang_n, lead): groups' counts of the kept terms; one row of a term is its lead.

    A group is also there as its row of the term ''.
    """
    # Dealt by term once: both the sums per group and those over the groups of a language stay in place.
    dealt = term_counts(docs).repartition("lang", "term")
    counts = dealt.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    counts = counts.select("lang", "source", "term", "n", F.sum("docs").over(term).alias("in_docs"), F.sum("n").over(term).alias("lang_n"),
                           (F.min("source").over(term) == F.col("source")).alias("lead"))
    kept = counts.where((F.col("term") == "") | (F.col("in_docs") >= min_documents))
    return materialize(kept.select("lang", "source", "term", "n", "lang_n", "lead"), "audit-counts")


def probability(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (n + 2) / (total + 2 * terms)), exact."""
    wide = F.lit(UNIT).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)")
    return F.call_function("div", wide, (total + 2 * terms).cast("decimal(20,0)")).cast("long") + 1


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def difference(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); p and q are at most UNIT + 1, so the square fits 64 bits."""
    return _div((p - q) * (p - q), p + q)


def group_sizes(counts: DataFrame) -> DataFrame:
    """(lang, source, total, terms, lang_total): N of the group, V and N of the language, one row per group."""
    per = counts.groupBy("lang", "source").agg(
        F.sum("n").alias("total"), F.count_if(F.col("lead") & (F.col("term") != "")).alias("leads"))
    lang = Window.partitionBy("lang")
    return materialize(per.select("lang", "source", "total", F.sum("leads").over(lang).alias("terms"),
                                  F.sum("total").over(lang).alias("lang_total")), "audit-groups")


def level_bitmaps(counts: DataFrame, shards: DataFrame) -> DataFrame:
    """(lang, shard, size, source, n, size of the level, words): term-id bitsets per (group, count) of every shard.

    ``shards``: lang, shards. Ids number the shard's terms in the order of their count in the language; ``size`` is the
    number of them. A bitset is stored as (word, bits) pairs of its words that are not zero.
    """

    def run(key, table):
        sources, terms = (table.column(c).to_pylist() for c in ("source", "term"))
        n, lang_n = (table.column(c).to_numpy() for c in ("n", "lang_n"))
        number: dict[str, int] = {}
        which = np.array([number.setdefault(t, len(number)) for t in terms], np.int64)
        total = np.zeros(len(number), np.int64)
        total[which] = lang_n
        ids = np.empty(len(number), np.int64)
        ids[np.lexsort((list(number.values()), total))] = np.arange(len(number))
        at = ids[which]
        name: dict[str, int] = {}
        group = np.array([name.setdefault(s, len(name)) for s in sources], np.int64)
        order = np.lexsort((at, n, group))
        group, n, at = group[order], n[order], at[order]
        level = np.flatnonzero(np.concatenate(([True], (group[1:] != group[:-1]) | (n[1:] != n[:-1]))))
        owner = np.repeat(np.arange(len(level)), np.diff(np.concatenate((level, [len(at)]))))
        word = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (at[1:] >> 6 != at[:-1] >> 6))))
        bits = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), word)
        place, owner = at[word] >> 6, owner[word]
        ends = np.concatenate((np.searchsorted(owner, np.arange(len(level))), [len(owner)]))
        names = list(name)
        sizes = np.diff(np.concatenate((level, [len(at)])))
        return pa.table({
            "lang": pa.array([key[0].as_py()] * len(level), pa.string()), "shard": pa.array([key[1].as_py()] * len(level), pa.int64()),
            "size": pa.array([len(number)] * len(level), pa.int64()),
            "source": pa.array([names[g] for g in group[level]], pa.string()), "n": pa.array(n[level]), "level": pa.array(sizes, pa.int64()),
            "places": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(place.astype(np.int32))),
            "bits": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(bits.view(np.int64)))})

    rows = counts.where((F.col("term") != "") & (F.col("n") > 0)).join(shards, "lang")
    rows = rows.withColumn("shard", F.pmod(order_hash(F.col("term")), F.col("shards")))
    return rows.groupBy("lang", "shard").applyInArrow(
        run, "lang string, shard long, size long, source string, n long, level long, places array<int>, bits array<long>")


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def joint_sums(bitmaps: DataFrame, groups: DataFrame, shards: DataFrame) -> DataFrame:
    """(lang, source, item, value): every shard's part of the sum of f, for pairs of groups with source < item."""

    def run(key, left, right):
        names = right.column("source").to_pylist()
        order = sorted(range(len(names)), key=lambda i: names[i].encode("utf-8"))
        names = [names[i] for i in order]
        base = [right.column("total").to_pylist()[i] + 2 * right.column("terms").to_pylist()[i] for i in order]
        size = left.column("size")[0].as_py() if left.num_rows else 0
        number = {s: i for i, s in enumerate(names)}
        group = np.array([number[s] for s in left.column("source").to_pylist()], np.int64)
        n = left.column("n").to_pylist()
        p = np.array([1 + UNIT * (c + 2) // base[g] for c, g in zip(n, group.tolist())], np.int64)
        zero = np.array([1 + UNIT * 2 // b if b else 0 for b in base], np.int64)
        g = len(names)
        value = np.zeros((g, g), np.int64)
        if size:
            none = _f(zero[:, None], zero[None, :])
            value += size * none
            level = left.column("level").to_numpy()
            alone = np.zeros((g, g), np.int64)
            step = max(1, CELLS // g)
            for lo in range(0, len(p), step):
                at = slice(lo, lo + step)
                np.add.at(alone, group[at], level[at][:, None] * (_f(p[at][:, None], zero[None, :]) - none[group[at]]))
            value += alone + alone.T
            places = left.column("places").combine_chunks()
            owner = np.repeat(np.arange(len(p)), np.diff(places.offsets.to_numpy()))
            place = places.values.to_numpy()
            bits = left.column("bits").combine_chunks().values.to_numpy().view(np.uint64)
            by = np.lexsort((group[owner], place))
            owner, place, bits = owner[by], place[by], bits[by]
            cuts = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(place)]):
                own, word = owner[a:b], bits[a:b]
                step = max(1, CELLS // (b - a))
                for lo in range(0, b - a, step):
                    cells = np.bitwise_count(word[lo:lo + step, None] & word[None, lo:])
                    x, y = np.nonzero(cells)
                    cell = cells[x, y].astype(np.int64)
                    i, j = own[lo + x], own[lo + y]
                    gi, gj = group[i], group[j]
                    two = gi < gj
                    i, j, gi, gj, cell = i[two], j[two], gi[two], gj[two], cell[two]
                    np.add.at(value, (gi, gj), cell * (_f(p[i], p[j]) - _f(p[i], zero[gj]) - _f(zero[gi], p[j]) + none[gi, gj]))
        x, y = np.triu_indices(g, 1)
        return pa.table({"lang": pa.array([key[0].as_py()] * len(x), pa.string()),
                         "source": pa.array([names[i] for i in x.tolist()], pa.string()),
                         "item": pa.array([names[i] for i in y.tolist()], pa.string()), "value": pa.array(value[x, y])})

    # Every shard needs N and V of all groups of its language: one row per group and shard.
    spread = groups.join(shards, "lang").select(
        "lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"), "source", "total", "terms")
    parts = bitmaps.groupBy("lang", "shard").cogroup(spread.groupBy("lang", "shard")).applyInArrow(
        run, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def pair_values(counts: DataFrame, groups: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(lang, source, item, value): the difference of every ordered pair of sources of a language."""
    shards = counts.where(F.col("term") != "").groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    shards = materialize(shards.select("lang", F.ceil(F.col("rows") / shard_rows).cast("long").alias("shards")), "audit-shards")
    sums = materialize(joint_sums(level_bitmaps(counts, shards), groups, shards), "audit-sums")
    both = sums.unionByName(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    # All pairs are the result itself; a language without kept terms has no shard and its pairs are 0.
    other = groups.select("lang", F.col("source").alias("item"))
    pairs = groups.select("lang", "source").join(other, "lang").where("source <> item")
    return pairs.join(both, ["lang", "source", "item"], "left").select(
        "lang", "source", "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))


def term_values(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): terms a group uses more than its language, with their f."""
    rows = counts.where((F.col("term") != "") & (F.col("n") > 0)).join(groups, ["lang", "source"])
    rows = rows.select("lang", "source", "term", probability(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
                       probability(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"))
    return rows.where("p > q").select("lang", "source", F.col("term").alias("item"),
                                      difference(F.col("p"), F.col("q")).cast("long").alias("value"))


def divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
               min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): ``pair``: all other sources by difference; ``term``: the most overused terms."""
    require(docs, text, lang, source)
    rows = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a)
                         for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])
    counts = kept_counts(rows, min_documents)
    groups = group_sizes(counts)
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    rank = F.row_number().over(order)
    pairs = pair_values(counts, groups).withColumn("rank", rank)
    terms = term_values(counts, groups).withColumn("rank", rank).where(F.col("rank") <= top_terms)
    both = pairs.withColumn("part", F.lit("pair")).unionByName(terms.withColumn("part", F.lit("term")))
    out = materialize(both.select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank")), "audit-ranked")
    discard(counts)
    return out


ORACLE_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), t AS (
  SELECT i, lang, source, unnest(w) AS term FROM d
), kept AS (
  SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT i) >= {MIN_DOCUMENTS}
), c AS (
  SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), v AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), g AS (
  SELECT x.lang, x.source, coalesce(v, 0) AS v, coalesce((SELECT sum(n) FROM c WHERE c.lang = x.lang AND c.source = x.source), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM d) x LEFT JOIN v ON v.lang = x.lang
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    CAST(1 + (CAST({UNIT} AS HUGEINT) * (coalesce(c.n, 0) + 2)) // CAST(g.n + 2 * g.v AS HUGEINT) AS BIGINT) AS p
  FROM g JOIN kept k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), l AS (
  SELECT lang, term, CAST(1 + (CAST({UNIT} AS HUGEINT) * (sum(n) + 2)) // CAST(sum(sum(n)) OVER (PARTITION BY lang) + 2 * any_value(v) AS HUGEINT)
    AS BIGINT) AS q FROM c JOIN v USING (lang) GROUP BY lang, term
), sums AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS BIGINT) AS value
  FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY a.lang, a.source, b.source
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
  SELECT p.lang, p.source, 'term' AS part, p.term AS item, ((p - q) * (p - q)) // (p + q) AS value
  FROM p JOIN l ON l.lang = p.lang AND l.term = p.term WHERE p.n > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
