"""SimHash links and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from ledgerline.llm import op4_simhash
from ledgerline.llm.components import connected_components


def plain_simhash(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x20\x09-\x0d]+", t)
    if not w:
        return 0
    sh = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(values, radius):
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_documents_against_brute_force(documents):
    rows = documents.select("doc_id", "text").orderBy("doc_id").collect()
    prints = [plain_simhash(r["text"]) for r in rows]
    comp = brute_components(prints, 4)
    want = {r["doc_id"]: (f"{p:016x}", rows[c]["doc_id"]) for r, p, c in zip(rows, prints, comp)}
    got = op4_simhash.near_duplicates(documents).select(
        "doc_id", op4_simhash.hex_fingerprint().alias("f"), "component_id").collect()
    assert {r["doc_id"]: (r["f"], r["component_id"]) for r in got} == want


@pytest.mark.parametrize("slice_rows", [1024, 16])
def test_links_of_dense_groups(spark, slice_rows):
    """A chain and a large group of near copies, with keys cut into slices and not."""
    r = random.Random(3)
    base = r.getrandbits(64)
    values = {base}
    while len(values) < 150:
        values.add(base ^ sum(1 << b for b in r.sample(range(64), r.randint(1, 3))))
    at = r.getrandbits(64)
    for k in range(0, 40, 4):
        values.add(at)
        at ^= 0b1111 << k
    values |= {r.getrandbits(64) for _ in range(100)}
    values = sorted(values)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = op4_simhash.links(spark.createDataFrame(signed, "fp long"), 4, slice_rows=slice_rows)
    for a, b in links.collect():
        assert ((a ^ b) & (1 << 64) - 1).bit_count() <= 4
    got = {x["node"]: x["component"] for x in connected_components(links).collect()}
    mine = [got.get(v[0], v[0]) for v in signed]
    want = brute_components(values, 4)
    assert len(set(zip(mine, want))) == len(set(mine)) == len(set(want))


def test_bk_tree_follows_the_radius():
    r = np.random.default_rng(1)
    fps = r.integers(0, 1 << 63, 300, dtype=np.uint64)
    queries = np.concatenate([fps[:40] ^ np.uint64(5), r.integers(0, 1 << 63, 50, dtype=np.uint64)])
    got = {(n, int(j)) for n, near in op4_simhash.BKTree(fps).search(queries, 4) for j in near}
    want = {(i, j) for i in range(300) for j in range(90) if (int(fps[i]) ^ int(queries[j])).bit_count() <= 4}
    assert got == want


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(-5, 100), (7, 7)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: -5 for i in [-5, *range(100, 150)]}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(spark, odd):
    got = op4_simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by = {r["doc_id"]: r for r in got if r["doc_id"]}
    assert {by[i]["component_id"] for i in (1, 2, 3)} == {1} and by[1]["fp"] == 0
    assert by[5]["component_id"] == by[7]["component_id"] == 5
    assert op4_simhash.near_duplicates(odd.limit(0)).count() == 0
    left = op4_simhash.drop_near_duplicates(odd)
    assert left.columns == odd.columns
    ids = [r["doc_id"] for r in left.collect()]
    assert sorted(x for x in ids if x) == [1, 4, 5, 6, 8, 9, 10] and ids.count(None) == 1
