"""SimHash links, components and the removal of near copies."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lociweave.llm import simhash
from lociweave.llm.graph import star_components
from lociweave.llm.queries import QUERIES

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def plain_fingerprint(text, shingle=3):
    lower = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    words = WORD.findall(lower)
    if not words:
        return 0
    own = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    counts = [0] * 64
    for s in own:
        h = xxhash.xxh64_intdigest(s, seed=42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(own))


def components(values, names, radius):
    """Brute force: the smallest name that each value reaches."""
    parent = list(range(len(values)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    array = np.array(values, dtype=np.uint64)
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(array[i + 1 :] ^ array[i]) <= radius) + i + 1:
            parent[find(int(j))] = find(i)
    least = {}
    for i, name in enumerate(names):
        if name is not None:
            least[find(i)] = min(least.get(find(i), name), name)
    return [least.get(find(i)) for i in range(len(values))]


def odd_rows():
    rng = random.Random(0)
    base = [" ".join(rng.choice("the of and to in".split()) for _ in range(8)) for _ in range(20)]
    rows = [(i, rng.choice(base)) for i in range(80)]
    rows += [(100, None), (101, ""), (102, " \n\t"), (None, base[0]), (None, "alone here"), (103, "One"), (103, "one")]
    return [*rows, (104, "Ünï code x"), (105, "very long " * 100_000), (106, "x"), (106, "x")]


def test_components_of_texts(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    df = df.withColumns({c: F.lit("x") for c in ("fingerprint", "first", "u", "component_id")})
    marks = [plain_fingerprint(t) for _, t in rows]
    want = list(zip([i for i, _ in rows], [f"{m:016x}" for m in marks], components(marks, [i for i, _ in rows], 2), strict=True))
    got = [tuple(r) for r in simhash.near_duplicates(df).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_query_is_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    marks = [plain_fingerprint(t) for _, t in rows]
    want = components(marks, [i for i, _ in rows], 2)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op10_simhash"](spark, sf).collect()}
    assert got == {i: (f"{m:016x}", c) for (i, _), m, c in zip(rows, marks, want, strict=True)}


def test_spanning_forests_of_parts_make_one_of_the_whole():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 60, 900), rng.integers(0, 60, 900)
    links = (a, b, rng.integers(0, 5, 900).astype(np.int8))
    whole = simhash._spanning([links], 60, 4)
    parts = [simhash._spanning([tuple(c[i : i + 100] for c in links)], 60, 4) for i in range(0, 900, 100)]
    again = simhash._spanning(parts, 60, 4)
    assert len(whole[0]) == len(again[0]) == 59 and whole[2].sum() == again[2].sum()


@pytest.mark.parametrize(("shard_size", "radius", "bands"), [(4096, 2, 4), (7, 2, 4), (50, 3, 6), (5, 0, 1)])
def test_links_reach_all_pairs_whatever_the_shards(spark, shard_size, radius, bands):
    rng = random.Random(1)
    centres = [rng.getrandbits(64) for _ in range(15)]
    values = list({c ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(4))}) for c in centres for _ in range(25)})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    edges = simhash.links(df, radius, bands, shard_size=shard_size)
    for r in edges.collect():
        assert ((r["u"] ^ r["v"]) & (1 << 64) - 1).bit_count() <= radius
    roots = {r["u"]: r["v"] for r in star_components(edges).collect()}
    assert [roots.get(v, v) for v in signed] == components(values, signed, radius)


@pytest.mark.parametrize("visits", [1, 500, 10**6])
def test_tree_search_is_brute_force(monkeypatch, visits):
    monkeypatch.setattr(simhash, "VISITS", visits)
    rng = np.random.default_rng(0)
    values = rng.integers(0, 2**10, 300).astype(np.uint64) << np.uint64(50)
    values = np.concatenate([np.unique(values[:200]), np.unique(values[200:])])
    second = np.flatnonzero(values[1:] < values[:-1])[0] + 1  # two trees
    roots = np.where(np.arange(len(values)) < second, 0, second)
    trees = simhash.BKTrees(values, np.arange(len(values)), roots)
    probes = rng.permutation(len(values))[:60]
    sizes = np.where(roots[probes] == 0, second, len(values) - second)
    got = {(int(p), int(n)) for a, b, _ in trees.search(probes, roots[probes], sizes, 2) for p, n in zip(a, b, strict=True)}
    near = {(int(i), j) for i in probes for j in range(len(values)) if int(values[i] ^ values[j]).bit_count() <= 2}
    assert got == {(i, j) for i, j in near if roots[i] == roots[j]}
    # every child hangs at its distance from its parent, once
    parents, distances = trees.keys // 65, trees.keys % 65
    assert [int(values[p] ^ values[c]).bit_count() for p, c in zip(parents, trees.children, strict=True)] == distances.tolist()
    assert len(set(trees.children.tolist())) == len(trees.children) == len(values) - 2


def test_components_of_long_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(300, 400)] + [(5, 5), (401, 1001)]
    got = {tuple(r) for r in star_components(spark.createDataFrame(edges, "u long, v long").repartition(3)).collect()}
    want = {(i, 0) for i in range(1, 201)} | {(i, 300) for i in [*range(301, 400), 1000]} | {(1001, 401)}
    assert got == want


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.deduplicate(empty).collect() == []


def kept_ids(rows, radius=2):
    """Brute force: the smallest id of each component."""
    names = [i for i, _ in rows]
    return {c for c in components([plain_fingerprint(t) for _, t in rows], names, radius)}


def test_one_of_each_component_stays(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(2000)]
    rows = []
    for g in range(12):
        own = rng.choices(vocabulary, k=400)
        for c in range(8):  # copies with up to two changed words; some are linked and some are not
            copy = list(own)
            for _ in range(c % 3):
                copy[rng.randrange(400)] = "changed"
            rows.append((g * 100 + c, " ".join(copy).upper() if c == 5 else " ".join(copy)))
    rows += [(5000, None), (5001, ""), (5001, " \n"), (5002, "alone"), (5003, "alone"), (5003, "alone"), (None, "alone")]
    rows += [(6000, "twice"), (6000, "twice"), (None, "no id here at all"), (None, "no id here at all")]
    want = kept_ids(rows)
    assert len(want) > 20
    clashing = ("node", "doc", "place", "stays", "again", "words", "root", "_key", "_again", "c0")
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(7) for c in clashing}).repartition(4)
    kept = simhash.deduplicate(df)
    assert kept.columns == df.columns
    out = kept.collect()
    assert len(out) == len(want) and {r["doc_id"] for r in out} == want
    assert all(r[c] == 7 for r in out for c in clashing)
    texts = dict(rows)
    assert all(r["text"] == texts[r["doc_id"]] for r in out if r["doc_id"] not in (None, 5001))


def test_of_equal_ids_one_row_stays(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (1, "another text that is not like it"), (2, "A b C d")]
    out = simhash.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["text"]) for r in out) == [(1, "a b c d"), (1, "another text that is not like it")]
