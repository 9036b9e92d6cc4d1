"""Super-k-mers and sparse suffix arrays against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociweave.llm import sparse_suffixes, superkmer
from lociweave.llm import text as tx
from lociweave.llm.queries import QUERIES
from lociweave.session import materialise


def order(i):
    return (i is None, i or 0)


def without_repeats(rows, k):
    """Brute force: (id, words, removed, digest of what is kept)."""
    split = [(order(i), tuple((t or "").encode().split())) for i, t in rows]
    first = {}
    for doc, words in sorted(set(split)):
        for j in range(len(words) - k + 1):
            first.setdefault(words[j : j + k], (doc, j))
    out = []
    for (doc, words), (i, _) in zip(split, rows, strict=True):
        gone = [False] * len(words)
        for j in range(len(words) - k + 1):
            if first[words[j : j + k]] < (doc, j):
                gone[j : j + k] = [True] * k
        kept = [w for w, g in zip(words, gone, strict=True) if not g]
        out.append((i, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=lambda r: (order(r[0]), *r[1:]))


def in_order(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (order(r[0]), *r[1:]))


def odd_rows():
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(40)))) for i in range(60)]
    rows += [(None, "a b " * 30), (None, None), (7, ""), (5, "x " * 100), (5, "x " * 100), (2, "a b " * 30)]
    return [*rows, (90, "é ü ö " * 30), (91, "\té ü ö\x0b" * 30), (92, "long " * 20_000)]


@pytest.mark.parametrize(("k", "m", "buckets"), [(5, 2, None), (5, 2, 1), (20, 3, 3), (3, 3, 7)])
def test_removes_what_brute_force_removes(spark, k, m, buckets):
    df = spark.createDataFrame(odd_rows(), "doc_id long, text string").repartition(4)
    df = df.withColumns({c: F.lit(1) for c in ("doc", "no_id", "text_key", "start", "spans")})
    assert in_order(superkmer.removal_report(df, k=k, m=m, buckets=buckets)) == without_repeats(odd_rows(), k)


def test_equal_hashes_do_not_make_windows_equal(spark, monkeypatch):
    monkeypatch.setattr(tx.WordHashes, "__missing__", lambda self, w: len(w))
    rows = [(i, " ".join(random.Random(i // 2).choice("abcdef") for _ in range(30))) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert in_order(superkmer.removal_report(df, k=6, m=2, buckets=2)) == without_repeats(rows, 6)


def test_removal_query_is_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert in_order(QUERIES["op2_superkmer"](spark, sf)) == without_repeats(rows, 20)


def test_cutting_keeps_other_columns_and_clean_texts(spark):
    rows = [(1, "keep  this\nas it is", "a"), (2, "one two three four five\tsix  end", "b"), (3, "x one two three four five y", "c"), (4, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string")
    got = {r["doc_id"]: tuple(r) for r in superkmer.remove_repeats(df, k=5, m=2).collect()}
    assert got == {1: rows[0], 2: rows[1], 3: (3, "x y", "c"), 4: rows[3]}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert superkmer.removal_report(empty).collect() == []
    assert superkmer.remove_repeats(empty).collect() == []
    assert sparse_suffixes.repeated_passages(empty, materialise).collect() == []


def repeated_words(rows, least):
    """Brute force: (id, place) of words under a window of ``least`` words that occurs twice."""
    split = [(i, (t or "").encode().split()) for i, t in dict.fromkeys(rows)]
    places = collections.defaultdict(list)
    for n, (_, words) in enumerate(split):
        for j in range(len(words) - least + 1):
            places[tuple(words[j : j + least])].append((n, j))
    found = {(n, j + x) for at in places.values() if len(at) > 1 for n, j in at for x in range(least)}
    return {(split[n][0], j) for n, j in found}


def passages_fixture():
    rng = random.Random(5)

    def words(n):
        return [f"w{rng.randrange(3000)}" for _ in range(n)]

    passages = [words(n) for n in (55, 60, 120, 400, 50)]
    rows = []
    for i in range(60):
        own = words(rng.randrange(10, 200))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(own))
            own[at:at] = rng.choice(passages)
        rows.append((i, " ".join(own)))
    rows += [(100, "x " * 500), (101, "a b " * 40), (None, rows[0][1]), (200, None), (201, ""), (5, rows[5][1])]
    return [*rows, (202, rows[7][1]), (203, "short"), (204, "short")]


@pytest.mark.parametrize(("least", "seed", "right"), [(50, 16, 64), (12, 4, 20)])
def test_finds_the_passages_that_brute_force_finds(spark, least, seed, right):
    rows = passages_fixture()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).withColumn("start", F.lit("x"))
    found = sparse_suffixes.repeated_passages(df, materialise, least=least, seed=seed, right=right).collect()
    got = {(r["doc_id"], r["start"] + x) for r in found for x in range(r["words"])}
    assert got == repeated_words(rows, least)
    texts = dict(rows[::-1])
    for r in found:  # the partner holds at least ``least`` words of the passage
        own, other = (set(zip(*(texts[i].split()[x:] for x in range(least)))) for i in (r["doc_id"], r["other_id"]))  # noqa: B905
        assert own & other


@pytest.mark.parametrize("edge", [100, 2])
def test_finds_passages_around_a_frequent_line(spark, monkeypatch, edge):
    monkeypatch.setattr(sparse_suffixes, "EDGE_OF_WINDOW", edge)
    rng = random.Random(9)

    def words(n):
        return [f"w{rng.randrange(30_000)}" for _ in range(n)]

    line, rows = words(45), []
    for i in range(60):  # two documents share 15 words before the line
        shared = words(15)
        rows += [(2 * i + c, " ".join([*words(30), *shared, *line, *words(30)])) for c in range(2)]
    rows += [(1000 + i, " ".join([*words(30), *line, *words(30)])) for i in range(200)]
    rows += [rows[0], rows[130]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = sparse_suffixes.repeated_passages(df, materialise).collect()
    got = {(r["doc_id"], r["start"] + x) for r in found for x in range(r["words"])}
    assert got == repeated_words(rows, 50) and len({i for i, _ in got}) == 120
    assert {(r["doc_id"], r["other_id"]) for r in found} == {(i, i ^ 1) for i in range(120)}


def test_passage_query_finds_documents_of_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op4_sparse_suffixes"](spark, sf).collect()
    got = {(r["doc_id"], r["start"] + x) for r in found for x in range(r["words"])}
    assert got == repeated_words(rows, 50)


def test_minimisers_are_the_leftmost_minima():
    rng = np.random.default_rng(0)
    for n, span in ((40, 5), (7, 7), (3, 5), (200, 1)):
        values = rng.integers(0, 6, n).astype(np.uint64)
        want = sorted({a + int(values[a : a + span].argmin()) for a in range(n - span + 1)})
        assert sparse_suffixes.selected(values, span).tolist() == want


def test_rolling_hashes_and_minima():
    values = np.random.default_rng(1).integers(0, 2**63, 50).astype(np.uint64)
    for width in (1, 2, 7, 20, 50, 51):
        want = [sum(int(values[i + j]) * pow(tx.BASE, j, 2**64) for j in range(width)) % 2**64 for i in range(51 - width)]
        assert tx.rolling(values, width).tolist() == want
        assert tx.sliding_min(values, width).tolist() == [values[i : i + width].min() for i in range(51 - width)]


def test_common_words_at_the_beginning():
    rng = random.Random(7)
    for _ in range(3000):
        a = [rng.choice([b"a", b"ab", b"b", b"abc"]) for _ in range(rng.randrange(7))]
        b = a[: rng.randrange(7)] + [rng.choice([b"a", b"ab", b"b"]) for _ in range(rng.randrange(4))]
        want = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))  # noqa: B905
        assert sparse_suffixes.common(b" ".join(a), b" ".join(b)) == want


def test_a_text_of_one_repeated_word(spark):
    """Every place of it is kept, as one row; it is one passage and shares words with the other."""
    rows = [(1, "so " * 20_000), (2, "yes " + "so " * 60 + "no"), (3, "other " * 10)]
    got = sparse_suffixes.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), materialise).collect()
    assert sorted((r["doc_id"], r["start"], r["words"]) for r in got) == [(1, 0, 20_000), (2, 1, 60)]
