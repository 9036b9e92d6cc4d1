"""Ranked search against its SQL and a plain scorer over odd texts."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lociweave.llm import ranked_search as rs
from lociweave.llm.queries import ORACLES, QUERIES

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k):
    """Scores every document for every item."""
    own = [(i, Counter(words(t)), len(words(t))) for i, t in docs]
    own = [d for d in own if d[2]]
    n, total = len(own), sum(d[2] for d in own)
    df = Counter(t for _, c, _ in own for t in c)
    out = []
    for item, text in items:
        wanted, found = Counter(words(text)), []
        for doc, counts, length in own:
            m = 75 + 25 * length * n // total
            score = sum(
                often * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * counts[t] // (1000 * counts[t] + 12 * m))
                for t, often in wanted.items()
                if counts[t]
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, e[3], -e[0]) for rank, e in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def corpus():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "naïve", "x_y", "Don't", "A1"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(1, 120)))) for i in range(400)]
    docs += [(1000, None), (1001, ""), (1002, " .,;"), (None, "w7 w8 rare"), (1003, "w9 " * 50_000), (1004, docs[0][1]), (1005, docs[0][1]), (7, docs[0][1])]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 30)))) for i in range(30)]
    items += [(100, None), (101, "nothing like it"), (102, "W0 w0 w0"), (103, "rare"), (None, "w1 w250"), (102, "w1")]
    return docs, items


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize(("k", "block", "query_bytes"), [(20, 10**6, 2 << 20), (3, 50, 200), (1, 1, 2 << 20), (5, 700, 900)])
def test_ranks_as_a_plain_scorer(spark, k, block, query_bytes):
    docs, items = corpus()
    left = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("rank", "score", "length", "terms", "query", "id")})
    right = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("x"))
    want = plain(docs, [i for i in items if i != (102, "w1")], k)
    one = right.filter("text is null or text <> 'w1'")
    assert as_rows(rs.search(left.repartition(3), one, k, block=block, query_bytes=query_bytes)) == want


def test_repeated_queries_are_queries_of_their_own(spark):
    docs, items = corpus()
    left, right = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = [tuple(r) for r in rs.search(left, right).collect()]
    assert sorted(got, key=str) == plain(docs, items, 20)


def test_empty_tables(spark):
    docs, items = corpus()
    left, right = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for a, b in ((left.limit(0), right), (left, right.limit(0)), (left.filter("doc_id in (1000, 1001, 1002)"), right)):
        found = rs.search(a, b)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.collect() == []


def test_query_is_the_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    told = con.sql(ORACLES["op12_lexical_search"])
    assert as_rows(QUERIES["op12_lexical_search"](spark, sf).select(*told.columns)) == sorted(told.fetchall(), key=str)


def test_no_accumulators_are_made_once_the_rest_cannot_reach_the_kth(monkeypatch):
    """The common term comes last and would find every document; only those found before are updated."""
    made = []
    keep = rs.Accumulators.add

    def add(self, docs, gains):
        keep(self, docs, gains)
        made.append(int(self.made.sum()))

    monkeypatch.setattr(rs.Accumulators, "add", add)
    n, rare = 5000, 40
    lengths = np.full(n, 10)
    which = np.concatenate([np.ones(n, int), np.zeros(rare, int)])
    docs = np.concatenate([np.arange(n), np.arange(rare) * 3])
    order = np.argsort(docs, kind="stable")
    ends = np.append(0, np.cumsum(np.bincount(docs, minlength=n)))
    block = rs.Block(lengths, ends, which[order], np.ones(n + rare, np.int64), n, 10 * n)
    wanted = [(0, rs.weight(n, rare)), (1, rs.weight(n, n // 2))]
    found, scores = block.best(wanted, 20, 0)
    assert made == [rare, rare]
    impact = 1_000_000_000 // (1000 + 12 * 100)
    assert set(scores.tolist()) == {impact * (wanted[0][1] + wanted[1][1])} and len(found) == rare


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(rs, "SLICE_BYTES", 7)
    text = ("alpha beta, gammadeltaepsilon; é漢字 X " * 20).encode()
    assert [t for part in rs.terms(text) for t in part] == [w.encode() for w in words(text.decode())]
