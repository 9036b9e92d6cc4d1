"""Packing and token counts against the tokenizer library."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lociweave.llm import packing, token_counts, tokenizer
from lociweave.llm.queries import QUERIES, VOCABULARY

PATH = tokenizer.vocabulary_file(VOCABULARY)
ODD = [
    (1, "plain words, and more of them"),
    (2, ""),
    (None, "no id"),
    (3, None),
    (4, "x" * 9_000),
    (5, " " * 3_000 + "end"),
    (6, "a<|endoftext|>b <|endoftext|>"),
    (7, "é 漢字 ՘ 🎉 \x1c  don't 123456"),
    (8, "same"),
    (8, "same"),
    (9, " ".join(f"word{i}" for i in range(4_000))),
]


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    return lambda t: found.encode(t or "", add_special_tokens=False).ids


@pytest.fixture
def odd(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string").repartition(3)
    return df.withColumns({c: F.lit("clash") for c in ("id", "start", "offset", "n_tokens", "ids", "keep_0")})


def check_pieces(rows, texts, ids_of, capacity):
    """Pieces cover each document's ids once and fill sequences without gaps or padding."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == {i for i, _ in texts}
    for doc, pieces in by_doc.items():
        own = [[*ids_of(t), packing.END_ID] for i, t in texts if i == doc]
        pieces.sort(key=lambda r: r["start"])
        for repeat in range(len(own)):
            mine, at = pieces[repeat :: len(own)], 0
            for r in mine:
                size = len(r["ids"]) // 4
                assert (r["start"], r["doc_tokens"]) == (at, len(own[repeat]))
                assert bytes(r["ids"]) == np.array(own[repeat][at : at + size], "<u4").tobytes()
                at += size
            assert at == len(own[repeat])
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r["offset"])
        sizes = [len(r["ids"]) // 4 for r in pieces]
        assert [r["offset"] for r in pieces] == [0, *np.cumsum(sizes)[:-1]]
        total = sum(sizes)
        assert total <= capacity and total & (total - 1) == 0


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packs_every_id_once(odd, library, capacity):
    rows = packing.pack_documents(odd, PATH, capacity=capacity).collect()
    check_pieces(rows, ODD, library, capacity)


def test_packs_an_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_bins_hold_a_fixed_count_per_class():
    rng = random.Random(0)
    bins, done = packing.HarmonicBins(100, 5), []
    for _ in range(500):
        finished = bins.add((rng.randrange(1, 101),))
        if finished:
            done.append(finished)
    for _, pieces in done:
        assert {100 // p[0] for p in pieces} == {len(pieces)}
        assert sum(p[0] for p in pieces) <= 100
    rest = list(bins.close())
    assert sum(len(p) for _, p in done + rest) == 500
    assert [i for i, _ in done + rest] == list(range(5, 5 + len(done + rest)))


def test_query_digests(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op1_packing"](spark, sf).collect():
        ids = [*library(texts[r["doc_id"]]), 1]
        own = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()
        assert zlib.crc32(own) == r["ids_crc32"] and r["doc_tokens"] == len(ids)


def test_counts_like_the_library(odd, library):
    got = sorted(((r[0] is None, r[0] or 0), r[1], r[2]) for r in token_counts.count_tokens(odd, PATH).collect())
    want = sorted(((i is None, i or 0), len((t or "").encode()), len(library(t))) for i, t in ODD)
    assert got == want


def test_counts_random_unicode(library):
    rng, count = random.Random(1), token_counts.TextCounter(PATH)
    for _ in range(300):
        text = "".join(
            chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x3000), 0x20, 0x0A, rng.randrange(0xE000, 0x11000)]))
            for _ in range(rng.randrange(80))
        )
        assert count(text) == len(library(text)) == len(tokenizer.encoder(PATH)([text])[0])


def test_counts_an_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.count_tokens(empty, PATH).collect() == []


def test_query_marks_long_texts(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op9_token_counts"](spark, sf).collect():
        n = len(library(texts[r["doc_id"]]))
        assert (r["n_tokens"], r["over_limit"]) == (n, n > 1024)


def test_other_vocabularies_go_to_the_library():
    path = tokenizer.vocabulary_file("word_bpe_49k.json")
    text = "Some words here"
    assert tokenizer.encoder(path)([text])[0] == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    with pytest.raises(ValueError):
        token_counts.TextCounter(path)
