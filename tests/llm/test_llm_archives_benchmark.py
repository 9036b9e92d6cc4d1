"""WARC round trips, decontamination and the pipeline."""

import gzip
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lociweave.llm import packing, simhash, superkmer, templates, tokenizer, warc
from lociweave.llm import queries as q
from lociweave.session import materialise, scratch_path

SF = "/root/testdata/sf0.001"
PAGES = [(1, "u", "x"), (2, None, "x"), (3, "u\r\nb: c", None), (4, "", ""), (None, "n", "x"), (None, "q", "only"), (None, "q", "only"),
         (5, "é", "é" * 100_000), (1, "u", "x"), (-7, "z", "\x1f\x08WARC/1.1\r\n" * 50), (9, "w", "\r\n\r\n")]


def test_round_trip_is_the_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{SF}/pages.parquet'")
    cursor = con.execute(q.ORACLES["op8_warc"])
    names = [c[0] for c in cursor.description]
    got = q.QUERIES["op8_warc"](spark, SF).select(*names).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, cursor.fetchall()))


@pytest.mark.parametrize("split", [1, 7, 1000, 1 << 25])
def test_every_split_size_reads_every_record_once(spark, split):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(2)
    df = df.withColumns({c: F.lit("x") for c in ("id", "payload", "_digest", "path", "bytes")})
    archives = materialise(warc.write_archives(df, scratch_path(spark, "warc")), "archives")
    rows = warc.read_archives(archives, split).collect()
    assert len(rows) == len(PAGES) and len({(r["path"], r["place"]) for r in rows}) == len(PAGES)
    got = sorted((r["record_type"], r["payload_bytes"], r["digest"], bytes(r["payload"] or b"").decode()) for r in rows)
    want = []
    for i, _, html in PAGES:
        body = (html or "").encode()
        first = min((j for j, _, h in PAGES if (h or "") == (html or "") and j is not None), default=None)
        kind = "response" if i == first else "revisit"
        want.append((kind, len(body), warc.sha1_base32(body), body.decode() if kind == "response" else ""))
    assert got == sorted(want)


def test_small_payloads_need_not_be_revisits(spark):
    df = spark.createDataFrame([(1, "a", "xy"), (2, "b", "xy"), (3, "c", "long enough"), (4, "d", "long enough")], "page_id long, url string, html string")
    got = warc.round_trip(df, scratch_path(spark, "warc"), materialise, least_bytes=5).collect()
    assert {r["page_id"]: (r["record_type"], r["refers_to"]) for r in got} == {
        1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3)}


def test_long_headers_come_back(spark):
    """However long a url is, its page has a row; one that is damaged is an error."""
    pages = [(1, "http://a.example/" + "x" * 1_200_000, "one"), (2, "http://b.example/" + "\x01" * 400_000, "two"), (3, None, "one")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: (r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.round_trip(df, warc.archive_folder(spark), materialise).collect()}
    assert got == {1: (3, "response", None), 2: (3, "response", None), 3: (3, "revisit", 1)}
    raw = zlib.compress(warc.VERSION + b"WARC-Type: response\r\nWARC-Target-URI: " + b"y" * 3_000_000, wbits=31)
    with pytest.raises(ValueError, match="does not end"):
        warc.decode_member(warc.Archive(Bytes(raw), len(raw)), 0)


def test_no_pages(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(empty, scratch_path(spark, "warc"), materialise).collect() == []


class Bytes:
    def __init__(self, data):
        self.data, self.place = data, 0

    def seek(self, place):
        self.place = place

    def read(self, n):
        out = self.data[self.place : self.place + n]
        self.place += len(out)
        return out


def test_members_that_are_no_records_are_passed_over():
    one = warc.encode_record([("WARC-Type", "response")], b"body one")
    inner = warc.encode_record([("WARC-Type", "response")], b"first body")
    data = b"\x1f\x8b\x08junk" + gzip.compress(b"not a record") + one + b"\x1f\x8b\x08" + inner
    found = [(h["warc-type"], b) for _, h, b in warc.records_in(warc.Archive(Bytes(data), len(data)), 0, len(data))]
    assert found == [("response", b"body one"), ("response", b"first body")]
    for cut in range(len(data)):  # each record belongs to the range it starts in
        archive = warc.Archive(Bytes(data), len(data))
        parts = [p for a, b in ((0, cut), (cut, len(data))) for p, _, _ in warc.records_in(archive, a, b)]
        assert len(parts) == len(set(parts)) == 2


def test_damaged_records_are_errors():
    one = warc.encode_record([("WARC-Type", "response")], bytes(range(256)) * 500)
    for data in (one[:-9], one[:-4] + b"\0\0\0\0"):
        with pytest.raises(ValueError):
            list(warc.records_in(warc.Archive(Bytes(data), len(data)), 0, len(data)))
    with pytest.raises(zlib.error):
        zlib.decompress(one[:-4] + b"\0\0\0\0", 31)


ITEM = "Yesterday Alice bought 3 apples for 12 dollars and then Alice gave 3 apples away to Tom."
DOCS = [
    (1, ITEM),
    (2, "Noise before. Yesterday Maria bought 7 apples for 99 euros and then Maria gave 7 apples away to Jim. And after"),
    (3, "Yesterday Maria bought 7 apples for 99 euros and then Jane gave 8 apples away to Jim."),
    (4, ITEM.upper()),
    (5, None),
    (6, ""),
    (None, ITEM.lower()),
    (7, "short one"),
    (2, "clean text here with nothing in it at all or so"),
    (1, ITEM),
    (8, "filler " * 5_000 + ITEM),
]
ITEMS = [(10, ITEM), (11, "too short"), (12, None), (None, ITEM), (13, "five words are just enough"), (10, ITEM)]


@pytest.mark.parametrize("hashes", [2_000_000, 5])
def test_finds_copies_and_changed_parameters(spark, hashes):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("doc", "item", "start", "hash")})
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("template", F.lit("x"))
    got = templates.contaminated(docs, items, broadcast_hashes=hashes).collect()
    found = {(r["doc_id"], r["item_id"]): r["changed"] for r in got}
    assert found == {(1, 10): False, (2, 10): True, (4, 10): False, (None, 10): False, (8, 10): False}
    kept = templates.decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r["text"] or "" for r in kept.collect()) == sorted(t or "" for _, t in (DOCS[i] for i in (2, 4, 5, 7, 8)))


def test_empty_sides(spark):
    docs, items = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert templates.contaminated(docs.limit(0), items).collect() == []
    assert templates.contaminated(docs, items.limit(0)).collect() == []
    assert templates.decontaminate(docs, items.limit(0)).count() == len(DOCS)


def test_slots_fit_together():
    assert templates.consistent([("a", "x"), ("b", "y"), ("a", "x")])
    assert not templates.consistent([("a", "x"), ("a", "y")])
    assert not templates.consistent([("a", "x"), ("b", "x")])


def test_parameters_may_become_equal_or_different(spark):
    items = [
        (1, "A farmer has 3 apples and then buys 5 pears at the market"),
        (2, "The box holds 2 books and the shelf has 2 more than that"),
        (3, "Every day Alice walks to the old mill by the river and in the evening when the sun goes down over the quiet "
            "valley and all the lamps are lit Alice reads"),
    ]
    docs = [
        (1, "A farmer has 4 apples and then buys 4 pears at the market"),
        (2, "The box holds 3 books and the shelf has 4 more than that"),
        # the end has another name: only the windows with a name are void
        (3, items[2][1].replace("Alice walks", "Maria walks").replace("Alice reads", "Jane reads").upper()),
        (4, items[2][1].replace("Alice walks", "Maria walks").replace("Alice reads", "Jane reads")),
        (5, "A farmer has apples and then buys pears at the market"),
    ]
    docs, items = (spark.createDataFrame(r, f"{c} long, text string") for r, c in ((docs, "doc_id"), (items, "item_id")))
    got = {(r["doc_id"], r["item_id"]) for r in templates.contaminated(docs, items).collect()}
    assert got == {(1, 1), (2, 2), (3, 3), (4, 3)}


def test_a_misfit_voids_only_its_windows():
    def window(start, *slots):
        item, doc = zip(*slots, strict=True)
        return {"item_start": start, "doc_start": start, "width": 8, "typed": True, "item_slots": item, "doc_slots": doc}

    bad = [window(0, ("2:a", "2:x")), window(30, ("2:a", "2:y"))]
    assert templates.covered_words([*bad, window(15, ("1:3", "1:4"))]) == (8, True)
    assert templates.covered_words([window(0, ("1:2", "1:3")), window(4, ("1:2", "1:4"))]) == (12, True)


def test_decontamination_query_is_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    items = {r["item_id"]: r["text"].lower().split() for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    want = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        text = f" {' '.join(r['text'].lower().split())} "
        want |= {(r["doc_id"], i) for i, words in items.items() if " ".join(words[1:-1]) in text}
    assert {(r["doc_id"], r["item_id"]) for r in q.QUERIES["op3_templates"](spark, sf).collect()} == want


def test_pipeline_stage_by_stage(spark):
    """Each stage against plain code on its own input."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names, columns = [n for n, _ in corpus_pipeline.STAGES], docs.columns
    assert names == ["quality", "near_dedup", "substring_dedup", "decontamination", "packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = materialise(stage(spark, docs, sf), name)
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name != "packing":
            assert out.columns == columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
            kept = {r["doc_id"]: r["text"] for r in out.collect()}
            assert len(kept) == out.count() and set(kept) <= set(before)
        if name == "quality":
            bad = {r["doc_id"] for r in q.QUERIES["op5_qda"](spark, sf).collect() if not r["predicted"]}
            assert set(kept) == set(before) - bad
        if name == "near_dedup":
            told = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
            assert set(kept) == set(told.values()) and set(told) == set(before)
        if name == "substring_dedup":
            report = superkmer.removal_report(docs).collect()
            assert {r["doc_id"] for r in report if not r["n_removed"]} == {i for i in kept if kept[i] == before[i]}
            assert all(len(kept[r["doc_id"]].split()) == r["n_words"] - r["n_removed"] for r in report if r["doc_id"] in kept)
            assert all(r["n_chars"] == len(r["text"]) for r in out.collect())
        if name == "decontamination":
            found = templates.contaminated(docs, q.table(spark, sf, "benchmark")).collect()
            assert set(kept) == set(before) - {r["doc_id"] for r in found}
        docs = out
    encode = tokenizer.encoder(tokenizer.vocabulary_file(q.VOCABULARY))
    sizes = {i: len(x) + 1 for i, x in zip(kept, encode(list(kept.values())), strict=True)}
    pieces = docs.collect()
    assert {r["doc_id"]: r["doc_tokens"] for r in pieces} == sizes
    assert sum(r["length"] for r in pieces) == sum(sizes.values())
    assert max(r["offset"] + r["length"] for r in pieces) <= packing.CAPACITY


def test_stages_keep_columns_that_clash(spark):
    """Columns called like those that stages add come out as they went in."""
    clashing = ("_doc", "_key", "_key_id", "_again", "_was_empty", "was_empty", "_gone_id", "gone_id", "gone_key", "spans", "start", "c1", "_row_0")
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({c: F.lit(7) for c in clashing})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert out.count() > 0 and out.filter(" or ".join(f"{c} <> 7 or {c} is null" for c in clashing)).count() == 0, name


def test_pipeline_runs_as_a_query(spark):
    import __spark_entry__

    got = __spark_entry__.queries()["pipeline"](spark, SF)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert got.count() > 0
    no_rows = [f(spark, spark.read.parquet(f"{SF}/documents.parquet").limit(0), SF).count() for _, f in corpus_pipeline.STAGES]
    assert no_rows == [0] * 5
