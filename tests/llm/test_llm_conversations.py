"""Repair of conversations and chat formatting: SQL over odd rows, brute force, round trips."""

import hashlib
import itertools
import random
import subprocess
import sys

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lociweave.llm import chat_format, chat_repair
from lociweave.llm.queries import ORACLES, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
MARKS = "</s>[INST] ok [/INST] <|im_end|>\n<|im_start|>user\n <\\s> <\\\\<s> <<SYS>> <<</SYS>>"


def odd_rows():
    rng = random.Random(5)
    texts = ["Yes.", "No", "", " \t", None, "Fine!", "Why?  ", "end ", "é. ", MARKS, "a" * 60_000 + "."]
    roles = ["user", "assistant", "system", "tool", "", None, "ugly\nrole\\", "User"]
    rows = []
    for conv in [*range(40), None, -1]:
        for _ in range(rng.randrange(1, 12)):
            turn = rng.choice([None, *range(8), 10**12])
            role = rng.choice(roles[:2] if rng.random() < 0.7 else roles)
            rows += [(conv, turn, role, rng.choice(texts[:6] if rng.random() < 0.7 else texts))] * rng.choice([1, 1, 1, 2, 5])
    for conv in range(100, 140):  # well-formed ones, of which damage makes the rest
        rows += [(conv, t, "user" if t % 2 == 0 else "assistant", f"text {t} of {conv}.") for t in range(conv % 9)]
    rows += [(200, t, "user", "the same.") for t in range(3000)]  # one conversation of very many turns
    return rows


def write(spark, folder, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    clashing = ("position", "segment", "audit", "copies2", "n", "fresh", "mark", "part", "edit")
    df.withColumns({c: F.lit("clash") for c in clashing}).repartition(5).write.parquet(f"{folder}/conversations.parquet")


def agree(spark, folder, name):
    found = QUERIES[name](spark, str(folder))
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{folder}/conversations.parquet/*.parquet'")
    told = con.sql(ORACLES[name])
    want = sorted(str(r) for r in told.fetchall())
    assert sorted(str(tuple(r)) for r in found.select(*told.columns).collect()) == want
    assert sorted(found.columns) == sorted(told.columns)
    return len(want)


@pytest.mark.parametrize("name", ["op11_chat_repair", "op13_prefix_targets"])
def test_odd_rows_as_the_sql_says(spark, tmp_path, name):
    write(spark, tmp_path, odd_rows())
    assert agree(spark, tmp_path, name) > 70


@pytest.mark.parametrize("name", ["op11_chat_repair", "op13_prefix_targets"])
def test_no_conversations(spark, tmp_path, name):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert agree(spark, tmp_path, name) == (1 if name.startswith("op13") else 0)


def edits_of(rows):
    """Brute force: the least (cost, audit) of all runs of edits with up to two inserted turns in a gap."""
    gaps = [("", 0), ("u", 2), ("a", 2), ("ua", 4), ("au", 4)]
    options = []
    for initial, must_go, truncated in rows:
        own = [("D", "", 3)]
        if not must_go:
            own += [("K", initial, truncated)] + [("R", new, 2 + truncated) for new in "ua"]
        options.append(own)
    best = None
    for chosen in itertools.product(*options):
        for filled in itertools.product(gaps, repeat=len(rows) + 1):
            audit, roles, cost = "", "", 0
            for i, (new, price) in enumerate(filled):
                audit, roles, cost = audit + "I" * len(new), roles + new, cost + price
                if i < len(rows):
                    edit, left, price = chosen[i]
                    audit, roles, cost = audit + edit, roles + left, cost + price
            body = roles.removeprefix("s")
            if (best is None or (cost, audit) < best) and body == "ua" * (len(body) // 2) and (body or not roles):
                best = (cost, audit)
    return best


def test_cells_are_brute_force():
    kinds = [(r, g, t) for r in "suat" for g, t in ((False, False), (False, True), (True, False))]
    rng = random.Random(0)
    cases = [[rng.choice(kinds) for _ in range(n)] for n in (0, 1, 2, 2, 3, 3, 3) for _ in range(6)]
    for rows in cases:
        cells = [chat_repair.CHAT.turn(*r) for r in rows]
        assert chat_repair.CHAT.best(chat_repair.CHAT.parse(cells)) == edits_of(rows), rows


def test_every_split_of_a_span_gives_the_same_cell():
    rng = random.Random(1)
    grammar = chat_repair.CHAT
    cells = [grammar.turn(rng.choice("suax"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(30)]
    whole = grammar.parse(cells)
    for cut in range(1, 30):
        assert grammar.joined(grammar.parse(cells[:cut]), grammar.parse(cells[cut:])) == whole
    assert grammar.gone(3) == grammar.parse([grammar.turn("u", True, False)] * 3)


@pytest.mark.parametrize("piece", [1, 2, 7])
def test_pieces_of_any_size_give_the_same_verdicts(spark, piece):
    rows = spark.createDataFrame([r for r in odd_rows() if r[0] != 200], SCHEMA).repartition(3)
    damaged = chat_repair.damaged(rows)
    want = chat_repair.repair(damaged)
    got = chat_repair.repair(damaged, piece=piece)
    for a, b in zip(got, want, strict=True):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_repaired_turns(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "user", "More"), (2, 0, "system", "Be."), (3, 5, "tool", " ")]
    verdict, turns = chat_repair.repair(spark.createDataFrame(rows, SCHEMA))
    told = {r["conv_id"]: (r["cost"], r["audit"], r["duplicate"], r["truncated"], r["blank"], r["gaps"]) for r in verdict.collect()}
    assert told == {1: (6, "KDR", 1, 1, 0, 0), 2: (3, "D", 0, 0, 0, 0), 3: (3, "D", 0, 0, 1, 0)}
    got = sorted((r["conv_id"], r["position"], r["role"], r["text"], r["edit"]) for r in turns.collect())
    assert got == [(1, 0, "user", "Hi.", "K"), (1, 1, "assistant", "More", "R")]


TEXT = st.lists(st.sampled_from([*chat_format.CONTROLS, "\\", "<", "[", "s>", "/s>", "|im_end|>", "INST]", "\n", "x", "é"]), max_size=8).map("".join)


def test_escapes_are_reversible_and_hide_all_marks(spark):
    template = chat_format.CHATML
    read, _ = template.reader()
    seen = []

    @settings(max_examples=400, deadline=None)
    @given(TEXT, TEXT)
    def collect(role, text):
        seen.append((role, text))

    collect()
    df = spark.createDataFrame(seen, "role string, text string")
    for r in df.select("role", "text", template.segment(F.col("role"), F.col("text")).alias("s"), template.escaped(F.col("text")).alias("e")).collect():
        assert read(r["s"]) == [(r["role"], r["text"])]
        assert not any(c in r["e"] for c in template.controls)
    assert len({r[0] for r in df.distinct().select(template.escaped(F.col("text"))).collect()}) == len({t for _, t in seen})


def test_examples_hold_all_turns_before_and_train_on_the_reply_only(spark):
    rows = [(1, 0, "system", "S"), (1, 1, "user", "a <s>"), (1, 2, "assistant", "b </s>"), (1, 3, "assistant", None), (1, 4, "user", "c"),
            (2, 0, "user", "alone"), (3, 0, "assistant", "first")]
    expanded = chat_format.expand(spark.createDataFrame(rows, SCHEMA).repartition(3))
    read, plain = chat_format.CHATML.reader()
    got = {}
    for r in chat_format.render(expanded).collect():
        loss = None if r["loss_start"] is None else plain(r["text"][r["loss_start"] : r["loss_end"]])
        got[r["conv_id"], r["example"]] = ([t for _, t in read(r["text"])], loss)
    assert got == {
        (1, 0): (["S", "a <s>", "b </s>"], "b </s>"),
        (1, 1): (["S", "a <s>", "b </s>", ""], ""),
        (1, 2): (["S", "a <s>", "b </s>", "", "c"], None),
        (2, 0): (["alone"], None),
        (3, 0): (["first"], "first"),
    }
    told = {r["conv_id"]: r for r in chat_format.read_back(expanded).collect()}
    sizes = {}
    for r in chat_format.render(expanded).collect():
        sizes[r["conv_id"]] = sizes.get(r["conv_id"], 0) + len(r["text"])
    assert {c: r["formatted_chars"] for c, r in told.items()} == sizes
    turns = "".join(f"{role}\n{text or ''}\n" for c, _, role, text in rows if c == 1)
    assert told[1]["turns_sha256"] == hashlib.sha256(turns.encode()).hexdigest()
    assert told[2]["loss_chars"] == 0 and told[2]["loss_sha256"] == hashlib.sha256().hexdigest()


def test_each_example_is_a_row_with_the_text_of_its_whole_prefix(spark):
    rows = [(c, t, ("user", "assistant")[t % 2], "x" * 50_000) for c in range(2) for t in range(40)]
    expanded = chat_format.expand(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert expanded.count() == 40 and set(expanded.columns) >= {"example", "text", "loss_start", "loss_end"}
    read, _ = chat_format.CHATML.reader()
    for r in expanded.filter("example in (0, 19)").collect():
        turns = read(r["text"])
        assert len(turns) == 2 * r["example"] + 2 and all(said == "x" * 50_000 for _, said in turns)
        assert r["text"][r["loss_start"] : r["loss_end"]] == turns[-1][1] and r["chars"] == len(r["text"])


def test_templates_are_checked():
    with pytest.raises(ValueError):
        chat_format.Template(begin="<turn>")
    with pytest.raises(ValueError):
        chat_format.Template(controls=(*chat_format.CONTROLS, "x"))
    own = chat_format.Template(begin="[[", end="]]", controls=("[[", "]]", "^^"))
    assert own.reader()[0]("[[user\nhi]]\n") == [("user", "hi")]


@pytest.mark.parametrize("module", ["text", "multi_index"])
def test_modules_load_what_their_tasks_call(module):
    # in a process of its own, as on an executor where nothing else has loaded it
    code = f"import pyarrow as pa, lociweave.llm.{module}; assert pa.compute.binary_length(pa.array(['ab']))[0].as_py() == 2"
    subprocess.run([sys.executable, "-c", code], check=True)
