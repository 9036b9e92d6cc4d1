"""Quality scores, URL verdicts and nearest neighbours."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lociweave.llm import multi_index, qda, url_filter
from lociweave.llm.queries import QUERIES, SPAM_WORDS, URL_RULES
from lociweave.session import materialise

SF = "/root/testdata/sf0.01"


def test_quality_on_held_out_rows(spark):
    got = {r["doc_id"]: r for r in QUERIES["op5_qda"](spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [(got[r["doc_id"]]["predicted"], r["quality"]) for r in labels if got[r["doc_id"]]["held_out"]]
    assert sum(p == q for p, q in held) >= 0.97 * len(held)


def test_scores_do_not_use_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = labels.withColumn("quality", F.when(qda.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(tuple(r) for r in qda.score_documents(docs, x, materialise).collect()) for x in (labels, turned))
    assert a == b


def test_quality_of_odd_rows(spark):
    rows = [(1, "some plain words here", "x"), (2, "", "x"), (3, None, "x"), (None, "no id", "x"), (1, "some plain words here", "x"), (4, "w " * 200_000, "x"), (5, "\0!?", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(3)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in qda.score_documents(docs, none, materialise).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1), (1, 1), (4, 1), (None, 0), (2, None)], "doc_id long, quality int")
    assert {r["score"] for r in qda.score_documents(docs, one, materialise).collect()} == {1.0}
    both = spark.createDataFrame([(1, 1), (4, 0), (3, 1), (2, 1)], "doc_id long, quality int")
    got = qda.score_documents(docs, both, materialise).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    kept = qda.keep_good(docs, both)
    assert kept.columns == docs.columns
    good = sorted(str(r["doc_id"]) for r in got if r["predicted"])
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == good
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert qda.score_documents(empty, both, materialise).collect() == []


def test_model_is_the_textbook_one():
    rng = np.random.default_rng(0)
    size = len(qda.STATISTICS)
    mean, root = rng.normal(size=size), rng.normal(size=(size, size))
    cov = root @ root.T + np.eye(size)
    factor = np.linalg.cholesky(cov)
    own = qda.Gaussian(-0.5, mean, np.linalg.inv(factor), -float(np.log(np.diag(factor)).sum()))
    x = rng.normal(size=(5, size))
    want = [-0.5 - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * (v - mean) @ np.linalg.solve(cov, v - mean) for v in x]
    assert np.allclose(own.log_density(x), want)


def parts(url):
    """Brute force: host, path and longest rule."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = []
    for rule in URL_RULES:
        domain, prefix = rule.split("/", 1)
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + prefix):
            fits.append(rule)
    return host, path, max(fits, key=len, default=None)


ODD_URLS = [None, "", "http://", "x://Net/es/?a", "http://example.com/en", "HTTP://WWW.EXAMPLE.COM/en/x\n#y", "http://a.net/fr/é?://z/",
            "ftp:/a", "http://com/", "http://xcom/", "http://a.com", "http://example.com/en/", "://a.net/fr/", "a" * 5000, "http://É.NET/es/"]


def test_url_rules(spark):
    rows = [*enumerate(ODD_URLS), (3, ODD_URLS[3]), (None, "http://b.com/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit("x") for c in ("host", "rule", "_id", "bad")})
    got = url_filter.judge(pages, URL_RULES, materialise).collect()
    assert sorted(str((r["page_id"], r["host"], r["path"], r["rule"])) for r in got) == sorted(str((i, *parts(u))) for i, u in rows)
    assert all(r["verdict"] == URL_RULES[r["rule"]] for r in got if r["rule"])
    assert all(r["verdict"] in ("allow", "block") for r in got)
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(empty, URL_RULES, materialise).collect() == []


def test_url_query(spark):
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op6_url_filter"](spark, SF).collect()
    assert len(got) == len(urls)
    for r in got:
        assert (r["host"], r["path"], r["rule"]) == parts(urls[r["page_id"]])
        assert not r["rule"] or r["verdict"] == URL_RULES[r["rule"]]


def test_trees_learn_what_urls_tell(spark):
    rng = random.Random(0)
    good = [f"https://site{rng.randrange(9)}.org/page" for _ in range(60)]
    bad = [f"http://win-{rng.randrange(10**6)}.biz/a/b/c?x={i}&y=2" for i in range(60)]
    pages = spark.createDataFrame([*enumerate(good + bad)], "page_id long, url string")
    labelled = pages.filter("page_id % 2 = 0").withColumn("bad", (F.col("page_id") >= 60).cast("int"))
    got = url_filter.judge(pages, {"example.net/": "block"}, materialise, labelled).collect()
    assert all((r["verdict"] == "block") == (r["page_id"] >= 60) for r in got)


def area_under_curve(good, bad):
    return sum((b > g) + (b == g) / 2 for b in bad for g in good) / (len(good) * len(bad))


def test_hosts_held_out(spark):
    """Trained on half of the hosts, the trees tell the bad hosts of the other half from ordinary ones."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    held = F.pmod(F.crc32(F.regexp_extract(url_filter.host_of(F.col("url")), r"([^.]+)\.example", 1)), F.lit(2)) == 0
    labelled = url_filter.labelled_urls(pages.filter(~held), URL_RULES, SPAM_WORDS)
    got = url_filter.judge(pages.filter(held), URL_RULES, materialise, labelled).filter("rule is null").collect()
    spam = [r["score"] for r in got if any(w in r["host"] for w in SPAM_WORDS)]
    ordinary = [r["score"] for r in got if not any(w in r["host"] for w in SPAM_WORDS)]
    assert spam and ordinary
    assert area_under_curve(ordinary, spam) > 0.9
    assert {r["verdict"] for r in got} == {"allow", "block"} and len({r["score"] for r in got}) > 2


def test_seed_words_are_whole_words(spark):
    urls = ["http://fun-ads.org/", "http://heads.org/", "http://x.net/fr/1", "http://x.com/", "nothing", None]
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    got = url_filter.labelled_urls(pages, URL_RULES, ("ads",)).collect()
    assert [(r["url"], r["bad"]) for r in got] == [(urls[0], 1), (urls[1], 0), (urls[2], 1), (urls[3], 0)]


def boosted(rows, trees, depth, rate, ridge):
    """Margins of rows (bins, n, bad) by plain boosting: every cut of every node is tried."""
    share = (sum(r[2] for r in rows) + 1) / (sum(r[1] for r in rows) + 2)
    margins = [np.log(share / (1 - share))] * len(rows)
    for _ in range(trees):
        p = [1 / (1 + np.exp(-m)) for m in margins]
        g = [bad - n * q for (_, n, bad), q in zip(rows, p, strict=True)]
        h = [n * q * (1 - q) for (_, n, _), q in zip(rows, p, strict=True)]
        score = lambda of: sum(g[i] for i in of) ** 2 / (sum(h[i] for i in of) + ridge)

        def grow(of, left):
            cuts = [
                (score(low) + score(high) - score(of), -f, -a, low, high)
                for f in range(len(rows[0][0]))
                for a in sorted({rows[i][0][f] for i in of})[:-1]
                for low, high in [([i for i in of if rows[i][0][f] <= a], [i for i in of if rows[i][0][f] > a])]
            ]
            best = max(cuts, default=(0.0,))
            if left and best[0] > 1e-6:
                for side in best[3:]:
                    grow(side, left - 1)
            else:
                for i in of:
                    margins[i] += rate * sum(g[j] for j in of) / (sum(h[j] for j in of) + ridge)

        grow(range(len(rows)), depth)
    return margins


def test_trees_are_those_of_plain_boosting(spark):
    rng = random.Random(3)
    rows = [([rng.randrange(4) for _ in range(3)], float(rng.randrange(5, 40)), 0.0) for _ in range(60)]
    rows = [(b, n, float(round(n * (0.8 if b[0] > 1 and b[2] < 2 else 0.2) * rng.random()))) for b, n, _ in rows]
    df = spark.createDataFrame([(*b, n, bad) for b, n, bad in rows], "b_x int, b_y int, b_z int, n double, bad double")
    model = url_filter.fit_trees(df, ["x", "y", "z"], trees=4)
    got = [r["m"] for r in df.select(model.margin().alias("m")).collect()]
    assert got == pytest.approx(boosted(rows, 4, url_filter.DEPTH, url_filter.RATE, url_filter.RIDGE))


def test_features_of_a_url(spark):
    url = "https://a-b.x.com/p/q1?k=v&z=22"
    row = spark.range(1).select(*[c.alias(n) for n, c in url_filter.lexical(F.lit(url)).items()]).first()
    counts = [url.count(c) / len(url) for c in set(url)]
    assert row["entropy"] == pytest.approx(-sum(p * np.log2(p) for p in counts))
    assert (row["length"], row["depth"], row["dots"], row["hyphens"], row["params"], row["secure"]) == (len(url), 2, 2, 1, 3, 1)
    assert row["digit_ratio"] == pytest.approx(3 / len(url))


def exact(rows, queries, k):
    """Brute force over (id, vector): {query: [(score, id), ...]}."""
    out = {}
    for q in queries:
        own = np.array(next(v for i, v in rows if i == q), np.float32).astype(float)
        near = [(float(np.sqrt(((np.array(v, np.float32).astype(float) - own) ** 2).sum())), i) for i, v in rows if i != q]
        out[q] = sorted(near)[:k]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["score"], r["vec_id"]))
    return out


@pytest.mark.parametrize("strip", [4096, 2])
def test_neighbours_of_odd_vectors(spark, strip):
    good = [(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(30)] + [(100, [2.0, 1.0, 2.0])]
    odd = [(31, None), (32, [0.0, -0.0, 0.0]), (33, [1.0, None, 2.0]), (34, [float("nan"), 1.0, 1.0]), (36, [float("inf"), 1.0, 1.0]),
           (35, [1.0]), (37, []), (None, [1.0, 1.0, 1.0]), (3, [3.0, 1.0, 0.0])]
    df = spark.createDataFrame(good + odd, "vec_id long, embedding array<float>").repartition(3)
    df = df.withColumns({c: F.lit("x") for c in ("id", "cell", "score", "ids", "rank")})
    got = answers(multi_index.search(df, F.col("vec_id") % 10 == 0, materialise, strip=strip))
    assert got == exact(good, [0, 10, 20, 100], 10)


def test_few_and_no_candidates(spark):
    def search(rows):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        return answers(multi_index.search(df, F.col("vec_id") % 100 == 0, materialise))

    assert search([]) == {}
    assert search([(0, [1.0, 2.0])]) == {}
    assert search([(1, [1.0, 2.0]), (2, [1.0, 3.0])]) == {}
    assert search([(0, [1.0, 2.0]), (7, [4.0, 6.0]), (100, [1.0, 2.0])]) == {0: [(0.0, 100), (5.0, 7)], 100: [(0.0, 0), (5.0, 7)]}


def test_many_equal_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(300)] + [(1000 + i, [float(i), 5.0]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = answers(multi_index.search(df, F.col("vec_id") % 100 == 0, materialise))
    assert got == exact(rows, [0, 100, 200, 1000], 10)


def test_recall_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = answers(QUERIES["op7_multi_index"](spark, sf))
    want = exact(rows, [i for i, _ in rows if i % 100 == 0], 10)
    assert set(got) == set(want)
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)


def test_cells_come_in_the_order_of_the_summed_distance():
    rng = np.random.default_rng(0)
    a, b, sizes = rng.random(6), rng.random(5), rng.integers(0, 3, 30)
    sums = (a[:, None] + b[None]).ravel()
    want = [c for c in np.argsort(sums, kind="stable").tolist() if sizes[c]]
    assert [c for c, _ in multi_index.traversal(a, b, sizes)] == want
    assert multi_index.visited(a, b, sizes, 7) == want[: int(np.searchsorted(np.cumsum(sizes[want]), 7)) + 1]


def test_best_keeps_the_closest_whatever_the_limit():
    rng = np.random.default_rng(0)
    rows = [(int(q), float(s), [int(i)]) for q, s, i in zip(rng.integers(0, 9, 600), rng.integers(0, 20, 600), rng.permutation(600), strict=True)]
    want = {q: sorted((s, i[0]) for p, s, i in rows if p == q)[:5] for q in range(9)}
    for limit in (10, 100, 10_000):
        best, out = multi_index.Best(5, limit), []
        for a in range(0, 600, 7):
            q, s, i = zip(*rows[a : a + 7], strict=True)
            best.add(np.array(q), np.array(s), pa.array(i, pa.list_(pa.int64())))
            if best.full():
                out += best.take().to_pylist()
        out += best.take().to_pylist()
        assert {q: sorted((r["score"], r["ids"][0]) for r in out if r["uid"] == q)[:5] for q in range(9)} == want
        assert best.take().num_rows == 0
