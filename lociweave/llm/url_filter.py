"""URL verdicts: rules first, gradient-boosted trees on lexical features for the rest.

Everything is built from DataFrame and SQL functions. Training bins every feature once and
collapses the labelled URLs to distinct rows of bins with counts. Each level of a tree is one
aggregation to (node, feature, bin); the driver sees only these histograms, whose size is set by
depth, features and bins, picks the splits and extends the score expression. Scoring is that
expression, one nested condition per tree.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

TREES, DEPTH, BINS, RATE, RIDGE = 8, 3, 16, 0.3, 1.0
#: Hosts are dealt into this many folds by hash; the rate of a suffix leaves out the host's own fold.
FOLDS = 8
#: Labelled URLs of one suffix count together with this many at the share of bad ones overall.
SUFFIX_PRIOR = 20.0
CUT = 0.5


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3)))


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    raw = F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(raw, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, or null. ``rules``: domain with path prefix -> verdict.

    A rule fits its domain and all subdomains, if the path starts with the rule's. The rules are
    a parameter of a few lines and become one condition.
    """
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=len):
        domain, prefix = rule.split("/", 1)
        fits = (host == domain) | F.endswith(host, F.lit("." + domain))
        found = F.when(fits & F.startswith(path, F.lit("/" + prefix)), F.lit(rule)).otherwise(found)
    return found


def _entropy(s: Column) -> Column:
    n = F.greatest(F.length(s), F.lit(1)).cast("double")
    letters = F.array_distinct(F.split(s, ""))

    def term(total: Column, c: Column) -> Column:
        p = (F.length(s) - F.length(F.replace(s, c, F.lit("")))) / n
        return total + F.when((c != "") & (p > 0), -p * F.log2(p)).otherwise(0.0)

    return F.aggregate(letters, F.lit(0.0), term)


def _count(s: Column, letter: str) -> Column:
    return (F.length(s) - F.length(F.replace(s, F.lit(letter), F.lit("")))).cast("double")


def lexical(url: Column) -> dict[str, Column]:
    """Features of the text of a URL alone, as doubles; a null URL counts as empty."""
    url = F.coalesce(url, F.lit(""))
    host, path = host_of(url), path_of(url)
    length = F.greatest(F.length(url), F.lit(1)).cast("double")
    digits = F.length(url) - F.length(F.translate(url, "0123456789", ""))
    return {
        "length": length,
        "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"),
        "depth": _count(path, "/"),
        "dots": _count(host, "."),
        "hyphens": _count(host, "-"),
        "digit_ratio": digits / length,
        "entropy": _entropy(url),
        "params": _count(url, "=") + _count(url, "&"),
        "secure": F.startswith(url, F.lit("https:")).cast("double"),
    }


def labelled_urls(pages: DataFrame, rules: dict[str, str], seeds: tuple[str, ...], url_col: str = "url") -> DataFrame:
    """(``url_col``, ``bad``) of every URL with a host.

    Bad are URLs that a rule blocks, and those of hosts with a seed word as one of their words (runs
    of letters and digits). All others are counted as ordinary, those that nothing is known of too,
    as is usual with positive and unlabelled rows: most URLs are ordinary, and a bad one among
    them only lowers the scores of all that look like it.
    """
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    seeded = F.arrays_overlap(F.split(host, "[^a-z0-9]+"), F.array(*[F.lit(w) for w in seeds])) if seeds else F.lit(False)
    blocked = [r for r, v in rules.items() if v == "block"]
    rule = F.coalesce(rule_of(host, path, rules), F.lit(""))
    bad = (seeded | rule.isin(blocked)).cast("int")
    return pages.filter(host != "").select(url_col, bad.alias("bad"))


def suffix_of(host: Column) -> Column:
    """The last label of a host."""
    return F.substring_index(host, ".", -1)


@dataclass
class Trees:
    """Boosted trees over binned features. A tree is a list of (feature, bin) by node in level
    order, None where a node was not split, and the values of all nodes."""

    bias: float
    trees: list[tuple[list, list[float]]]

    def margin(self) -> Column:
        def value(tree, node: int) -> Column:
            splits, values = tree
            split = splits[node] if node < len(splits) else None
            if split is None:
                return F.lit(values[node])
            goes_left = F.col(f"b_{split[0]}") <= split[1]
            return F.when(goes_left, value(tree, 2 * node + 1)).otherwise(value(tree, 2 * node + 2))

        return reduce(add, [value(t, 0) for t in self.trees], F.lit(self.bias))


def _node(splits: list) -> Column:
    """Number of the node that a row reaches under the splits made so far."""

    def at(node: int) -> Column:
        split = splits[node] if node < len(splits) else None
        if split is None:
            return F.lit(node)
        return F.when(F.col(f"b_{split[0]}") <= split[1], at(2 * node + 1)).otherwise(at(2 * node + 2))

    return at(0)


def fit_trees(
    rows: DataFrame, names: list[str], trees: int = TREES, depth: int = DEPTH, rate: float = RATE, ridge: float = RIDGE
) -> Trees:
    """Logistic boosting of binned rows (b_<name> ..., n, bad): URLs of weight n, of which ``bad`` are
    to block."""
    import math

    total = rows.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    if not total["n"]:
        return Trees(0.0, [])
    share = (total["bad"] + 1) / (total["n"] + 2)
    model = Trees(math.log(share / (1 - share)), [])
    for _ in range(trees):
        p = 1 / (1 + F.exp(-model.margin()))
        base = rows.withColumns({"g": F.col("bad") - F.col("n") * p, "h": F.col("n") * p * (1 - p)})
        splits: list = []
        values: list[float] = [0.0]
        for level in range(depth):
            first, last = 2**level - 1, 2 ** (level + 1) - 2
            cells = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(f"b_{c}").alias("b")) for i, c in enumerate(names)]))
            found = (
                base.withColumn("node", _node(splits))
                .filter(F.col("node").between(first, last))
                .select("node", "g", "h", cells.alias("cell"))
                .groupBy("node", "cell.f", "cell.b")
                .agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
                .collect()  # at most 2**level * features * bins rows
            )
            splits += [None] * (last + 1 - len(splits))
            values += [0.0] * (2 * last + 3 - len(values))
            for node in range(first, last + 1):
                mine = sorted((r["f"], r["b"], r["g"], r["h"]) for r in found if r["node"] == node)
                if not mine:
                    continue
                g = sum(r[2] for r in mine if r[0] == mine[0][0])
                h = sum(r[3] for r in mine if r[0] == mine[0][0])
                best, gain = None, 1e-6
                left_g = left_h = 0.0
                for i, (f, b, cell_g, cell_h) in enumerate(mine):
                    if not i or mine[i - 1][0] != f:
                        left_g = left_h = 0.0
                    left_g, left_h = left_g + cell_g, left_h + cell_h
                    right_g, right_h = g - left_g, h - left_h
                    won = left_g**2 / (left_h + ridge) + right_g**2 / (right_h + ridge) - g**2 / (h + ridge)
                    more = i + 1 < len(mine) and mine[i + 1][0] == f
                    if more and won > gain:  # cut halfway to the next bin seen
                        best, gain = (f, (b + mine[i + 1][1]) // 2, left_g, left_h, right_g, right_h), won
                values[node] = rate * g / (h + ridge)
                if best:
                    f, b, left_g, left_h, right_g, right_h = best
                    splits[node] = (names[f], b)
                    values[2 * node + 1] = rate * left_g / (left_h + ridge)
                    values[2 * node + 2] = rate * right_g / (right_h + ridge)
        model.trees.append((splits, values))
    return model


def judge(
    pages: DataFrame,
    rules: dict[str, str],
    materialise,
    labelled: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    bins: int = BINS,
    cut: float = CUT,
) -> DataFrame:
    """Id, host, path, rule, verdict and score of every row of ``pages``.

    ``rules``: domain with path prefix -> allow or block; the longest rule that fits decides. Where
    none fits, the trees do: block if their probability is over ``cut``. They are trained
    from ``labelled`` (``url_col``, ``bad`` 0 or 1) or, without it, from the pages that a rule
    decides, all of them. ``materialise`` writes a table and reads it back.

    A null or malformed URL has an empty host and path and is judged by its features like any
    other. Repeated rows and null ids are kept. Without labelled URLs the trees block nothing.
    An empty table gives no rows.
    """

    def featured(df: DataFrame, *keep: Column) -> DataFrame:
        url = F.col(url_col)
        values = [c.alias(f"x_{n}") for n, c in lexical(url).items()]
        parts = df.select(*keep, host_of(url).alias("host"), path_of(url).alias("path"), *values)
        return parts.withColumns({"suffix": suffix_of(F.col("host")), "fold": F.pmod(F.xxhash64("host"), F.lit(FOLDS))})

    own = materialise(
        featured(pages, F.col(id_col).alias("_id")).withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)),
        "urls",
    )
    if labelled is None:
        verdicts = F.create_map(*[F.lit(x) for rule, v in rules.items() for x in (rule, int(v == "block"))])
        known = own.filter("rule is not null").withColumn("bad", verdicts[F.col("rule")])
    else:
        known = materialise(featured(labelled, F.col("bad")), "labelled").dropna(subset=["bad"])

    lexicals = [c for c in own.columns if c.startswith("x_")]
    points = [i / bins for i in range(1, bins)]
    overall = known.agg(
        F.avg("bad").alias("share"), *[F.percentile_approx(c, points, 1000).alias(c) for c in lexicals]
    ).first()  # one row
    share = overall["share"] or 0.0
    # sums by suffix and fold of hosts, then of all other folds: no URL's own host is in its rate
    sums = known.groupBy("suffix", "fold").agg(F.count("bad").alias("n"), F.sum("bad").alias("bad"))
    folds = F.explode(F.sequence(F.lit(0), F.lit(FOLDS - 1)).cast("array<bigint>"))
    others = sums.withColumnRenamed("fold", "left_out").withColumn("fold", folds).filter("fold <> left_out")
    by_suffix = others.groupBy("suffix", "fold").agg(
        ((F.sum("bad") + SUFFIX_PRIOR * share) / (F.sum("n") + SUFFIX_PRIOR)).alias("x_suffix")
    )
    cuts = {c: sorted(set(overall[c] or [])) for c in lexicals}
    cuts["x_suffix"] = [i / bins for i in range(1, bins)]
    names = [c.removeprefix("x_") for c in cuts]

    def binned(df: DataFrame) -> DataFrame:
        rated = df.join(by_suffix, ["suffix", "fold"], "left").withColumn("x_suffix", F.coalesce("x_suffix", F.lit(share)))
        above = {
            f"b_{c.removeprefix('x_')}": reduce(add, [(F.col(c) > p).cast("int") for p in points_], F.lit(0))
            for c, points_ in cuts.items()
        }
        return rated.withColumns(above)

    columns = [f"b_{n}" for n in names]
    distinct = binned(known).groupBy(*columns).agg(
        F.count("bad").cast("double").alias("n"), F.sum("bad").cast("double").alias("bad")
    )
    model = fit_trees(materialise(distinct, "bins"), names)
    probability = 1 / (1 + F.exp(-model.margin())) if model.trees else F.lit(0.0)
    by_rule = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair])[F.col("rule")]
    return (
        binned(own)
        .withColumn("score", probability)
        .select(
            F.col("_id").alias(id_col),
            "host",
            "path",
            "rule",
            F.coalesce(by_rule, F.when(F.col("score") > cut, "block").otherwise("allow")).alias("verdict"),
            "score",
        )
    )
