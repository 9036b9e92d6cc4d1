"""Registering a query together with the SQL that must give the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lociweave import fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The input tables of one scale, as ``t("sumstats")``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        return fixtures.table(self.spark, self.sf_dir, name)

    @property
    def far(self) -> bool:
        """Whether their positions are in 64 bits."""
        return fixtures.is_far(self.spark, self.sf_dir)

    def derived(self, name: str, build) -> DataFrame:
        return fixtures.derived(self.spark, self.sf_dir, name, build)


def with_recipes(sql: str, needs=(), ctes=()) -> str:
    """One statement: the recipes behind ``needs``, more CTEs, then ``sql``."""
    parts = [(n, fixtures.RECIPES[n]) for n in fixtures.closure(needs)] + list(ctes)
    if not parts:
        return sql.strip()
    recursive = any(re.search(rf"\bfrom {re.escape(n)}\b", body) for n, body in ctes)
    return ("with recursive " if recursive else "with ") + ",\n".join(f"{n} as ({body.strip()})" for n, body in parts) + "\n" + sql.strip()


def query(name: str, sql: str | None = None, needs=(), ctes=()):
    """Decorator: ``fn(tables) -> DataFrame`` becomes the query ``name``."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_recipes(sql, needs, ctes)
        return fn

    return register
