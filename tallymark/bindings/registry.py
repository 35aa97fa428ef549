"""Registering a query: how to run it, and the SQL it must agree with."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.bindings.roles import ROLES
from tallymark.functions.exprs import round_to

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _mentioned(sql: str) -> list[str]:
    return [n for n in dict.fromkeys(re.findall(r"<(\w+)>", sql)) if n in ROLES or n in TABLES]


class Tables:
    """Tables and roles (inputs shaped for an operator) of one data folder, by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._read: dict[str, DataFrame] = {}
        self._views: set[str] = set()
        self._tag = hashlib.md5(self.folder.encode()).hexdigest()[:8]

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}.parquet"

    def __call__(self, name: str) -> DataFrame:
        if name not in self._read:
            if name in TABLES:
                self._read[name] = self.spark.read.parquet(self.path(name))
            else:
                self._read[name] = self.spark.table(self._view(name))
        return self._read[name]

    def _view(self, name: str) -> str:
        view = f"t_{self._tag}_{name}"
        if view in self._views:
            return view
        self._views.add(view)
        if name in TABLES:
            self(name).createOrReplaceTempView(view)
        else:
            sql = ROLES[name]
            for used in _mentioned(sql):
                sql = sql.replace(f"<{used}>", self._view(used))
            self.spark.sql(sql).createOrReplaceTempView(view)
        return view


def _with_roles(sql: str) -> str:
    ordered: list[str] = []

    def visit(text: str) -> None:
        for n in _mentioned(text):
            if n in ROLES and n not in ordered:
                visit(ROLES[n])
                ordered.append(n)

    visit(sql)
    plain = lambda text: re.sub(r"<(\w+)>", lambda m: m.group(1) if m.group(1) in ROLES or m.group(1) in TABLES else m.group(0), text)
    if not ordered:
        return plain(sql)
    parts = ", ".join(f"{n} AS ({plain(ROLES[n])})" for n in ordered)
    body = plain(sql).strip()
    if body.upper().startswith("WITH "):
        return f"WITH {parts}, {body[5:]}"
    return f"WITH {parts} {body}"


def register(name: str, run: Callable[[Tables], DataFrame], sql: str | None = None) -> None:
    """``<name>`` in the SQL stands for a table or role."""
    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")
    QUERIES[name] = lambda spark, folder: run(Tables(spark, folder))
    if sql:
        ORACLES[name] = _with_roles(sql)


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Floating results cut to ``digits``, so that both engines agree on them."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: round_to(c, digits) for c in floats}) if floats else df


def names_of(column: str):
    """Names in a list of entries as one text."""
    return F.array_join(F.transform(column, lambda e: e["name"]), "|")
