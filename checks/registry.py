"""Registration of checks and composition of their SQL."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.tables_sql import CTES
from kpiloom.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def with_tables(body: str) -> str:
    """Prefix ``body`` with the logical tables it names, in dependency order."""
    order: list[str] = []

    def add(sql: str) -> None:
        for name, text in CTES.items():
            if name not in order and _names(name, sql):
                add(text)
                if name not in order:
                    order.append(name)

    add(body)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in order)
    return f"WITH {ctes}\n{body}" if not body.lstrip().upper().startswith("WITH ") else (
        f"WITH {ctes},\n{body.lstrip()[5:]}")


def _names(name: str, sql: str) -> bool:
    return re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql) is not None


def check(name: str, sql: str | None = None):
    """Register a query under ``name``, with its SQL if there is one."""
    def register(build):
        if name in QUERIES:
            raise ValueError(f"duplicate check {name}")
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return build
    return register


def shared_path(spark: SparkSession, name: str) -> str:
    """``scratch_path``; a local session without a shared folder gets one of its own."""
    unset = not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())
    if unset and spark.sparkContext.master.startswith("local"):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="checks-"))
    return scratch_path(spark, name)
