"""Registry of runnable queries and their check SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@dataclass(frozen=True)
class Query:
    name: str
    survey: str
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


REGISTRY: dict[str, Query] = {}

# Named building blocks of the check SQL; a query pulls in the ones it mentions.
CTES: dict[str, str] = {}


def query(name: str, survey: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with optional check SQL."""

    def register(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(name, survey, fn, oracle)
        return fn

    return register


def cte(name: str, sql: str) -> None:
    CTES[name] = sql.strip()


def with_ctes(sql: str) -> str:
    """Prefix ``sql`` with every building block it needs, in order of use."""
    ordered: list[str] = []

    def need(text: str) -> None:
        for word in re.findall(r"[a-z_][a-z0-9_]*", text):
            if word in CTES and word not in ordered and CTES[word] is not text:
                need(CTES[word])
                if word not in ordered:
                    ordered.append(word)

    need(sql)
    if not ordered:
        return sql.strip()
    recursive = "RECURSIVE " if any(n.startswith("recursive_") for n in ordered) else ""
    return f"WITH {recursive}" + ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in ordered) + "\n" + sql.strip()
