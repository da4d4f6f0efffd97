"""Query registry: one entry per operator, with its ANSI SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    build: Build
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, covers: str, build: Build, sql: str | None = None) -> None:
    if name in REGISTRY:
        raise ValueError(f"query {name} registered twice")
    REGISTRY[name] = Query(name, tuple(covers.split()), build, sql)


def query(name: str, covers: str, sql: str | None = None):
    def wrap(build: Build) -> Build:
        register(name, covers, build, sql)
        return build

    return wrap


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double so both engines print the same value."""
    return df.select(
        *[
            F.round(f.name, digits).alias(f.name)
            if f.dataType.typeName() in ("double", "float")
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def r(expr: str, name: str, digits: int = 6) -> str:
    """SQL twin of ``rounded``; adding 0.0 turns -0.0 into 0.0."""
    return f"round({expr}, {digits}) + 0.0 AS {name}"


def with_ctes(ctes: Sequence[str], body: str, recursive: bool = False) -> str:
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(c.strip() for c in ctes) + "\n" + body.strip()
