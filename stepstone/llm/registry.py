"""Queries of this subpackage and the SQL they are checked against."""

from __future__ import annotations

from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from stepstone.plans.registry import Query

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
MODULES = (
    "fingerprint", "url_lists", "lattice", "packing", "simhash", "wordpiece", "bpe", "toxicity", "quality", "rules", "ball_tree", "conversations", "neighbours",
)


def query(name: str, sql: str | None = None):
    def keep(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return keep


def load_all() -> None:
    for name in MODULES:
        import_module(f"stepstone.llm.{name}")


def queries() -> dict[str, Query]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLES)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
