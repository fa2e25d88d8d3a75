"""Registered queries: operators over the domain tables, each with SQL that DuckDB runs on the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_QUERIES: dict[str, Callable] = {}
_SQL: dict[str, str] = {}
#: SQL as written, without the domain tables put ahead.
RAW: dict[str, str] = {}


class Tables:
    """Domain and driver tables of one folder, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._at, self._seen = (spark, sf_dir), {}

    def __getattr__(self, name: str) -> DataFrame:
        from ..sources.adapter import domain

        return domain(*self._at, name, self._seen)

    def written(self, name: str, columns: list[str]) -> DataFrame:
        """These columns of a domain table, written once: the domain tables that are made from it hereafter read them from there."""
        from ..session import materialize

        self._seen[name] = materialize(getattr(self, name).select(*columns), name, "zstd")
        return self._seen[name]

    @property
    def spark(self) -> SparkSession:
        return self._at[0]


def query(name: str, sql: str | None = None):
    """Register a function of Tables under ``name``."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from ..session import bounded_tasks, make_importable

            make_importable(spark)
            bounded_tasks(spark)
            return f(Tables(spark, sf_dir))

        run.__doc__ = f.__doc__
        _QUERIES[name] = run
        if sql:
            from ..sources.adapter import with_domain

            RAW[name], _SQL[name] = sql, with_domain(sql)
        return f

    return add


def _load() -> None:
    from . import alerting, assets, bundling, dispatching, enriching, exports, identity, jobs, linking, merging, more, readers, rules, serving, steps, stored, texts  # noqa: F401


def queries() -> dict[str, Callable]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
