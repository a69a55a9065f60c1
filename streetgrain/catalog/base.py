"""Registry of the check queries: one DataFrame builder and, where the
operator can be written in SQL, the same result in plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from streetgrain.session import configure

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
CHECK_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    """Register ``name``; ``sql`` is the check statement, if there is one."""

    def wrap(builder: Builder) -> Builder:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return builder(configure(spark), sf_dir)

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            CHECK_SQL[name] = sql.strip()
        return run

    return wrap
