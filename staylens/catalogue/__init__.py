"""Every operator bound to the driver tables, with an independent SQL form.

`queries()` and `oracle_sql()` gather what the modules of this package register.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from staylens.catalogue.registry import QUERIES, SQL


def load() -> None:
    from staylens.catalogue import (  # noqa: F401  (each import registers its queries)
        keys_and_tables, market_answers, models_and_features, quality_checks, scalars, statistics,
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load()
    return dict(SQL)
