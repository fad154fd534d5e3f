"""Stored SQL over named tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from padron.session import quoted


def run_sql(
    spark: SparkSession, text: str, tables: Mapping[str, DataFrame], args: Mapping[str, Any] | None = None
) -> DataFrame:
    """Runs one query over the given tables; ``:name`` markers take their values from ``args``.

    The names hold for this call only: each table is a view under a name nobody else has, the query sees it under the
    given one, and the views are gone when the query has been read. Jobs that use one name at once, or a name that is a
    view of the session already, each see their own rows.
    """
    views = {name: f"{name}_{uuid.uuid4().hex}" for name in tables}
    try:
        for name, table in tables.items():
            table.createOrReplaceTempView(quoted(views[name]))
        named = ", ".join(f"{quoted(name)} AS (SELECT * FROM {quoted(view)})" for name, view in views.items())
        return spark.sql(f"WITH {named} SELECT * FROM (\n{text}\n)" if named else text, args=dict(args or {}))
    finally:
        for view in views.values():
            spark.catalog.dropTempView(view)
