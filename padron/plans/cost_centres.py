"""Cost-centre catalogue from the employee master."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.operators import catalog, shape
from padron.plans.tables import COST_CENTRES
from padron.sources import sinks

ORDER = ("file", "sheet", "row_idx")


def catalogue(silver: DataFrame) -> DataFrame:
    """First row per cost centre in sheet order, sorted by code."""
    return _unique(silver).orderBy(_by_code())


def _by_code() -> Column:
    return F.col("CC").asc_nulls_first()


def _unique(silver: DataFrame) -> DataFrame:
    order = [o for o in ORDER if o in silver.columns]
    chosen = shape.select_required(silver, [*COST_CENTRES.columns, *[o for o in order if o not in COST_CENTRES.columns]])
    unique = catalog.keep_first(chosen, "CC", order)
    return shape.select_required(unique, COST_CENTRES.columns)


def run(silver: DataFrame, base: str) -> dict[str, str]:
    """The catalogue, stored in the order of its codes; its source is the checked silver table of the employees."""
    paths = sinks.write_versioned(_unique(silver), f"{base}/gold", "centros_costo", order=[_by_code()])
    sinks.missing_outputs(silver.sparkSession, paths)
    return paths
