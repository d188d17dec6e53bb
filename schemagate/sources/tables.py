"""Reading back loaded tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: rows shown after a load.
PREVIEW_ROWS = 3


def preview(
    spark: SparkSession, table: str, order_by: list[str] | str | None = None, n: int = PREVIEW_ROWS
) -> DataFrame:
    """First ``n`` rows by ``order_by``, so the same rows show every time.

    The order is settled on its columns alone; whole rows are read only where their keys are
    among the first ``n``.  Without ``order_by`` any ``n`` rows are given, from few files.
    """
    rows = spark.table(table)
    if order_by is None:
        return rows.limit(n)
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    first = rows.select(*keys).orderBy(*keys).limit(n).distinct()
    same = [rows[k].eqNullSafe(first[k]) for k in keys]
    return rows.join(F.broadcast(first), same, "left_semi").orderBy(*keys).limit(n)
