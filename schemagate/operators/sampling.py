"""A look at the rejects."""

from __future__ import annotations

from pyspark.sql import DataFrame

from schemagate.contract import CORRUPT
from schemagate.functions import sql
from schemagate.functions.messages import SAMPLE_WIDTH, shortened
from schemagate.operators.marking import invalid_rows

# Fixed value: rejects shown.
SAMPLE_ROWS = 5


def invalid_sample(
    marked: DataFrame,
    *,
    columns: tuple[str, ...] = (),
    order_by: tuple[str, ...] = (CORRUPT,),
    n: int = SAMPLE_ROWS,
    width: int = SAMPLE_WIDTH,
) -> DataFrame:
    """First ``n`` rejects by ``order_by``, with their text cut to ``width``.

    Each task keeps its own first ``n``; no full sort takes place.
    """
    sort_only = [c for c in order_by if c not in (*columns, CORRUPT)]
    rejects = invalid_rows(marked).select(*columns, *sort_only, CORRUPT)
    first = rejects.orderBy(*order_by).limit(n)
    return first.selectExpr(*map(sql.name, columns), f"{shortened(CORRUPT, width)} AS {CORRUPT}")
