"""Join helpers.

Which side is broadcast is left to the planner's statistics and to AQE's
runtime sizes. The one exception is a result bounded by its definition, such
as a top-k list: it may be broadcast whatever the size of the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_to_few(few: DataFrame, large: DataFrame, key: str) -> DataFrame:
    """``few LEFT JOIN large USING (key)`` without shuffling ``large``.

    ``few`` must be bounded by its definition (a top-k result). It becomes one value, an
    array of its rows, in a scalar subquery: ``large`` is filtered by the keys in it while
    it is scanned, and the few rows that match meet the array's rows. The subquery is used
    twice and run once, so ``few`` is computed once. Same rows as the left join,
    duplicates included.
    """
    rows = few.agg(F.collect_list(F.struct(*few.columns)).alias("rows")).scalar()
    matched = large.where(F.array_contains(rows.getField(key), F.col(key)))
    listed = few.sparkSession.range(1).select(F.inline(rows))
    return listed.join(matched, key, "left")
