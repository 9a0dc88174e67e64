"""Approximate distinct counts that can be merged, for those who ask for them.

A sketch has a fixed size (about 16 KB at most) whatever it counts, is stored
like any column and merges with others: days to months, provinces to the
country. The estimate is within 2 % or so; counts of some hundreds are exact.
Reports use exact counts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRECISION = 14


def sketch(column: Column | str) -> Column:
    """Aggregate: sketch of the different values of a text or whole-number column."""
    return F.hll_sketch_agg(column, F.lit(PRECISION))


def merged(column: Column | str) -> Column:
    """Aggregate: sketch of all that the sketches of a column count."""
    return F.hll_union_agg(column)


def estimate(column: Column | str) -> Column:
    return F.hll_sketch_estimate(column)
