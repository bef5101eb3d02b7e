"""One-row aggregates turned into readable long tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stacked(frame: DataFrame, keys: list[str], rows: Iterable[tuple], names: list[str]) -> DataFrame:
    """Each input row becomes one output row per tuple; a tuple holds literals and Columns."""
    cells = F.array(*(
        F.struct(*((v if isinstance(v, Column) else F.lit(v)).alias(n) for v, n in zip(row, names)))
        for row in rows
    ))
    return frame.select(*keys, F.inline(cells))


def count_rows(frame: DataFrame, counts: Mapping[str, Column], label: str, value: str) -> DataFrame:
    """One global aggregation, one output row per named count."""
    wide = frame.agg(*(expression.alias(name) for name, expression in counts.items()))
    return stacked(wide, [], ((name, F.col(name)) for name in counts), [label, value])
