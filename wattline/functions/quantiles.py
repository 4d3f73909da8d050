"""Exact interpolated quantiles by distributed selection of ranks.

The built-in `percentile` keeps every distinct value in one buffer, which is
fine for counts and too much for money over a billion customers. Here a wanted
rank is closed in by cells of values instead. `percentile_approx` proposes a cell
whose two ends lie closely around the rank; one pass counts the rows below it, on
either end and inside. Either an end is the answer, or the search goes on inside
the cell that holds the rank, which has well under a hundredth of the rows,
until a cell has so few that they can be read. No task orders or holds more than
`limit` values a statistic, and ten billion rows take two rounds.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCURACY = 2_000
LIMIT = 1 << 16


@dataclass(frozen=True)
class Cell:
    """The values of a column between two others, how many rows have them, and which of these rows in order are wanted."""

    name: str
    column: str
    low: float | None
    high: float | None
    rows: int
    ranks: tuple[tuple[int, int], ...]  # (rank in the column, rank in the cell)

    def holds(self, v: Column) -> Column:
        inside = v.isNotNull()
        if self.low is not None:
            inside = inside & (v > self.low)
        return inside if self.high is None else inside & (v < self.high)

    def within(self, low: float | None, high: float | None, rows: int, before: int) -> Cell | None:
        """The part of this cell from `before` rows on, if it holds a wanted rank."""
        ranks = tuple((rank, own - before) for rank, own in self.ranks if before <= own < before + rows)
        return Cell(self.name, self.column, low, high, rows, ranks) if ranks else None


def _value(column: str) -> Column:
    """The column as a double, NaN as NULL."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def _narrowed(df: DataFrame, cells: list[Cell], accuracy: int) -> tuple[dict[tuple[str, int], float], list[Cell]]:
    """Ranks found at the ends of closer cells, and the cells that hold the others."""
    margin = 2.0 / accuracy
    brackets = []
    for i, cell in enumerate(cells):
        v = _value(cell.column)
        own = [rank / max(1, cell.rows - 1) for _, rank in cell.ranks]
        shares = F.array(F.lit(max(0.0, min(own) - margin)), F.lit(min(1.0, max(own) + margin)))
        brackets.append(F.percentile_approx(F.when(cell.holds(v), v), shares, F.lit(accuracy)).alias(f"b{i}"))
    ends = df.agg(*brackets).first()
    counts = []
    for i, cell in enumerate(cells):
        v, (low, high) = _value(cell.column), ends[i]
        parts = {"below": v < low, "low": v == low, "inside": (v > low) & (v < high), "high": (v == high) & (v > low), "above": v > high}
        counts += [F.count_if(cell.holds(v) & rule).alias(f"{part}{i}") for part, rule in parts.items()]
    counted = df.agg(*counts).first()
    found, left = {}, []
    for i, cell in enumerate(cells):
        low, high = ends[i]
        below, on_low, inside, on_high, above = counted[5 * i : 5 * i + 5]
        for value, rows, before in ((low, on_low, below), (high, on_high, below + on_low + inside)):
            found |= {(cell.name, rank): value for rank, own in cell.ranks if before <= own < before + rows}
        left += [
            cell.within(cell.low, low, below, 0),
            cell.within(low, high, inside, below + on_low),
            cell.within(high, cell.high, above, below + on_low + inside + on_high),
        ]
    return found, [cell for cell in left if cell]


def _read(df: DataFrame, cells: list[Cell]) -> dict[tuple[str, int], float]:
    """The wanted ranks of small cells from their distinct values."""
    entries = [F.struct(F.lit(i).alias("cell"), F.when(c.holds(_value(c.column)), _value(c.column)).alias("v")) for i, c in enumerate(cells)]
    values = df.select(F.explode(F.array(*entries)).alias("e")).select("e.*").where("v is not null")
    table = values.groupBy("cell", "v").agg(F.count("*").alias("n")).toArrow()
    number, value, n = (table.column(c).to_numpy() for c in ("cell", "v", "n"))
    found = {}
    for i, cell in enumerate(cells):
        own = np.flatnonzero(number == i)
        own = own[np.argsort(value[own])]
        upto = np.cumsum(n[own])
        found |= {(cell.name, rank): float(value[own][np.searchsorted(upto, at, "right")]) for rank, at in cell.ranks}
    return found


def exact_quantiles(
    df: DataFrame, wanted: Mapping[str, tuple[str, float]], accuracy: int = ACCURACY, limit: int = LIMIT
) -> DataFrame:
    """One row with a column per entry of `wanted` (name -> (column, p)).

    Equals linear interpolation between the neighbouring order statistics;
    NULL and NaN are skipped, and an empty column gives NULL. Reads `df` twice,
    and twice more for every round that closes in on a rank, so give a stored frame.
    """
    columns = list(dict.fromkeys(column for column, _ in wanted.values()))
    rows = dict(zip(columns, df.agg(*[F.count(_value(c)) for c in columns]).first(), strict=True))
    at = {name: p * (rows[column] - 1) for name, (column, p) in wanted.items() if rows[column]}
    cells = []
    for name, place in at.items():
        column = wanted[name][0]
        ranks = tuple((rank, rank) for rank in sorted({math.floor(place), math.ceil(place)}))
        cells.append(Cell(name, column, None, None, rows[column], ranks))
    found: dict[tuple[str, int], float] = {}
    while large := [c for c in cells if c.rows > limit]:
        small = [c for c in cells if c.rows <= limit]
        ends, closer = _narrowed(df, large, accuracy)
        found, cells = found | ends, small + closer
    if cells:
        found |= _read(df, cells)

    def between(name: str) -> float:
        low, high = found[name, math.floor(at[name])], found[name, math.ceil(at[name])]
        return low if low == high else low + (high - low) * (at[name] - math.floor(at[name]))

    values = {name: between(name) if name in at else None for name in wanted}
    one = df.sparkSession.range(1)
    return one.select(*[F.lit(value).cast("double").alias(name) for name, value in values.items()])


def attach_scalars(df: DataFrame, stats: DataFrame, name: str = "stats") -> DataFrame:
    """Add a one-row frame to every row as the struct column `name`.

    A scalar subquery, so there is no join and nothing comes to the driver.
    """
    return df.withColumn(name, stats.select(F.struct(*stats.columns).alias(name)).scalar())
