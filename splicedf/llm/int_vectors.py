"""Vectors of integers: floors of scaled components, exact sums by cell. Shared by the code compression and the clustering."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Integers saturate here, so that every one fits into a long and sums of them into 38 digits.
LIMIT = 1 << 62
LONG = (1 << 63) - 1


def sound(vector: Column) -> Column:
    """Whether a vector is there and holds neither nulls nor values that are not finite."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(vector.isNotNull() & ~F.exists(vector, odd), F.lit(False))


def floors(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, x as double."""
    whole = lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))
    at = lambda x: F.when(F.abs(F.lit(float(scale)) * x.cast("double")) < float(LIMIT), whole(x)).otherwise(F.when(x > 0, F.lit(LIMIT)).otherwise(F.lit(-LIMIT)))
    return F.transform(vector, at)


def matrix(column, width: int) -> np.ndarray:
    """A column of lists of equal length as rows by width."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def exact(a: np.ndarray, b: np.ndarray, terms: int) -> tuple[np.ndarray, np.ndarray]:
    """Both as 64-bit integers if a sum of `terms` squared differences fits, else as Python's integers of any size."""
    top = max([abs(int(f(x))) for x in (a, b) if x.size for f in (np.min, np.max)], default=0)
    if 4 * top * top * terms < 1 << 62:
        return a.astype(np.int64), b.astype(np.int64)
    return a.astype(object), b.astype(object)


class CellSums:
    """Counts and componentwise sums of the vectors of each cell, gathered within a task."""

    SCHEMA = "cell int, place int, total decimal(38,0)"

    def __init__(self, cells: int, width: int):
        self.counts, self.sums = np.zeros(cells, np.int64), np.zeros((cells, width), object)

    def add(self, cells: np.ndarray, rows: np.ndarray) -> None:
        self.counts += np.bincount(cells, minlength=len(self.counts))
        small = rows.dtype != object and rows.size and int(np.abs(rows).max()) * len(rows) < 1 << 62
        sums = np.zeros(self.sums.shape, np.int64 if small else object)
        np.add.at(sums, cells, rows)
        self.sums += sums

    def batch(self):
        """(cell, place, total) of the cells in use; place -1 holds the count."""
        import pyarrow as pa
        from decimal import Decimal

        used = np.flatnonzero(self.counts)
        width = self.sums.shape[1]
        totals = [Decimal(int(t)) for c in used for t in (self.counts[c], *self.sums[c])]
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(used, width + 1), pa.int32()), pa.array(np.tile(np.arange(-1, width), len(used)), pa.int32()), pa.array(totals, pa.decimal128(38, 0))], ["cell", "place", "total"])


def means(partial: DataFrame, old: np.ndarray) -> np.ndarray:
    """old with the rows of used cells replaced by floor(sum / count); what comes to the driver has the size of old."""
    new = old.astype(object)
    found = {(r["cell"], r["place"]): int(r["total"]) for r in partial.groupBy("cell", "place").agg(F.sum("total").alias("total")).collect()}
    for (cell, place), total in found.items():
        if place >= 0:
            new[cell, place] = total // found[cell, -1]
    return new
