"""Vector code compression: one codebook a part of the vector, entries found by Walsh-Hadamard coefficients.

The transform of a difference has n times its squared length, where n is the part's length, padded with zeros to a power
of two. So the squared differences of coefficients, added up in sequency order, only grow towards n times the distance,
and an entry goes as soon as its sum is above what some entry has in full. All numbers are integers.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splicedf.llm.common import maybe_broadcast, written
from splicedf.llm.int_vectors import LONG, CellSums, exact, floors, matrix, means, sound

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256


def sequency(n: int) -> list[int]:
    """Places of the Hadamard rows by number of sign changes: the bits of the Gray code, read backwards."""
    bits = n.bit_length() - 1
    return [int(format(s ^ (s >> 1), f"0{bits}b")[::-1], 2) if bits else 0 for s in range(n)]


def walsh(rows: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, padded with zeros to a power of two, in sequency order."""
    n = 1 << max(rows.shape[1] - 1, 0).bit_length()
    a = np.zeros((len(rows), n), rows.dtype)
    a[:, : rows.shape[1]] = rows
    half = 1
    while half < n:
        pairs = a.reshape(len(a), n // (2 * half), 2, half)
        a = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(len(a), n)
        half *= 2
    return a[:, sequency(n)]


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the nearest entry (the first of equals) and the squared distance."""
    width = 1 << max(rows.shape[1] - 1, 0).bit_length()
    rows, entries = exact(rows, entries, width * width)
    if not len(rows):
        return np.zeros(0, np.int64), rows.sum(1)
    x, e = walsh(rows), walsh(entries)
    sums = (x[:, :1] - e[None, :, 0]) ** 2
    full = ((x - e[sums.argmin(1)]) ** 2).sum(1)  # of the entry that comes closest in the first coefficient
    row, entry = np.nonzero(sums <= full[:, None])
    sums = sums[row, entry]
    for c in range(1, width):
        sums = sums + (x[row, c] - e[entry, c]) ** 2
        live = (sums <= full[row]).astype(bool)
        row, entry, sums = row[live], entry[live], sums[live]
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    least = np.minimum.reduceat(sums, first)
    at = np.flatnonzero((sums == np.repeat(least, np.diff(np.r_[first, len(row)]))).astype(bool))
    at = at[np.unique(row[at], return_index=True)[1]]
    return entry[at], least // width


def started(table: DataFrame, parts: int, entries: int) -> np.ndarray:
    """The first codebooks, parts by entries by width: the parts of the vectors with the smallest ids."""
    rows = [r["v"] for r in table.orderBy(F.col("_id").asc_nulls_last(), "v").limit(entries).select("v").collect()]
    return np.array(rows, object).reshape(len(rows), parts, -1).transpose(1, 0, 2)


def refined(table: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: each used entry is the floor of its parts' mean."""
    parts, entries, width = books.shape

    def gather(batches):
        sums = CellSums(parts * entries, width)
        for batch in batches:
            v = matrix(batch.column(0), parts * width).reshape(-1, parts, width)
            for p in range(parts):
                sums.add(nearest(v[:, p], books[p])[0] + p * entries, v[:, p])
        yield sums.batch()

    return means(table.select("v").mapInArrow(gather, CellSums.SCHEMA), books.reshape(-1, width)).reshape(books.shape)


def coded(table: DataFrame, books: np.ndarray) -> DataFrame:
    """table with code and error in place of the vectors."""
    parts, _, width = books.shape
    keep = [c for c in table.columns if c != "v"]
    schema = ", ".join(f"{c} {table.schema[c].dataType.simpleString()}" for c in keep)

    def assign(batches):
        import pyarrow as pa

        for batch in batches:
            v = matrix(batch.column(batch.num_columns - 1), parts * width).reshape(-1, parts, width)
            found = [nearest(v[:, p], books[p]) for p in range(parts)]
            codes = np.stack([i for i, _ in found], 1).tolist()
            errors = [min(int(e), LONG) for e in sum(d.astype(object) for _, d in found)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(["".join(map("{:02x}".format, c)) for c in codes], pa.string()), pa.array(errors, pa.int64())], [*keep, "code", "error"])

    return table.select(*keep, "v").mapInArrow(assign, f"{schema}, code string, error long")


def compressed(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list[list[list[int]]]]:
    """(_id, _label, code, error, label_error) of each vector, and the codebooks as parts of entries of integers.

    Vectors that are null or hold nulls, NaN or infinities are dropped. Shorter vectors count as filled up with zeros to
    the longest, rounded up to a multiple of parts; so do empty ones. Components beyond LIMIT saturate, errors do so at the
    largest long. Repeated rows and rows with equal or null ids each have a row; of equal ids the smaller vector starts a
    codebook first, null ids come last. With fewer vectors than entries there are so many entries; an empty table gives an
    empty result. Other columns are left out, whatever their names. At most 256 entries, for two digits each.
    """
    if not 0 < entries <= 256:
        raise ValueError("between 1 and 256 entries")
    v = vectors.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"), F.col(vector_col).alias("x")).filter(sound(F.col("x"))).select("_id", "_label", floors(F.col("x"), scale).alias("v"))
    table = written(v, "vectors")
    longest = table.agg(F.max(F.size("v"))).first()[0]
    if longest is None:
        return table.select("_id", "_label", *[F.lit(None).cast(t).alias(c) for c, t in (("code", "string"), ("error", "long"), ("label_error", "long"))]), []
    dims = -(-max(longest, 1) // parts) * parts
    table = table.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("v"))))
    books = started(table, parts, entries)
    for _ in range(rounds):
        books = refined(table, books)
    out = written(coded(table, books), "codes")
    of = out.groupBy(F.col("_label").alias("_l")).agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG).cast("decimal(38,0)")).cast("long").alias("label_error"))
    out = out.join(maybe_broadcast(of), F.col("_label").eqNullSafe(F.col("_l")), "left").drop("_l")
    return out, [[[int(x) for x in e] for e in part] for part in books]


def digest(books: list[list[list[int]]]) -> str:
    return hashlib.sha256(",".join(str(x) for part in books for e in part for x in e).encode()).hexdigest()
