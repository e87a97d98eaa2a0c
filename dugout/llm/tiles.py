"""Vectors in blocks and packs: what the two vector operators share.

A *block* holds a bounded number of candidate rows, a *pack* a bounded number of query rows; both keep their vectors
in binary form.  Only packs are copied, once per block they have to meet, and a pair meets in one task as one row.
Blocks are copied ``SPREAD`` times, so that the packs of one block spread over several tasks.  The rows of a group
that is too large for one block (equal vectors, one label) are dealt over several blocks by a stored row number, which
repeated rows do not share.
"""

from __future__ import annotations

import contextlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPREAD = 4
#: Values of a block (2 MB as doubles) and rows of a pack.
BLOCK_VALUES = 1 << 18
PACK_ROWS = 256
_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": None, "spark.sql.execution.arrow.maxBytesPerBatch": None}


@contextlib.contextmanager
def arrow_limits(spark: SparkSession, records: int, size: int = 32 << 20):
    """Small Arrow batches for the jobs run inside; the caller's settings come back afterwards."""
    wanted = dict(zip(_LIMITS, (str(records), str(size))))
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def usable_vectors(df: DataFrame, id_col: str, vector_col: str, *others: Column, zero: bool = True) -> DataFrame:
    """(id, vector array<double>, others) of rows with an id and a vector of finite components; all-zero ones on request."""
    vector = F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector"), *others)
    good = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) <= F.lit(1.7976931348623157e308)))
    if not zero:
        good = good & F.exists("vector", lambda x: x != 0)
    return rows.filter(F.col("id").isNotNull() & F.col("vector").isNotNull() & good)


def padded(lists: pa.Array, dim: int) -> np.ndarray:
    """Vectors of an Arrow list column as the rows of a matrix; missing components at the end are zero."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    offsets = lists.offsets.to_numpy()
    values = np.asarray(lists.values.to_numpy(zero_copy_only=False), np.float64)
    sizes = np.diff(offsets)
    if len(sizes) and (sizes == dim).all():
        return values[offsets[0] : offsets[-1]].reshape(-1, dim)
    out = np.zeros((len(sizes), dim))
    at = np.arange(dim)[None, :] < sizes[:, None]
    out[at] = values[offsets[0] : offsets[-1]]
    return out


def binary_rows(matrix: np.ndarray) -> pa.Array:
    matrix = np.ascontiguousarray(matrix)
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * np.int32(matrix.itemsize * matrix.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(matrix), [None, pa.py_buffer(offsets), pa.py_buffer(matrix)])


def stacked(lists: pa.ListArray, at: int, dim: int) -> np.ndarray:
    """One cell of binary vectors as a matrix."""
    return np.frombuffer(b"".join(lists[at].values.to_pylist()), np.float64).reshape(-1, dim)


def numbers(lists: pa.ListArray, at: int) -> np.ndarray:
    return lists[at].values.to_numpy(zero_copy_only=False)


def block_rows(dim: int, block_values: int = BLOCK_VALUES) -> int:
    return max(64, block_values // max(dim, 1))


def parts(count: int, size: int) -> int:
    return max(1, math.ceil(count / size))


def dealt(row: Column, n: Column | int) -> Column:
    """A part from 0 for a row number."""
    return F.pmod(F.xxhash64(row), F.lit(n) if isinstance(n, int) else n).cast("int")


def spread_blocks(blocks: DataFrame, spread: int = SPREAD) -> DataFrame:
    return blocks.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))


def lane(pack: Column, spread: int = SPREAD) -> Column:
    return F.pmod(F.xxhash64(pack), F.lit(spread)).cast("int")
