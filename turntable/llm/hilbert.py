"""Shards along a Hilbert curve through several columns, so that files can be skipped by any of them.

Each column is cut into cells of about equally many rows; the cell numbers of a row are a point whose place
on the curve is one number. Rows are ordered by it and cut into runs of equal length. Rows close together on
the curve are close in every column, so each run covers a small box of values.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from turntable.llm.common import map_batches
from turntable.operators.ranking import positions
from turntable.sources.tables import materialise

BITS = 8
_ACCURACY = 10_000


def curve_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points (rows) whose coordinates have `bits` bits.

    From the highest bit down, the quadrant of a point tells how the curve is turned within it: the lower
    bits are either flipped in the first coordinate or exchanged with it. The turned coordinates, taken as
    a Gray code, give the digits of the place.
    """
    x = [points[:, axis].astype(np.int64) for axis in range(points.shape[1])]
    for bit in range(bits - 1, 0, -1):
        lower = np.int64((1 << bit) - 1)
        for axis in range(len(x)):
            flip = (x[axis] >> bit & 1).astype(bool)
            exchanged = np.where(flip, 0, (x[0] ^ x[axis]) & lower)
            x[0] = np.where(flip, x[0] ^ lower, x[0] ^ exchanged)
            x[axis] = x[axis] ^ exchanged if axis else x[0]
    for axis in range(1, len(x)):
        x[axis] = x[axis] ^ x[axis - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> bit & 1, np.int64((1 << bit) - 1), 0)
    place = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            place = place << 1 | ((axis ^ turn) >> bit & 1)
    return place


def _is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, StringType)


def _text_cuts(digest: DataFrame, column: str, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """The first value of each cell of a text column and the number of that cell; cells hold about equally many rows.

    Whole values count, so that a common beginning (such as that of addresses) makes no difference. A value belongs to the
    cell of its first row in the order of all rows.
    """
    rows = digest.select(column, "_id", "text_crc32").where(F.col(column).isNotNull())
    order = [F.col(column).asc(), F.col("_id").asc_nulls_first(), F.col("text_crc32").asc()]
    placed = positions(rows, [], order, "_place", "_rows")
    values = placed.groupBy(column).agg(F.min("_place").alias("_first"), F.max("_rows").alias("_rows"))
    cell = F.expr(f"(_first - 1) * {cells} div _rows + 1").cast("int").alias("_cell")
    # One row for each cell at most.
    found = values.select(column, cell).groupBy("_cell").agg(F.min(column).alias("_value")).orderBy("_cell").collect()
    return np.array([row._value for row in found], dtype=object), np.array([row._cell for row in found], dtype=np.int64)


def _number_cuts(digest: DataFrame, columns: list[str], cells: int) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """The same for columns of numbers, from approximate quantiles."""
    if not columns:
        return {}
    shares = [i / cells for i in range(1, cells)]
    # One row of a fixed number of bounds for each dimension.
    found = digest.agg(*[F.percentile_approx(name, shares, _ACCURACY).alias(name) for name in columns]).first()
    out = {}
    for name in columns:
        # A frequent value is a bound many times over: it has the number of the last, so that numbers stand for shares of the rows.
        bounds, last = np.unique(np.sort(np.asarray(found[name] or [], dtype=np.float64))[::-1], return_index=True)
        out[name] = bounds, len(found[name] or []) - last + 1
    return out


def hilbert_shards(df: DataFrame, dimensions: Sequence[str], shards: int, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, size (bytes of the text plus 8), text_crc32, shard, slot and curve (place on the curve).

    The shards are runs of the rows in order of (curve, id, checksum, size), null ids first; their lengths
    differ by one row at most, and slots count from 0 without gaps. A null text counts as empty. A null value
    has the first cell of its column; repeated rows take neighbouring slots. Rows of one cell are ordered by id,
    so a cell that holds most of the table is cut like any other. An empty table gives no rows; columns of `df` that are
    named like those of the result are only read if they are dimensions. Texts are read once, for checksum and size,
    and not moved.
    """
    numbers = [f"_d{i}" for i in range(len(dimensions))]
    kinds = [_is_text(df, name) for name in dimensions]
    digest = materialise(
        df.select(
            F.col(f"`{id_column}`").alias("_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("bigint").alias("size"),
            F.crc32(F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8")).alias("text_crc32"),
            *[
                (F.col(f"`{name}`") if is_text else F.col(f"`{name}`").cast("double")).alias(number)
                for name, number, is_text in zip(dimensions, numbers, kinds, strict=True)
            ],
        )
    )
    cells = (1 << BITS) - 2
    cuts = _number_cuts(digest, [number for number, is_text in zip(numbers, kinds, strict=True) if not is_text], cells)
    cuts |= {number: _text_cuts(digest, number, cells) for number, is_text in zip(numbers, kinds, strict=True) if is_text}

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        points = np.zeros((batch.num_rows, len(numbers)), dtype=np.int64)
        for axis, (number, is_text) in enumerate(zip(numbers, kinds, strict=True)):
            column = batch.column(number)
            there = column.is_valid().to_numpy(zero_copy_only=False)
            values = column.drop_null().to_numpy(zero_copy_only=False)
            first, cell = cuts[number]
            at = np.searchsorted(first, values, side="right")
            points[there, axis] = np.concatenate([[0 if is_text else 1], cell])[at] if len(cell) else 0
        own = [batch.column(name) for name in ("_id", "size", "text_crc32")]
        return pa.record_batch([*own, pa.array(curve_index(points, BITS))], ["_id", "size", "text_crc32", "curve"])

    kind = digest.schema["_id"].dataType.simpleString()
    placed = map_batches(digest, place, f"_id {kind}, size bigint, text_crc32 bigint, curve bigint")
    order = [F.col("curve").asc(), F.col("_id").asc_nulls_first(), F.col("text_crc32").asc(), F.col("size").asc()]
    ranked = positions(placed, [], order, "_rank", "_rows").withColumn("_rank", F.col("_rank") - 1)
    shard = F.expr(f"_rank * {shards} div _rows")
    return ranked.withColumn("_shard", shard).select(
        F.col("_id").alias(id_column),
        "size",
        "text_crc32",
        F.col("_shard").cast("int").alias("shard"),
        F.expr(f"_rank - (_shard * _rows + {shards - 1}) div {shards}").alias("slot"),
        "curve",
    )


def write_shards(df: DataFrame, assigned: DataFrame, path: str, id_column: str = "doc_id") -> None:
    """Write `df` (one row per id) below path/shard=N, rows in order of their slots.

    A shard is written as several files of consecutive slots, each a small box of the columns on the curve,
    which the minima and maxima in the footers let readers skip.
    """
    own = assigned.select(F.col(id_column).alias("_shard_id"), "shard", F.col("slot").alias("_slot"))
    both = df.drop("shard", "_slot").join(own, F.col(id_column).eqNullSafe(F.col("_shard_id"))).drop("_shard_id")
    ranged = both.repartitionByRange("shard", "_slot").sortWithinPartitions("shard", "_slot")
    ranged.drop("_slot").write.partitionBy("shard").parquet(path)
