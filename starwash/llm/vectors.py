"""Vectors of whole numbers, packed: a row of a packed table is a block of some thousand vectors as one matrix."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from starwash.sources.staging import stage

BLOCK_VECTORS, BLOCK_COMPONENTS = 4096, 1 << 18
PACKED = (
    "block long, n int, dims int, width int, ids binary, labels binary, data binary, largest double, longest double"
)
PACKED_ARROW = pa.schema([
    ("block", pa.int64()), ("n", pa.int32()), ("dims", pa.int32()), ("width", pa.int32()), ("ids", pa.binary()),
    ("labels", pa.binary()), ("data", pa.binary()), ("largest", pa.float64()), ("longest", pa.float64()),
])
TYPES = {2: np.dtype("<i2"), 4: np.dtype("<i4"), 8: np.dtype("<f8")}
ROUNDING = 1 + 1e-9
#: Stands for a null id in a block: the largest, so that it comes last among ties.
NULL_ID = (1 << 63) - 1


@dataclass(frozen=True)
class Block:
    """Vectors as rows of ``x``; whole numbers, in the narrowest type that holds them."""

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray

    @classmethod
    def read(cls, row: dict) -> Block:
        x = np.frombuffer(row["data"], TYPES[row["width"]]).reshape(row["n"], row["dims"])
        return cls(np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i4"), x)


def as_dicts(tables: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time, so that a task holds one block as numpy beside the Arrow batch."""
    for table in tables:
        for i in range(table.num_rows):
            yield {name: table.column(k)[i].as_py() for k, name in enumerate(table.schema.names)}


def narrowest(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(initial=0)
    return x.astype(TYPES[2] if top < 1 << 15 else TYPES[4] if top < 1 << 31 else TYPES[8])


def whole_components(lists: pa.Array, scale: float, dims: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, matrix) of the usable vectors of a list array: floor(scale * component).

    Left out are null vectors, those with a null or non-finite component, before or after scaling, and, where
    ``dims`` is given, those of another length; otherwise shorter ones end in zeros.
    """
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # a null component becomes NaN
    with np.errstate(over="ignore", invalid="ignore"):
        flat = np.floor(flat * scale)
    ends = np.cumsum(lengths)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    usable = (bad[ends] == bad[ends - lengths]) & lists.is_valid().to_numpy(zero_copy_only=False)
    if dims is not None:
        usable &= lengths == dims
    rows = np.flatnonzero(usable)
    own = lengths[rows]
    width = int(own.max(initial=0))
    x = np.zeros((len(rows), width))
    inside = np.arange(width) < own[:, None]
    x[inside] = flat[np.repeat(usable, lengths)]
    return rows, x


def pack(df: DataFrame, vec_id: Column, label: Column, vector: Column, scale: float, dims: int | None = None) -> DataFrame:
    """A staged table PACKED of the rows with a label and a usable vector (``whole_components``).

    A null id becomes NULL_ID; ``named`` turns it back. A block's vectors are in the order of their ids. ``block`` numbers the blocks, ``largest`` is a block's largest absolute component and ``longest`` at least
    the largest squared length of its vectors. Nothing is shuffled.
    """

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for table in tables:
            table = table.filter(table.column(1).is_valid())
            rows, x = whole_components(table.column(2), scale, dims)
            order = np.argsort(table.column(0).to_numpy(zero_copy_only=False)[rows], kind="stable")
            rows, x = rows[order], x[order]
            ids = table.column(0).to_numpy(zero_copy_only=False)[rows].astype("<i8")
            labels = table.column(1).to_numpy(zero_copy_only=False)[rows].astype("<i4")
            size = max(1, min(BLOCK_VECTORS, BLOCK_COMPONENTS // max(1, x.shape[1])))
            for i in range(0, len(rows), size):
                part = narrowest(x[i : i + size])
                squares = np.einsum("ij,ij->i", x[i : i + size], x[i : i + size])
                yield pa.RecordBatch.from_pylist([{
                    "block": number, "n": len(part), "dims": part.shape[1], "width": part.dtype.itemsize,
                    "ids": ids[i : i + size].tobytes(), "labels": labels[i : i + size].tobytes(), "data": part.tobytes(),
                    "largest": float(np.abs(x[i : i + size]).max(initial=0)),
                    "longest": float(squares.max(initial=0)) * ROUNDING,
                }], PACKED_ARROW)
                number += 1

    rows = df.select(
        F.coalesce(vec_id.cast("long"), F.lit(NULL_ID)).alias("id"), label.cast("int").alias("label"), vector.cast("array<double>").alias("vector")
    )
    return stage(rows.mapInArrow(run, PACKED))


def named(column: str) -> Column:
    """An id of a block as it was."""
    return F.nullif(F.col(column), F.lit(NULL_ID)).alias(column)
