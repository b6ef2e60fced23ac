"""Hard negatives by exact integer scores from small-prime matrix products.

Vectors of whole numbers are reduced modulo a few primes so small that float32 products are exact; the signed score
is put together from its remainders, digit by digit in mixed radix. Every anchor meets every row, in cells of one
block of anchors and one part of the rows; a cell hands on the best rows of each anchor only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from starwash.llm.vectors import NULL_ID, TYPES, Block, as_dicts, named, pack
from starwash.sources.staging import stage

#: Products of remainders are summed over this many components at once: 64 * 510^2 < 2^24.
CHUNK = 64
LARGEST_PRIME = 1021
ANCHOR_BLOCK, ANCHOR_TILE, ROW_PARTS = 2048, 512, 16


def primes_for(longest: float) -> list[int]:
    """The largest primes up to LARGEST_PRIME whose product holds signed scores up to ``longest`` in size.

    Below 0.49 of the product, so that a digit that is one beyond its range by rounding changes nothing.
    """
    if longest >= 2**62:
        raise ValueError("scores of these vectors do not fit 64 bits")
    found, product = [], 1
    for p in range(LARGEST_PRIME, 2, -1):
        if product * 0.49 > max(longest, 1):
            return found
        if all(p % d for d in range(2, int(p**0.5) + 1)):
            found.append(p)
            product *= p
    raise AssertionError("unreachable: 64 bits need seven primes")


def reduced(x: np.ndarray, p: int) -> np.ndarray:
    """``x`` modulo ``p``, near zero; in place for floats below 2^24."""
    x -= np.rint(x * x.dtype.type(1 / p)) * x.dtype.type(p)
    return x


def residues(x: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    wide = x.astype(np.float64)
    return [reduced(np.fmod(wide, p), p).astype(np.float32) for p in primes]


def scores(anchors: list[np.ndarray], rows: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products (anchor, row) from their residues; float32, float64 or int64, as the primes need."""
    digits: list[np.ndarray] = []
    for n, p in enumerate(primes):
        a, b = anchors[n], rows[n]
        width = min(a.shape[1], b.shape[1])  # what is beyond the shorter one is zero
        digit = np.zeros((len(a), len(b)), np.float32)
        for i in range(0, width, CHUNK):
            digit += reduced(a[:, i : min(i + CHUNK, width)] @ b[:, i : min(i + CHUNK, width)].T, p)
            reduced(digit, p)
        for q, earlier in zip(primes, digits):  # Chinese remainders: (digit - earlier) / q modulo p
            digit = reduced((digit - earlier) * np.float32(pow(q, -1, p) - p * (2 * pow(q, -1, p) > p)), p)
        digits.append(digit)
    kind = np.float32 if len(primes) <= 2 else np.float64 if len(primes) <= 5 else np.int64
    total = digits[-1].astype(kind)
    for p, digit in zip(primes[-2::-1], digits[-2::-1]):
        total *= kind(p)
        total += digit.astype(kind)
    return total


def least(kind: np.dtype) -> float | int:
    return np.iinfo(kind).min if np.issubdtype(kind, np.integer) else -np.inf


@dataclass
class Best:
    """The first ``n`` rows of each anchor by (score descending, id) among all that were offered."""

    n: int
    anchors: int

    def __post_init__(self) -> None:
        self.anchor = np.empty(0, np.int64)
        self.score = np.empty(0, np.int64)
        self.row_id = np.empty(0, np.int64)
        self.floor: np.ndarray | None = None

    def offer(self, at: np.ndarray, scored: np.ndarray, usable: np.ndarray, ids: np.ndarray) -> None:
        """``scored`` and ``usable`` are (anchor, row) for the anchors ``at``; ``ids`` of the rows ascend."""
        if self.floor is None:
            self.floor = np.full(self.anchors, least(scored.dtype), scored.dtype)
        usable &= scored >= self.floor[at][:, None]
        if len(ids) > self.n:
            crowded = np.flatnonzero(usable.sum(axis=1) > self.n)
            if len(crowded):
                known = np.where(usable[crowded], scored[crowded], least(scored.dtype))
                last = np.partition(known, len(ids) - self.n, axis=1)[:, len(ids) - self.n][:, None]
                above = usable[crowded] & (known > last)
                level = usable[crowded] & (known == last)
                room = self.n - above.sum(axis=1)[:, None]
                usable[crowded] = above | (level & (np.cumsum(level, axis=1) <= room))
        a, r = np.nonzero(usable)
        if len(a):
            self._merge(at[a], scored[a, r].astype(np.int64), ids[r])

    def _merge(self, anchor: np.ndarray, score: np.ndarray, row_id: np.ndarray) -> None:
        anchor, score = np.concatenate([self.anchor, anchor]), np.concatenate([self.score, score])
        row_id = np.concatenate([self.row_id, row_id])
        order = np.lexsort((row_id, -score, anchor))
        anchor, score, row_id = anchor[order], score[order], row_id[order]
        starts = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        rank = np.arange(len(anchor)) - np.repeat(starts, np.diff(np.append(starts, len(anchor))))
        full = rank == self.n - 1
        self.floor[anchor[full]] = score[full]
        kept = rank < self.n
        self.anchor, self.score, self.row_id = anchor[kept], score[kept], row_id[kept]


ANCHOR = "anchor long, id long, label int, data binary"
CELL = "anchor long, anchor_id long, place int, positive_id long, positive_score long, id long, score long"
CELL_NAMES = [c.split()[0] for c in CELL.split(", ")]


def _anchors(blocks: DataFrame, every: int) -> DataFrame:
    """A row per distinct anchor, staged, with a number of its own."""

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in as_dicts(tables):
            block = Block.read(row)
            own = np.flatnonzero((block.ids % every == 0) & (block.ids != NULL_ID))
            if len(own):
                data = [np.trim_zeros(x.astype("<f8"), "b").tobytes() for x in block.x[own]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.ids[own]), pa.array(block.labels[own]), pa.array(data, pa.binary())],
                    names=["id", "label", "data"],
                )

    found = blocks.select("n", "dims", "width", "ids", "labels", "data").mapInArrow(run, "id long, label int, data binary")
    return stage(found.dropDuplicates().select(F.monotonically_increasing_id().alias("anchor"), "id", "label", "data"))


class Cell:
    """The anchors of a block, and what has been found for them in a part of the rows."""

    def __init__(self, rows: list[dict], primes: list[int], best: list[Best]) -> None:
        self.rows, self.primes, self.best = rows, primes, best
        vectors = [np.frombuffer(r["data"], "<f8") for r in rows]
        x = np.zeros((len(rows), max([1, *map(len, vectors)])))
        for i, v in enumerate(vectors):
            x[i, : len(v)] = v
        self.residues = residues(x, primes)
        self.ids = np.array([r["id"] for r in rows], np.int64)
        self.labels = np.array([r["label"] for r in rows], np.int32)

    def scored(self, at: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
        return scores([r[at] for r in self.residues], rows, self.primes)

    def positives(self, block: Block) -> None:
        """Other rows of an anchor's label; only pairs of one label are multiplied."""
        whole = residues(block.x, self.primes)
        for label in np.intersect1d(self.labels, block.labels):
            own, same = np.flatnonzero(self.labels == label), np.flatnonzero(block.labels == label)
            rows, ids = [r[same] for r in whole], block.ids[same]
            for i in range(0, len(own), ANCHOR_TILE):
                at = own[i : i + ANCHOR_TILE]
                self.best[0].offer(at, self.scored(at, rows), self.ids[at][:, None] != ids, ids)

    def negatives(self, block: Block) -> None:
        """Rows of other labels whose score lies in a positive's window."""
        rows = residues(block.x, self.primes)
        for i in range(0, len(self.ids), ANCHOR_TILE):
            at = np.arange(i, min(i + ANCHOR_TILE, len(self.ids)))
            scored = self.scored(at, rows)
            other = self.labels[at][:, None] != block.labels
            for place, best in enumerate(self.best):
                low, high = (np.array([self.rows[a][side][place] for a in at], np.int64) for side in ("low", "high"))
                low, high = (edge.astype(scored.dtype)[:, None] for edge in (low, high))
                best.offer(at, scored, other & (scored >= low) & (scored <= high), block.ids)

    def found(self) -> list[pa.RecordBatch]:
        out = []
        for place, best in enumerate(self.best):
            own = [self.rows[a] for a in best.anchor]
            extra = [(r["positive_ids"][place], r["positive_scores"][place]) if "low" in r else (None, None) for r in own]
            columns = (
                [r["anchor"] for r in own], [r["id"] for r in own], [place] * len(own), [e[0] for e in extra],
                [e[1] for e in extra], best.row_id, best.score,
            )
            types = (pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 4)
            out.append(pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=CELL_NAMES))
        return out


def _searched(anchors: DataFrame, n_anchors: int, blocks: DataFrame, primes: list[int], wanted: int, places: int, parts: int) -> DataFrame:
    """Rows of CELL: in each part of the rows the best ``wanted`` of every anchor, for each of ``places`` windows
    (0: the anchors have none, the rows of their label are meant).

    Anchors go to every part, rows to every block of anchors. Inside a cell the anchors come first, then the rows
    stream by, a block at a time: a task holds one block of anchors, one of rows and what it found.
    """
    groups = -(-n_anchors // ANCHOR_BLOCK)
    windows = ["low", "high", "positive_ids", "positive_scores"] if places else []
    group = F.pmod(F.xxhash64("anchor"), F.lit(groups))
    left = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), group.alias("group"), F.lit(0).alias("kind"),
        "anchor", "id", "label", "data", *windows,
    )
    right = blocks.select(
        F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group"), F.lit(1).alias("kind"),
        "n", "dims", "width", "ids", "labels", "data",
    )
    cells = left.unionByName(right, allowMissingColumns=True).repartition(2 * groups * parts, "group", "part")
    cells = cells.sortWithinPartitions("group", "part", "kind")

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, waiting, cell = None, [], None
        for row in as_dicts(tables):
            if (row["group"], row["part"]) != at:
                if cell:
                    yield from cell.found()
                at, waiting, cell = (row["group"], row["part"]), [], None
            if row["kind"] == 0:
                waiting.append({k: row[k] for k in ("anchor", "id", "label", "data", *windows)})
                continue
            if not waiting:
                continue  # no anchor of this block
            cell = cell or Cell(waiting, primes, [Best(wanted, len(waiting)) for _ in range(max(1, places))])
            (cell.negatives if places else cell.positives)(Block.read(row))
        if cell:
            yield from cell.found()

    return cells.mapInArrow(run, CELL)


def _first(df: DataFrame, keys: list[str], n: int, rank: str) -> DataFrame:
    order = W.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return df.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= n)


def _hundredth(x: Column) -> Column:
    """A whole decimal by 100, rounded down."""
    return ((x - F.pmod(x, F.lit(100))) / 100).cast("long")


def mine_hard_negatives(
    df: DataFrame, label: Column, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30,
    high: int = 90, scale: float = 256, parts: int = ROW_PARTS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), hard negatives of ``df``
    (vec_id, embedding; ``label`` is an expression over it).

    Anchors are the rows whose id is divisible by ``every``. A score is the inner product with the anchor of the
    components floor(scale * x). An anchor's positives are the ``positives`` best other rows of its label; for each,
    its negatives are the ``negatives`` best rows of other labels that score at least ``low`` and at most ``high``
    percent of it. Higher scores first, ties by smaller id. A positive without a negative gives no row.

    Rows with a null label, a null vector or a null or non-finite component take no part. A vector that is shorter
    than another counts zeros at its end. Equal anchor rows count once, a row with the anchor's id is not another
    one; other repeated rows count each. A null id is no anchor and comes last among ties. Without anchors the result
    is empty; other columns are left out. A ValueError is raised where scores do not fit 64 bits.

    Anchors grow with the rows, so the products grow with the square: that is the search. Rows move once for every
    2,048 anchors, anchors ``parts`` times; with many executors raise ``parts`` beyond their cores / blocks of anchors.
    """
    spark = df.sparkSession
    blocks = pack(df, F.col("vec_id"), label, F.col("embedding"), scale)
    anchors = _anchors(blocks, every)
    n_anchors, longest = anchors.count(), blocks.agg(F.max("longest")).first()[0]
    columns = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n_anchors:
        return spark.createDataFrame([], columns)
    primes = primes_for(longest)
    near = _first(_searched(anchors, n_anchors, blocks, primes, positives, 0, parts), ["anchor"], positives, "place")
    # An anchor has a window for each positive, an empty one where it has fewer.
    edges = near.select(
        "anchor", "place", "id", "score", (-_hundredth(F.col("score") * F.lit(-low).cast("decimal(4,0)"))).alias("low"),
        _hundredth(F.col("score") * F.lit(high).cast("decimal(4,0)")).alias("high"),
    )
    of_place = {c: [F.max(F.when(F.col("place") == p + 1, F.col(c))) for p in range(positives)] for c in ("low", "high", "id", "score")}
    empty = {"low": 1, "high": 0}
    windows = edges.groupBy("anchor").agg(*[
        F.array(*[F.coalesce(v, F.lit(empty[c]).cast("long")) if c in empty else v for v in values]).alias(name)
        for (c, values), name in zip(of_place.items(), ("low", "high", "positive_ids", "positive_scores"))
    ])
    aimed = stage(anchors.join(windows, "anchor"))
    found = _searched(aimed, n_anchors, blocks, primes, negatives, positives, parts)
    best = _first(found, ["anchor", "place"], negatives, "rank")
    return best.select(
        "anchor_id", named("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.nullif("id", F.lit(NULL_ID)).alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )
