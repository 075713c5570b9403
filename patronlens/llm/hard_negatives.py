"""Hard negatives of stated anchors: exact integer scores by Strassen's multiplication, bounded heaps that merge.

Vectors become integers. Candidates are dealt into stripes of bounded size; every anchor goes to every
stripe, and a task multiplies tiles of anchors with tiles of its candidates. Strassen's recursion
replaces the eight half-size products of a tile by seven, with integer additions, which are exact;
odd sides are padded with zeros. The first pass keeps a heap of the best positives of each
anchor, the second a heap for each window that an anchor's positives open. Heaps hold at
most ``positives`` and ``negatives`` entries, and those of different stripes merge into the best of all.

Defined results: rows with a null label, a null vector, or any null or non-finite component take no part; a
shorter vector is padded with zeros and an empty one scores 0 with all; components are bounded by
2^62 in size and scores by 2^63 - 1, which is exact below; a null vec_id is never an anchor unless the
caller says so, and comes last among ties; rows that repeat are rows of their own, so an
anchor given twice is answered twice and each is the other's positive; a window of a
negative positive score is empty; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronlens.operators.lineage import settle

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
WINDOW = (30, 90)  # percent of the positive's score between which a negative lies
STRIPE_BYTES = 64_000_000  # of the candidates that a task holds
ROWS, COLUMNS = 256, 2_048  # anchors and candidates of a tile
LEAF = 32  # products with a side below twice this are not divided further
LIMIT = 2**63 - 1


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a`` times the transpose of ``b``, both int64, modulo 2^64."""
    (m, k), n = a.shape, len(b)
    if min(m, k, n) < 2 * LEAF:
        return a @ b.T
    if m % 2 or k % 2 or n % 2:
        return product(_padded(a, m + m % 2, k + k % 2), _padded(b, n + n % 2, k + k % 2))[:m, :n]
    (a11, a12), (a21, a22) = _quarters(a)
    (b11, b21), (b12, b22) = _quarters(b)  # of the transpose
    p1 = product(a11 + a22, b11 + b22)
    p2 = product(a21 + a22, b11)
    p3 = product(a11, b12 - b22)
    p4 = product(a22, b21 - b11)
    p5 = product(a11 + a12, b22)
    p6 = product(a21 - a11, b11 + b12)
    p7 = product(a12 - a22, b21 + b22)
    out = np.empty((m, n), dtype=np.int64)
    out[: m // 2, : n // 2] = p1 + p4 - p5 + p7
    out[: m // 2, n // 2 :] = p3 + p5
    out[m // 2 :, : n // 2] = p2 + p4
    out[m // 2 :, n // 2 :] = p1 - p2 + p3 + p6
    return out


def _quarters(x: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    i, j = x.shape[0] // 2, x.shape[1] // 2
    return (x[:i, :j], x[:i, j:]), (x[i:, :j], x[i:, j:])


def _padded(x: np.ndarray, rows: int, columns: int) -> np.ndarray:
    return np.pad(x, ((0, rows - x.shape[0]), (0, columns - x.shape[1])))


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` and ``b``, exact, and bounded by ``LIMIT`` in size."""
    width = max(a.shape[1], b.shape[1])
    a, b = _padded(a, len(a), width), _padded(b, len(b), width)
    if a.size and b.size and int(abs(a).max()) * int(abs(b).max()) * width > LIMIT:
        # Beyond 64 bits: Python's integers.
        return np.clip(a.astype(object) @ b.T.astype(object), -LIMIT, LIMIT).astype(np.int64)
    return product(a, b)


@dataclass
class Tile:
    """Rows with their vectors as one matrix."""

    row: np.ndarray
    ids: np.ndarray
    unnamed: np.ndarray  # rows whose vec_id is null
    label: np.ndarray
    vectors: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Tile:
        ids = batch.column("vec_id")
        plain = lambda c: c.fill_null(0).to_numpy(zero_copy_only=False)
        return cls(
            plain(batch.column("row")), plain(ids), ids.is_null().to_numpy(zero_copy_only=False),
            plain(batch.column("label")), _matrix(batch.column("vector")),
        )

    @classmethod
    def joined(cls, parts: list[Tile]) -> Tile:
        """All rows of ``parts``, by label."""
        if not parts:
            none = np.empty(0, dtype=np.int64)
            return cls(none, none, none.astype(bool), none, none.reshape(0, 0))
        width = max(p.vectors.shape[1] for p in parts)
        both = cls(
            *(np.concatenate([getattr(p, c) for p in parts]) for c in ("row", "ids", "unnamed", "label")),
            np.concatenate([_padded(p.vectors, len(p.vectors), width) for p in parts]),
        )
        return both.take(np.argsort(both.label, kind="stable"))

    def take(self, at: np.ndarray | slice) -> Tile:
        return Tile(self.row[at], self.ids[at], self.unnamed[at], self.label[at], self.vectors[at])

    def tiles(self, size: int) -> Iterator[Tile]:
        for i in range(0, len(self.row), size):
            yield self.take(slice(i, i + size))

    def labelled(self, label: int) -> Tile:
        """The rows of a tile sorted by label that have ``label``."""
        a, b = np.searchsorted(self.label, [label, label + 1])
        return self.take(slice(a, b))


def _matrix(column: pa.ListArray) -> np.ndarray:
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    lengths, values = np.diff(offsets), values[offsets[0] : offsets[-1]]
    width = int(lengths.max(initial=0))
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


class Best:
    """Heap of the best ``size`` entries: higher scores first, of equal ones the smaller vec_id, a null one last."""

    def __init__(self, size: int):
        self.size, self.heap = size, []

    def offer(self, found: np.ndarray, candidates: Tile, allowed: np.ndarray) -> None:
        """Add the candidates at ``allowed``, whose scores are ``found``."""
        if len(self.heap) == self.size:
            allowed = allowed[found[allowed] >= self.heap[0][0]]
        if len(allowed) > self.size:
            own = found[allowed]
            least = np.partition(own, -self.size)[-self.size]
            allowed = allowed[own >= least]
            order = np.lexsort((candidates.ids[allowed], candidates.unnamed[allowed], -found[allowed]))
            allowed = allowed[order[: self.size]]
        for i in allowed.tolist():
            entry = (int(found[i]), not candidates.unnamed[i], -int(candidates.ids[i]), int(candidates.row[i]))
            if len(self.heap) < self.size:
                heapq.heappush(self.heap, entry)
            else:
                heapq.heappushpop(self.heap, entry)

    def entries(self) -> list[tuple[int, int | None, int]]:
        """(score, vec_id, row)."""
        return [(score, -minus if named else None, row) for score, named, minus, row in self.heap]


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(row, vec_id, label, vector) of the rows of ``vectors`` (vec_id, label, embedding) that take part."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf)))
    whole = F.transform(x, lambda v: F.floor(F.greatest(F.least(v * scale, F.lit(2.0**62)), F.lit(-(2.0**62)))).cast("long"))
    return settle(
        vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
        .select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), whole.alias("vector"))
    )


def _blocks(rows: DataFrame, anchors: DataFrame, stripes: int) -> DataFrame:
    """Candidates and anchors of each stripe, the candidates first."""
    extra = [c for c in anchors.columns if c not in rows.columns]
    types = {f.name: f.dataType for f in anchors.schema}
    own = rows.select(
        F.pmod(F.xxhash64("row"), F.lit(stripes)).cast("int").alias("stripe"), F.lit(False).alias("asks"), *rows.columns,
        *(F.lit(None).cast(types[c]).alias(c) for c in extra),
    )
    asked = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("stripe"), F.lit(True).alias("asks"), *rows.columns, *extra
    )
    return own.unionByName(asked).repartition("stripe").sortWithinPartitions("stripe", "asks", "row")


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Tile, Tile, pa.RecordBatch]]:
    """(candidates of a stripe by label, tile of anchors, rows of that tile)."""
    stripe, held, candidates = None, [], None
    for batch in batches:
        stripes, asks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("stripe", "asks"))
        cuts = np.flatnonzero((stripes[1:] != stripes[:-1]) | (asks[1:] != asks[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(stripes)]):
            if a == b:
                continue
            if stripes[a] != stripe:
                stripe, held, candidates = stripes[a], [], None
            if not asks[a]:
                held.append(Tile.of(batch.slice(a, b - a)))
                continue
            if candidates is None:
                candidates, held = Tile.joined(held), []
            for i in range(a, b, ROWS):
                rows = batch.slice(i, min(ROWS, b - i))
                yield candidates, Tile.of(rows), rows


def _positives(size: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for candidates, anchors, _ in _meetings(batches):
            best = [Best(size) for _ in anchors.row]
            for label in np.unique(anchors.label):
                own = np.flatnonzero(anchors.label == label)
                for tile in candidates.labelled(label).tiles(COLUMNS):
                    table = scores(anchors.vectors[own], tile.vectors)
                    for i, found in zip(own.tolist(), table):
                        best[i].offer(found, tile, np.flatnonzero(tile.row != anchors.row[i]))
            out = [(int(anchors.row[i]), row, vec_id, score) for i, b in enumerate(best) for score, vec_id, row in b.entries()]
            yield _records(out, ["anchor", "row", "positive_id", "positive_score"])

    return find


def _negatives(size: int, low: int, high: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for candidates, anchors, rows in _meetings(batches):
            aims = rows.column("positive_scores").to_pylist()
            # Whole scores s with low * aim <= 100 * s <= high * aim.
            windows = [[(-(-low * p // 100), high * p // 100, Best(size)) for p in own] for own in aims]
            for tile in candidates.tiles(COLUMNS):
                table = scores(anchors.vectors, tile.vectors)
                for i, found in enumerate(table):
                    other = tile.label != anchors.label[i]
                    for least, most, best in windows[i]:
                        best.offer(found, tile, np.flatnonzero((found >= least) & (found <= most) & other))
            out = [
                (int(anchors.row[i]), place, row, vec_id, score)
                for i, own in enumerate(windows) for place, (_, _, best) in enumerate(own) for score, vec_id, row in best.entries()
            ]
            yield _records(out, ["anchor", "place", "row", "negative_id", "negative_score"])

    return find


def _records(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == "place" else pa.int64()) for n, c in zip(names, columns)], names)


def mine(
    vectors: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW, scale: int = SCALE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows of ``vectors`` where ``anchor`` holds.

    ``vectors`` has vec_id, label and embedding; ``anchor`` is a condition on vec_id and label. An
    anchor's positives are its best other rows of the same label; for each of them the best rows of
    other labels with window[0] * positive_score <= 100 * negative_score <= window[1] * positive_score.
    """
    rows = integers(vectors.select("vec_id", "label", "embedding"), scale)
    size = rows.agg(F.coalesce(F.sum(F.size("vector") * F.lit(8)), F.lit(0))).first()[0]
    stripes = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / STRIPE_BYTES))
    anchors = rows.where(anchor)
    near = _blocks(rows, anchors, stripes).mapInArrow(_positives(positives), "anchor long, row long, positive_id long, positive_score long")
    merged = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), F.col("positive_id").asc_nulls_last(), "row")
    chosen = settle(near.withColumn("place", F.row_number().over(merged) - 1).where(F.col("place") < positives))
    aims = chosen.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("aims"))
    asking = anchors.join(aims.withColumnRenamed("anchor", "row"), "row").select(
        *rows.columns, F.col("aims.positive_score").alias("positive_scores")
    )
    hard = _blocks(rows, settle(asking), stripes).mapInArrow(
        _negatives(negatives, *window), "anchor long, place int, row long, negative_id long, negative_score long"
    )
    merged = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), F.col("negative_id").asc_nulls_last(), "row")
    best = hard.withColumn("rank", F.row_number().over(merged)).where(F.col("rank") <= negatives).drop("row")
    named = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return best.join(chosen.drop("row"), ["anchor", "place"]).join(named, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
