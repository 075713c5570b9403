"""Repeated passages of documents, found by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of a document, its minimiser the smallest hash of
``MER`` consecutive words in it. Neighbouring windows mostly share their minimiser and
make a super-k-mer, which travels as one packed string to the bucket of that minimiser. Equal
windows have equal minimisers, so sorting the windows of a bucket counts them exactly.

The places of minimisers are counted first, with partial sums: only super-k-mers whose
minimiser occurs again anywhere travel at all. A minimiser with more than ``HOT`` places gets
no bucket: its windows are counted one by one under a 128-bit hash, again with partial sums, so no passage that
many documents share meets in one task. Every window takes exactly one of the two ways, by
the count of its minimiser alone.

Defined results: a null text has no words; words are taken as they are, case and all; a
window of one document that occurs twice in it is repeated; documents below the window
length keep every word; rows that repeat doc_id and text are documents of their own and
remove each other's windows; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.llm.common import row_key
from patronlens.llm.words import Words, slices, windows_hash
from patronlens.operators.lineage import new_folder, own_name, settle

WINDOW = 35
MER = 5
HOT = 256  # places of a minimiser, and so super-k-mers of a bucket; above, windows are counted singly
LONGEST = 256  # windows of a super-k-mer


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    step, out = 1, values
    while step * 2 <= width:
        out, step = np.minimum(out[:-step], out[step:]), step * 2
    n = len(values) - width + 1
    return np.minimum(out[:n], out[width - step : width - step + n])


def super_kmers(mers: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, minimiser) of every super-k-mer, from a document's hashes of MER words."""
    least = _sliding_min(mers, window - MER + 1)
    starts = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
    counts = np.diff(np.concatenate([starts, [len(least)]]))
    if counts.max() > LONGEST:
        pieces = -(-counts // LONGEST)
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        counts = np.minimum(np.repeat(counts, pieces) - nth * LONGEST, LONGEST)
        starts = np.repeat(starts, pieces) + nth * LONGEST
    return starts, counts, least[starts].view(np.int64)


def occurrences(mers: np.ndarray, window: int) -> np.ndarray:
    """Every place of a document's minimisers, by value. Two equal windows mean two places, also in one super-k-mer."""
    values = mers.view(np.int64)
    return values[np.isin(values, super_kmers(mers, window)[2])]


def _documents(batch: pa.RecordBatch, window: int) -> Iterator[tuple[int, Words, slice, np.ndarray | None]]:
    """(row, words, range of its words, hashes of MER words or None if too short) for every row of a batch."""
    texts = batch.column("text")
    for a, b in slices(texts):
        words = Words(texts.slice(a, b - a))
        mers = windows_hash(words.hashes, MER)
        for i in range(b - a):
            own = words.of(i)
            enough = own.stop - own.start >= window
            yield a + i, words, own, mers[own.start : own.stop - MER + 1] if enough else None


def _signed(docs: DataFrame, window: int) -> DataFrame:
    """(k1, k2, doc_id, n_words, all_sha256, minimisers) for every row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, minimisers, ends = [], [], [np.empty(0, np.int64)], [0]
            for _, words, own, mers in _documents(batch, window):
                counts.append(own.stop - own.start)
                whole = words.text(own.start, own.stop) if counts[-1] else b""
                digests.append(hashlib.sha256(whole).hexdigest())
                if mers is not None:
                    minimisers.append(occurrences(mers, window))
                ends.append(ends[-1] + (len(minimisers[-1]) if mers is not None else 0))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(minimisers)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("k1", "k2", "doc_id")), pa.array(counts, pa.int64()), pa.array(digests), lists],
                ["k1", "k2", "doc_id", "n_words", "all_sha256", "minimisers"],
            )

    keyed = docs.select(*row_key("doc_id", "text"), "doc_id", "text")
    return settle(
        keyed.mapInArrow(sign, "k1 long, k2 long, doc_id long, n_words long, all_sha256 string, minimisers array<long>")
    )


def _candidates(docs: DataFrame, signed: DataFrame) -> DataFrame:
    """(k1, k2, text, cool, hot): documents with minimisers that occur again, and which these are.

    Written in buckets of ``k1``, so that the texts are shuffled once.
    """
    spark = docs.sparkSession
    each = signed.select("k1", F.explode("minimisers").alias("m"))
    repeated = settle(
        each.groupBy("m").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("m", (F.col("n") > HOT).alias("hot"))
    )
    lists = each.join(repeated, "m").groupBy("k1").agg(
        F.collect_set(F.when(~F.col("hot"), F.col("m"))).alias("cool"), F.collect_set(F.when(F.col("hot"), F.col("m"))).alias("hot")
    )
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(*row_key("doc_id", "text"), "text").repartition(n, "k1")
    path = new_folder(spark, "passages")
    name = own_name(spark, path.rsplit("/", 1)[-1].replace("-", "_"))
    texts.join(lists.repartition(n, "k1").hint("merge"), "k1").write.bucketBy(n, "k1").option("path", path).saveAsTable(name)
    return spark.table(name)


def _packed(candidates: DataFrame, window: int) -> DataFrame:
    """(m, k1, k2, first, packed): super-k-mers with a repeated minimiser that is not hot."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2, cool = (batch.column(c) for c in ("k1", "k2", "cool"))
            rows: list[tuple] = []
            size = 0
            for i, words, own, mers in _documents(batch, window):
                if mers is None or not len(chosen := np.asarray(cool[i].values)):
                    continue
                starts, counts, minimisers = super_kmers(mers, window)
                key = k1[i].as_py(), k2[i].as_py()
                for j in np.flatnonzero(np.isin(minimisers, chosen)).tolist():
                    first = int(starts[j])
                    a = own.start + first
                    packed = words.text(a, a + int(counts[j]) + window - 1)
                    rows.append((int(minimisers[j]), *key, first, packed))
                    size += len(packed)
                if size > 8_000_000:
                    yield _batch(rows, _PACKED)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, _PACKED)

    return candidates.where(F.size("cool") > 0).select("k1", "k2", "text", "cool").mapInArrow(
        emit, "m long, k1 long, k2 long, first long, packed binary"
    )


_PACKED = pa.schema([("m", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("first", pa.int64()), ("packed", pa.binary())])
_SPANS = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def repeated_windows(packed: list[bytes], window: int) -> list[list[tuple[int, int]]]:
    """Word ranges of each packed string that are covered by a window found again in the bucket.

    Windows are sorted as text, so that counting them is exact.
    """
    windows: list[tuple[bytes, int, int]] = []
    for i, text in enumerate(packed):
        offsets = np.concatenate([[-1], np.flatnonzero(np.frombuffer(text, np.uint8) == 0x20), [len(text)]]).tolist()
        windows += [(text[offsets[j] + 1 : offsets[j + window]], i, j) for j in range(len(offsets) - window)]
    windows.sort()
    spans: list[list[tuple[int, int]]] = [[] for _ in packed]
    for before, now in zip(windows, windows[1:]):
        if before[0] == now[0]:
            for _, i, j in (before, now):
                spans[i].append((j, j + window))
    return [merged(s) for s in spans]


def _bucket_spans(packed: DataFrame, window: int) -> DataFrame:
    """(k1, k2, a, b): word ranges that repeat, from buckets of at most ``HOT`` super-k-mers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket: list[dict] = []
        out: list[tuple] = []
        for batch in batches:
            for row in batch.to_pylist():
                if bucket and bucket[0]["m"] != row["m"]:
                    out += spans(bucket)
                    bucket = []
                bucket.append(row)
            if len(out) > 10_000:
                yield _batch(out, _SPANS)
                out = []
        out += spans(bucket)
        yield _batch(out, _SPANS)

    def spans(bucket: list[dict]) -> Iterator[tuple]:
        for row, found in zip(bucket, repeated_windows([r["packed"] for r in bucket], window), strict=True):
            for a, b in found:
                yield row["k1"], row["k2"], row["first"] + a, row["first"] + b

    n = int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return packed.repartition(n, "m").sortWithinPartitions("m").mapInArrow(count, "k1 long, k2 long, a long, b long")


def _hot_spans(candidates: DataFrame, window: int) -> DataFrame:
    """(k1, k2, a, b): repeated windows whose minimiser is hot."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2, hot = (batch.column(c) for c in ("k1", "k2", "hot"))
            texts = batch.column("text")
            for a, b in slices(texts):
                part = texts.slice(a, b - a)
                each = [Words(part, family=f) for f in (0, 1)]
                mers = windows_hash(each[0].hashes, MER)
                d1, d2 = (windows_hash(w.hashes, window).view(np.int64) for w in each)
                columns: list[list[np.ndarray]] = [[], [], [], [], []]
                for i in range(b - a):
                    own = each[0].of(i)
                    if own.stop - own.start < window:
                        continue
                    starts, counts, minimisers = super_kmers(mers[own.start : own.stop - MER + 1], window)
                    of_hot = np.repeat(np.isin(minimisers, np.asarray(hot[a + i].values)), counts)
                    at = np.flatnonzero(of_hot)
                    for column, values in zip(
                        columns,
                        (d1[own.start + at], d2[own.start + at], np.full(len(at), k1[a + i].as_py()), np.full(len(at), k2[a + i].as_py()), at),
                        strict=True,
                    ):
                        column.append(values)
                if columns[0]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(c), pa.int64()) for c in columns], ["d1", "d2", "k1", "k2", "a"]
                    )

    rows = candidates.where(F.size("hot") > 0).select("k1", "k2", "text", "hot")
    windows = settle(rows.mapInArrow(emit, "d1 long, d2 long, k1 long, k2 long, a long"))
    repeated = settle(windows.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("d1", "d2"))
    return windows.join(repeated, ["d1", "d2"]).select("k1", "k2", "a", (F.col("a") + window).alias("b"))


def _changed(candidates: DataFrame, window: int) -> DataFrame:
    """(k1, k2, n_removed, kept) for every document that loses words."""
    spans = _bucket_spans(_packed(candidates, window), window).unionByName(_hot_spans(candidates, window))
    n = int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_key = spans.repartition(n, "k1").groupBy("k1").agg(F.collect_set(F.struct("k2", "a", "b")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, k2, spans = batch.column("text"), batch.column("k2").to_pylist(), batch.column("spans").to_pylist()
            for a, b in slices(texts):
                words = Words(texts.slice(a, b - a))
                removed, kept = [], []
                for i in range(b - a):
                    own, at, gone, parts = words.of(i), 0, 0, []
                    for x, y in merged([(s["a"], s["b"]) for s in spans[a + i] if s["k2"] == k2[a + i]]):
                        if x > at:
                            parts.append(words.text(own.start + at, own.start + x))
                        gone, at = gone + y - x, y
                    if own.start + at < own.stop:
                        parts.append(words.text(own.start + at, own.stop))
                    removed.append(gone)
                    kept.append(b" ".join(parts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("k1").slice(a, b - a), batch.column("k2").slice(a, b - a), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                    ["k1", "k2", "n_removed", "kept"],
                )

    # The texts lie in buckets of k1: only the spans move.
    rows = candidates.select("k1", "k2", "text").join(by_key.hint("merge"), "k1")
    return rows.mapInArrow(cut, "k1 long, k2 long, n_removed long, kept string").where("n_removed > 0")


def report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row of ``docs``."""
    signed = _signed(docs, window)
    changed = _changed(_candidates(docs, signed), window)
    digests = changed.select("k1", "k2", "n_removed", F.sha2("kept", 256).alias("kept_sha256")).dropDuplicates(["k1", "k2"])
    return signed.join(settle(digests), ["k1", "k2"], "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("kept_sha256", "all_sha256").alias("kept_sha256"),
    )


def deduplicated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with all columns; texts that lose words have the kept ones joined by one space."""
    changed = settle(_changed(_candidates(docs, _signed(docs, window)), window).dropDuplicates(["k1", "k2"]))
    k1, k2 = row_key("doc_id", "text")
    new = changed.select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), F.col("kept").alias("__kept"))
    keyed = docs.select("*", k1.alias("__k1"), k2.alias("__k2")).join(new, ["__k1", "__k2"], "left")
    return keyed.withColumn("text", F.coalesce("__kept", "text")).select(*docs.columns)
