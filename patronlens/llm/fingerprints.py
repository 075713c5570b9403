"""Fingerprints of documents: counts of hashed byte triplets, encoded as quartiles.

Every three bytes that lie within ``SPAN`` consecutive ones and begin with the first of them are
hashed into one of 128 buckets. A digest says for each bucket in which quartile of the
text's own buckets its count lies, and holds the length and the ratios of the quartiles. Two digests
differ by a score that is bounded: a bucket adds 1 or 2 for a step of as many quartiles and 6 for opposite ends, and length and
ratios add what is capped. Likeness is 1 for a score of 0 and 0 for the largest possible.

``report`` compares each text with an edited one and with its neighbour in the order of ids.
Documents are sorted once by ranges, so a text and its neighbour meet in one task; only the
ends of each range are joined afterwards, one row a range.

Defined results: a null text counts as empty; texts of fewer than three bytes have the digest of no triplets
and their length; documents that share an id follow each other by the MD5 of their text, null
ids come last; rows that repeat are documents of their own; a single document is its own
neighbour; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronlens.operators.lineage import settle

BUCKETS = 128
SPAN = 4
LENGTH_CAP = 16
HEAD = 3  # bytes before the buckets: length, ratios of the first and second quartile to the third
LARGEST = LENGTH_CAP + 2 * 8 + 6 * BUCKETS
AT_ONCE = 1_000_000  # bytes whose triplets are hashed at once

_OFFSETS = [(i, j) for i in range(1, SPAN - 1) for j in range(i + 1, SPAN)]
_TABLES = np.random.default_rng(20_250_301).integers(0, BUCKETS, (len(_OFFSETS), 3, 256), dtype=np.uint8)
_STEPS = np.array([0, 1, 2, 6], dtype=np.uint8)


def counts(texts: list[bytes]) -> np.ndarray:
    """Triplets of each text in each bucket."""
    out = np.zeros(len(texts) * BUCKETS, dtype=np.int64)
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) <= AT_ONCE):
            size += len(texts[last])
            last += 1
        _count(texts[first:last], out[first * BUCKETS : last * BUCKETS])
        first = last
    return out.reshape(len(texts), BUCKETS)


def _count(texts: list[bytes], out: np.ndarray) -> None:
    data = np.frombuffer(b"".join([*texts, bytes(SPAN)]), dtype=np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    for a in range(0, ends[-1], AT_ONCE):
        n = min(AT_ONCE, ends[-1] - a)
        text = np.searchsorted(ends, [a, a + n - 1], side="right")
        inside = slice(text[0], text[1] + 1)
        base = np.repeat(np.arange(text[0], text[1] + 1) * BUCKETS, np.diff(np.clip(ends[inside], a, a + n), prepend=a))
        for (i, j), (x, y, z) in zip(_OFFSETS, _TABLES):
            places = base + (x[data[a : a + n]] ^ y[data[a + i : a + n + i]] ^ z[data[a + j : a + n + j]])
            out += np.bincount(places, minlength=len(out))
            # What began in the last bytes of a text ran into the next one.
            over = (ends[inside][:, None] - 1 - np.arange(j)).ravel()
            over = over[(over >= np.repeat(ends[inside] - [len(t) for t in texts[inside]], j)) & (over >= a) & (over < a + n)] - a
            out -= np.bincount(places[over], minlength=len(out))


def digests(texts: list[bytes]) -> np.ndarray:
    """One row of numbers for each text: ``HEAD`` numbers, then the quartile of each bucket."""
    found = counts(texts)
    quartiles = np.sort(found, axis=1)[:, [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    out = np.empty((len(texts), HEAD + BUCKETS), dtype=np.uint8)
    out[:, 0] = [length_code(len(t)) for t in texts]
    third = np.maximum(quartiles[:, 2], 1)
    out[:, 1], out[:, 2] = (quartiles[:, i] * 15 // third for i in (0, 1))
    out[:, HEAD:] = sum((found > quartiles[:, [i]]).astype(np.uint8) for i in range(3))
    return out


def length_code(n: int) -> int:
    """Length in steps of an eighth of its highest power of two."""
    bits = n.bit_length()
    return n if bits < 4 else min(255, 8 * (bits - 3) + (n >> (bits - 4)) % 8)


def written(digest: np.ndarray) -> list[str]:
    """Digests as text: two hex digits for the length, one for each ratio, one for each two buckets."""
    codes = digest[:, HEAD:].reshape(len(digest), -1, 2)
    pairs = (codes[:, :, 0] * 4 + codes[:, :, 1]).astype(np.uint8)
    nibbles = np.concatenate([digest[:, :1] >> 4, digest[:, :1] & 15, digest[:, 1:HEAD], pairs], axis=1)
    return [bytes(row).decode() for row in np.frombuffer(b"0123456789abcdef", np.uint8)[nibbles]]


def parsed(fingerprints: list[str]) -> np.ndarray:
    """The inverse of ``written``."""
    nibbles = np.array([[int(c, 16) for c in f] for f in fingerprints], dtype=np.uint8).reshape(len(fingerprints), -1)
    pairs = nibbles[:, HEAD + 1 :]
    codes = np.stack([pairs >> 2, pairs & 3], axis=2).reshape(len(fingerprints), -1)
    return np.concatenate([nibbles[:, :1] * 16 + nibbles[:, 1:2], nibbles[:, 2 : HEAD + 1], codes], axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 - score / ``LARGEST`` of the digests in the rows of ``a`` and ``b``."""
    far = abs(a.astype(np.int64) - b)
    score = np.minimum(far[:, 0], LENGTH_CAP) + np.minimum(far[:, 1:HEAD], 8).sum(axis=1) + _STEPS[far[:, HEAD:]].sum(axis=1, dtype=np.int64)
    return 1 - score / LARGEST


def fingerprinted(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) for every row of ``docs``."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = written(digests(batch.column("bytes").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.string())], ["doc_id", "fingerprint"])

    whole = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("bytes")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole).mapInArrow(compute, "doc_id long, fingerprint string")


def compared(pairs: DataFrame) -> DataFrame:
    """``pairs`` (a, b, left, right) of two ids and their fingerprints, as (a, b, likeness)."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (parsed(batch.column(c).to_pylist()) for c in ("left", "right"))
            near = likeness(left, right) if len(left) else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(near)], ["a", "b", "likeness"])

    return pairs.select("a", "b", "left", "right").mapInArrow(compute, "a long, b long, likeness double")


def edited(text: str, other: str) -> str:
    """``text`` with its last third replaced by as much of the beginning of ``other``."""
    cut = len(text) // 3
    return text[: len(text) - cut] + other[:cut]


_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])
_RESULT_TYPES = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)
_ENDS = [("part", pa.int32()), ("end", pa.int8()), ("text", pa.string())]  # end: 1 first and 2 last row of a range, else 0


def _rows(ids: list, texts: list[str], following: list[str], own: np.ndarray, after: np.ndarray) -> pa.RecordBatch:
    """Results of documents, the texts that follow them, and the digests of both."""
    changed = [edited(t, f).encode() for t, f in zip(texts, following, strict=True)]
    new = digests(changed)
    columns = [
        ids, [len(t) for t in texts], [hashlib.sha256(c).hexdigest() for c in changed], written(own), written(new),
        likeness(own, new), likeness(own, after),
    ]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _RESULT)], schema=_RESULT)


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of all rows of a sorted range but the last, and its first and last texts."""
    part, last = TaskContext.get().partitionId(), None
    for batch in batches:
        for ids, texts in _portions(batch):
            own = digests([t.encode() for t in texts])
            if last is None:
                yield _end(part, 1, ids[0], texts[0])
            else:
                ids, texts, own = [last[0], *ids], [last[1], *texts], np.concatenate([last[2], own])
            if len(ids) > 1:
                yield _ordinary(part, _rows(ids[:-1], texts[:-1], texts[1:], own[:-1], own[1:]))
            last = ids[-1], texts[-1], own[-1:]
    if last is not None:
        yield _end(part, 2, last[0], last[1])


def _portions(batch: pa.RecordBatch, size: int = 4 * AT_ONCE) -> Iterator[tuple[list, list[str]]]:
    ids, texts, waiting = [], [], 0
    for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
        ids.append(i)
        texts.append(text)
        waiting += len(text)
        if waiting >= size:
            yield ids, texts
            ids, texts, waiting = [], [], 0
    if ids:
        yield ids, texts


def _ordinary(part: int, rows: pa.RecordBatch) -> pa.RecordBatch:
    n = rows.num_rows
    ends = [pa.array(np.full(n, part), pa.int32()), pa.array(np.zeros(n), pa.int8()), pa.nulls(n, pa.string())]
    return pa.RecordBatch.from_arrays([*ends, *rows.columns], schema=pa.schema([*_ENDS, *_RESULT]))


def _end(part: int, which: int, doc_id: int | None, text: str) -> pa.RecordBatch:
    row = {"part": part, "end": which, "text": text, "doc_id": doc_id}
    return pa.RecordBatch.from_pylist([row], schema=pa.schema([*_ENDS, *_RESULT]))


def _over_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, following = batch.column("text").to_pylist(), batch.column("following").to_pylist()
        own, after = (digests([t.encode() for t in side]) for side in (texts, following))
        yield _rows(batch.column("doc_id").to_pylist(), texts, following, own, after)


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for every row of ``docs``.

    The next document is that with the next smaller id, the first one for the last. The
    edited text has its last third replaced by the beginning of the next document's.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.md5(text.cast("binary")).alias("tie"),
        F.monotonically_increasing_id().alias("copy"),  # any order of equal rows will do, but they need not share a task
    )
    order = [F.desc_nulls_last("doc_id"), F.asc("tie"), F.asc("copy")]
    along = settle(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
        .mapInArrow(_along, f"part int, end byte, text string, {_RESULT_TYPES}")
    )
    first = along.where("end = 1").select(F.col("part").alias("next"), F.col("text").alias("following"))
    last = along.where("end = 2").select("part", "doc_id", "text")
    # One row a range, without texts.
    in_order = Window.orderBy("part")
    parts = last.select("part", F.coalesce(F.lead("part").over(in_order), F.min("part").over(in_order)).alias("next"))
    over = last.join(parts, "part").join(first, "next").select("doc_id", "text", "following")
    return along.where("end = 0").select(_RESULT.names).unionByName(over.mapInArrow(_over_ends, _RESULT_TYPES))
