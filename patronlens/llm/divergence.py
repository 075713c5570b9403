"""How the words of sources differ inside a language, exact and term by term.

Single-pass in-memory indexing: a task reads its documents once and builds postings (term, source, occurrences) of a
block in memory. When the block is full it spills: the postings leave sorted by term, cut into
hash shards. A shard gets its slices of all runs and merges them with a heap into the
frequencies of its terms. Terms in enough documents of their language are kept.

The divergence of two sources sums over all kept terms, most of which most sources don't have. So
each pair starts with what a term absent from both adds, times the number of terms; each
source corrects this for the counts that it has, once for all terms with the same count; and while the
frequencies stream by, each term corrects the pairs of sources that share it. No pair of sources
is looked at for a term that only one of them has.

Defined results: null text, language and source are read as ''; terms are runs of letters A to Z in
either case, lowered, and of all characters beyond ASCII; documents without terms still name their source;
rows that repeat count as often as they occur; a language without kept terms has values
of 0; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronlens.operators.lineage import settle

LEAST_DOCS = 10
TOP = 10
SHARES = 1_000_000_000  # shares are counted in billionths
BLOCK_POSTINGS = 600_000  # of a block in memory
BLOCK_BYTES = 32_000_000  # of its terms
DOCUMENT = 2**40  # one document, in numbers that hold occurrences and documents
PIECE = 4_000_000  # bytes of a text that are cut into terms at once
CHUNK = 20_000  # postings of a row of the frequencies

_OTHER = re.compile(rb"[^A-Za-z\x80-\xff]")
_LETTERS = bytes(c | 0x20 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 0x20 for c in range(256))


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, some ``PIECE`` bytes at a time."""
    start = 0
    while start < len(text):
        end = start + PIECE
        if end < len(text):
            gap = _OTHER.search(text, end)
            end = gap.start() if gap else len(text)
        yield text[start:end].translate(_LETTERS).split()
        start = end


class Block:
    """Postings in memory: for each language and source the terms with their occurrences and documents.

    Both counts are one number, documents above the bits of the occurrences.
    """

    def __init__(self):
        self.counts: dict[tuple[str, str], dict[bytes, int]] = defaultdict(dict)
        self.size = self.bytes = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        counts, own = self.counts[lang, source], Counter()
        for terms in terms_of(text):
            own.update(terms)
        before, get = len(counts), counts.get
        for term, n in own.items():
            counts[term] = get(term, 0) + n + DOCUMENT
        if len(counts) > before:
            self.size += len(counts) - before
            self.bytes += sum(map(len, own))  # at least what the new ones take

    def full(self) -> bool:
        return self.size > BLOCK_POSTINGS or self.bytes > BLOCK_BYTES

    def runs(self, shards: int) -> Iterator[pa.RecordBatch]:
        """The block sorted by term, as one row for each language and shard."""
        by_lang = defaultdict(list)
        for (lang, source), counts in self.counts.items():
            if counts:
                by_lang[lang].append((source, counts))
        for lang, sources in by_lang.items():
            encoded = pa.array([t for _, counts in sources for t in counts], pa.binary()).dictionary_encode()
            both = np.fromiter((n for _, counts in sources for n in counts.values()), np.int64, len(encoded))
            source = np.repeat(np.arange(len(sources)), [len(counts) for _, counts in sources])
            known, code, start = encoded.dictionary, encoded.indices.to_numpy(), zlib.crc32(lang.encode())
            shard = np.array([zlib.crc32(t, start) % shards for t in _listed(known)], dtype=np.int64)  # the same in every process
            rank = np.empty(len(known), dtype=np.int64)
            rank[pa.compute.sort_indices(known).to_numpy()] = np.arange(len(known))
            order = np.lexsort((rank, shard))
            place = np.empty(len(known), dtype=np.int64)
            place[order] = np.arange(len(known))
            docs = np.zeros(len(known), dtype=np.int64)
            np.add.at(docs, place[code], both // DOCUMENT)
            widths = np.bincount(place[code], minlength=len(known))
            postings = np.argsort(place[code], kind="stable")
            names = pa.array([s for s, _ in sources], pa.string()).take(pa.array(source[postings]))
            times, terms, ends = pa.array(both[postings] % DOCUMENT), known.take(pa.array(order)), np.append(0, np.cumsum(widths))
            cuts = [0, *(np.flatnonzero(np.diff(shard[order])) + 1).tolist(), len(known)]
            for a, b in zip(cuts, cuts[1:]):
                c, d = int(ends[a]), int(ends[b])
                lists = (terms.slice(a, b - a), pa.array(docs[a:b]), pa.array(widths[a:b], pa.int32()), names.slice(c, d - c), times.slice(c, d - c))
                row = [pa.array([shard[order[a]]], pa.int32()), pa.array([lang]), *(pa.ListArray.from_arrays([0, len(x)], x) for x in lists)]
                yield pa.RecordBatch.from_arrays(row, schema=_RUN)


_RUN = pa.schema([
    ("shard", pa.int32()), ("lang", pa.string()), ("terms", pa.list_(pa.binary())), ("docs", pa.list_(pa.int64())),
    ("widths", pa.list_(pa.int32())), ("sources", pa.list_(pa.string())), ("times", pa.list_(pa.int64())),
])
_RUN_TYPES = "shard int, lang string, terms array<binary>, docs array<long>, widths array<int>, sources array<string>, times array<long>"
_CHUNK = pa.schema([
    ("lang", pa.string()), ("n_terms", pa.int64()), ("terms", pa.list_(pa.string())), ("sums", pa.list_(pa.int64())),
    ("sources", pa.list_(pa.string())), ("times", pa.list_(pa.int64())),
])
_CHUNK_TYPES = "lang string, n_terms long, terms array<string>, sums array<long>, sources array<string>, times array<long>"


def runs(docs: DataFrame, shards: int) -> DataFrame:
    """Term-sorted runs of ``docs`` (lang, source, text as bytes), cut into shards."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block()
        for batch in batches:
            for lang, source, text in zip(*(batch.column(c) for c in ("lang", "source", "text"))):
                block.add(lang.as_py(), source.as_py(), text.as_py())
                if block.full():
                    yield from block.runs(shards)
                    block = Block()
        yield from block.runs(shards)

    return docs.mapInArrow(index, _RUN_TYPES)


def _postings(run: pa.RecordBatch, order: int, step: int = 1_000) -> Iterator[tuple[bytes, int, int, range, list[str], list[int]]]:
    """(term, number of the run, documents, range in the lists that follow) of a run, of which only ``step`` terms are unpacked."""
    terms, docs, widths, sources, times = (run.column(c)[0].values for c in ("terms", "docs", "widths", "sources", "times"))
    at = 0
    for i in range(0, len(terms), step):
        cut = [_listed(c.slice(i, step)) for c in (terms, docs, widths)]
        size, place = sum(cut[2]), 0
        names, counts = (_listed(c.slice(at, size)) for c in (sources, times))
        at += size
        for term, n, width in zip(*cut):
            yield term, order, n, range(place, place + width), names, counts
            place += width


def _listed(column: pa.Array) -> list:
    return column.to_numpy(zero_copy_only=False).tolist()


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (batch.slice(i, 1) for batch in batches for i in range(batch.num_rows))


def frequencies(found: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """The runs merged into terms that ``least`` documents of their language have.

    (lang, n_terms, terms, sums, sources, times): one entry of the lists for each term and
    source, ``sums`` being the term's occurrences in the language; some ``CHUNK`` entries a row.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = lambda r: (r.column("shard")[0].as_py(), r.column("lang")[0].as_py())
        for (_, lang), same in groupby(_each(batches), key=shard):
            merged = heapq.merge(*(_postings(run, order) for order, run in enumerate(same)))
            n_terms, terms, sums, names, times = 0, [], [], [], []
            for term, entries in groupby(merged, key=itemgetter(0)):
                entries = list(entries)
                if sum(n for _, _, n, *_ in entries) < least:
                    continue
                counts = Counter()
                for _, _, _, places, sources, own in entries:
                    for i in places:
                        counts[sources[i]] += own[i]
                n_terms += 1
                terms += [term.decode()] * len(counts)
                sums += [counts.total()] * len(counts)
                names += counts
                times += counts.values()
                if len(names) >= CHUNK:
                    yield _chunk(lang, n_terms, terms, sums, names, times)
                    n_terms, terms, sums, names, times = 0, [], [], [], []
            if n_terms:
                yield _chunk(lang, n_terms, terms, sums, names, times)

    return found.repartition("shard").sortWithinPartitions("shard", "lang").mapInArrow(merge, _CHUNK_TYPES)


def _chunk(*columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(columns, _CHUNK.types)], schema=_CHUNK)


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(``SHARES`` * count / total), exact for totals below 2^53 and counts of at most the total."""
    whole, rest = np.divmod(count, total)
    for _ in range(3):  # SHARES is 1000 three times
        step, rest = np.divmod(rest * 1_000, total)
        whole = whole * 1_000 + step
    return 1 + whole


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def share_sql(count: Column, total: Column) -> Column:
    wide = lambda c: c.cast("decimal(28,0)")
    return F.call_function("div", wide(count) * F.lit(SHARES).cast("decimal(10,0)"), wide(total)) + 1


def _of_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a source's own counts, and the terms it doesn't have, add to its pairs."""
    for batch in batches:
        for row in batch.to_pylist():
            totals, terms = np.array(row["totals"], dtype=np.int64), row["v"]
            if not terms:
                values = np.zeros(len(totals), dtype=np.int64)
                own = values
            else:
                absent = share(np.full(len(totals), 2), totals + 2 * terms)
                mine = row["total"] + 2 * terms
                zero = share(np.array([2]), np.array([mine]))
                base = divergence(zero, absent)
                own = np.zeros(len(totals), dtype=np.int64)
                for n, times in zip(row["ns"] or [], row["counts"] or []):
                    own += n * (divergence(share(np.array([times + 2]), np.array([mine])), absent) - base)
                values = own + terms * base
            place = row["all_sources"].index(row["source"])
            value = own + np.where(np.arange(len(own)) > place, values - own, 0)  # the constant once for a pair
            for part in (slice(0, place), slice(place + 1, None)):
                names = row["all_sources"][part]
                mine = [row["source"]] * len(names)
                yield _pairs([row["lang"]] * len(names), *((names, mine) if part.stop == place else (mine, names)), value[part])


def _of_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corrections of pairs of sources that share a term, summed over what a task reads."""
    found: dict[str, tuple[list[str], list, list]] = {}
    for one in _each(batches):
        row = one.to_pylist()[0]
        number = {s: i for i, s in enumerate(row["all_sources"])}
        source = np.array([number[s] for s in row["sources"]], dtype=np.int64)
        totals = np.array(row["totals"], dtype=np.int64) + 2 * row["v"]
        words = row["terms"]
        term = np.cumsum([0, *(a != b for a, b in zip(words, words[1:]))])
        zero = share(np.full(len(totals), 2), totals)
        p, absent = share(np.array(row["times"], dtype=np.int64) + 2, totals[source]), zero[source]
        _, keys, values = found.setdefault(row["lang"], (row["all_sources"], [], []))
        left, step = np.arange(len(term)), 0
        while len(left):
            step += 1
            left = left[left + step < len(term)]
            left = left[term[left] == term[left + step]]
            a, b = left, left + step
            value = divergence(p[a], p[b]) - divergence(p[a], absent[b]) - divergence(absent[a], p[b]) + divergence(absent[a], absent[b])
            keys.append(np.minimum(source[a], source[b]) * len(totals) + np.maximum(source[a], source[b]))
            values.append(value)
            if sum(map(len, keys)) > 1_000_000 or not len(left):
                keys[:], values[:] = _summed(keys, values)
        if sum(len(k) for _, keys, _ in found.values() for k in keys) > 2_000_000:
            yield from _of_found(found)
            found = {}
    yield from _of_found(found)


def _of_found(found: dict[str, tuple[list[str], list, list]]) -> Iterator[pa.RecordBatch]:
    for lang, (names, keys, values) in found.items():
        for key, value in zip(*_summed(keys, values)):
            first, second = (np.array(names, dtype=object)[x].tolist() for x in np.divmod(key, len(names)))
            yield _pairs([lang] * len(first), first, second, value)


def _summed(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    key, value = np.concatenate(keys), np.concatenate(values)
    order = np.argsort(key, kind="stable")
    key, value = key[order], value[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, dtype=np.int64)
    return [key[starts]], [np.add.reduceat(value, starts) if len(starts) else value]


def _pairs(langs: list[str], first: list[str], second: list[str], values: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(c, pa.string()) for c in (langs, first, second)]
    return pa.RecordBatch.from_arrays([*columns, pa.array(values, pa.int64())], ["lang", "source", "item", "value"])


_PAIR_TYPES = "lang string, source string, item string, value long"


def totals_of(named: DataFrame, merged: DataFrame, postings: DataFrame) -> DataFrame:
    """(lang, source, total, v, lang_total) for every language and source that occurs."""
    own = postings.groupBy("lang", "source").agg(F.sum("times").alias("total"))
    whole = own.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    kept = merged.groupBy("lang").agg(F.sum("n_terms").alias("v"))
    return settle(
        named.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(whole, "lang", "left").join(kept, "lang", "left")
        .fillna(0)
    )


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) for every language and source of ``docs``.

    part ``pair``: the other sources of the language by divergence, all of them; part
    ``term``: the ``top`` terms that the source has more of than its language, by divergence.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    named = docs.select(blank("lang"), blank("source"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    merged = settle(frequencies(runs(named, shards), least))
    postings = merged.select("lang", F.inline(F.arrays_zip("terms", "sums", "sources", "times"))).withColumnsRenamed(
        {"terms": "term", "sources": "source"}
    )
    totals = totals_of(named, merged, postings)

    size, lang_size = F.col("total") + 2 * F.col("v"), F.col("lang_total") + 2 * F.col("v")
    shares = postings.join(totals, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"),
        share_sql(F.col("times") + 2, size).alias("p"), share_sql(F.col("sums") + 2, lang_size).alias("q"),
    )
    terms = shares.where("p > q").select("lang", "source", "item", F.expr("(p - q) * (p - q) div (p + q)").alias("value"))

    # A language's sources in one row: each of them has as many rows in the result.
    each = F.sort_array(F.collect_list(F.struct("source", "total")))
    by_lang = settle(totals.groupBy("lang").agg(F.first("v").alias("v"), each.alias("each"))).select(
        "lang", "v", F.col("each.source").alias("all_sources"), F.col("each.total").alias("totals")
    )
    counts = postings.groupBy("lang", "source", "times").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.groupBy("lang", "source").agg(F.collect_list(F.struct("n", "times")).alias("counts"))
    alone = (
        totals.select("lang", "source", "total").join(counts, ["lang", "source"], "left").join(by_lang, "lang")
        .select("lang", "source", "total", "v", "all_sources", "totals", F.col("counts.n").alias("ns"), F.col("counts.times").alias("counts"))
    )
    shared = merged.drop("n_terms", "sums").join(by_lang, "lang")
    pairs = (
        alone.mapInArrow(_of_counts, _PAIR_TYPES).unionByName(shared.mapInArrow(_of_shared, _PAIR_TYPES))
        .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    )
    # Each pair was looked at once; both of its sources report it.
    sides = F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))
    pairs = pairs.select("lang", F.explode(sides).alias("side"), "value").select("lang", "side.source", "side.item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    ranked = lambda rows, part: rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return ranked(pairs, "pair").unionByName(ranked(terms, "term").where(F.col("rank") <= top))
