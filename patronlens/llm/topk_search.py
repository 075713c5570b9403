"""Exact BM25 top-k of stated queries: an inverted index per shard, block-max WAND, merged exactly.

Documents are dealt into shards, and these into stripes, a fixed number for a core. A task holds the queries and gets
the shards of its stripe one after the other: it turns the documents into postings as they come, keeps no text, and puts the
queries to each shard in turn. A query keeps its best k, and the k-th best score of the shards before is its threshold in the next.
So queries are copied, and answers given, once a stripe, however many shards there are. Document
frequencies, document count and mean length are those of all documents, so scores of different shards
compare and the best k of every stripe contain the best k of all.

A list with many of a shard's documents is long, the others are short; documents that share frequent words lie side by side, so
blocks are alike inside. Long lists keep the largest contribution in each block of ``BLOCK`` documents, every list that in the whole shard.
Queries are put to a shard ``TOGETHER`` at a time, those that repeat the same word side by side. Short lists are read; what they give to the
best k is a first threshold where no shard before gave one, later it is the k-th best score so far. What a document has from
short lists and the block maxima of the long lists are a bound of its score: only where it reaches the threshold
are long lists read: this is WAND's pivot test, made for whole blocks. There they are a matrix of the documents and words of some blocks, multiplied by the weights of all
queries that may find something there. A query whose lists' maxima don't reach the threshold passes the shard over. Sums in single precision
only pass over what their error can't lift to the threshold; what is left is summed again in double precision. Nothing that could tie with the k-th best is passed over.

Words are lower-cased in A-Z; a query is the whole text of its row, each distinct word weighted
by its count. score = sum of count * ln(1 + (N - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (tf + K1 * (1 - B +
B * length / mean length)).

Defined results: a null text has no words, matches nothing and as a query finds nothing; a query without an id
can't be named in the result and is left out, a document without one is found; only
documents that share a word with the query are found; ties go to the smaller doc_id, a null
one last; rows that repeat are found as rows of their own, and are one query; an empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronlens.llm.common import row_key, word_count
from patronlens.llm.words import Words, slices
from patronlens.operators.lineage import settle

K = 10
K1, B = 1.2, 0.75
SHARD = 8_192  # documents of a shard, on average at most
BLOCK = 8  # documents whose largest contributions are kept for a long list
WIDE = 16  # blocks whose long lists are held as one matrix
LONG = 50  # a list is long if at least one of so many documents of the shard is in it,
COLUMNS = 4_096  # and if it is among the so many longest ones
TOGETHER = 256  # queries that are put to a shard together
VISIT = 1  # such matrices visited at first before thresholds are raised; twice as many each time
STRIPES = 2  # tasks a core: each takes some of the shards, one after the other
HELD = 32_768  # queries that a task holds, about; with more of them the documents are dealt once for each group
RARE = 200  # a word that fewer than one of so many documents of a shard have doesn't tell which are alike
NEAR = 3  # words by which alike documents are put side by side
SLACK = 1e-9  # relative error of sums that is allowed for before anything is passed over


def bags(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, distinct word hashes, their counts)."""
    for a, b in slices(texts):
        words = Words(texts.slice(a, b - a), lower=True)
        hashes = words.hashes.view(np.int64)
        for i in range(b - a):
            yield a + i, *np.unique(hashes[words.of(i)], return_counts=True)


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All places from each start to its end, one range after the other."""
    sizes = ends - starts
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def _neighbours(term: np.ndarray, doc: np.ndarray, begins: np.ndarray, n: int) -> np.ndarray:
    """The documents 0 to n - 1 in the order of their ``NEAR`` least words, by hash, of those that many have. Postings are sorted by term."""
    sizes = np.diff(np.append(np.flatnonzero(begins), len(term)))
    many = np.repeat(sizes * RARE >= n, sizes)
    term, doc, keys = term[many], doc[many], []
    for _ in range(NEAR):
        least = np.full(n, np.iinfo(np.int64).max)
        least[doc[::-1]] = term[::-1]  # the last one written stays
        keys.append(least)
        left = term != least[doc]
        term, doc = term[left], doc[left]
    return np.lexsort(keys[::-1])


class Postings:
    """Postings of a shard as its documents stream by."""

    def __init__(self) -> None:
        self.parts: tuple[list[np.ndarray], ...] = ([], [], [])  # term, document, count
        self.lengths: list[np.ndarray] = []
        self.n = 0

    def add(self, texts: pa.Array) -> None:
        own, lengths = [], np.zeros(len(texts))
        for i, terms, times in bags(texts):
            own.append((terms, np.full(len(terms), self.n + i, dtype=np.int32), times.astype(np.int32)))
            lengths[i] = times.sum()
        for part, columns, kind in zip(self.parts, zip(*own) if own else [()] * 3, (np.int64, np.int32, np.int32)):
            part.append(np.concatenate([*columns, np.empty(0, kind)]))
        self.lengths.append(lengths)
        self.n += len(texts)

    def take(self, column: int) -> np.ndarray:
        """A whole column, whose parts are given up."""
        whole = np.concatenate(self.parts[column])
        self.parts[column].clear()
        return whole


class Index:
    """Inverted lists of a shard. ``read`` counts the postings that queries read, when asked one at a time, ``held`` those of their lists."""

    def __init__(self, found: Postings, mean: float):
        # One column at a time, and its parts go as it is made: the peak is far below three columns twice.
        term = found.take(0)
        order = np.argsort(term, kind="stable").astype(np.int32)  # lists by term, each by document
        term = term[order]
        begins = np.append(True, term[1:] != term[:-1])[: len(term)]
        self.terms, doc = term[begins], found.take(1)[order]
        self.n, self.read, self.held = found.n, 0, 0
        # Documents are numbered by the words they share, so that a list has its documents in few blocks.
        self.order = _neighbours(term, doc, begins, self.n)
        del term
        number = np.empty(self.n, dtype=np.int32)
        number[self.order] = np.arange(self.n, dtype=np.int32)
        self.doc = number[doc]
        del doc
        again = (np.cumsum(begins) - 1) * self.n + self.doc
        again = np.argsort(again, kind="stable").astype(np.int32)
        self.doc, order = self.doc[again], order[again]
        del again
        tf = found.take(2)[order]
        del order
        norm = (K1 * (1 - B + B * np.concatenate(found.lengths) / max(mean, 1e-9)))[self.order]
        self.impact = tf * (K1 + 1)
        below = norm[self.doc]
        below += tf
        self.impact /= below
        del below, tf
        self.starts = np.append(np.flatnonzero(begins), len(begins))
        self.lists = np.arange(len(self.starts))
        self.most = np.maximum.reduceat(self.impact, self.starts[:-1]) if len(begins) else np.empty(0)
        del begins
        # The same postings by document, each document's by term.
        order = np.argsort(self.doc, kind="stable").astype(np.int32)
        sizes = np.diff(self.starts)
        self.term_of, self.impact_of = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[order], self.impact[order]
        del order
        self.doc_starts = np.append(0, np.cumsum(np.bincount(self.doc, minlength=self.n)))
        self.weight_of = np.zeros(len(sizes))
        long = np.flatnonzero(sizes * LONG >= self.n)
        long = long[np.argsort(-sizes[long], kind="stable")[:COLUMNS]]
        self.column = np.full(len(sizes), -1, dtype=np.int32)
        self.column[long] = np.arange(len(long), dtype=np.int32)
        self.columns = len(long)
        self.slack = (len(long) + 8) * 2.0**-23  # relative error of single precision in sums over so many columns
        self.tiles = [self._tile(a, min(a + WIDE * BLOCK, self.n)) for a in range(0, self.n, WIDE * BLOCK)]

    def _tile(self, a: int, b: int) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray]:
        """Documents from ``a`` to ``b``, the columns that they have, their contributions there, and the largest ones of each block."""
        own = slice(self.doc_starts[a], self.doc_starts[b])
        column = self.column[self.term_of[own]]
        long = column >= 0
        used, column = np.unique(column[long], return_inverse=True)
        impact = np.zeros((b - a, len(used)), dtype=np.float32)
        impact[np.repeat(np.arange(b - a), np.diff(self.doc_starts[a : b + 1]))[long], column] = self.impact_of[own][long]
        return a, b, used, impact, np.maximum.reduceat(impact, np.arange(0, b - a, BLOCK), axis=0)

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, least: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """Documents, as ``order`` numbers them, and scores of at least the best ``k``, ties with the last one included; those below ``least`` may be left out."""
        scored: list[np.ndarray] = []
        found = self.best_of([(terms, weights, least)], k, scored)[0]
        at = self._known(terms)
        at = at[at >= 0]
        self.held += int((self.starts[at + 1] - self.starts[at]).sum())
        if scored:
            seen = np.zeros(self.n, dtype=bool)
            seen[np.concatenate(scored)] = True
            for t in at:
                docs = self.doc[self.starts[t] : self.starts[t + 1]]
                self.read += len(docs) if self.column[t] < 0 else int(seen[docs].sum())
        return found

    def best_of(
        self, asked: list[tuple[np.ndarray, np.ndarray, float]], k: int, scored: list[np.ndarray] | None = None
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """``best`` for each of some queries (terms, weights, least). ``scored`` is given the documents whose long lists were read."""
        found = [(np.empty(0, np.int64), np.empty(0))] * len(asked)
        known = np.split(self._known(np.concatenate([t for t, _, _ in asked])), np.cumsum([len(t) for t, _, _ in asked])[:-1])
        live: list[tuple[int, np.ndarray, np.ndarray]] = []
        for i, (at, (_, weights, least)) in enumerate(zip(known, asked)):
            at, weights = at[at >= 0], weights[at >= 0]
            if len(at) and weights @ self.most[at] >= least * (1 - SLACK):
                live.append((i, at, weights))
        if not live:
            return found
        short = np.empty((len(live), self.n), dtype=np.float32)
        long = np.zeros((self.columns, len(live)), dtype=np.float32)
        for j, (_, at, weights) in enumerate(live):
            column = self.column[at]
            long[column[column >= 0], j] = weights[column >= 0]
            at, weights = at[column < 0], weights[column < 0]
            starts, ends = self.starts[at], self.starts[at + 1]
            places = _ranges(starts, ends)
            short[j] = np.bincount(self.doc[places], np.repeat(weights, ends - starts) * self.impact[places], self.n)
        bound = np.concatenate([long[used].T @ most.T for _, _, used, _, most in self.tiles], axis=1)
        bound = np.repeat(bound, BLOCK, axis=1)[:, : self.n]
        bound += short
        least = np.array([asked[i][2] for i, _, _ in live])
        if self.n >= k and (unset := np.flatnonzero(least <= 0)).size:
            # What the short lists alone give to the best k is a first threshold.
            least[unset] = np.partition(short[unset], self.n - k, axis=1)[:, self.n - k] * (1 - self.slack)
        waiting = sorted(self.tiles, key=lambda tile: -bound[:, tile[0] : tile[1]].max())
        query, doc, sums, visit = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32), VISIT
        while waiting:
            need, parts = least * (1 - self.slack), [(query, doc, sums)]
            for a, b, used, impact, _ in waiting[:visit]:
                able = (bound[:, a:b] >= need[:, None]) & (bound[:, a:b] > 0)
                if not (queries := np.flatnonzero(able.any(axis=1))).size:
                    continue
                docs = np.flatnonzero(able[queries].any(axis=0))
                if scored is not None:
                    scored.append(a + docs)
                whole = long[used][:, queries].T @ impact[docs].T
                whole += short[queries, a:b][:, docs]
                at, place = np.nonzero((whole >= need[queries, None]) & (whole > 0))
                parts.append((queries[at], a + docs[place], whole[at, place]))
            waiting, visit = waiting[visit:], 2 * visit
            query, doc, sums = (np.concatenate(c) for c in zip(*parts))
            order = np.lexsort([-sums, query])
            query, doc, sums = query[order], doc[order], sums[order]
            cuts = np.searchsorted(query, np.arange(len(live) + 1))
            full = np.flatnonzero(np.diff(cuts) >= k)
            least[full] = np.maximum(least[full], sums[cuts[full] + k - 1] * (1 - self.slack))
            left = sums >= (least * (1 - self.slack))[query]
            query, doc, sums = query[left], doc[left], sums[left]
        cuts = np.searchsorted(query, np.arange(len(live) + 1))
        for j in np.flatnonzero(np.diff(cuts)):
            i, at, weights = live[j]
            docs = doc[cuts[j] : cuts[j + 1]]
            found[i] = docs, self._scores(at, weights, docs)
        return found

    def _known(self, terms: np.ndarray) -> np.ndarray:
        """Numbers of the terms' lists, -1 for a term without one."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def _scores(self, at: np.ndarray, weights: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Scores in double precision, summed by term, so that equal texts have equal scores in every block and shard."""
        own = [slice(a, b) for a, b in zip(self.doc_starts[docs].tolist(), self.doc_starts[docs + 1].tolist())]
        self.weight_of[at] = weights
        parts = self.weight_of[np.concatenate([self.term_of[s] for s in own])] * np.concatenate([self.impact_of[s] for s in own])
        self.weight_of[at] = 0
        return np.bincount(np.repeat(np.arange(len(docs)), [s.stop - s.start for s in own]), parts, len(docs))


def search(docs: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, doc_id, score): for each of ``queries`` (doc_id, text) the best ``k`` of ``docs``."""
    n, words = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(word_count("text")), F.lit(0))).first()
    mean, stripes = words / max(n, 1), STRIPES * docs.sparkSession.sparkContext.defaultParallelism
    shards = stripes * max(1, math.ceil(n / SHARD / stripes))  # as many in every stripe

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = np.concatenate([*(terms for _, terms, _ in bags(batch.column("text"))), np.empty(0, np.int64)])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in np.unique(each, return_counts=True)], ["term", "df"])

    def query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, terms, counts in bags(batch.column("text")):
                keys = [pa.array(np.full(len(terms), batch.column(c)[i].as_py()), pa.int64()) for c in ("k1", "k2", "query_id")]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(terms), pa.array(counts, pa.int64())], ["k1", "k2", "query_id", "term", "n"])

    asked = queries.where("doc_id IS NOT NULL").select(*row_key("doc_id", "text"), F.col("doc_id").alias("query_id"), "text")
    asked = settle(
        asked.mapInArrow(query_terms, "k1 long, k2 long, query_id long, term long, n long").distinct()
    )
    vocabulary = asked.select("term").distinct()
    df = settle(
        docs.select("text").mapInArrow(frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
        .join(vocabulary, "term", "left_semi")
    )
    weight = F.col("n") * F.log(1 + (F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    # A query term that no document has can't score.
    weighted = settle(
        asked.join(df, "term").groupBy("k1", "k2", "query_id")
        .agg(F.collect_list(F.struct("term", weight.alias("weight"))).alias("terms"), F.max_by("term", F.struct("n", "term")).alias("repeated"))
        .select("k1", "k2", "query_id", F.col("terms.term").alias("terms"), F.col("terms.weight").alias("weights"), "repeated")
    )

    groups = max(1, math.ceil(weighted.count() / HELD))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A partition is one group of queries and one stripe: first the queries, then the stripe's shards one after the other.
        asked, shard, found, ids, rows = [], None, Postings(), [], []
        for batch in batches:
            numbers = batch.column("shard").to_numpy()
            cuts = np.flatnonzero(numbers[1:] != numbers[:-1]) + 1
            for a, b in zip([0, *cuts], [*cuts, len(numbers)]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if numbers[a] < 0:
                    asked += [Query(*(part.column(c)[i] for c in ("k1", "k2", "id", "terms", "weights"))) for i in range(part.num_rows)]
                    continue
                if numbers[a] != shard:
                    _answer(asked, found, mean, ids, rows, k)
                    shard, found, ids, rows = numbers[a], Postings(), [], []
                found.add(part.column("text"))
                ids.append(part.column("id"))
                rows.append(part.column("k1"))
        _answer(asked, found, mean, ids, rows, k)
        for a in range(0, len(asked), 1_000):
            best = [row for query in asked[a : a + 1_000] for row in query.rows()]
            columns = zip(*best) if best else [()] * len(_FOUND)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _FOUND, strict=True)], schema=_FOUND)

    none = lambda kind: F.lit(None).cast(kind)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = docs.select(
        F.pmod(F.xxhash64("text", "doc_id"), F.lit(shards)).cast("int").alias("shard"), F.col("doc_id").cast("long").alias("id"),
        F.xxhash64("doc_id", "text").alias("k1"), none("long").alias("k2"), "text", none("array<long>").alias("terms"), none("array<double>").alias("weights"), none("long").alias("repeated"),
    ).select(F.pmod("shard", F.lit(stripes)).alias("stripe"), each(groups).alias("group"), "*")
    sent = weighted.select(
        each(stripes).alias("stripe"), F.pmod(F.xxhash64("k1", "k2"), F.lit(groups)).cast("int").alias("group"), F.lit(-1).alias("shard"),
        F.col("query_id").alias("id"), "k1", "k2", none("string").alias("text"), "terms", "weights", "repeated",
    )
    stream = dealt.unionByName(sent).repartitionById(stripes * groups, F.col("stripe") * groups + F.col("group")).sortWithinPartitions("shard", "repeated")
    found = stream.mapInArrow(answer, "k1 long, k2 long, query_id long, doc_id long, row long, score double")
    order = Window.partitionBy("k1", "k2").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")


class Query:
    """A query that a task holds, with its best documents so far as (-score, no id, id, row)."""

    def __init__(self, k1: pa.Scalar, k2: pa.Scalar, query_id: pa.Scalar, terms: pa.Scalar, weights: pa.Scalar):
        self.names = k1.as_py(), k2.as_py(), query_id.as_py()
        self.terms, self.weights = (np.array(c.values) for c in (terms, weights))
        order = np.argsort(self.terms)  # words that lie side by side are found faster
        self.terms, self.weights = self.terms[order], self.weights[order]
        self.best: list[tuple[float, bool, int, int]] = []

    def least(self, k: int) -> float:
        return -self.best[-1][0] if len(self.best) == k else 0.0

    def take(self, scores: np.ndarray, ids: pa.Array, rows: pa.Array, k: int) -> None:
        new = [(-s, i is None, i or 0, r) for s, i, r in zip(scores.tolist(), ids.to_pylist(), rows.to_pylist(), strict=True)]
        self.best = sorted(self.best + new)[:k]

    def rows(self) -> list[tuple]:
        return [(*self.names, None if unnamed else i, row, -score) for score, unnamed, i, row in self.best]


def _answer(asked: list[Query], found: Postings, mean: float, ids: list[pa.Array], rows: list[pa.Array], k: int) -> None:
    if found.n and asked:
        index = Index(found, mean)
        ids_, rows_ = (pa.concat_arrays(c).take(pa.array(index.order)) for c in (ids, rows))
        for a in range(0, len(asked), TOGETHER):
            some = asked[a : a + TOGETHER]
            for query, (docs, scores) in zip(some, index.best_of([(q.terms, q.weights, q.least(k)) for q in some], k)):
                if len(docs):
                    query.take(scores, *(c.take(pa.array(docs)) for c in (ids_, rows_)), k)


_FOUND = pa.schema([
    ("k1", pa.int64()), ("k2", pa.int64()), ("query_id", pa.int64()), ("doc_id", pa.int64()), ("row", pa.int64()), ("score", pa.float64()),
])
