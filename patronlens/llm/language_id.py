"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. The
probability of a word is the sum over all its segmentations into pieces, computed by a
forward pass; that of a text is the product over its words, and the language with the
highest one is predicted. The piece probabilities come from expectation maximisation:
tasks run the forward and backward passes over the words of the sample, Spark sums the
expected counts, and the driver only sees one number for each language and piece.

The sample is bounded: at most ``SAMPLE`` labelled documents a language (rounded up to a
multiple of ``STRATA``), chosen by their id hashes. Prediction reads every text whole.

Words are runs of letters in lower case, of any length. Those up to ``LONGEST`` letters are scored many at a
time; longer ones one at a time in logarithms, with a window as wide as the longest piece, so that neither
numbers nor memory run out. Both sum all segmentations.

Defined results: a null text and one without a letter is ``und`` with score 0, as is every
text when there is nothing to learn from; rows with a null label are predicted and not
learned from; of equally likely languages the first by name is taken; rows that repeat are
predicted alike; a null doc_id is never held out; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from patronlens.llm.common import id_hash
from patronlens.operators.lineage import settle

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLE = 1_024
STRATA = 256  # classes by the last two hex digits of the id hash
ROUNDS = 3
LONGEST = 32  # letters of words that are scored many at a time
CHUNK = 4_096  # positions of a long word whose pieces are looked up at once
SMOOTHING = 0.05  # added to the expected count of every piece
UNKNOWN = 1e-8  # probability of a character that no piece covers
UNDETERMINED = "und"
CACHED_WORDS = 250_000  # word scores a worker remembers
SLICE_CHARACTERS = 2_000_000

_LETTERS = re.compile(r"[^\W\d_]+")  # and a few other characters, such as superscripts
_BEGIN = "▁"  # marks the start of a word in the vocabulary
_FACTOR, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_SLOT_BITS = 18


def read_vocabulary(path: str = VOCABULARY) -> list[str]:
    """Pieces of letters in a sentencepiece file, with or without the mark of a word's start."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not model.is_byte(i) and not model.is_control(i))
    return sorted({p for p in pieces if p == _BEGIN or _LETTERS.fullmatch(p.removeprefix(_BEGIN)) and p == p.lower()})


def words_of(text: str | None) -> list[str]:
    found = _LETTERS.findall((text or "").lower())
    if not all(map(str.isalpha, found)):
        found = "".join(c if c.isalpha() else " " for c in " ".join(found)).split()
    return found


class Lattice:
    """All places where pieces of the vocabulary fit into words, found many words at a time."""

    def __init__(self, pieces: list[str]):
        self.n = len(pieces)
        self.longest = max(map(len, pieces), default=1)
        slots = 1 << _SLOT_BITS
        while slots < 4 * self.n:
            slots *= 2
        self.shift = np.uint64(64 - slots.bit_length() + 1)
        self.keys, self.ids, self.probes = np.zeros(slots, dtype=np.uint64), np.full(slots, -1), 1
        with np.errstate(over="ignore"):
            for i, piece in enumerate(pieces):
                h = np.uint64(0)
                for c in piece:
                    h = h * _FACTOR + np.uint64(ord(c))
                slot, tried = int((h * _SPREAD) >> self.shift), 1
                while self.ids[slot] >= 0:
                    slot, tried = (slot + 1) % slots, tried + 1
                self.keys[slot], self.ids[slot] = h, i
                self.probes = max(self.probes, tried)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        slot = ((hashes * _SPREAD) >> self.shift).astype(np.int64)
        found = np.where(self.keys[slot] == hashes, self.ids[slot], -1)
        for _ in range(self.probes - 1):
            slot = (slot + 1) % len(self.keys)
            found = np.where((found < 0) & (self.keys[slot] == hashes), self.ids[slot], found)
        return found

    def edges(self, words: list[str]) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
        """(start, end) to (rows, pieces), for words that are all of the same length.

        The first position is the mark of a word's start. A character that no piece
        covers alone is the piece ``n``.
        """
        text = "".join(_BEGIN + w for w in words)
        codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64).reshape(len(words), -1)
        n = codes.shape[1]
        found, hashes = {}, np.zeros_like(codes)
        for length in range(1, min(self.longest, n) + 1):
            hashes = hashes[:, : n - length + 1] * _FACTOR + codes[:, length - 1 :]
            ids = self._find(hashes)
            if length == 1:
                ids = np.where(ids < 0, self.n, ids)
            for start in range(n - length + 1):
                rows = np.flatnonzero(ids[:, start] >= 0)
                if len(rows):
                    found[start, start + length] = rows, ids[rows, start]
        return found

    def forward(self, words: list[str], chances: np.ndarray, edges: dict | None = None) -> np.ndarray:
        """alpha[word, position, language]: sum over all segmentations of the word's beginning."""
        n = len(words[0]) + 1
        alpha = np.zeros((len(words), n + 1, chances.shape[1]))
        alpha[:, 0] = 1
        for (start, end), (rows, ids) in sorted((edges or self.edges(words)).items(), key=lambda e: e[0][1]):
            alpha[rows, end] += alpha[rows, start] * chances[ids]
        return alpha

    def steps(self, word: str, backward: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(start, lengths, pieces) at each position of one word."""
        codes = np.frombuffer((_BEGIN + word).encode("utf-32-le"), dtype=np.uint32)
        n, longest = len(codes), max(1, self.longest)
        chunks = range(0, n, CHUNK)
        for a in reversed(chunks) if backward else chunks:
            size = min(CHUNK, n - a)
            piece = codes[a : a + size + longest - 1].astype(np.uint64)
            table, hashes = np.full((longest, size), -1), np.zeros_like(piece)
            for length in range(1, min(longest, len(piece)) + 1):
                hashes = hashes[: len(piece) - length + 1] * _FACTOR + piece[length - 1 :]
                ids = self._find(hashes[:size])
                table[length - 1, : len(ids)] = np.where(ids < 0, self.n, ids) if length == 1 else ids
            for i in reversed(range(size)) if backward else range(size):
                lengths = np.flatnonzero(table[:, i] >= 0)
                yield a + i, lengths + 1, table[lengths, i]

    def score(self, word: str, logs: np.ndarray) -> np.ndarray:
        """Log probability of one word of any length, from the logarithms of the chances."""
        window = np.full((max(1, self.longest) + 1, logs.shape[1]), -np.inf)
        window[0] = 0
        for _, lengths, ids in self.steps(word):
            window[lengths] = np.logaddexp(window[lengths], window[0] + logs[ids])
            window[:-1] = window[1:]
            window[-1] = -np.inf
        return window[0]

    def expected_long(self, word: str, times: float, logs: np.ndarray) -> np.ndarray:
        """``expected`` for one word of any length; ``logs`` of one language."""
        alpha = np.full(len(word) + 2, -np.inf)
        beta, counts = alpha.copy(), np.zeros(self.n + 1)
        alpha[0] = beta[-1] = 0
        for start, lengths, ids in self.steps(word):
            alpha[start + lengths] = np.logaddexp(alpha[start + lengths], alpha[start] + logs[ids])
        for start, lengths, ids in self.steps(word, backward=True):
            each = logs[ids] + beta[start + lengths]
            beta[start] = np.logaddexp.reduce(each)
            counts[ids] += times * np.exp(alpha[start] + each - alpha[-1])
        return counts

    def expected(self, words: list[str], times: np.ndarray, chances: np.ndarray) -> np.ndarray:
        """Expected uses of each piece over all segmentations of the words, all of one length; ``chances`` of one language."""
        if len(words[0]) > LONGEST:
            logs = np.log(chances[:, 0])
            return sum(self.expected_long(w, n, logs) for w, n in zip(words, times, strict=True))
        edges = self.edges(words)
        alpha = self.forward(words, chances, edges)[:, :, 0]
        beta = np.zeros_like(alpha)
        beta[:, -1] = 1
        for (start, end), (rows, ids) in sorted(edges.items(), key=lambda e: -e[0][0]):
            beta[rows, start] += beta[rows, end] * chances[ids, 0]
        counts, scale = np.zeros(self.n + 1), times / alpha[:, -1]
        for (start, end), (rows, ids) in edges.items():
            uses = alpha[rows, start] * chances[ids, 0] * beta[rows, end] * scale[rows]
            counts += np.bincount(ids, uses, self.n + 1)
        return counts


def _by_length(words: list[str]) -> Iterator[list[int]]:
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    order = np.argsort(lengths, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        for i in range(0, len(group), 20_000):
            yield group[i : i + 20_000].tolist()


@dataclass
class Model:
    languages: list[str]
    lattice: Lattice
    chances: np.ndarray  # piece by language, with a last row for unknown characters

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language."""
        out = np.empty((len(words), len(self.languages)))
        for rows in _by_length(words):
            if len(words[rows[0]]) > LONGEST:
                logs = np.log(self.chances)
                out[rows] = [self.lattice.score(words[i], logs) for i in rows]
                continue
            out[rows] = np.log(self.lattice.forward([words[i] for i in rows], self.chances)[:, -1])
        return out


class Scorer:
    """Scores texts batch by batch and remembers the words it has met."""

    def __init__(self, model: Model):
        self.model, self.known, self.table = model, {}, np.empty((0, len(model.languages)))

    def _slice(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        languages = self.model.languages
        words, ends = [], [0]
        for text in texts:
            words += words_of(text)
            ends.append(len(words))
        if not languages or not words:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        if len(self.known) > CACHED_WORDS:
            self.known, self.table = {}, self.table[:0]
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            self.table = np.concatenate([self.table, self.model.word_scores(new)])
        places = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
        bounds = np.array(ends)
        full = np.flatnonzero(np.diff(bounds))
        totals = np.add.reduceat(self.table[places], bounds[full], axis=0)
        best = totals.argmax(axis=1)
        sure = 1 / np.exp(totals - totals.max(axis=1, keepdims=True)).sum(axis=1)
        labels, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        for i, b, s in zip(full.tolist(), best.tolist(), sure.tolist(), strict=True):
            labels[i], scores[i] = languages[b], s
        return labels, scores

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        labels, scores, a, size = [], [], 0, 0
        for b, text in enumerate(texts, 1):
            size += len(text or "")
            if size >= SLICE_CHARACTERS or b == len(texts):
                more = self._slice(texts[a:b])
                labels, scores, a, size = labels + more[0], scores + more[1], b, 0
        return labels, scores


def _strings(values: list[str]) -> pd.Series:
    """Plain strings: columns of pandas' own string type reach Arrow in chunks at times, which Spark refuses."""
    return pd.Series(values, dtype=object)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sampled(labelled: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(lang, text): of every language, some ``sample`` documents with the lowest id hashes.

    Each of ``STRATA`` hash classes of a language gives the same number, so that no task
    ranks a whole language. Only hashes are shuffled; the texts are then read where they are.
    """
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text", id_hash("doc_id").alias("hash"))
    rows = rows.withColumn("stratum", F.substring("hash", 31, 2))
    ranked = rows.select("lang", "stratum", "hash").withColumn(
        "n", F.row_number().over(Window.partitionBy("lang", "stratum").orderBy("hash"))
    )
    last = ranked.where(F.col("n") <= -(-sample // STRATA)).groupBy("lang", "stratum").agg(F.max("hash").alias("last"))
    # Never more than STRATA rows for a language.
    return rows.join(F.broadcast(last), ["lang", "stratum"]).where("hash <= last").select("lang", "text")


def train(
    labelled: DataFrame, path: str = VOCABULARY, sample: int = SAMPLE, rounds: int = ROUNDS
) -> Model:
    """Piece probabilities of every language among ``labelled`` (doc_id, text, lang)."""
    spark = labelled.sparkSession
    pieces = read_vocabulary(path)
    lattice = Lattice(pieces)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts = {lang: Counter() for lang in batch["lang"].unique()}
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                counts[lang].update(words_of(text))
            for lang, words in counts.items():
                yield pd.DataFrame({"lang": _strings([lang] * len(words)), "word": _strings(list(words)), "n": list(words.values())})

    words = sampled(labelled, sample).mapInPandas(count, "lang string, word string, n long")
    words = settle(words.groupBy("lang", "word").agg(F.sum("n").alias("n")))
    languages = [r[0] for r in words.select("lang").distinct().orderBy("lang").collect()]
    chances = np.full((lattice.n + 1, len(languages)), 1 / max(1, lattice.n))
    chances[-1] = UNKNOWN
    known = spark.sparkContext.broadcast(lattice)
    for _ in range(rounds if languages else 0):
        now = spark.sparkContext.broadcast(chances)

        def expect(batches: Iterator[pd.DataFrame], now=now) -> Iterator[pd.DataFrame]:
            total = {}
            for batch in batches:
                for lang, own in batch.groupby("lang"):
                    i = languages.index(lang)
                    listed, times = own["word"].tolist(), own["n"].to_numpy(float)
                    for rows in _by_length(listed):
                        some = known.value.expected([listed[r] for r in rows], times[rows], now.value[:, [i]])
                        total[i] = total.get(i, 0) + some
            for i, counts in total.items():
                used = np.flatnonzero(counts)
                yield pd.DataFrame({"language": i, "piece": used, "uses": counts[used]})

        uses = words.mapInPandas(expect, "language int, piece int, uses double")
        counts = np.zeros((lattice.n + 1, len(languages)))
        for row in uses.groupBy("language", "piece").agg(F.sum("uses").alias("uses")).collect():
            counts[row.piece, row.language] = row.uses
        chances = counts + SMOOTHING
        chances[-1] = 0
        chances = chances / chances.sum(axis=0)
        chances[-1] = UNKNOWN
    return Model(languages, lattice, chances)


def predict(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """Column (lang, score) for a text column of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @pandas_udf("lang string, score double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for batch in texts:
            labels, scores = scorer.predict(batch.tolist())
            yield pd.DataFrame({"lang": _strings(labels), "score": scores})

    return score(F.col(text))


def identify(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), learned from the rows of ``docs`` that are not held out."""
    model = train(docs.where(~held_out()).select("doc_id", "text", "lang"), **options)
    return docs.select("doc_id", held_out().alias("held_out"), predict(docs, model).alias("p")).select(
        "doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score")
    )


def accepted(docs: DataFrame, least: float = 0.5, **options) -> DataFrame:
    """The rows of ``docs`` whose language is recognised with at least this score, with all their columns."""
    model = train(docs.where(~held_out()).select("doc_id", "text", "lang"), **options)
    judged = docs.withColumn("__p", predict(docs, model))
    return judged.where((F.col("__p.lang") != UNDETERMINED) & (F.col("__p.score") >= least)).drop("__p")
