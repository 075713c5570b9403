"""Documents whose sets of word n-grams are nearly equal, by PartEnum signatures.

Two sets with Jaccard similarity of at least g have similar sizes and a symmetric difference of at most
(1 - g) / (1 + g) times the sum of their sizes. Sizes are cut into bands so that partners lie
in the same or in adjacent bands; for a pair of bands let k be the largest possible
difference. The domain of hashes is cut into ``n1`` ranges and each of these into ``n2``.
If at most k hashes differ, some first-level range has at most k2 = k // n1 of them,
and then the sets agree on at least n2 - k2 of its parts. A signature is the content of a
set on such a choice of parts; sets that are similar enough share one.

Sets that are equal form a class, which is joined once. Signatures that several classes
share make buckets. In each bucket the class that meets most others is the centre, and only
centre pairs are compared first; what they link falls into components. Then a bucket only needs the
pairs whose sides are still in different components. The outline of a set, an odd sketch, never rejects a true pair
and sorts out nearly all others before sets are fetched. Of the rest each member first gives its nearest ``NEAREST``;
buckets where one had more are gone through again with the components that these leave, and more pairs a member,
until none has more. So groups of near copies cost a few pairs a member and not all pairs, and no link
between components is lost. ``links`` gives all links, those inside components too, by the same buckets and blocks.

Defined results: words are lower-cased in A-Z; a null text and one without words has an
empty set and is linked with nothing; fewer words than ``n`` are one gram; rows that
repeat doc_id are rows of their own; a null doc_id is never a component's name unless it
has no other; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.llm.common import connected_components, row_key, sorted_groups
from patronlens.llm.words import Words, mix, runs_hash, slices, windows_hash
from patronlens.operators.lineage import gathered, settle

GRAM = 3
SIMILAR = (90, 100)  # linked when 100 * intersection >= 90 * union
ALLOWED = 1  # parts of a first-level range that may differ (k2)
PARTS = 2  # parts of a first-level range (n2)
SPLIT = 63  # parts of a signature that very many sets have
TAGS = SPLIT + 1
SAMPLE = 2_048  # documents, about, that tell which signatures these are
HOT = 0.02  # share of them
FIRSTS = 16  # lowest signatures of a set that tell which bucket gives a pair
BLOCK = 4_096  # members of a bucket compared in one task against as many others
MARKS = 1 << 26  # bits, at most, that tell which rows' sets are fetched
NEAREST = 16  # pairs that a member of a block gives at first; each round NEAREST times as many


class Scheme:
    """Bands and signatures for one similarity."""

    def __init__(self, similar: tuple[int, int] = SIMILAR, allowed: int = ALLOWED, parts: int = PARTS):
        self.num, self.den, self.allowed, self.parts = *similar, allowed, parts
        self.lows = [1]  # smallest size of each band

    def band(self, size: int) -> int:
        while self.lows[-1] <= size:
            low = self.lows[-1]
            self.lows.append(low * self.den // self.num + 1)
        return int(np.searchsorted(self.lows, size, side="right")) - 1

    def bound(self, instance: int) -> int:
        """Largest difference of a pair with the smaller set in band ``instance - 1``."""
        low = self.lows[instance]
        smaller = low - 1
        larger = min(smaller * self.den // self.num, low * self.den // self.num)
        return (self.den - self.num) * (smaller + larger) // (self.den + self.num)

    def instances(self, size: int) -> tuple[int, int]:
        """A set is the larger one of a pair in the first, the smaller one or one of two equals in the second."""
        band = self.band(size)
        self.band(self.lows[band + 1])
        return band, band + 1

    def shape(self, instance: int) -> tuple[int, int, int]:
        """(n1, n2, k2)."""
        k = self.bound(instance)
        if k == 0:
            return 1, 1, 0
        n1 = math.ceil((k + 1) / (self.allowed + 1))
        k2 = k // n1
        return n1, max(self.parts, k2 + 1), k2

    def content(self, hashes: np.ndarray, instance: int) -> np.ndarray:
        """What a sorted set holds on each part (n1 x n2), as numbers."""
        n1, n2, _ = self.shape(instance)
        return part_sums(hashes, n1 * n2).reshape(n1, n2)

    def signatures(self, content: np.ndarray, instance: int) -> np.ndarray:
        """All signatures (n1 x choices) of a set in an instance."""
        _, n2, k2 = self.shape(instance)
        chosen = _choices(n2, n2 - k2)
        sums = (content[:, None, :] * chosen[None]).sum(axis=2, dtype=np.uint64)
        label = np.arange(sums.size, dtype=np.uint64).reshape(sums.shape) + np.uint64(instance << 32)
        return mix(sums + mix(label)).view(np.int64)

    def similar_sizes(self, a: np.ndarray | int, b: np.ndarray) -> np.ndarray:
        return self.den * np.minimum(a, b) >= self.num * np.maximum(a, b)

    def difference(self, a: np.ndarray | int, b: np.ndarray) -> np.ndarray:
        """Largest symmetric difference of linked sets of these sizes."""
        return (self.den - self.num) * (a + b) // (self.den + self.num)

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        both = len(np.intersect1d(a, b, assume_unique=True))
        return self.den * both >= self.num * (len(a) + len(b) - both)


@lru_cache
def _choices(n: int, k: int) -> np.ndarray:
    return np.array([[i in c for i in range(n)] for c in combinations(range(n), k)], dtype=np.uint64)


@lru_cache(maxsize=1_000)
def _edges(parts: int) -> np.ndarray:
    return np.array([i * 2**64 // parts for i in range(1, parts)], dtype=np.uint64)


def part_sums(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Content of a sorted set of hashes on each of ``parts`` equal ranges of the hash domain, as one number."""
    cuts = np.searchsorted(hashes, _edges(parts))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes + np.uint64(1)), dtype=np.uint64)])
    bounds = np.concatenate([[0], cuts, [len(hashes)]])
    return total[bounds[1:]] - total[bounds[:-1]]


def outline(hashes: np.ndarray) -> np.ndarray:
    """Odd sketch of a set, in 64-bit words: a bit for each of at least as many residues as it has hashes, set where their number is odd.

    Each hash that only one of two sets has turns one bit, so two sets differ at least as often as their
    outlines do, and these never reject a true pair.
    """
    bits = max(64, 1 << (len(hashes) - 1).bit_length())
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def folded(outlines: list[bytes]) -> np.ndarray:
    """Outlines as rows of a table, brought to the width of the shortest one."""
    words = [np.frombuffer(o, np.uint64) for o in outlines]
    width = min(map(len, words))
    return np.array([w if len(w) == width else np.bitwise_xor.reduce(w.reshape(-1, width)) for w in words], dtype=np.uint64)


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits that differ in rows of outlines."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def gram_sets(texts: pa.Array, n: int = GRAM) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct hashes of its word n-grams)."""
    for a, b in slices(texts):
        words = Words(texts.slice(a, b - a), lower=True)
        grams = windows_hash(words.hashes, n)
        for i in range(b - a):
            own = words.of(i)
            count = own.stop - own.start
            if count >= n:
                yield a + i, np.unique(grams[own.start : own.stop - n + 1])
            elif count:
                yield a + i, runs_hash(words.hashes[own], np.array([0]), np.array([count]))
            else:
                yield a + i, np.empty(0, dtype=np.uint64)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def class_of(hashes: np.ndarray) -> int:
    """64-bit name of a set."""
    return int(_signed(mix(np.array([mix(hashes).sum(dtype=np.uint64) + np.uint64(len(hashes))], dtype=np.uint64)))[0])


def classes(docs: DataFrame, n: int = GRAM) -> DataFrame:
    """(k1, k2, doc_id, n_shingles, class, outline) for every row; class and outline are null for empty sets."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, names, outlines = [], [], []
            for _, hashes in gram_sets(batch.column("text"), n):
                sizes.append(len(hashes))
                names.append(class_of(hashes) if len(hashes) else None)
                outlines.append(outline(hashes).tobytes() if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("k1", "k2", "doc_id")), pa.array(sizes, pa.int64()), pa.array(names, pa.int64()), pa.array(outlines, pa.binary())],
                ["k1", "k2", "doc_id", "n_shingles", "class", "outline"],
            )

    keyed = docs.select(*row_key("doc_id", "text"), "doc_id", "text")
    return keyed.mapInArrow(name, "k1 long, k2 long, doc_id long, n_shingles long, class long, outline binary")


def signed(docs: DataFrame, scheme: Scheme, n: int, hot: np.ndarray) -> DataFrame:
    """(signature, tag, class): all signatures of all sets, each class once a task.

    ``tag`` is the instance and, for signatures in ``hot``, the part that the class belongs to.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        found: dict[int, list[tuple[int, np.ndarray]]] = {}
        waiting = 0
        for batch in batches:
            for _, hashes in gram_sets(batch.column("text"), n):
                if not len(hashes) or (own := class_of(hashes)) in seen:
                    continue
                seen.add(own)
                found[own] = [(i, scheme.signatures(scheme.content(hashes, i), i).ravel()) for i in scheme.instances(len(hashes))]
                waiting += sum(len(s) for _, s in found[own])
                if waiting > 200_000:
                    yield _signature_rows(found, hot)
                    found, waiting = {}, 0
        if found:
            yield _signature_rows(found, hot)

    return docs.select("text").mapInArrow(sign, "signature long, tag int, class long")


def _signature_rows(found: dict[int, list[tuple[int, np.ndarray]]], hot: np.ndarray) -> pa.RecordBatch:
    signature = np.concatenate([s for each in found.values() for _, s in each])
    instance = np.concatenate([np.full(len(s), i, dtype=np.int32) for each in found.values() for i, s in each])
    name = np.repeat(np.fromiter(found, dtype=np.int64, count=len(found)), [sum(len(s) for _, s in each) for each in found.values()])
    part = np.where(np.isin(signature, hot), 1 + name % SPLIT, 0)
    return pa.RecordBatch.from_arrays(
        [pa.array(signature), pa.array((instance * TAGS + part).astype(np.int32)), pa.array(name)], ["signature", "tag", "class"]
    )


def hot_signatures(docs: DataFrame, scheme: Scheme, n: int = GRAM) -> np.ndarray:
    """Signatures that several classes and ``HOT`` of some ``SAMPLE`` documents have.

    They only decide which signatures are split over tasks, not what is found. A document
    has as many signatures on average as its sets differ, so they are few: at most that number over ``HOT``.
    """
    every = max(1, docs.count() // SAMPLE)
    sample = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(every)) == 0)
    counted = (
        signed(sample, scheme, n, np.empty(0, dtype=np.int64)).groupBy("signature")
        .agg(F.count_distinct("class").alias("classes")).where(F.col("classes") >= max(2, HOT * SAMPLE))
    )
    return np.array([r.signature for r in counted.select("signature").collect()], dtype=np.int64)


def buckets(docs: DataFrame, scheme: Scheme, n: int = GRAM) -> DataFrame:
    """(signature, instance, class): memberships in signatures that several classes share.

    All signatures are shuffled and sorted once; lonely ones go while they stream by, with one
    row held. Signatures known to be shared by very many are split by class, as none of their rows is lonely.
    """
    hot = hot_signatures(docs, scheme, n)

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, dtype=kind) for kind in (np.int64, np.int32, np.int64, bool)]
        for batch in batches:
            signature, tag, name = (batch.column(c).to_numpy() for c in ("signature", "tag", "class"))
            rows = [np.concatenate(pair) for pair in zip(held, (signature, tag, name, tag % TAGS > 0))]
            if not len(rows[0]):
                continue
            same = rows[0][1:] == rows[0][:-1]
            new = np.append(True, ~same | (rows[2][1:] != rows[2][:-1]))
            signature, tag, name, sure = (c[new] for c in rows)
            same = signature[1:] == signature[:-1]
            sure[1:] |= same
            sure[:-1] |= same
            held = [c[-1:] for c in (signature, tag, name, sure)]
            yield _members(signature[:-1], tag[:-1], name[:-1], sure[:-1])
        yield _members(*held)

    rows = signed(docs, scheme, n, hot).repartition(F.col("signature"), F.col("tag") % TAGS)
    return settle(
        rows.sortWithinPartitions("signature", "class").mapInArrow(shared, "signature long, instance int, class long")
    )


def _members(signature: np.ndarray, tag: np.ndarray, name: np.ndarray, sure: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(signature[sure]), pa.array(tag[sure] // TAGS), pa.array(name[sure])], ["signature", "instance", "class"]
    )


def shapes(named: DataFrame) -> DataFrame:
    """(class, size, outline) of every class."""
    rows = named.where("class IS NOT NULL").select("class", F.col("n_shingles").alias("size"), "outline")
    return settle(rows.dropDuplicates(["class"]))


def plausible(pairs: DataFrame, shape: DataFrame, scheme: Scheme) -> DataFrame:
    """The pairs (a, b) whose sizes and outlines allow a link."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).to_numpy() for c in ("size_a", "size_b"))
            good = scheme.similar_sizes(a, b)
            most = scheme.difference(a, b)
            left, right = batch.column("outline_a"), batch.column("outline_b")
            for i in np.flatnonzero(good).tolist():
                good[i] = differing(*folded([left[i].as_py(), right[i].as_py()])) <= most[i]
            yield batch.select(["a", "b"]).filter(pa.array(good))

    side = lambda c: shape.select(F.col("class").alias(c), F.col("size").alias(f"size_{c}"), F.col("outline").alias(f"outline_{c}"))
    return settle(pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").mapInArrow(check, "a long, b long"))


def marks(keys: DataFrame) -> np.ndarray:
    """A bit for each residue of the column k1 of ``keys``, in bytes: a key without its bit is not among them.

    Only these bits reach the driver, some 8 bytes a key and at most ``MARKS`` bits; with more keys more pass.
    """
    bits = min(MARKS, max(1 << 15, 1 << (64 * keys.count()).bit_length()))
    place = keys.select((F.pmod("k1", F.lit(bits)) + 1).alias("place"))
    pieces = (
        place.select(F.bitmap_bucket_number("place").alias("piece"), F.bitmap_bit_position("place").alias("bit")).repartition("piece")
        .groupBy("piece").agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    found = np.zeros((bits >> 15, 1 << 12), dtype=np.uint8)
    for row in pieces.collect():
        found[row.piece - 1] = np.frombuffer(row.bits, np.uint8)
    return found.ravel()


def sets_of(docs: DataFrame, named: DataFrame, pairs: DataFrame, n: int = GRAM) -> DataFrame:
    """(class, hashes): the sets of the classes in ``pairs``, and of few others. Texts stay where they are read."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    one = named.where("class IS NOT NULL").groupBy("class").agg(F.min("k1").alias("k1")).join(wanted, "class", "left_semi")
    marked = marks(settle(gathered(one)))
    last = len(marked) * 8 - 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column("k1").to_numpy() & last
            texts = batch.column("text").filter(pa.array((marked[place >> 3] >> (place & 7) & 1).astype(bool)))
            names, packed = [], []
            for i, hashes in gram_sets(texts, n):
                if len(hashes):
                    names.append(class_of(hashes))
                    packed.append(hashes.tobytes())
                if len(packed) == 1_000 or i == len(texts) - 1:
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(packed, pa.binary())], ["class", "hashes"])
                    names, packed = [], []

    # Rows of a class hold the same set; one of them is enough.
    return settle(docs.select(row_key("doc_id", "text")[0], "text").mapInArrow(pack, "class long, hashes binary").dropDuplicates(["class"]))


def verified(pairs: DataFrame, docs: DataFrame, named: DataFrame, scheme: Scheme, n: int) -> DataFrame:
    """The pairs (a, b) of classes whose sets are similar enough."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("left"), batch.column("right")
            good = [
                scheme.linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64))
                for x, y in zip(left, right, strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    sets = sets_of(docs, named, pairs, n)
    # Pairs grow with the corpus: joined by sort-merge at every size, never broadcast.
    both = (
        pairs.hint("merge").join(sets.select(F.col("class").alias("a"), F.col("hashes").alias("left")), "a")
        .join(sets.select(F.col("class").alias("b"), F.col("hashes").alias("right")), "b")
        .select("a", "b", "left", "right")
    )
    return settle(both.mapInArrow(check, "a long, b long"))


def star_pairs(members: DataFrame) -> DataFrame:
    """(a, b): each bucket's centre with its other members. The centre is in most buckets."""
    degree = members.groupBy("class").agg(F.count(F.lit(1)).alias("degree"))
    centres = (
        members.join(degree, "class").groupBy("signature")
        .agg(F.max(F.struct("degree", "class")).alias("centre")).select("signature", F.col("centre.class").alias("centre"))
    )
    pairs = members.join(settle(gathered(centres)), "signature").where("class <> centre")
    return pairs.select(F.least("class", "centre").alias("a"), F.greatest("class", "centre").alias("b")).distinct()


def remaining_pairs(
    members: DataFrame, shape: DataFrame, parts: DataFrame, scheme: Scheme, most: int = BLOCK
) -> DataFrame:
    """(a, b, cut): pairs that share a bucket, lie in different components, and whose outlines allow a link.

    In each bucket the largest component is at home; the other members visit it and one
    another. Both are dealt into blocks, so that no task holds more than two blocks. Sets that
    share a signature among the lowest of both are only given by the bucket of the lowest one they share there;
    the few others by each of their buckets. A member gives its nearest ``most`` of a block; where it had more,
    ``cut`` is the signature of the bucket, else null.
    """
    labelled = members.join(parts.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class")
    )
    sizes = settle(gathered(labelled.groupBy("signature", "component").agg(F.count(F.lit(1)).alias("size"))))
    open_ = settle(gathered(
        sizes.groupBy("signature").agg(
            F.max(F.struct("size", "component")).alias("home"), F.sum("size").alias("members"), F.count(F.lit(1)).alias("components")
        ).where("components > 1 AND members > 2")  # the one pair of a bucket of two is a star pair
        .select(
            "signature", F.col("home.component").alias("home"),
            F.ceil(F.col("members") / BLOCK).cast("int").alias("rows"),
            F.ceil((F.col("members") - F.col("home.size")) / BLOCK).cast("int").alias("columns"),
        ))
    )
    member = settle(
        labelled.join(open_, "signature")
        .withColumn("visitor", F.col("component") != F.col("home"))
        .withColumn("place", F.xxhash64("class"))
    )
    at_home = member.withColumn("block", F.pmod("place", F.col("rows")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("columns") - 1))
    ).withColumn("visits", F.lit(False))
    visiting = member.where("visitor").withColumn("other", F.pmod("place", F.col("columns")).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("rows") - 1))
    ).withColumn("visits", F.lit(True))
    fields = ["signature", "block", "other", "class", "component", "visits"]
    firsts = settle(
        member.groupBy("class").agg(F.slice(F.sort_array(F.collect_list("signature")), 1, FIRSTS).alias("firsts"))
    )
    dealt = at_home.select(fields).unionByName(visiting.select(fields)).join(shape.join(firsts, "class"), "class")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["signature", "block", "other"]):
            pairs = _candidates(group, scheme, most)
            if pairs.num_rows:
                yield pairs

    tasks = dealt.repartition("signature", "block", "other").sortWithinPartitions("signature", "block", "other")
    return tasks.mapInArrow(compare, "a long, b long, cut long").distinct()


def _candidates(group: pa.Table, scheme: Scheme, most: int) -> pa.RecordBatch:
    """Pairs of a visitor and one at home whose components differ and whose outlines allow a link: the nearest ``most`` of each visitor."""
    visits = group.column("visits").to_numpy()
    size, component, name = (group.column(c).to_numpy() for c in ("size", "component", "class"))
    home, out = np.flatnonzero(~visits), []
    if len(home) and visits.any():
        table = folded(group.column("outline").to_pylist())
        at_home, home_size, home_component = table[home], size[home], component[home]
        firsts, bucket = _padded(group.column("firsts").to_pylist()), group.column("signature")[0].as_py()
        for v in np.flatnonzero(visits).tolist():
            fits = np.flatnonzero((home_component != component[v]) & scheme.similar_sizes(size[v], home_size))
            far = differing(at_home[fits], table[v])
            near = far <= scheme.difference(size[v], home_size[fits])
            fits, far = home[fits[near]], far[near]
            shared = np.isin(firsts[fits], firsts[v])
            lowest = firsts[fits, shared.argmax(axis=1)] if len(fits) else fits
            own = ~shared.any(axis=1) | (lowest == bucket)
            other, far = name[fits[own]], far[own]
            more = len(other) > most
            if more:
                other = other[np.lexsort((other, far))[:most]]
            if len(other):
                out.append((np.minimum(other, name[v]), np.maximum(other, name[v]), np.full(len(other), more)))
    a, b, cut = (np.concatenate([o[i] for o in out] or [np.empty(0, kind)]) for i, kind in enumerate((np.int64, np.int64, bool)))
    cut = pa.array(np.full(len(a), bucket if out else 0), pa.int64(), mask=~cut)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), cut], ["a", "b", "cut"])


def _padded(lists: list[list[int]]) -> np.ndarray:
    """Rising lists as rows of a table, their last entries repeated."""
    width = max(map(len, lists))
    return np.array([x + x[-1:] * (width - len(x)) for x in lists], dtype=np.int64)


def components(docs: DataFrame, similar: tuple[int, int] = SIMILAR, n: int = GRAM) -> DataFrame:
    """(k1, k2, doc_id, n_shingles, component_id) for every row of ``docs``; k1, k2 is its ``row_key``."""
    scheme = Scheme(similar)
    named = settle(classes(docs, n))
    members = buckets(docs, scheme, n)
    shape = shapes(named)
    tested = settle(gathered(star_pairs(members)))
    links = verified(plausible(tested, shape, scheme), docs, named, scheme, n)
    parts, most = connected_components(links), NEAREST
    while True:
        given = settle(remaining_pairs(members, shape, parts, scheme, most))
        left = settle(gathered(given.select("a", "b").distinct().join(tested, ["a", "b"], "left_anti")))
        if not left.isEmpty():
            more = verified(left, docs, named, scheme, n)
            if not more.isEmpty():
                links = links.unionByName(more)
                parts = connected_components(links)
        again = given.where("cut IS NOT NULL").select(F.col("cut").alias("signature")).distinct()
        if again.isEmpty():
            break
        # At BLOCK pairs a member no block is cut any more.
        tested, members, most = tested.unionByName(left), settle(gathered(members.join(again, "signature", "left_semi"))), most * NEAREST
    ids = settle(gathered(named.where("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("own"))))
    labelled = ids.join(parts.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class")
    )
    lowest = settle(gathered(labelled.groupBy("component").agg(F.min("own").alias("component_id"))))
    by_class = settle(gathered(labelled.join(lowest, "component").select("class", "component_id")))
    return named.join(by_class, "class", "left").select(
        "k1", "k2", "doc_id", "n_shingles",
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def links(docs: DataFrame, similar: tuple[int, int] = SIMILAR, n: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """All links: pairs (a, b) of linked classes, a < b, and membership (k1, k2, doc_id, class) of every row.

    Rows of one class are linked by their equal sets and make no pair; the class is null for
    empty sets, which are linked with nothing. Unlike ``components``, all pairs of a bucket are
    verified, those inside a component too, which is quadratic in a group of near copies.
    """
    scheme = Scheme(similar)
    named = settle(classes(docs, n))
    members = buckets(docs, scheme, n)
    shape = shapes(named)
    tested = settle(gathered(star_pairs(members)))
    # Without components every class is one of its own, so no pair of a bucket is left out.
    apart = docs.sparkSession.createDataFrame([], "node long, component long")
    more = remaining_pairs(members, shape, apart, scheme).select("a", "b").distinct().join(tested, ["a", "b"], "left_anti")
    pairs = verified(settle(plausible(tested, shape, scheme).unionByName(more)), docs, named, scheme, n)
    return pairs, named.select("k1", "k2", "doc_id", "class")


def representatives(docs: DataFrame, similar: tuple[int, int] = SIMILAR, n: int = GRAM) -> DataFrame:
    """One row of ``docs`` for each component, that with the smallest doc_id; empty sets all stay."""
    found = components(docs, similar, n)
    stay = found.where("doc_id <=> component_id OR n_shingles = 0").select(
        F.col("k1").alias("__k1"), F.col("k2").alias("__k2")
    ).distinct()
    k1, k2 = row_key("doc_id", "text")
    keyed = docs.select("*", k1.alias("__k1"), k2.alias("__k2"))
    return keyed.join(stay, ["__k1", "__k2"], "left_semi").dropDuplicates(["__k1", "__k2"]).drop("__k1", "__k2")
