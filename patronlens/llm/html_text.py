"""Main text of web pages: structure first, repeated runs of the host for the rest.

A tolerant reader cuts a page into blocks. Menus, headers, footers, sidebars, notices, adverts,
forms and comments are told by their elements, classes and roles. All other blocks are
decided by the host: the token streams of its pages outside articles are concatenated and a
suffix array sorts them. Boilerplate are runs of whole blocks, ``RUN`` tokens or more, whose
windows of ``RUN`` tokens are all on ``needed`` distinct texts of the host. Anything less stays:
phrases, parts of blocks, and passages that a few pages share.

What lies inside an article or inside ``main`` is its main text. Runs of whole blocks there go if all
their windows are such boilerplate of the host outside articles, and lie inside the articles of
``needed`` distinct texts too: a notice or menu that is set into the articles as well. Passages that
articles share among themselves stay, and so does a lead that other pages show as a teaser.

A host is dealt into shards of some ``SHARD`` texts, each with a suffix array of its own. All
copies of a text are in one shard, so the counts of the shards add up, by the digests of the
windows, and the result does not depend on the shards.

Defined results: a null html is empty and gives an empty text; a null or broken url counts
as a host of its own; pages whose whole text is equal, whatever their ids, urls and markup, are
one text and don't make each other boilerplate; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.llm.common import sorted_groups
from patronlens.llm.words import Words, windows_hash
from patronlens.operators.lineage import settle

RUN = 10  # tokens
FEWEST, MAJORITY, SHARE = 3, 5, 10  # see ``needed``
SHARD = 128  # texts of a host that one suffix array holds, on average

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([a-z-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)|\b(hidden)\b")
_RAW = {t: re.compile(rf"</{t}\s*>?", re.IGNORECASE) for t in ("script", "style", "noscript", "template", "iframe", "textarea", "title", "svg")}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav ol optgroup option p "
    "pre section select summary table tbody td textarea tfoot th thead tr ul".split()
)
_HEAD_TAGS = frozenset("base link meta noscript script style template title".split())
_CHROME_TAGS = frozenset("nav footer aside form button select head dialog menu object".split())
_SECTIONS = frozenset("article main nav header footer aside form section body".split())
_NAMED_TAGS = frozenset("div section ul ol dl table p span figure details".split())
_CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog".split())
_CHROME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices popup modal newsletter subscribe subscription sidebar nav navbar navigation menu breadcrumb breadcrumbs "
    "footer masthead toolbar share sharing social related login signup pagination pager copyright".split()
)
_COMMENT_WORDS = frozenset("comment comments disqus replies respond".split())
_NOT_CHROME = frozenset("no with without has main content article post entry".split())


@dataclass
class Page:
    """Blocks of a page, in order: inside the article, inside ``main``, chrome, or none of these."""

    blocks: list[tuple[str, int]] = field(default_factory=list)

    ARTICLE, MAIN, CHROME, OPEN = 3, 2, 1, 0

    def content(self) -> int | None:
        """The lowest kind of block that is main text, or None where structure doesn't tell."""
        return min((k for _, k in self.blocks if k >= Page.MAIN), default=None)

    def main_text(self) -> str:
        return " ".join(text for text, k in self.blocks if k >= Page.MAIN)

    def outside(self) -> list[tuple[str, int]]:
        return [b for b in self.blocks if b[1] < Page.MAIN]


def _attributes(text: str) -> dict[str, str]:
    return {m[1] or m[3]: (m[2] or "").strip("\"'").lower() for m in _ATTRIBUTE.finditer(text.lower())}


def _is_chrome(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    if tag in _CHROME_TAGS or tag == "header" and not in_article:
        return True
    if not attributes:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or attributes.get("role") in _CHROME_ROLES:
        return True
    if tag not in _NAMED_TAGS and tag != "article":
        return False
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = re.split(r"[^a-z]+", name)
        if _COMMENT_WORDS.intersection(words):
            return True
        if tag != "article" and not _NOT_CHROME.intersection(words):
            if words[0] in _CHROME_WORDS or words[-1] in _CHROME_WORDS or "header" in words and not in_article:
                return True
    return False


def _content_kind(tag: str, attributes: dict[str, str]) -> int:
    if tag == "article" or attributes.get("itemprop") == "articlebody":
        return Page.ARTICLE
    return Page.MAIN if tag == "main" or attributes.get("role") == "main" else Page.OPEN


def parse(source: str | None) -> Page:
    """Cut a page into blocks. Never fails: what is not markup is text."""
    source = source or ""
    page, open_, data, at = Page(), [("", Page.OPEN)], [], 0

    def close_block() -> None:
        if data:
            if text := " ".join(entities.unescape("".join(data)).split()):
                page.blocks.append((text, open_[-1][1]))
            data.clear()

    while (m := _MARKUP.search(source, at)) is not None:
        if m.start() > at:
            data.append(source[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                data.append(m[0][9:].removesuffix("]]>"))
            continue
        if tag in _BLOCK:
            close_block()
        if m[1] or m[4]:
            _pop(open_, tag, close_block)
            continue
        if tag in _RAW:
            if not (m[3] or m[6] or "").endswith("/"):
                end = _RAW[tag].search(source, at)
                at = end.end() if end else len(source)
            continue
        if tag in _VOID:
            continue
        if tag == "body":
            del open_[1:]
        elif open_[-1][0] == "head" and tag not in _HEAD_TAGS:
            open_.pop()
        kind = open_[-1][1]
        attributes = _attributes(m[3] or m[6]) if (m[3] or m[6]) else {}
        if kind != Page.CHROME:
            own = Page.CHROME if _is_chrome(tag, attributes, kind == Page.ARTICLE) else max(kind, _content_kind(tag, attributes))
            if own != kind:
                close_block()
            kind = own
        open_.append((tag, kind))
    data.append(source[at:])
    close_block()
    return page


def _pop(open_: list[tuple[str, int]], tag: str, close_block) -> None:
    """Close the innermost open element of this name; others than sections don't close across one."""
    for i in range(len(open_) - 1, 0, -1):
        if open_[i][0] == tag:
            if any(kind != open_[i - 1][1] for _, kind in open_[i:]):
                close_block()
            del open_[i:]
            return
        if open_[i][0] in _SECTIONS and tag not in _SECTIONS:
            return


def _name(text: str) -> int:
    """64-bit name of a text."""
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _streams(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, whole, stream, told, tokens, chrome, sizes, words): the blocks to decide on, and those outside articles.

    ``whole`` names the text of the page with all its blocks, ``stream`` that outside the main text, and
    ``tokens`` are hashes of the words there. ``words`` (the words), ``sizes`` (words of each block) and
    ``chrome`` (whether a block is chrome) are of the blocks inside the article where there is one
    (``told``), else of all.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told, streams, wholes, chrome, sizes, kept = [], [], [], [], [], []
            for source in batch.column("html"):
                page = parse(source.as_py())
                told.append(page.content() is not None)
                outside = page.outside()
                candidates = [b for b in page.blocks if b[1] >= Page.MAIN] if told[-1] else outside
                streams.append(" ".join(text for text, _ in outside))
                wholes.append(_name(" ".join(text for text, _ in page.blocks)))
                kept.append(" ".join(text for text, _ in candidates))
                sizes.append([len(text.split()) for text, _ in candidates])
                chrome.append([k == Page.CHROME for _, k in candidates])
            words = Words(pa.array(streams, pa.large_string()))
            hashes = [words.hashes[words.of(i)].view(np.int64) for i in range(len(streams))]
            ends = np.concatenate([[0], np.cumsum([len(h) for h in hashes])])
            tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*hashes, np.empty(0, np.int64)])))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("page_id", "url", "host")), pa.array(wholes, pa.int64()),
                 pa.array([_name(t) for t in streams], pa.int64()), pa.array(told, pa.bool_()), tokens,
                 pa.array(chrome, pa.list_(pa.bool_())), pa.array(sizes, pa.list_(pa.int32())), pa.array(kept, pa.string())],
                ["page_id", "url", "host", "whole", "stream", "told", "tokens", "chrome", "sizes", "words"],
            )

    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))
    return settle(pages.select("page_id", "url", host.alias("host"), "html").mapInArrow(
        read, "page_id long, url string, host string, whole long, stream long, told boolean, tokens array<long>, "
        "chrome array<boolean>, sizes array<int>, words string"
    ))


def suffix_ranks(tokens: np.ndarray, length: int) -> np.ndarray:
    """Rank of every suffix by its first ``length`` tokens, by prefix doubling; equal ranks share them all."""
    _, rank = np.unique(tokens, return_inverse=True)
    have, step = 1, rank
    while have < length:
        more = min(have, length - have)
        ahead = np.full(len(rank), -1)
        ahead[: max(0, len(rank) - more)] = step[more:]
        # The first ``have`` tokens, then the ``have`` tokens that start ``more`` later: together have + more.
        _, rank = np.unique(rank * (len(rank) + 1) + ahead + 1, return_inverse=True)
        have, step = have + more, rank
    return rank


def holders(pages: list[np.ndarray], owners: list[int], length: int = RUN) -> list[np.ndarray]:
    """For each page and each place with ``length`` tokens left: how many distinct owners have these tokens somewhere."""
    sizes = [len(p) for p in pages]
    n = sum(sizes)
    # A separator that occurs once ends each page, so no run goes on into the next one.
    joined = np.concatenate([np.unique(np.concatenate([*pages, np.empty(0, np.int64)]), return_inverse=True)[1], np.empty(0, np.int64)])
    stream, owner, at, start = np.empty(n + len(pages), np.int64), np.empty(n + len(pages), np.int64), 0, 0
    for i, size in enumerate(sizes):
        stream[at : at + size], owner[at : at + size + 1] = joined[start : start + size], owners[i]
        stream[at + size] = n + i
        at, start = at + size + 1, start + size
    if not len(stream):
        return []
    rank = suffix_ranks(stream, length)
    order = np.lexsort((owner, rank))  # the suffix array, as far as ``length`` tokens
    sorted_rank, sorted_owner = rank[order], owner[order]
    new_rank = np.concatenate([[True], sorted_rank[1:] != sorted_rank[:-1]])
    new_owner = new_rank | np.concatenate([[True], sorted_owner[1:] != sorted_owner[:-1]])
    first = np.flatnonzero(new_rank)
    count = np.empty(len(order), np.int64)
    count[order] = np.repeat(np.add.reduceat(new_owner.astype(np.int64), first), np.diff(np.concatenate([first, [len(order)]])))
    found, at = [], 0
    for size in sizes:
        found.append(count[at : at + max(0, size - length + 1)])
        at += size + 1
    return found


def repeated_places(pages: list[np.ndarray], length: int = RUN) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each page, the places whose next ``length`` tokens another page has too, and the other places."""
    counts = holders(pages, list(range(len(pages))), length)
    return [np.flatnonzero(c > 1) for c in counts], [np.flatnonzero(c < 2) for c in counts]


def needed(texts: Column) -> Column:
    """On how many of the distinct texts of a host boilerplate is: a tenth; half up to ``MAJORITY``; ``FEWEST`` at least."""
    return F.greatest(F.lit(FEWEST), F.least(F.lit(MAJORITY), F.ceil(texts / 2)), F.ceil(texts / SHARE)).cast("long")


def _covered(streams: DataFrame, run: int) -> tuple[DataFrame, DataFrame]:
    """Windows outside articles that are on enough texts of the host.

    (host, whole, stream, places), where they begin, for undecided pages; and (host, digest, needed), the windows.
    """
    texts = streams.groupBy("host", "whole").agg(F.count(F.lit(1)).alias("copies")).groupBy("host").agg(F.count(F.lit(1)).alias("texts"))
    counts = settle(texts.select("host", F.ceil(F.col("texts") / SHARD).cast("int").alias("shards"), needed(F.col("texts")).alias("needed")))
    pages = streams.where(F.size("tokens") >= run).groupBy("host", "whole", "stream").agg(
        F.first("tokens").alias("tokens"), F.max(~F.col("told")).alias("undecided")
    )
    dealt = pages.join(counts.hint("merge"), "host").withColumn("shard", F.pmod("whole", "shards").cast("int"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["host_key", "shard"]):
            for _, part in sorted(_by_host(group).items()):
                yield from _shard_rows(part, run)

    fields = ["host_key", "host", "shard", "shards", "needed", "whole", "stream", "undecided", "tokens"]
    tasks = dealt.withColumn("host_key", F.xxhash64("host")).select(fields)
    tasks = tasks.repartition("host_key", "shard").sortWithinPartitions("host_key", "shard")
    found = settle(tasks.mapInArrow(search, "host string, needed long, whole long, stream long, place int, digest long, holders long"))
    local = found.where("digest IS NULL").select("host", "whole", "stream", "place")
    # What grows with the pages is joined by sort-merge and never broadcast, however well its file is packed.
    common = settle(
        found.where("holders IS NOT NULL").groupBy("host", "digest").agg(F.sum("holders").alias("holders"), F.max("needed").alias("needed"))
        .where("holders >= needed").select("host", "digest", "needed")
    )
    between = found.where("digest IS NOT NULL AND place IS NOT NULL")
    other = between.join(common.hint("merge"), ["host", "digest"]).select("host", "whole", "stream", "place")
    return local.unionByName(other).groupBy("host", "whole", "stream").agg(F.collect_set("place").alias("places")), common


def _by_window(windows: DataFrame) -> DataFrame:
    """One row a host with its boilerplate: at most as many windows as ten of its texts have on average, for a large host."""
    return settle(windows.groupBy("host").agg(F.collect_set("digest").alias("digests")))


def _set_in(streams: DataFrame, common: DataFrame, run: int) -> DataFrame:
    """(host, digests): boilerplate windows of the host that enough distinct texts have inside their article too."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, wholes, digests = [], [], []
            for i, (each, found) in enumerate(_matches(batch.column("words"), batch.column("digests"), run)):
                seen = np.unique(each[found])
                hosts += [batch.column("host")[i].as_py()] * len(seen)
                wholes += [batch.column("whole")[i].as_py()] * len(seen)
                digests.append(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(wholes, pa.int64()), pa.array(np.concatenate([*digests, np.empty(0, np.int64)]))],
                ["host", "whole", "digest"],
            )

    articles = streams.where("told AND host <> ''").select("host", "whole", "words").join(_by_window(common), "host")
    found = articles.mapInArrow(match, "host string, whole long, digest long").distinct().groupBy("host", "digest").agg(F.count(F.lit(1)).alias("texts"))
    return _by_window(found.join(common, ["host", "digest"]).where("texts >= needed"))


def _matches(words: pa.Array, digests: pa.Array, run: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text the digests of its windows, and the places of those that are among the ``digests`` beside it."""
    read = Words(pa.compute.if_else(digests.is_valid(), words, pa.scalar(None, pa.string())).cast(pa.large_string()))
    for i in range(len(words)):
        each = np.empty(0, np.int64)
        if digests[i].is_valid and len(hashes := read.hashes[read.of(i)]) >= run:
            each = windows_hash(hashes, run).view(np.int64)
        yield each, np.flatnonzero(np.isin(each, np.asarray(digests[i].values))) if len(each) else np.empty(0, np.int64)


def _by_host(group: pa.Table) -> dict[str, pa.Table]:
    """Hosts whose keys are equal by chance are kept apart."""
    hosts = group.column("host").to_pylist()
    return {h: group.filter(pa.array([x == h for x in hosts])) for h in set(hosts)}


def _shard_rows(part: pa.Table, run: int) -> Iterator[pa.RecordBatch]:
    """A host's only shard gives the windows that are on enough texts, and their places in undecided pages.

    One of several gives the number of its texts for each window, and all places of undecided pages with their digests.
    """
    host, several, enough = (part.column(c)[0].as_py() for c in ("host", "shards", "needed"))
    whole, stream = (part.column(c).to_numpy() for c in ("whole", "stream"))
    undecided = part.column("undecided").to_pylist()
    pages = [np.asarray(t.values) for t in part.column("tokens")]
    counts = holders(pages, np.unique(whole, return_inverse=True)[1].tolist(), run)
    digests = [windows_hash(p.view(np.uint64), run).view(np.int64) for p in pages]

    def rows(size: int, **columns: np.ndarray) -> pa.RecordBatch:
        columns |= {"host": [host] * size, "needed": np.full(size, enough)}
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in _FOUND], schema=_FOUND
        )

    for i in np.flatnonzero(undecided).tolist():
        places = np.arange(len(counts[i])) if several > 1 else np.flatnonzero(counts[i] >= enough)
        shown = {"digest": digests[i][places]} if several > 1 else {}
        yield rows(len(places), whole=np.full(len(places), whole[i]), stream=np.full(len(places), stream[i]), place=places, **shown)
    each, at = np.unique(np.concatenate(digests), return_index=True)
    held = np.concatenate(counts)[at]
    shown = np.flatnonzero(held >= (1 if several > 1 else enough))
    yield rows(len(shown), digest=each[shown], holders=held[shown])


_FOUND = pa.schema([
    ("host", pa.string()), ("needed", pa.int64()), ("whole", pa.int64()), ("stream", pa.int64()), ("place", pa.int32()),
    ("digest", pa.int64()), ("holders", pa.int64()),
])


def unique_runs(words: str, chrome: list[bool], sizes: list[int], places: list[int] | None, run: int = RUN) -> str:
    """The words of the blocks that are neither chrome nor in a run of whole blocks that windows at ``places`` cover."""
    split = words.split()
    covered = np.zeros(len(split), bool)
    for p in places or ():
        covered[p : p + run] = True
    ends = np.cumsum(sizes, dtype=np.int64).tolist()
    whole = [bool(covered[e - n : e].all()) for n, e in zip(sizes, ends, strict=True)]
    out: list[str] = []
    for i, (n, e) in enumerate(zip(sizes, ends, strict=True)):
        if i == 0 or whole[i] != whole[i - 1]:
            together = i
            while together < len(sizes) and whole[together] == whole[i]:
                together += 1
            long = ends[together - 1] - (e - n) >= run
        if not chrome[i] and not (whole[i] and long):
            out += split[e - n : e]
    return " ".join(out)


def extract(pages: DataFrame, run: int = RUN) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html)."""
    streams = _streams(pages)
    covered, common = _covered(streams.where("host <> ''"), run)
    covered, set_in = settle(covered), _set_in(streams, common, run)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("words", "chrome", "sizes", "places")]
            inside = _matches(batch.column("words"), batch.column("digests"), run)
            texts = [
                unique_runs(words, chrome, sizes, places if places is not None else found.tolist(), run)
                for words, chrome, sizes, places, (_, found) in zip(*columns, inside, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    key = ["host", "whole", "stream"]
    fields = ["page_id", "url", "words", "chrome", "sizes", "places", "digests"]
    none = F.lit(None)
    told = streams.where("told").join(set_in, "host", "left").withColumn("places", none.cast("array<int>")).select(fields)
    untold = streams.where("NOT told").join(covered.hint("merge"), key, "left").withColumn("digests", none.cast("array<long>")).select(fields)
    decided = told.unionByName(untold).mapInArrow(decide, "page_id long, url string, text string")
    return decided.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
