"""Main text of web pages, with repeated boilerplate found by suffix arrays over hosts.

Every page is cut into blocks of visible text. The token streams of a host's pages, without the blocks that the
markup itself names as the article, are laid end to end and suffix-sorted; substrings of at least ``LEAST``
tokens that stand in enough distinct contents (``needed``) are boilerplate, and blocks covered by them are removed.
Pages of the same visible text are one content, and what stands in menus, headers and the like supports only what
stands there too. What remains are the article's blocks and all others outside menus, forms and the like that are
not repeated; a page of which nothing would remain keeps them all.

The pages of hosts with more than ``SHARD_PAGES`` pages are dealt into shards, each sorted in a task of its own. Their
windows of ``LEAST`` tokens are counted over all shards: a task sends a window at most once for each content, and at most
``ENOUGH`` contents of it, which is all that can matter. So the counts are exact, and dealing changes no result.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from math import ceil
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesline.llm.common import U64, mix, pieces, trimmed
from salesline.session import cut_lineage

LEAST = 6
COVERED = 0.9
SHARE, ENOUGH = 1 / 3, 10
NAMED = U64(0x5851F42D4C957F2D)
SHARD_PAGES = 500

# Elements that never hold main text, those whose content is no markup, those that end a block,
# those without content, names in class, id or role of what is not the article, those of them under which no article is
# the page's own, and words that may stand beside such a name ("site-footer").
DROPPED = frozenset("nav header footer aside form button select option dialog menu noscript template svg iframe object canvas head".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NAMES = frozenset(
    "ad ads advert advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer "
    "gdpr header masthead menu modal nav navbar navigation newsletter notice popup promo promotion related share sharing sidebar skip "
    "social sponsor sponsored subscribe toolbar widget alert contentinfo complementary search".split()
)
HARD = frozenset("ad ads advert advertisement comment comments disqus promo promotion related sponsor sponsored".split())
BESIDE = frozenset(
    "area bar block bottom box button buttons column container desktop form global group icons inner item items left link links list "
    "main mobile outer panel primary right row secondary section site slot top unit wrap wrapper".split()
)
MAINS = frozenset(("main", "main-content", "maincontent"))
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table article section main div body html nav aside header footer form".split())

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>", re.DOTALL)
NAMING = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
WORDS = re.compile(r"[a-z0-9]+")


def page_blocks(html: str) -> list[tuple[str, str]]:
    """(kind, text) of the visible blocks in page order: ``article``, ``other`` or ``dropped``.

    A stack of open elements is kept; end tags that match nothing are ignored, and elements left open end with
    an enclosing one or the page. Without an ``article`` element, ``main`` (or its role) takes its place.
    """
    out: list[tuple[str, int, bool, bool]] = []
    stack: list[tuple[str, int, bool, bool]] = []  # name, dropped (1: by a name, 2: for good), in article, in main
    buffer: list[str] = []

    def flush() -> None:
        text = " ".join("".join(buffer).split())
        buffer.clear()
        if text:
            _, dropped, article, main = stack[-1] if stack else ("", 0, False, False)
            out.append((text, dropped, article, main))

    def close(upto: int) -> None:
        if any(s[0] in BLOCKS for s in stack[upto:]):
            flush()
        del stack[upto:]

    at, n = 0, len(html)
    while at < n:
        m = TAG.search(html, at)
        if not m:
            buffer.append(entities.unescape(html[at:]))
            break
        if m.start() > at:
            buffer.append(entities.unescape(html[at : m.start()]))
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    close(i)
                    break
                if stack[i][0] in SCOPES and name not in SCOPES:
                    break
            else:
                if name in BLOCKS:
                    flush()
            continue
        if name in RAW:
            end = re.compile(rf"</{name}[\s/>]", re.IGNORECASE).search(html, at)
            shut = html.find(">", end.start()) if end else -1
            at = shut + 1 if shut >= 0 else n
            continue
        if name in BLOCKS:
            flush()
            for i in range(len(stack) - 1, -1, -1):  # a block ends an open paragraph, an item the one before it
                if stack[i][0] == "p" or stack[i][0] in CLOSES.get(name, ()):
                    close(i)
                    break
                if stack[i][0] in SCOPES:
                    break
        if name == "br":
            buffer.append(" ")
        if name in VOID or m[3].endswith("/"):
            continue
        _, dropped, article, main = stack[-1] if stack else ("", 0, False, False)
        words: set[str] = set()
        if m[3]:
            for g in NAMING.finditer(m[3]):
                words |= named_by(g[1] or g[2] or g[3] or "")
        own = name in ("article", "main") or "main" in words
        if name in DROPPED or not HARD.isdisjoint(words) and name not in ("html", "body", "main"):
            dropped = 2
        elif own and dropped == 1:
            dropped = 0
        elif not own and not NAMES.isdisjoint(words) and name not in ("html", "body"):
            dropped = max(dropped, 1)
        stack.append((name, dropped, article or name == "article", main or name == "main" or "main" in words))
    flush()
    marked = 2 if any(a and not d for _, d, a, _ in out) else 3 if any(m and not d for _, d, _, m in out) else None
    return [("dropped" if b[1] else "article" if marked and b[marked] else "other", b[0]) for b in out]


def named_by(value: str) -> set[str]:
    """The names that a class, id or role consists of: "main", or a token of names and words that may stand beside them."""
    out: set[str] = set()
    for token in value.lower().split():
        words = set(WORDS.findall(token))
        found = words & NAMES
        if token in MAINS:
            out.add("main")
        elif found and words <= NAMES | BESIDE:
            out |= found
    return out


def host_of(url: str | None) -> str:
    try:
        return (urlsplit((url or "").strip()).hostname or "").lower()
    except ValueError:
        return ""


def token_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit numbers for the tokens of the texts, end to end, and the text of each."""
    from xxhash import xxh3_64_intdigest

    tokens = [t.split(" ") for t in texts]
    ids = np.fromiter((xxh3_64_intdigest(x) for t in tokens for x in t), U64)
    return ids, np.repeat(np.arange(len(texts)), [len(t) for t in tokens])


def suffix_array(stream: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes in order, by doubling the sorted length until all differ."""
    n = len(stream)
    rank = np.unique(stream, return_inverse=True)[1].astype(np.int64)
    k = 1
    while True:
        nxt = np.full(n, -1, np.int64)
        nxt[: max(0, n - k)] = rank[k:]
        order = np.lexsort((nxt, rank))
        new = np.concatenate(([0], np.cumsum((rank[order][1:] != rank[order][:-1]) | (nxt[order][1:] != nxt[order][:-1]))))
        rank[order] = new
        if n == 0 or new[-1] == n - 1 or k >= n:
            return order
        k *= 2


def needed(contents: int) -> int:
    """In how many distinct contents a string stands that is boilerplate of a host with so many of them."""
    return max(2, min(ENOUGH, ceil(SHARE * contents)))


def repeated_starts(stream: np.ndarray, page: np.ndarray, least: int, content: np.ndarray | None = None, need: int = 2) -> np.ndarray:
    """Whether the ``least`` tokens from each position stand in ``need`` contents, one to a page if there is no
    ``content`` for each position. Windows never cross pages."""
    n = len(stream)
    out = np.zeros(n, bool)
    if n < least:
        return out
    order = suffix_array(stream)
    order = order[order <= n - least]
    order = order[page[order] == page[order + least - 1]]
    if not len(order):
        return out
    joint = np.ones(len(order) - 1, bool)  # neighbours in the order that share their first tokens
    for k in range(least):
        joint &= stream[order[1:] + k] == stream[order[:-1] + k]
    group = np.concatenate(([0], np.cumsum(~joint)))
    where = (page if content is None else content)[order]
    each = np.unique(group * (int(where.max()) + 1) + where)
    out[order] = (np.bincount(each // (int(where.max()) + 1)) >= need)[group]
    return out


def window_hashes(stream: np.ndarray, page: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the windows of ``least`` tokens within a page, and their hashes."""
    if len(stream) < least:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    h = np.zeros(len(stream) - least + 1, U64)
    for k in range(least):
        h = h * U64(0x9E3779B97F4A7C15) + stream[k : len(stream) - least + 1 + k]
    at = np.flatnonzero(page[: len(h)] == page[least - 1 :])
    return at, mix(h[at])


def covered(starts: np.ndarray, least: int) -> np.ndarray:
    """The positions covered by windows of ``least`` tokens that start where ``starts`` is True."""
    edge = np.zeros(len(starts) + least + 1, np.int64)
    at = np.flatnonzero(starts)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + least, -1)
    return np.cumsum(edge)[: len(starts)] > 0


BLOCK_ROWS = "page_id long, url string, host string, kinds string, texts string"
KINDS = {"a": "article", "d": "dropped", "o": "other"}


def blocks_of(rows: pa.RecordBatch | pa.Table) -> tuple[list[list[str]], list[list[str]]]:
    """Kinds and texts of the blocks of every page."""
    kinds = [[KINDS[k] for k in ks] for ks in rows.column("kinds").to_pylist()]
    return kinds, [t.split("\n") if ks else [] for ks, t in zip(kinds, rows.column("texts").to_pylist(), strict=True)]


def parsed_pages(pages: DataFrame, large: DataFrame) -> DataFrame:
    """The blocks of every page (kinds as first letters, texts as lines) with its host, the number of shards of a large
    host, and the page's shard."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "html"):
                blocks = [page_blocks(h) for h in batch.column("html").to_pylist()]
                hosts = [host_of(u) for u in batch.column("url").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("page_id"), batch.column("url"), pa.array(hosts, pa.string()),
                        pa.array(["".join(k[0] for k, _ in b) for b in blocks], pa.string()),
                        pa.array(["\n".join(t for _, t in b) for b in blocks], pa.string()),
                    ],
                    ["page_id", "url", "host", "kinds", "texts"],
                )

    parsed = rows.mapInArrow(trimmed(work), BLOCK_ROWS).join(large, "host", "left")
    shard = F.pmod(F.xxhash64("page_id", "url"), F.col("shards")).cast("int")
    return parsed.withColumn("shard", F.coalesce(shard, F.lit(0)))


def large_hosts(pages: DataFrame, shard_pages: int) -> DataFrame:
    """host, shards: the hosts with more than ``shard_pages`` pages, and how many shards theirs are dealt into."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Counter(host_of(u) for u in batch.column("url").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["host", "n"])

    found = pages.select(F.col("url").cast("string").alias("url")).mapInArrow(trimmed(work), "host string, n long").groupBy("host").agg(F.sum("n").alias("n"))
    return cut_lineage(found.where(F.col("n") > shard_pages).select("host", F.ceil(F.col("n") / shard_pages).cast("int").alias("shards")))


def open_stream(kinds: list[list[str]], texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of the blocks that the markup does not name as article, their pages, and their blocks (numbered
    over all pages, articles' blocks included). Tokens of dropped blocks are like no others."""
    chosen, named, page, block, n = [], [], [], [], 0
    for p, (ks, ts) in enumerate(zip(kinds, texts, strict=True)):
        for k, t in zip(ks, ts, strict=True):
            if k != "article":
                chosen.append(t)
                named.append(k == "dropped")
                page.append(p)
                block.append(n)
            n += 1
    ids, which = token_hashes(chosen)
    ids = np.where(np.array(named, bool)[which], ids ^ NAMED, ids)
    return ids, np.array(page, np.int64)[which], np.array(block, np.int64)[which]


def content_hashes(kinds: list[list[str]], texts: list[list[str]]) -> np.ndarray:
    """A 64-bit number for the visible text of every page outside dropped blocks."""
    from xxhash import xxh3_64_intdigest

    return np.fromiter((xxh3_64_intdigest("\n".join(t for k, t in zip(ks, ts, strict=True) if k != "dropped")) for ks, ts in zip(kinds, texts, strict=True)), U64)


def cross_shard_windows(parsed: DataFrame, large: DataFrame, least: int) -> DataFrame:
    """host, shard and the hashes of the windows that enough contents of a large host have, for each of its shards."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in pieces(whole, "texts", 1 << 20):
                kinds, texts = blocks_of(part)
                ids, page, _ = open_stream(kinds, texts)
                at, h = window_hashes(ids, page, least)
                content, page = content_hashes(kinds, texts), page[at]
                host = part.column("host").dictionary_encode().indices.to_numpy()
                order = np.lexsort((content[page], h, host[page]))
                key, mine, page = h[order], content[page[order]], page[order]
                new = np.concatenate(([True], (key[1:] != key[:-1]) | (host[page[1:]] != host[page[:-1]])))[: len(key)]
                once = new | np.concatenate(([True], mine[1:] != mine[:-1]))[: len(key)]
                key, mine, page, new = key[once], mine[once], page[once], new[once]
                few = np.arange(len(key)) - np.maximum.accumulate(np.where(new, np.arange(len(key)), 0)) < ENOUGH
                where = np.concatenate((page[few], np.arange(part.num_rows))).astype(np.int64)
                hashes = np.concatenate((key[few].view(np.int64), np.zeros(part.num_rows, np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("host").take(pa.array(where)), pa.array(hashes, mask=np.arange(len(where)) >= few.sum()),
                        pa.array(np.concatenate((mine[few], content)).view(np.int64)),
                    ],
                    ["host", "h", "content"],
                )

    sent = parsed.where("shards is not null").select("host", "kinds", "texts").mapInArrow(trimmed(work), "host string, h long, content long").distinct()
    counts = sent.groupBy("host", "h").agg(F.count(F.lit(1)).alias("n"))
    share = F.greatest(F.lit(2), F.least(F.lit(ENOUGH), F.ceil(F.col("n") * SHARE)))
    hosts = counts.where("h is null").select("host", share.alias("need")).join(large, "host")
    enough = counts.where("h is not null and n > 1").join(hosts, "host").where("n >= need")
    return enough.select("host", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "h")


RESULT = "page_id long, url string, text string, n_chars long, n_repeated long"


def extract_main_text(pages: DataFrame, least: int = LEAST, shard_pages: int = SHARD_PAGES) -> DataFrame:
    """page_id, url, text (blocks joined by line breaks), n_chars and n_repeated (tokens found to be boilerplate).

    Null html is empty and gives an empty text; a null or unreadable url counts to the host without a name. Pages
    that occur repeatedly are repeated in the result, and none counts as evidence against its copies.
    """
    large = large_hosts(pages, shard_pages)
    parsed = parsed_pages(pages, large)
    cross = cross_shard_windows(parsed, large, least)

    def group(key, left: pa.Table, right: pa.Table) -> pa.Table:
        kinds, texts = blocks_of(left)
        ids, page, block = open_stream(kinds, texts)
        if left.num_rows and left.column("shards")[0].is_valid:
            again = np.zeros(len(ids), bool)
            at, h = window_hashes(ids, page, least)
            again[at[np.isin(h, right.column("h").to_numpy().view(U64))]] = True
        else:
            contents, which = np.unique(content_hashes(kinds, texts), return_inverse=True)
            again = repeated_starts(ids, page, least, which[page], needed(len(contents)))
        cover = covered(again, least)
        n_blocks = sum(map(len, kinds))
        size, hit = np.bincount(block, minlength=n_blocks), np.bincount(block, weights=cover, minlength=n_blocks)
        gone = (hit >= COVERED * size) & (hit > 0)
        out, i = [], 0
        for ks, ts in zip(kinds, texts, strict=True):
            kept = [t for j, (k, t) in enumerate(zip(ks, ts, strict=True), i) if k == "article" or k == "other" and not gone[j]]
            kept = kept or [t for k, t in zip(ks, ts, strict=True) if k == "other"]
            out.append(("\n".join(kept), int(hit[i : i + len(ks)].sum())))
            i += len(ks)
        found = [t for t, _ in out]
        return pa.table(
            {
                "page_id": left.column("page_id"), "url": left.column("url"), "text": pa.array(found, pa.string()),
                "n_chars": pa.array([len(t) for t in found], pa.int64()), "n_repeated": pa.array([n for _, n in out], pa.int64()),
            }
        )

    return parsed.groupBy("host", "shard").cogroup(cross.groupBy("host", "shard")).applyInArrow(group, RESULT)
