"""Main text of pages by a suffix array over the pages of a host.

A page is cut into blocks of text at block-level tags. The blocks' tokens of all pages of a host are concatenated, and a suffix array,
sorted to a depth of ``WINDOW`` tokens by prefix doubling, shows every substring of that length which stands in two or more
pages; longer repeats are the union of such windows. Tokens that no repeat covers are unique runs. Pages of equal
blocks are one page here, since a copy of a whole page tells nothing about which of its parts are the article.

What is removed: comments, scripts, styles and everything else that is no text; blocks whose tag, role, class or id, or those of a
container around them, name a menu, header, footer, sidebar, notice, advert, form or reader comments (the last word of such a name
counts, and the first before words of layout: ``share-buttons``, but not ``share-price``); and, in blocks for which the markup does not
tell, the covered tokens. Blocks in a marked article stay whole, repeats included, because articles of one host quote
each other. A page with a marked article keeps that alone; one without keeps the unique runs of its other blocks.

Repeats are searched for over all pages of every host, whatever their markup tells. A host is dealt into shards of about
``shard_bytes`` of html, so a host with a third of all pages is many tasks. The suffix array of a
shard finds the repeats inside it. For hosts of several shards the pages' windows are also hashed (64 bits, with the host) and grouped over all
shards; those of two or more shards come back to each of them as marks. A page and its copies are in one shard, so these and the
suffix arrays together are all repeats of two pages, whatever ``shard_bytes`` is.

Cases: a null or empty page has the text ''. Pages are read once from front to back, however long and malformed. Pages without a host in their url are looked at as one host. Rows repeated under one
page_id yield a row each. Unclosed and stray tags are read as browsers do as far as blocks
go. Other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import shuffles_dropped
from ..sinks.stage import stage

WINDOW = 12
SHARD_BYTES = 4 << 20
_FLUSH = 1_000_000
#: Bytes of html whose windows are about one bucket of the exchange over shards.
_BUCKET_BYTES = 8 << 20
_SHARED = "shard long, hashes binary, n long"
_WORDS = 500_000

# Fixed values of HTML: elements whose content is no text; of the first ones an end tag is the only end.
_OPAQUE = frozenset("script style textarea template iframe noscript".split())
_RAW = _OPAQUE | frozenset("svg math object canvas head title select button audio video map".split())
#: A tag ends at the first ``>`` that is not inside a quoted value; nothing is tried twice.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+)>")
_NAMES = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PARTS = re.compile(r"[^a-z0-9]+")

# Fixed values of HTML: elements that stand as blocks, and those among them that hold others.
_CONTAINERS = frozenset(
    "div section article main nav aside footer header form ul ol dl table figure dialog blockquote details fieldset center".split()
)
_BLOCKS = _CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th caption pre hr address figcaption summary body html".split())
_ASIDE_TAGS = frozenset("nav aside footer form dialog".split())
#: Parts of class, id and role names that mark what is not the article.
_ASIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsored sponsor promo promotion banner sidebar menu menubar nav navbar "
    "navigation breadcrumb breadcrumbs footer masthead topbar cookie cookies consent gdpr notice notices notification alert popup modal "
    "overlay dialog comment comments disqus respond reply replies share sharing social related recommended newsletter subscribe "
    "subscription signup login search pagination pager widget toolbar contentinfo complementary copyright skip".split()
)
#: Parts of names that only say how something is laid out.
_LAYOUT_NAMES = frozenset(
    "area bar block body bottom box btn button buttons col column container content count desktop fixed form global group header heading icon "
    "icons inner item items label large left link links list main mobile outer panel posts primary right row secondary section slot small sticky "
    "stories text title top unit wrap wrapper zone".split()
)
_MAIN_NAMES = frozenset("main articlebody".split())

_MAIN, _OPEN, _ASIDE = 0, 1, 2


def _tags(page: str):
    """(text before it, closing, name, attributes) of every tag, and at last the text after them; moves forward only.

    A tag, comment, script or style that never ends takes the rest of the page with it, as in browsers; any other element
    without an end tag is read as if its start tag were not there.
    """
    endless: set[str] = set()
    start = at = 0
    while (at := page.find("<", at)) >= 0:
        if page.startswith(("<!", "<?"), at):
            yield page[start:at], False, "", ""
            close = "-->" if page.startswith("<!--", at) else "]]>" if page.startswith("<![CDATA[", at) else ">"
            end = page.find(close, at + 2)
            if end < 0:
                return
            start = at = end + len(close)
            continue
        if not (page[at + 1 : at + 2].isalpha() or page[at + 1 : at + 2] == "/"):
            at += 1  # no tag: a sign in the text
            continue
        m = _TAG.match(page, at)
        if not m:
            if page.find(">", at) < 0:
                yield page[start:at], False, "", ""
                return
            at += 1
            continue
        name = m[2].lower()
        yield page[start:at], bool(m[1]), name, m[3]
        start = at = m.end()
        if name in _RAW and not m[1] and name not in endless:
            # the head ends where the body begins, if nothing else ends it
            found = re.compile(rf"</{name}\s*>" + (r"|(?=<body\b)" if name == "head" else ""), re.I).search(page, at)
            if found:
                start = at = found.end()
                yield " ", True, "", ""
            elif name in _OPAQUE:
                return
            else:
                endless.add(name)
    yield page[start:], False, "", ""


def blocks_of(page: str | None) -> list[tuple[int, str]]:
    """(kind, text) of the blocks in page order; kind: in an article, undecided, aside."""
    if not page:
        return []
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = []
    pieces: list[str] = []
    opened: Counter[str] = Counter()
    kind = _OPEN

    def close() -> None:
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                out.append((kind, text))
            pieces.clear()

    for text, closing, name, attributes in _tags(page):
        if text:
            pieces.append(text)
        if name == "br" or not name:
            pieces.append(" ")
        if name not in _BLOCKS:
            continue
        close()
        if closing and name in _CONTAINERS:
            while opened[name] and (last := stack.pop()[0]):
                opened[last] -= 1
                if last == name:
                    break
        kind = stack[-1][1] if stack else _OPEN
        if closing or name in _CONTAINERS and attributes.rstrip().endswith("/"):
            continue
        if name in _CONTAINERS:
            kind = _kind_of(name, attributes, kind)
            stack.append((name, kind))
            opened[name] += 1
        elif attributes and name not in ("body", "html"):
            kind = _kind_of(name, attributes, kind)  # up to the next block
    close()
    return out


def _kind_of(name: str, attributes: str, outer: int) -> int:
    if outer == _ASIDE or name in _ASIDE_TAGS:
        return _ASIDE
    names: set[str] = set()
    roles: set[str] = set()
    for m in _NAMES.finditer(attributes):
        value = (m[2] or m[3] or m[4] or "").lower()
        names.update(value.split())
        if m[1].lower() in ("role", "itemprop"):
            roles.add(value)
    head = name == "header" or any("header" in _PARTS.split(n) for n in names)
    if any(map(_is_aside, names)) or head and outer != _MAIN:
        return _ASIDE
    if name in ("article", "main") or roles & _MAIN_NAMES:
        return _MAIN
    return outer


def _is_aside(name: str) -> bool:
    """Whether a class, id or role names something beside the article."""
    parts = [p for p in _PARTS.split(name) if p]
    while len(parts) > 1 and (parts[-1] in _LAYOUT_NAMES or parts[-1][0].isdigit()):
        parts.pop()
    return bool(parts) and parts[-1] in _ASIDE_NAMES


def _content(blocks: list[tuple[int, str]]) -> int:
    """A hash of the blocks, the same for copies of a page; they share a shard and count as one page."""
    return xxhash.xxh3_64_intdigest("\n".join(f"{k}{t}" for k, t in blocks)) >> 1


def covered(pages: np.ndarray, tokens: np.ndarray, window: int) -> np.ndarray:
    """Which tokens lie in a run of at least ``window`` tokens that two pages have.

    ``tokens`` is the concatenated stream, ``pages`` the page of each token. The suffixes are ranked by
    1, 2, 4, ... tokens until ``window``; a suffix that leaves its page before that is equal to no other.
    """
    n = len(tokens)
    out = np.zeros(n, dtype=bool)
    if n < window:
        return out
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    depth = 1
    while depth < window:
        step = min(depth, window - depth)
        later = np.full(n, -1, dtype=np.int64)
        later[: n - step] = rank[step:]
        pair = rank * (rank.max() + 2) + later + 1
        rank = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        depth += step
    whole = np.zeros(n, dtype=bool)
    whole[: n - window + 1] = pages[: n - window + 1] == pages[window - 1 :]
    suffixes = np.flatnonzero(whole)
    if not len(suffixes):
        return out
    suffixes = suffixes[np.argsort(rank[suffixes], kind="stable")]  # the suffix array; inside a rank, page order
    r, p = rank[suffixes], pages[suffixes]
    first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
    last = np.r_[first[1:], len(r)] - 1
    repeated = np.repeat(p[first] != p[last], last - first + 1)  # pages are ascending inside a rank
    marks = np.zeros(n + 1, dtype=np.int64)
    np.add.at(marks, suffixes[repeated], 1)
    np.add.at(marks, suffixes[repeated] + window, -1)
    return np.cumsum(marks[:n]) > 0


class _Numbers(dict):
    """Numbers of words by their hash; at most ``_WORDS`` are remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _WORDS:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word) >> 1
        return got


def window_hashes(tokens: np.ndarray, window: int) -> np.ndarray:
    """A hash for each run of ``window`` tokens of the stream, by its first token."""
    n = max(0, len(tokens) - window + 1)
    factors = np.random.default_rng(window).integers(0, 1 << 63, window, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(window):
        out += tokens[i : i + n].astype(np.uint64) * factors[i]
    return out.view(np.int64)


def marked_windows(pages: np.ndarray, tokens: np.ndarray, window: int, hashes: np.ndarray) -> np.ndarray:
    """Which tokens lie in a run of ``window`` tokens of one page whose hash is among ``hashes``."""
    n = len(tokens)
    found = np.isin(window_hashes(tokens, window), hashes)
    at = np.flatnonzero(found)
    at = at[pages[at] == pages[at + window - 1]]
    marks = np.zeros(n + 1, dtype=np.int64)
    marks[at] += 1
    marks[at + window] -= 1
    return np.cumsum(marks[:n]) > 0


def _main_text(kinds: list[int], texts: list[str], marked: list[np.ndarray]) -> str:
    """The kept blocks of a page; ``marked`` tells the covered tokens of each."""
    if _MAIN in kinds:
        return "\n".join(t for k, t in zip(kinds, texts, strict=True) if k == _MAIN)
    kept = []
    for k, t, m in zip(kinds, texts, marked, strict=True):
        if k == _OPEN:
            left = [w for w, c in zip(t.split(), m, strict=True) if not c] if m.any() else None
            t = t if left is None else " ".join(left)
            if t:
                kept.append(t)
    return "\n".join(kept)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def extract(
    pages: DataFrame, *, key: str = "page_id", url: str = "url", page: str = "html", window: int = WINDOW,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """(page_id, url, text) of every page."""
    rows = pages.select(
        F.col(key).alias("page_id"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"), F.col(page).alias("html")
    )
    # hosts of more than one shard: at most one for each ``shard_bytes`` of the input
    large = rows.groupBy("host").agg(F.sum(F.octet_length("html")).alias("size")).where(F.col("size") > shard_bytes)
    large = stage(large.withColumn("shards", F.ceil(F.col("size") / shard_bytes).cast("long")), "host-shards")
    shards = large.select("host", "shards")
    size = large.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    dealt = rows.join(shards, "host", "left").select(*rows.columns, F.coalesce("shards", F.lit(1)).alias("shards"))
    # the windows that several shards of a host hold; none when every host is one shard
    across = rows.sparkSession.createDataFrame([], _SHARED) if not size else _by_repeats(
        rows.join(shards, "host").select("host", "shards", "html"), window, size
    )
    ids = [f for f in rows.schema.fields if f.name in ("page_id", "url")]
    cut_type = T.StructType([*ids, *(T.StructField(n, t) for n, t in (
        ("shard", T.LongType()), ("salt", T.LongType()), ("content", T.LongType()), ("kinds", T.StringType()), ("texts", T.StringType())
    ))])

    def cut(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = [blocks_of(x.as_py()) for x in part.column(3)]
                content = [_content(b) for b in found]
                hosts, shards = part.column(2).to_pylist(), part.column(4).to_pylist()
                places = [_shard(*x) for x in zip(hosts, shards, content, strict=True)]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array(places, pa.int64()), pa.array(map(_salt, hosts), pa.int64()), pa.array(content, pa.int64()),
                    # a block is one line
                    pa.array(["".join(str(k) for k, _ in b) for b in found]), pa.array(["\n".join(t for _, t in b) for b in found]),
                ], names=cut_type.names)

    def shard_text(group: pd.DataFrame, marked: pd.DataFrame) -> pd.DataFrame:
        ids = pd.factorize(group["content"])[0]
        order = np.argsort(ids, kind="stable")
        kinds = [[int(k) for k in x] for x in group["kinds"]]
        texts = [x.split("\n") if k else [] for x, k in zip(group["texts"], kinds, strict=True)]
        numbers = _Numbers()
        stream: list[int] = []
        lengths: list[int] = []
        owner: list[int] = []
        for i in order:
            for text in texts[i]:
                words = text.split()
                stream.extend(map(numbers.__getitem__, words))
                lengths.append(len(words))
                owner.append(ids[i])
        owners, tokens = np.repeat(np.array(owner, dtype=np.int64), lengths), np.array(stream, dtype=np.int64)
        marks = covered(owners, tokens, window)
        if len(marked):
            shared = np.concatenate([_unpacked(*x) for x in zip(marked["hashes"], marked["n"], strict=True)])
            marks |= marked_windows(owners, tokens, window, shared ^ group["salt"].iloc[0])
        ends, out, b = np.cumsum([0, *lengths]), [""] * len(group), 0
        for i in order:
            n = len(texts[i])
            out[i] = _main_text(kinds[i], texts[i], [marks[ends[j] : ends[j + 1]] for j in range(b, b + n)])
            b += n
        return pd.DataFrame({"page_id": group["page_id"], "url": group["url"], "text": out})

    result = T.StructType([*ids, T.StructField("text", T.StringType())])
    grouped = dealt.mapInArrow(cut, cut_type).groupBy("shard")
    return grouped.cogroup(across.groupBy("shard")).applyInPandas(shard_text, result)


def _shard(host: str, shards: int, content: int) -> int:
    """The number of the shard of its host that a page and its copies are in; no two hosts share one."""
    return xxhash.xxh3_64_intdigest(f"{content % shards} {host}") >> 1


def _salt(host: str) -> int:
    """Tells equal windows of two hosts apart."""
    return xxhash.xxh3_64_intdigest(host) >> 1


def _packed(h: np.ndarray) -> bytes:
    """Hashes as the differences from one to the next, all first bytes, all second bytes and so on, compressed."""
    steps = np.diff(h, prepend=np.int64(0)).view(np.uint8).reshape(-1, 8).T
    return pa.compress(np.ascontiguousarray(steps).tobytes(), codec="zstd", asbytes=True)


def _unpacked(packed: bytes, n: int) -> np.ndarray:
    steps = np.frombuffer(pa.decompress(packed, decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(steps.T).view(np.int64).ravel())


def _by_repeats(rows: DataFrame, window: int, size: int) -> DataFrame:
    """(shard, hashes, n): the windows that two or more shards of a host hold, for each of these shards.

    ``rows`` are host, its number of shards and html, ``size`` their bytes. Hashes travel packed, a row for each bucket of them and flush of a task.
    """
    buckets = max(1, size // _BUCKET_BYTES)
    schema = pa.schema([("bucket", pa.int64()), ("shards", pa.binary()), ("hashes", pa.binary())])

    def windows(batches):
        words, held, n = _Numbers(), [], 0

        def out():
            shard, h = (np.concatenate(x) for x in zip(*held, strict=True))
            # by ranges of the hash: what lies close together packs well
            bucket = (h >> 32) * buckets >> 32
            order = np.lexsort((h, shard, bucket))
            shard, h, bucket = shard[order], h[order], bucket[order]
            new = np.r_[True, (shard[1:] != shard[:-1]) | (h[1:] != h[:-1])]
            shard, h, bucket = shard[new], h[new], bucket[new]
            first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            ends = [*first[1:], len(h)]
            rows = [(int(bucket[a]), shard[a:b].tobytes(), _packed(h[a:b])) for a, b in zip(first, ends, strict=True)]
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                for host, shards, page in zip(*(c.to_pylist() for c in batch.slice(start, 256).columns), strict=True):
                    blocks = blocks_of(page)
                    tokens = [words[w] for _, t in blocks for w in t.split()]
                    h = np.unique(window_hashes(np.array(tokens, dtype=np.int64), window) ^ np.int64(_salt(host)))
                    if len(h):
                        held.append((np.full(len(h), _shard(host, shards, _content(blocks)), dtype=np.int64), h))
                        n += len(h)
                    if n > _FLUSH:
                        yield out()
                        held, n = [], 0
        if held:
            yield out()

    def shared(group: pd.DataFrame) -> pd.DataFrame:
        shard = np.frombuffer(b"".join(group["shards"]), dtype=np.int64)
        h = np.concatenate([_unpacked(p, len(x) // 8) for p, x in zip(group["hashes"], group["shards"], strict=True)])
        order = np.lexsort((shard, h))
        shard, h = shard[order], h[order]
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        last = np.r_[first[1:], len(h)] - 1
        found = np.repeat(shard[first] != shard[last], last - first + 1) & np.r_[True, (h[1:] != h[:-1]) | (shard[1:] != shard[:-1])]
        shard, h = shard[found], h[found]
        order = np.argsort(shard, kind="stable")
        shard, h = shard[order], h[order]
        first = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if len(shard) else []
        return pd.DataFrame({"shard": shard[first], "hashes": [_packed(x) for x in np.split(h, first)[1:]], "n": np.diff([*first, len(h)])})

    packed = rows.mapInArrow(windows, "bucket long, shards binary, hashes binary")
    with shuffles_dropped(rows.sparkSession):
        return stage(packed.groupBy("bucket").applyInPandas(shared, _SHARED), "html-windows")


def digest(found: DataFrame) -> DataFrame:
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
