"""Main text of web pages, with repeats found by suffix arrays over each host.

Markup comes first: a page is read into blocks, and elements that can't be article
(scripts, menus, forms, comments and so on) are left out. Then the token streams of a
host's pages are put one after the other, their suffix array and the common prefixes
of its neighbours are worked out, and every run of suffixes that share `least` tokens
or more is a repeat of as many pages as it holds. Repeats decide in every zone, the
less readily the more the markup speaks for the text:

* where a page marks no article, tokens in runs that `few` pages hold are removed, and
  the unique runs stay, with the few tokens by which a run reaches into another block;
* elements whose names hint at something else (`related-work`, `notice-of-award`) go if
  such runs cover half of them, and stay otherwise;
* in a marked article a whole block goes if nearly all pages of the host (`most` of
  them, and five at least) hold it and it stands at the article's edge or beside
  another such block. What a share of the articles repeats inside them stays: authors
  repeat themselves and each other.

A host of up to `size` characters is one group with one suffix array. A larger host is
dealt by a hash of page_id into groups of about that size, each with a suffix array of
its own. What no group has often enough to see is counted over all pages of the host by
Spark, by hashes: whole blocks, so that a notice on three pages of a million is found,
and, for each large host with a page on which runs decide anything, the runs of `least`
tokens of all its pages. Results depend neither on the number of partitions nor on `size`.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import modest_batches, staged

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|([^<]+|<)", re.S)
_HINT = re.compile(r"(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Elements whose content is raw text, up to their own end tag.
RAW = frozenset(("script", "style", "textarea", "title", "xmp", "noembed", "noframes", "iframe"))
#: Elements that hold no article text.
DROPPED = RAW | frozenset(("head", "nav", "footer", "aside", "form", "button", "select", "noscript", "template", "svg", "math", "canvas", "object", "embed", "audio", "video", "dialog", "menu", "datalist", "input", "label", "fieldset"))
BLOCKS = frozenset("address article blockquote body center dd details dialog div dl dt fieldset figcaption figure form h1 h2 h3 h4 h5 h6 header hgroup hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))
#: Words in a class, an id or a role that tell what an element is for.
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright disqus footer gdpr menu nav navbar navigation newsletter notice notices paywall popup promo promoted promotion recommended related reply replies share sharing sidebar signup social sponsor sponsored subscribe subscription widget".split()
)
#: Words beside those, in a name that hints at nothing but furniture.
STRUCTURE = frozenset("area bar block bottom box button buttons body col column container content footer form group header holder icon icons inner inline item items left link links list main mid nav outer panel post posts right row section site slot small stories story top unit widget wide wrap wrapper global page primary secondary fixed sticky".split())
IN_ARTICLE, IN_MAIN, ELSEWHERE = 0, 1, 2
#: Added to a block's zone where its element's name only hints at furniture.
DOUBTFUL = 4
FURNITURE, HINT, PLAIN = 2, 1, 0


def _told(attributes: str) -> int:
    """What class, id and role tell: a name of hint words and words of structure alone
    is furniture, a name with other words too is a hint."""
    found = PLAIN
    for m in _HINT.finditer(attributes):
        for name in "".join(m.groups("")).lower().split():
            words = {w for w in re.split(r"[^a-z]+", name) if w}
            if not HINTS.isdisjoint(words):
                if words <= HINTS | STRUCTURE:
                    return FURNITURE
                found = HINT
    return found


def blocks(page: str) -> list[tuple[int, str]]:
    """The blocks of a page that may be article: the zone where each stands, and its
    text with references decoded and white space made single spaces."""
    out: list[tuple[int, str]] = []
    text: list[str] = []
    depth = {"article": 0, "main": 0}
    skipped, nested = "", 0
    doubted, inside = "", 0
    at, end = 0, len(page)

    def close() -> None:
        own = " ".join("".join(text).split())
        text.clear()
        if own:
            zone = IN_ARTICLE if depth["article"] else IN_MAIN if depth["main"] else ELSEWHERE
            out.append((zone + DOUBTFUL if doubted else zone, own))

    while at < end:
        m = _TOKEN.match(page, at)
        at = m.end()
        plain, name = m[4], m[2]
        if plain is not None:
            if not skipped:
                text.append(html.unescape(plain))
            continue
        if name is None:
            continue
        name, closing = name.lower(), m[1] == "/"
        if skipped:
            lax = skipped in ("p", "li")  # the end tag may be left out
            if lax and not closing and (name == skipped or name in BLOCKS) or skipped == "head" and name == "body":
                skipped = ""  # this tag ends it and is read itself
            else:
                nested += 0 if name != skipped else -1 if closing else 1
                if nested <= 0:
                    skipped = ""
                    close()
                continue
        if name in BLOCKS:
            close()
        elif name == "br":
            text.append(" ")
        if doubted:
            lax = doubted in ("p", "li") and not closing and name in BLOCKS
            inside += 0 if name != doubted else -1 if closing else 1
            if inside <= 0 or lax:
                close()
                doubted = ""
        if closing:
            if name in depth:
                depth[name] = max(0, depth[name] - 1)
            continue
        if name not in VOID:
            told = _told(m[3]) if m[3] and name not in ("html", "body", "main") and (name != "article" or depth["article"]) else PLAIN
            if name in DROPPED or name == "header" and not depth["article"] or told == FURNITURE:
                if m[3].rstrip().endswith("/") and name in ("svg", "math"):
                    continue
                close() if name in BLOCKS or name in DROPPED else None
                skipped, nested = name, 1
                if name in RAW:
                    stop = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
                    at, skipped = (stop.end() if stop else end), ""
                continue
            if told == HINT and not doubted:
                close()
                doubted, inside = name, 1
        if name in depth:
            depth[name] += 1
    close()
    return out


def suffix_array(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of numbers from 0, and for each place in it but the first the
    common prefix with the suffix before it (0 at the first).

    By prefix doubling: a rank is where a suffix's bucket begins, and only buckets of
    several suffixes are ranked further. The ranks of all rounds are kept, and the
    common prefixes follow from them, the longest power of two first."""
    size = len(tokens)
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(tokens, kind="stable")
    first = np.r_[True, tokens[order][1:] != tokens[order][:-1]]
    rank = np.empty(size, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(size), 0))
    ranks, reach = [rank.astype(np.int32)], 1
    while True:
        alone = first & np.r_[first[1:], True]
        places = np.flatnonzero(~alone)  # in the array, buckets of several
        if not len(places) or reach >= size:
            break
        which = order[places]
        after = np.where(which + reach < size, rank[np.minimum(which + reach, size - 1)], -1)
        resorted = np.lexsort((after, rank[which]))
        which, after, bucket = which[resorted], after[resorted], rank[which][resorted]
        order[places] = which
        fresh = np.r_[True, (bucket[1:] != bucket[:-1]) | (after[1:] != after[:-1])]
        first[places] = fresh
        rank = rank.copy()
        rank[which] = np.maximum.accumulate(np.where(fresh, places, 0))
        ranks.append(rank.astype(np.int32))
        reach *= 2
    common = np.zeros(size, np.int64)
    a, b = order[1:].copy(), order[:-1].copy()
    for k in range(len(ranks) - 1, -1, -1):
        inside = (a < size) & (b < size)
        same = np.zeros(len(a), bool)
        same[inside] = ranks[k][a[inside]] == ranks[k][b[inside]]
        # a suffix that ends within 2^k tokens equals no other one in a rank
        a[same] += 1 << k
        b[same] += 1 << k
        common[1:][same] += 1 << k
    return order, common


def pages_of_runs(streams: list[list[str]], least: int) -> tuple[list[np.ndarray], list[int]]:
    """For each stream of tokens and each place in it, how many distinct streams hold
    the `least` tokens that begin there (0 where fewer are left); and the number of
    each stream among the distinct ones. Equal streams count as one."""
    whole: dict[tuple, int] = {}
    owner = [whole.setdefault(tuple(s), len(whole)) for s in streams]
    number: dict[str, int] = {}
    flat: list[int] = []
    starts: list[int] = []
    for k, s in enumerate(whole):
        starts.append(len(flat))
        flat += [number.setdefault(t, len(number)) for t in s]
        flat.append(-1 - k)  # ends the stream, unlike any other token
    tokens = np.array(flat, np.int64)
    order, common = suffix_array(np.where(tokens < 0, len(number) - 1 - tokens, tokens))
    page = np.repeat(np.arange(len(whole)), np.diff([*starts, len(flat)]))
    run = np.cumsum(common < least) - 1
    held = np.unique(run * max(1, len(whole)) + page[order]) // max(1, len(whole)) if len(order) else run
    count = np.empty(len(flat), np.int64)
    count[order] = np.bincount(held, minlength=int(run[-1]) + 1 if len(run) else 1)[run] if len(order) else 0
    ends = [*starts[1:], len(flat)]
    own = []
    for a, b in zip(starts, ends, strict=True):
        mine = count[a : b - 1].copy()
        mine[max(0, len(mine) - least + 1) :] = 0
        own.append(mine)
    return [own[k] for k in owner], owner


def covered(counts: np.ndarray, least: int, pages: int) -> np.ndarray:
    """Which tokens lie in a window of `least` tokens that `pages` pages hold."""
    edge = np.zeros(len(counts) + least + 1, np.int64)
    where = np.flatnonzero(counts >= pages)
    np.add.at(edge, where, 1)
    np.add.at(edge, where + least, -1)
    return np.cumsum(edge)[: len(counts)] > 0


def _whole_runs(hit: np.ndarray, least: int) -> np.ndarray:
    """A block's covered tokens without runs of fewer than `least` that leave a part
    of it: those are the ends of runs that reach into it from its neighbours."""
    if hit.all():
        return hit
    edge = np.diff(np.r_[0, hit.astype(np.int8), 0])
    out = np.zeros(len(hit), bool)
    for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True):
        out[a:b] = b - a >= least
    return out


def _at_edges(gone: list[bool], common: list[bool]) -> list[bool]:
    """Of the blocks of an article those that are common and have nothing but gone
    or common blocks between them and its edge."""
    out = list(gone)
    for ks in (range(len(out)), range(len(out) - 1, -1, -1)):
        for k in ks:
            if not (out[k] or common[k]):
                break
            out[k] = True
    return out


def _zone(own: list[tuple[int, str]]) -> int:
    """The zone that a page's text is taken from."""
    return min((z % DOUBTFUL for z, _ in own), default=ELSEWHERE)


def _undecided(z: int, zone: int) -> bool:
    """Whether runs decide about a block of zone z on a page whose text is in zone."""
    return z % DOUBTFUL == zone and (zone == ELSEWHERE or z >= DOUBTFUL)


def _runs(own: list[tuple[int, str]], host: str, least: int) -> list[int]:
    """The hashes of a host with the `least` tokens that begin at each place of a page."""
    tokens = [t for _, b in own for t in b.split(" ")]
    return [xxhash.xxh64_intdigest(f"{host}\n{' '.join(tokens[i : i + least])}") - (1 << 63) for i in range(len(tokens) - least + 1)]


def main_texts(read: list[list[tuple[int, str]]], least: int = 8, few: int = 3, most: float = 0.8, known: list[tuple[set[int], set[int]]] | None = None, elsewhere: list[list[int]] | None = None) -> list[tuple[str, int]]:
    """The text of each page of a host, given as its blocks, and how many tokens of the
    blocks that runs decide about are in runs that few pages hold. known has for each
    page which of its blocks few and most pages of the host hold; without it these pages
    are the host. elsewhere has for each page the places where runs begin that few pages
    of the host hold, though these pages may not show it."""
    streams = [[t for _, b in own for t in b.split(" ")] for own in read]
    counts, owner = pages_of_runs(streams, least)
    if known is None:
        pages = len(set(owner))
        held = Counter()
        for own in {k: own for k, own in zip(owner, read, strict=True)}.values():
            held.update({b for _, b in own})
        often = {b for b, n in held.items() if n >= max(5, most * pages)}
        known = [(set(), {i for i, (_, b) in enumerate(own) if b in often}) for own in read]
    out = []
    for own, n, (shared, common), begun in zip(read, counts, known, elsewhere or [[]] * len(read), strict=True):
        n[begun] = np.maximum(n[begun], few)
        cover, at, found = covered(n, least, few), 0, 0
        zone = _zone(own)
        mine: list[tuple[int, list[str], bool]] = []  # place, tokens kept, gone
        for i, (z, b) in enumerate(own):
            tokens = b.split(" ")
            if i in shared and len(tokens) >= least:
                cover[at : at + len(tokens)] = True
            hit = cover[at : at + len(tokens)]
            at += len(tokens)
            if z % DOUBTFUL != zone:
                continue
            if _undecided(z, zone):
                found += int(hit.sum())
                hit = _whole_runs(hit, least)
            gone = z >= DOUBTFUL and 2 * int(hit.sum()) >= len(tokens)
            if zone == ELSEWHERE:
                tokens = [t for t, x in zip(tokens, hit, strict=True) if not x]
                gone = gone or not tokens
            mine.append((i, tokens, gone))
        gone = [g for _, _, g in mine]
        if zone != ELSEWHERE:
            gone = _at_edges(gone, [i in common for i, _, _ in mine])
        out.append(("\n".join(" ".join(t) for (_, t, _), g in zip(mine, gone, strict=True) if not g), found))
    return out


def _packed(own: list[tuple[int, str]]) -> bytes:
    """A page's blocks as bytes; texts hold no line feeds."""
    return zlib.compress("\n".join(f"{z}{b}" for z, b in own).encode("utf-8", "surrogatepass"), 1)


def _unpacked(data: bytes) -> list[tuple[int, str]]:
    text = zlib.decompress(data).decode("utf-8", "surrogatepass")
    return [(int(b[0]), b[1:]) for b in text.split("\n")] if text else []


def _stream(own: list[tuple[int, str]]) -> int:
    return xxhash.xxh64_intdigest(" ".join(b for _, b in own)) - (1 << 63)


def _reading(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        page_id, url, host, part, pages = (b.column(b.schema.get_field_index(c)) for c in ("page_id", "url", "host", "part", "html"))
        read = [blocks(x.as_py() or "") for x in pages]
        yield pa.RecordBatch.from_arrays([page_id, url, host, part, pa.array(map(_packed, read), pa.binary())], ["page_id", "url", "host", "part", "page"])


def _hashing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        host, part, pages = (b.column(b.schema.get_field_index(c)) for c in ("host", "part", "html"))
        streams, keys, undecided = [], [], []
        for name, x in zip(host.to_pylist(), pages, strict=True):
            own = blocks(x.as_py() or "")
            streams.append(_stream(own))
            keys.append([xxhash.xxh64_intdigest(f"{name}\n{t}") - (1 << 63) for _, t in own])
            undecided.append(any(_undecided(z, _zone(own)) for z, _ in own))
        columns = [host, part, pa.array(streams, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(undecided, pa.bool_())]
        yield pa.RecordBatch.from_arrays(columns, ["host", "part", "stream", "keys", "undecided"])


def _hashing_runs(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            host, part, pages = (b.column(b.schema.get_field_index(c)) for c in ("host", "part", "html"))
            for k, (name, x) in enumerate(zip(host.to_pylist(), pages, strict=True)):  # a page at a time: its runs are larger than itself
                own = blocks(x.as_py() or "")
                keys = np.unique(np.array(_runs(own, name, least), np.int64))
                yield pa.RecordBatch.from_arrays([host[k : k + 1], part[k : k + 1], pa.array([_stream(own)], pa.int64()), pa.array([keys], pa.list_(pa.int64()))], ["host", "part", "stream", "keys"])

    return run


def _extracting(least: int, few: int, most: float):
    def run(pages: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
        read = [_unpacked(x) for x in pages["page"]]
        runs = {k for own in marks["runs"] if own is not None for k in own}
        by_stream = {s: own for s, *own, r in zip(marks["stream"], marks["few"], marks["most"], marks["runs"], strict=True) if r is None}
        known = [tuple(map(set, by_stream.get(_stream(own), ((), ())))) for own in read]
        begun = None
        if runs:
            begun = [[i for i, k in enumerate(_runs(own, name, least)) if k in runs] for own, name in zip(read, pages["host"], strict=True)]
        found = main_texts(read, least, few, most, known, begun)
        texts = [t for t, _ in found]
        return pd.DataFrame({"page_id": pages["page_id"].astype("Int64"), "url": pages["url"], "text": texts, "n_chars": [len(t) for t in texts], "n_shared": [n for _, n in found]})

    return run


def _host(url: str = "url") -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def _common_blocks(hashed: DataFrame, few: int, most: float) -> DataFrame:
    """(host, part, stream, few, most): which blocks of a page few and most distinct
    pages of its host hold. hashed has a page's stream and the hashes of its host with
    each of its blocks; counts are combined before they are shuffled."""
    each = hashed.select("host", "part", "stream", F.posexplode("keys").alias("i", "key"))
    hosts = hashed.groupBy("host").agg(F.countDistinct("stream").alias("pages"))
    held = each.groupBy("key").agg(F.countDistinct("stream").alias("n")).where(F.col("n") >= few)
    marked = each.join(held, "key").join(hosts, "host")
    often = F.col("n") >= F.greatest(F.lit(5), F.lit(most) * F.col("pages"))
    return marked.groupBy("host", "part", "stream").agg(F.collect_set("i").alias("few"), F.collect_set(F.when(often, F.col("i"))).alias("most"))


def _common_runs(hashed: DataFrame, few: int) -> DataFrame:
    """Rows as those of _common_blocks, one for each group: the runs of its pages that few
    distinct pages of the host hold. They are no more than the group has tokens."""
    each = hashed.select("host", "part", "stream", F.explode("keys").alias("key"))
    held = each.groupBy("key").agg(F.countDistinct("stream").alias("n")).where(F.col("n") >= few).select("key")
    none = F.array().cast("array<int>")
    found = each.select("host", "part", "key").distinct().join(held, "key").groupBy("host", "part").agg(F.collect_list("key").alias("runs"))
    return found.select("host", "part", F.lit(0).cast("long").alias("stream"), none.alias("few"), none.alias("most"), "runs")


def extract_text(pages: DataFrame, size: int = 2 << 20, least: int = 8, few: int = 3, most: float = 0.8) -> DataFrame:
    """A row for each row of pages (page_id, url, html): page_id, url, text, n_chars
    (its code points) and n_shared (tokens in runs shared with other pages, of the
    blocks that runs decide about: those of pages that mark no article, and those whose
    names only hint at furniture).

    size is the number of characters of html up to which a host is one group; results
    don't depend on it. Null
    html is empty and has empty text; null urls are a host of their own; repeated rows
    are each extracted, and equal pages count as one when repeats are counted. An empty
    table gives an empty result; other columns are ignored."""
    modest_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", _host().alias("host"), "html")
    sizes = rows.groupBy("host").agg(F.sum(F.char_length("html")).alias("chars"))
    # a row for each host of several groups: no more than the table's characters over size
    large = staged(sizes.where(F.col("chars") > size).select(F.col("host").alias("h"), F.ceil(F.col("chars") / size).cast("int").alias("parts")))
    part = F.pmod(F.xxhash64("page_id"), F.coalesce("parts", F.lit(1))).cast("int")
    parted = rows.join(large, rows["host"] == large["h"], "left").select("page_id", "url", "host", part.alias("part"), "html")
    read = parted.mapInArrow(_reading, "page_id long, url string, host string, part int, page binary")
    # pages are read twice rather than kept: their blocks are as large as the table
    hashed = staged(parted.mapInArrow(_hashing, "host string, part int, stream long, keys array<long>, undecided boolean"))
    marks = _common_blocks(hashed, few, most).withColumn("runs", F.lit(None).cast("array<long>"))
    asked = staged(large.join(hashed.where("undecided").select(F.col("host").alias("h")).distinct(), "h", "left_semi").where("parts > 1"))
    if not asked.isEmpty():
        own = parted.join(asked, parted["host"] == asked["h"], "left_semi")
        marks = marks.unionByName(_common_runs(own.mapInArrow(_hashing_runs(least), "host string, part int, stream long, keys array<long>"), few))
    both = read.groupBy("host", "part").cogroup(marks.groupBy("host", "part"))
    return both.applyInPandas(_extracting(least, few, most), "page_id long, url string, text string, n_chars long, n_shared long")
