"""Main text of web pages: substrings that a host repeats over its pages, and page structure.

Pages are parsed once into blocks of text, those of menus, footers and adverts
included, and the blocks of a page are its token stream. What a host's streams
have in common is boilerplate where nothing says that it is the article:

* A block that enough distinct pages of the host have as a whole is one row of
  the host's suffixes for all of its positions: it is counted by one hash, and
  none of its suffixes is sorted.
* Of the other blocks outside of articles, every suffix goes to the bucket of
  its first ``RUN`` tokens. A bucket with enough distinct pages is a repeated
  substring: suffixes with a common prefix of ``RUN`` tokens or more share a
  bucket, and of a longer common prefix every later token starts a suffix that
  shares one, too. So the buckets cover what a suffix array of the host with its
  common prefixes does, and the order inside a bucket, which would decide
  nothing, is not made. A block with at least half of its words under such
  substrings loses these and keeps its unique runs.
* An article is never cut inside. Its first and last blocks go if more than half
  of the host's distinct pages, three at least, have the same block at the same
  place of their articles (a notice under every story, a fixed heading).

Structure says what an article is and leaves out menus, headers, footers,
sidebars, notices, adverts, forms and comments that nothing repeats, as on a host's only
page; ``extract(..., structure=False)`` goes by repetition alone.

Enough is a share of the host's distinct pages. Pages with the same text outside
of what structure leaves out (a page under two addresses, a reprint) count as
one. Everything is counted by sums per hash, combined before the shuffle, so no
task holds a host or a notice.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.shingles import _mix, text_words
from strata.llm.tables import sized, written
from strata.llm.url_redirects import host_of

RUN = 8  # tokens of the shortest repeated substring
SHARE = 0.2  # of a host's distinct pages, two at least, that have what is boilerplate outside of articles
EDGE = 3  # blocks at either end of an article that a host may repeat
BROADCAST_MARKS = 4_000_000  # numbers of at most 8 bytes
NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
STOP = re.compile("[>\"']")
#: A tag without "<" in it, as nearly all are.
PLAIN_TAG = re.compile(r"<(/?[a-zA-Z][^\s/<>]*)((?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*+)>")
RAW = frozenset("script style title textarea".split())  # without an end tag they go on to the end of the page
SKIPPED = RAW | frozenset("noscript template svg math iframe object canvas select button audio video".split())
SKIPPED_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in SKIPPED}
ATTRIBUTE = re.compile(r"(?<![a-zA-Z-])([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b", re.S)
# HTML's elements, ARIA's roles and usual class names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr br td th".split()
)
OUT = frozenset("nav footer aside menu dialog head".split())
OUT_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
# Whole class names and ids. What is beside the text is dropped with the articles in it (teasers, comments), unless the page has no others.
BESIDE_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer comment comments disqus reply replies respond related "
    "recommended widget pagination pager teaser site-nav main-nav main-navigation site-navigation nav-menu nav-links top-nav side-nav "
    "post-navigation main-menu site-footer page-footer main-footer footer-links footer-widgets side-bar left-sidebar right-sidebar "
    "sidebar-left sidebar-right widget-area related-posts related-articles related-links related-content recommended-posts "
    "comment-list comments-area comment-form comment-respond comments-section".split()
)
OUT_NAMES = BESIDE_NAMES | frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice "
    "notices alert popup modal overlay newsletter subscribe subscription signup masthead share sharing social toolbar login search "
    "cookie-notice cookie-banner cookie-bar cookie-consent gdpr-banner consent-banner ad-banner banner-ad ad-container ad-slot ad-unit "
    "ad-wrapper ad-box adsbygoogle sponsored-content newsletter-signup newsletter-form email-signup social-share social-links "
    "social-media social-icons share-buttons share-links sharing-buttons site-header login-form search-form search-box search-bar".split()
)
COMMENT_NAMES = frozenset(
    "comment comments reply replies ad ads advert advertisement sponsored promo related teaser comment-body comment-content "
    "ad-slot ad-unit related-post teaser-card".split()
)
ARTICLE_NAMES = frozenset(
    "article-body articlebody article-content article-text post-content post-body entry-content story-body main-content content-body".split()
)
OPEN, MAIN, ARTICLE, DROPPED = 0, 1, 2, 3
AROUND, FORM, BESIDE = 1, 2, 3  # why an element is dropped


def _region(tag: str, attributes: str, inside: int) -> tuple[int, int]:
    """What an element's content is, given what surrounds it, and why it is dropped (0: it is not)."""
    out = BESIDE if tag in OUT else FORM if tag == "form" else AROUND if tag == "header" and inside != ARTICLE else 0
    if attributes:
        values: dict[str, str] = {}
        for name, a, b, c, hidden in ATTRIBUTE.findall(attributes):
            values[hidden or name.lower()] = a or b or c
        names = set(values.get("class", "").lower().split())
        within = inside == ARTICLE
        if not within or tag == "div":  # in an article, ids are anchors of its sections
            names.update(values.get("id", "").lower().split())
        role = values.get("role", "").lower()
        style = values.get("style", "").replace(" ", "").lower()
        if role in OUT_ROLES or "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in style:
            out = BESIDE
        elif tag == "article":
            out = BESIDE if names & COMMENT_NAMES else out
        elif tag not in ("html", "body", "main") and not (within and tag in INLINE):
            out = BESIDE if names & BESIDE_NAMES else out or (AROUND if names & OUT_NAMES else 0)
        if role == "article" or values.get("itemprop", "").lower() == "articlebody" or ARTICLE_NAMES.intersection(names):
            return ARTICLE, out
        if role == "main":
            return max(inside, MAIN), out
    if tag == "article":
        return ARTICLE, out
    return (max(inside, MAIN) if tag == "main" else inside), out


class _Markup:
    """The tags of a page, one after the other, in time linear in the page.

    A tag ends at its first ``>`` outside of quotes. Where none follows, here
    and in the rest of the page quotes are ordinary characters.
    """

    def __init__(self, page: str):
        self.page, self.quotes = page, True

    def _end(self, at: int) -> int:
        """The place of the ``>`` that ends the tag whose name ends at ``at``; -1 if there is none."""
        k = at
        while self.quotes:
            m = STOP.search(self.page, k)
            if m is None:
                break
            if m[0] == ">":
                return m.start()
            closing = self.page.find(m[0], m.end())
            if closing < 0:
                break
            k = closing + 1
        self.quotes = False
        return self.page.find(">", at)

    def next(self, at: int) -> tuple[int, int, str, str]:
        """Start and end of the next markup from ``at`` on, the lower-case name (with ``/`` in end tags) and the attributes.

        Comments and the like have no name. At the end of the page the start is its length.
        """
        page = self.page
        while (start := page.find("<", at)) >= 0:
            if self.quotes and (m := PLAIN_TAG.match(page, start)):
                return start, m.end(), m[1].lower(), m[2]
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return start, len(page) if end < 0 else end + 3, "", ""
            m = NAME.match(page, start + 1)
            if m:
                end = self._end(m.end())
                if end < 0:
                    return len(page), len(page), "", ""
                return start, end + 1, m[0].lower(), page[m.end() : end]
            if page.startswith(("<!", "<?", "</"), start):
                end = page.find(">", start)
                return start, len(page) if end < 0 else end + 1, "", ""
            at = start + 1
        return len(page), len(page), "", ""


class _Dropped:
    """Elements to be dropped: why each is, and the next one around it (-1: none)."""

    def __init__(self):
        self.why: list[int] = []
        self.above: list[int] = []

    def add(self, why: int, around: int) -> int:
        self.why.append(why)
        self.above.append(around)
        return len(self.why) - 1

    def path(self, k: int) -> Iterator[int]:
        while k >= 0:
            yield k
            k = self.above[k]

    def out(self, kept: set[int]) -> list[int]:
        """Of every element, how many of it and those around it stay dropped."""
        n: list[int] = []
        for k, around in enumerate(self.above):
            n.append((k not in kept) + (n[around] if around >= 0 else 0))
        return n

    def kept(self, holders: list[tuple[bool, int]], blocks: list[tuple[int, int, str]]) -> set[int]:
        """Elements that are not dropped after all, as they hold the page's text.

        ``holders`` are the page's main (True) and article elements. A main
        element keeps all that surround it; an article keeps them but for
        menus, comments and the like, and these too if every article of the
        page is in such. On a page without either, a form with more words
        than all that is not dropped is the page itself.
        """
        kept: set[int] = set()

        def keep(holders: list[tuple[bool, int]], why: tuple[int, ...]) -> None:
            done: set[int] = set()
            for _, around in holders:
                for k in self.path(around):
                    if k in done:  # and so is all around it
                        break
                    done.add(k)
                    if self.why[k] in why:
                        kept.add(k)

        keep(holders, (AROUND, FORM))
        keep([h for h in holders if h[0]], (AROUND, FORM, BESIDE))
        out = self.out(kept)
        if holders and not any(around < 0 or not out[around] for _, around in holders):
            keep(holders, (AROUND, FORM, BESIDE))
        if not holders and FORM in self.why:
            words: Counter[int] = Counter()
            for _, around, text in blocks:
                n = out[around] if around >= 0 else 0
                if n < 2:  # in no dropped element, or in one
                    words[next((k for k in self.path(around) if k not in kept), -1)] += text.count(" ") + 1
            kept.update(k for k, w in enumerate(self.why) if w == FORM and words[k] > words[-1])
        return kept


def parse(page: str | None) -> list[tuple[int, str]]:
    """The blocks of a page as ``(region, text)``, in order, without empty ones; null and empty pages have none.

    A page without an article has its main element for one. Text that is never
    shown as such (scripts, styles, images, controls) is in no block. Takes
    time linear in the page, whatever its markup.
    """
    found: list[tuple[int, int, str]] = []
    stack: list[tuple[str, int, int]] = []
    opened: Counter[str] = Counter()
    dropped, holders = _Dropped(), []
    endless: set[str] = set()
    region, around, text, at = OPEN, -1, [], 0

    def close() -> None:
        if text:
            block = " ".join("".join(text).split())
            if block:
                found.append((region, around, block))
            text.clear()

    page = page or ""
    markup = _Markup(page)
    while at < len(page):
        start, end, tag, attributes = markup.next(at)
        if start > at:
            text.append(entities.unescape(page[at:start]))
        at = end
        if not tag:
            continue
        closing = tag[0] == "/"
        tag = tag[closing:]
        if tag in SKIPPED:
            if not closing and not attributes.endswith("/") and tag not in endless:
                m = SKIPPED_END[tag].search(page, at)
                end = page.find(">", m.end()) if m else -1
                if end >= 0:
                    at = end + 1
                elif tag in RAW:
                    at = len(page)
                else:
                    endless.add(tag)
            continue
        if tag in INLINE:
            if tag in ("br", "td", "th"):
                text.append(" ")
            if tag in VOID or (not closing and not attributes.strip()):
                if tag not in VOID:
                    stack.append((tag, region, around))
                    opened[tag] += 1
                continue
        else:
            close()
        if closing:
            if not opened[tag]:
                continue
            while stack:
                name = stack.pop()[0]
                opened[name] -= 1
                if name == tag:
                    break
            inner = stack[-1][1:] if stack else (OPEN, -1)
            if inner != (region, around):
                close()
                region, around = inner
        elif tag not in VOID and not attributes.endswith("/"):
            inner, out = _region(tag, attributes, region)
            if inner != region or out:
                close()
            region = inner
            if out:
                around = dropped.add(out, around)
            elif tag in ("article", "main"):
                holders.append((tag == "main", around))
            stack.append((tag, region, around))
            opened[tag] += 1
    close()
    kept = dropped.kept(holders, found) if dropped.why else set()
    out = dropped.out(kept)
    blocks = [(r if a < 0 or not out[a] else DROPPED, b) for r, a, b in found]
    if not any(r == ARTICLE for r, _ in blocks):
        blocks = [(ARTICLE if r == MAIN else r, b) for r, b in blocks]
    return [(OPEN if r == MAIN else r, b) for r, b in blocks]


def _digest(parts: list) -> int:
    """A hash of a list of numbers; 0 only for an empty one."""
    return (xxhash.xxh64_intdigest(np.array(parts, np.int64).tobytes()) | 1) - (1 << 63) if parts else 0


def parsed(pages: DataFrame, structure: bool = True) -> DataFrame:
    """``page_id, url, host, stream, content, regions, hashes, blocks`` of every row, parsed once.

    ``stream`` names all blocks of a page, ``content`` those that structure
    leaves (all, if it leaves none). Without ``structure`` every block is an open one.
    """
    ids = [pages.schema["page_id"], pages.schema["url"]]
    schema = T.StructType(list(ids)).add("host", "long").add("stream", "long").add("content", "long")
    schema = schema.add("regions", T.ArrayType(T.ByteType())).add("hashes", T.ArrayType(T.LongType())).add("blocks", T.ArrayType(T.StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                stream, content, regions, hashes, texts = [], [], [], [], []
                for page in part.column(1):
                    blocks = parse(page.as_py())
                    r = [k if structure else OPEN for k, _ in blocks]
                    h = [xxhash.xxh64_intdigest(b) - (1 << 63) for _, b in blocks]
                    stream.append(_digest(h + r))
                    content.append(_digest([x for x, k in zip(h, r, strict=True) if k != DROPPED] or h))
                    regions.append(r)
                    hashes.append(h)
                    texts.append([b for _, b in blocks])
                yield pa.RecordBatch.from_arrays(
                    [part.column(2), part.column(3), part.column(0), pa.array(stream, pa.int64()), pa.array(content, pa.int64()),
                     pa.array(regions, pa.list_(pa.int8())), pa.array(hashes, pa.list_(pa.int64())), pa.array(texts, pa.list_(pa.string()))],
                    names=[f.name for f in schema.fields],
                )

    rows = pages.select(F.xxhash64(host_of(F.col("url"))).alias("host"), "html", "page_id", "url")
    return rows.mapInArrow(run, schema)


def _places(rows: DataFrame) -> DataFrame:
    """``host, stream, content, k, hash, place`` of the blocks that may be repeated as a whole.

    ``place`` is 0 outside of articles, k or -k for the k-th block from an
    article's beginning or end (both where these overlap).
    """
    article = F.filter(F.sequence(F.lit(1), F.size("regions")), lambda k: F.element_at("regions", k) == ARTICLE)
    rows = rows.where(F.size("regions") > 0).withColumn("article", article)
    n = F.size("article")

    def at(k: Column, place: Column) -> Column:
        return F.struct((k - 1).alias("k"), F.element_at("hashes", k).alias("hash"), place.cast("int").alias("place"))

    free = F.filter(F.sequence(F.lit(1), F.size("regions")), lambda k: ~F.element_at("regions", k).isin(ARTICLE, DROPPED))
    some = F.when(n > 0, F.sequence(F.lit(1), F.least(n, F.lit(EDGE)))).otherwise(F.array().cast("array<int>"))
    parts = F.concat(
        F.transform(free, lambda k: at(k, F.lit(0))),
        F.transform(some, lambda j: at(F.element_at("article", j), j)),
        F.transform(some, lambda j: at(F.element_at("article", -j), -j)),
    )
    return rows.select("host", "stream", "content", F.explode(parts).alias("b")).select("host", "stream", "content", "b.*")


def _enough(rows: DataFrame, hosts: DataFrame, *keys: str) -> DataFrame:
    """``host`` and ``keys`` of what enough distinct pages of its host have; a negative or positive ``place`` needs a majority."""
    counted = rows.select("host", *keys, "content").distinct().groupBy("host", *keys).agg(F.count("*").alias("n")).where("n > 1")
    least = F.ceil(F.col("pages") * SHARE)
    if "place" in keys:
        least = F.when(F.col("place") == 0, least).otherwise(F.greatest(F.lit(3), F.floor(F.col("pages") / 2) + 1))
    return counted.join(sized(hosts), "host").where(F.col("n") >= least).select("host", *keys)


def _windows(block: str, host: int) -> np.ndarray:
    """The first ``RUN`` tokens of each suffix of a block, as a hash that differs by host."""
    tokens = text_words(np.frombuffer(block.encode("utf-8", "replace"), dtype=np.uint8))
    n = max(0, len(tokens) - RUN + 1)
    total = np.full(n, host, dtype=np.int64).view(np.uint64)
    for k in range(RUN):
        total = _mix(total ^ tokens[k : k + n])
    return total.view(np.int64)


def suffixes(rows: DataFrame) -> DataFrame:
    """``host, stream, content, k, starts``: per open block of a page its suffixes, by their first tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["host", "stream", "content", "k", "starts"]
        for batch in batches:
            out: list[tuple] = []
            for host, stream, content, regions, blocks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for k, (r, b) in enumerate(zip(regions, blocks, strict=True)):
                    if r == OPEN and b.count(" ") + 1 >= RUN:
                        out.append((host, stream, content, k, _windows(b, host)))
                if len(out) > 2000:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=names)

    some = rows.where(F.exists("regions", lambda r: r == OPEN)).select("host", "stream", "content", "regions", "blocks")
    return some.mapInArrow(run, "host long, stream long, content long, k long, starts array<long>")


def repeated(rows: DataFrame) -> DataFrame:
    """``host, stream, whole, covered`` of pages (rows of :func:`parsed`) with something that their host repeats.

    ``whole`` are blocks that are repeated, ``covered`` places of repeated
    substrings in others: the block, times 2 ** 32, and the token they start at.
    """
    pages = rows.where("content != 0").select("host", "content").distinct()
    hosts = written(pages.groupBy("host").agg(F.count("*").alias("pages")).where("pages > 1"), "hosts")
    places = _places(rows)
    marks = written(_enough(places, hosts, "hash", "place"), "repeated-blocks")
    whole = places.join(sized(marks), ["host", "hash", "place"], "left_semi").select("host", "stream", F.col("k").cast("long").alias("k")).distinct()
    whole = written(whole, "whole-blocks")
    # Suffixes of blocks that are no boilerplate as a whole, on hosts that have several pages.
    runs = suffixes(rows).join(sized(hosts.select("host")), "host", "left_semi").join(sized(whole), ["host", "stream", "k"], "left_anti")
    buckets = _enough(runs.select("host", "content", F.explode(F.array_distinct("starts")).alias("start")), hosts, "start")
    buckets = written(buckets, "repeated-suffixes")
    at = runs.select("host", "stream", "k", F.posexplode("starts").alias("token", "start")).join(sized(buckets), ["host", "start"], "left_semi")
    covered = at.select("host", "stream", (F.col("k") * (1 << 32) + F.col("token")).alias("at")).distinct()
    none = F.lit(None).cast("long")
    both = whole.select("host", "stream", "k", none.alias("at")).unionByName(covered.select("host", "stream", none.alias("k"), "at"))
    return both.groupBy("host", "stream").agg(F.collect_list("k").alias("whole"), F.collect_list("at").alias("covered"))


def main_text(blocks: list[tuple[int, str]], whole: list[int] | None = None, covered: list[int] | None = None) -> str:
    """The blocks that structure leaves, a block a line, without what the host repeats.

    Repeated blocks go outside of the article, and at its ends; an article
    that would be gone as a whole stays. Blocks with at least half of their
    words under repeated substrings lose these words.
    """
    gone = set(whole or ())
    article = [k for k, (r, _) in enumerate(blocks) if r == ARTICLE]
    ends: set[int] = set()
    for order in (article[:EDGE], article[: -EDGE - 1 : -1]):
        for k in order:
            if k not in gone:
                break
            ends.add(k)
    if len(ends) == len(article):
        ends = set()
    under: dict[int, set[int]] = {}
    for x in covered or ():
        under.setdefault(x >> 32, set()).update(range(x & 0xFFFFFFFF, (x & 0xFFFFFFFF) + RUN))
    out = []
    for k, (region, block) in enumerate(blocks):
        if region == DROPPED or k in (ends if region == ARTICLE else gone):
            continue
        if k in under and region == OPEN:
            words = block.split(" ")
            kept = [w for i, w in enumerate(words) if i not in under[k]]
            block = block if 2 * len(kept) > len(words) else " ".join(kept)
        out.append(block)
    return "\n".join(filter(None, out))


def extract(pages: DataFrame, structure: bool = True) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``.

    Null or empty html gives an empty text. Every row is extracted, repeated
    ones included; rows with the same text count as one page of their host.
    Other columns are not read. ``structure=False`` tells articles from
    boilerplate by what hosts repeat, and by nothing else.
    """
    rows = written(parsed(pages.select("page_id", "url", "html"), structure), "page-blocks")
    found = written(repeated(rows), "repeated")
    numbers = found.agg(F.sum(F.size("whole") + F.size("covered") + 2)).first()[0] or 0
    ids = [rows.schema["page_id"], rows.schema["url"]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = zip(*(batch.column(k).to_pylist() for k in (2, 3, 4, 5)), strict=True)
            texts = [main_text(list(zip(r, b, strict=True)), w, c) for r, b, w, c in pages]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    found = F.broadcast(found) if numbers <= BROADCAST_MARKS else found
    joined = rows.join(found, ["host", "stream"], "left").select("page_id", "url", "regions", "blocks", "whole", "covered")
    return joined.mapInArrow(run, T.StructType(list(ids)).add("text", "string").add("n_chars", "long"))
