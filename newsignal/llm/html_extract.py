"""Main text of web pages, without what recurs over a host's pages (operator 5)."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from newsignal.llm import common

MIN_PAGES = 5
BORDER_SHARE = 0.05
MIN_SHARE = 0.2

# Element kinds of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe textarea title svg math object".split())
BLOCKS = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
# Elements that close an open element of the listed kinds when they start.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
SCOPES = set("article aside body div dl footer form header main nav ol section table td th ul".split())
NOT_CONTENT = set(
    "nav footer aside form head button select dialog menu header script style noscript template "
    "iframe textarea svg math object".split()
)
NOT_CONTENT_ROLES = set(
    "navigation banner contentinfo complementary search form dialog alert menu menubar alertdialog".split()
)
# Words of class and id names of boilerplate.
NOT_CONTENT_NAMES = set(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies disqus footer header masthead menu menus modal nav navbar "
    "navigation newsletter notice notices pagination popup promo promoted promotion related share "
    "sharing sidebar sidebars skip social sponsor sponsored subscribe subscription toolbar widget".split()
)
# Words that may stand before and after them in one class name; any other word makes it another name.
BEFORE_NAMES = set("site page main top bottom left right global primary secondary reader user article post js".split())
AFTER_NAMES = set(
    "area bar block box button buttons container content form icons inner item items label link links list "
    "message overlay panel section signup slot text thread unit wrap wrapper".split()
)
ROOTS = {"article", "main"}
# Wrappers whose article is the page's own if there is no other.
OPEN_WRAPPERS = {"form", "dialog", "header"}

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*>|</\s*([a-zA-Z][^\s/>]*)[^>]*>|<([a-zA-Z][^\s/>]*)", re.S
)
# The rest of a tag: a value in quotes may hold anything, a quote elsewhere is a sign like others.
REST = re.compile(
    r"""((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*+)?+)?+)*+)>"""
)
ATTRIBUTE = re.compile(r"""([^\s/>=][^\s/>=]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*))""")
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
OWN, ROOTED, WRAPPED = 0, 1, 2  # where a block stands: anywhere, in an article, in one inside a wrapper


class Element:
    __slots__ = ("tag", "hidden", "place", "pieces", "first", "number")

    def __init__(self, tag: str, hidden: bool | None, place: int, first: int):
        self.tag, self.hidden, self.place, self.first = tag, hidden, place, first
        self.pieces: list[str] = []  # hashes and texts below, in order
        self.number = -1


def names_boilerplate(name: str) -> str | None:
    """The word of NOT_CONTENT_NAMES that a class or id name consists of, with words of its place.

    ``site-footer`` and ``commentList`` do, ``has-sidebar`` and ``social-sciences`` do not.
    """
    parts = [x.lower() for x in NAME_PART.findall(name)]
    while parts and parts[0] in BEFORE_NAMES:
        parts = parts[1:]
    found = parts[0] if parts and parts[0] in NOT_CONTENT_NAMES else None
    rest = set(parts[1:]) - NOT_CONTENT_NAMES - AFTER_NAMES
    return found if not any(not x.isdigit() for x in rest) else None


def boilerplate(tag: str, attributes: str, in_root: bool) -> str | None:
    """What says of an element that it is no article text: its kind, role, name, or nothing.

    A header inside an article holds the article's own title.
    """
    if tag in NOT_CONTENT and not (tag == "header" and in_root):
        return tag
    if not attributes or tag in ("html", "body", "article", "main"):
        return None
    for name, *values in ATTRIBUTE.findall(attributes):
        value = next((v for v in values if v), "")
        name = name.lower()
        if name == "role" and value.lower() in NOT_CONTENT_ROLES:
            return value.lower()
        if name in ("class", "id"):
            for word in value.split():
                found = names_boilerplate(word)
                if found and not (in_root and found == "header"):
                    return found
    return "hidden" if HIDDEN.search(attributes) else None


class Page:
    """Blocks of a page, and the hashes of the subtrees that hold them.

    A block is (text, place); a subtree is (hash, first block, behind the last).  Of
    subtrees around the same blocks only the innermost is kept.  Reading takes time in
    proportion to the page, however deep its elements are nested.
    """

    def __init__(self, source: str):
        self.blocks: list[tuple[str, int]] = []
        self.subtrees: list[tuple[int, int, int]] = []
        self.stack: list[Element] = [Element("", None, OWN, 0)]
        self.text: list[str] = []
        self.read(source)

    def read(self, source: str) -> None:
        at, end, last = 0, len(source), source.rfind(">")
        while at < end:
            found = TOKEN.search(source, at) if at < last else None
            if found is None:
                self.add(source[at:].split("<!--")[0])
                break
            if found.start() > at:
                self.add(source[at : found.start()])
            at = found.end()
            closing, opening = found.group(1), found.group(2)
            if closing:
                self.close(closing.lower())
            elif opening:
                tag, rest = opening.lower(), REST.match(source, at)
                if rest is None:  # no end of the tag: text like any other
                    self.add(found.group(0))
                    continue
                at = rest.end()
                if tag in RAW and not rest.group(1).endswith("/"):
                    stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                    at = stop.end() if stop else end
                else:
                    self.start(tag, rest.group(1))
        self.flush()
        while len(self.stack) > 1:
            self.pop()

    def add(self, text: str) -> None:
        if not self.stack[-1].hidden:
            self.text.append(text)

    def flush(self) -> None:
        """Ends the block that is being read."""
        if self.text:
            block = " ".join(html.unescape("".join(self.text)).split())
            self.text = []
            if block:
                self.stack[-1].pieces.append(block)
                self.blocks.append((block, self.stack[-1].place))

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.add(" ")
            return
        if tag in BLOCKS:
            self.flush()
            self.close_implied(tag)
        if tag in VOID or attributes.endswith("/"):
            return
        above = self.stack[-1]
        root = tag in ROOTS or 'role="main"' in attributes
        hidden = above.hidden or boilerplate(tag, attributes, above.place != OWN)
        place = above.place
        if root and above.hidden in OPEN_WRAPPERS:
            hidden, place = None, WRAPPED
        elif root and not hidden and place == OWN:
            place = ROOTED
        if hidden and not above.hidden and self.text:
            self.text.append(" ")
        self.stack.append(Element(tag, hidden, place, len(self.blocks)))

    def close_implied(self, tag: str) -> None:
        """Ends elements that the start of a block ends: an open p, or a sibling item."""
        kinds = CLOSES.get(tag, set()) | {"p"} if tag not in ("html", "body", "head") else set()
        for depth in range(len(self.stack) - 1, 0, -1):
            here = self.stack[depth].tag
            if here in kinds:
                while len(self.stack) > depth:
                    self.pop()
                return
            if here in SCOPES:
                return

    def close(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag == tag:
                while len(self.stack) > depth:
                    self.pop()
                return
            if self.stack[depth].tag in SCOPES and tag not in BLOCKS:
                return

    def pop(self) -> None:
        done = self.stack[-1]
        if done.tag in BLOCKS:
            self.flush()
        self.stack.pop()
        digest = xxhash.xxh64_intdigest("\0".join([done.tag, *done.pieces])) - 2**63
        self.stack[-1].pieces.append(str(digest))
        behind = len(self.blocks)
        if done.tag in BLOCKS and behind > done.first:
            if not self.subtrees or self.subtrees[-1][1:] != (done.first, behind):
                self.subtrees.append((digest, done.first, behind))

    def candidates(self) -> tuple[list[str], list[tuple[int, int, int]]]:
        """The blocks that may be the page's own, and the subtrees around them.

        Blocks in an article where the page has one; else those of an article that a form
        or the like wraps, if they hold more text than all others; else all.
        """
        places = {place for _, place in self.blocks}
        sizes = dict.fromkeys((OWN, ROOTED, WRAPPED), 0)
        for text, place in self.blocks:
            sizes[place] += len(text)
        chosen = ROOTED if ROOTED in places else WRAPPED if sizes[WRAPPED] > sizes[OWN] else OWN
        before = [0]
        for _, place in self.blocks:
            before.append(before[-1] + (place == chosen))
        kept = [(h, before[a], before[b]) for h, a, b in self.subtrees if before[b] > before[a]]
        return [t for t, place in self.blocks if place == chosen], kept


def name_of(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - 2**63


def read_page(source: str) -> tuple[list[str], list[dict], int]:
    """The candidate blocks of a page, the subtrees whose recurrence can delete them, a hash of the texts.

    ``rest`` of a subtree names what else the page holds: the hash of the longest block
    outside of it.  A subtree with nothing beside it is the whole text and never one of a
    template.
    """
    blocks, found = Page(source).candidates()
    names = [(len(t), name_of(t)) for t in blocks]
    before, behind = [(0, 0)], [(0, 0)]  # the longest block before and behind each place
    for name in names:
        before.append(max(before[-1], name))
    for name in reversed(names):
        behind.append(max(behind[-1], name))
    subtrees = []
    for digest, first, end in found:
        size, rest = max(before[first], behind[len(blocks) - end])
        if size:
            subtrees.append({"hash": digest, "rest": rest, "first": first, "end": end})
    return blocks, subtrees, name_of("\0".join(blocks))


PARSED = (
    "page_id long, url string, key long, host string, blocks array<string>, "
    "subtrees array<struct<hash:long,rest:long,first:int,end:int>>, content long"
)


def parsed(pages: DataFrame) -> DataFrame:
    """Blocks and subtrees of each page; ``key`` tells pages apart that share a page_id."""
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subtree = pa.struct([("hash", pa.int64()), ("rest", pa.int64()), ("first", pa.int32()), ("end", pa.int32())])
        for whole in batches:
            for batch in common.slices(whole, "html"):
                read = [read_page(h or "") for h in batch.column("html").to_pylist()]
                columns = [batch.column(c) for c in ("page_id", "url", "key", "host")] + [
                    pa.array([r[0] for r in read], pa.list_(pa.string())),
                    pa.array([r[1] for r in read], pa.list_(subtree)), pa.array([r[2] for r in read], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, names=["page_id", "url", "key", "host", "blocks", "subtrees", "content"]
                )

    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[^/]*//([^/:?#]+)", 1))
    rows = pages.select(
        F.col("page_id").cast("long"), "url", F.xxhash64("url", "html").alias("key"),
        host.alias("host"), F.coalesce("html", F.lit("")).alias("html"),
    )
    return rows.mapInArrow(parse, PARSED)


def own_blocks(blocks: list[str], gone: list[dict] | None) -> list[str]:
    """The blocks that no recurring subtree takes.

    Blocks of ``border`` subtrees go where they lie before the first or after the last block
    in none of them, all others of ``gone`` anywhere.  A text that stays somewhere on the
    page stays everywhere, and a page without a block of its own stays whole.
    """
    if not gone:
        return blocks
    often, anywhere = [0] * (len(blocks) + 1), [0] * (len(blocks) + 1)
    for g in gone:
        for marks in (often,) if g["border"] else (often, anywhere):
            marks[g["first"]] += 1
            marks[g["end"]] -= 1
    often, anywhere = list(accumulate(often[:-1])), list(accumulate(anywhere[:-1]))
    own = [i for i, n in enumerate(often) if not n]
    if not own:
        return blocks
    kept = [not often[i] or own[0] < i < own[-1] and not anywhere[i] for i in range(len(blocks))]
    texts = {t for t, k in zip(blocks, kept) if k}
    return [t for t in blocks if t in texts]


def exploded(pages: DataFrame) -> DataFrame:
    """A row per subtree; ``name`` is the same for equal subtrees of a host."""
    return pages.select("page_id", "key", "host", F.explode("subtrees").alias("s")).select(
        "page_id", "key", "host", F.xxhash64("host", "s.hash").alias("name"), "s.rest", "s.first", "s.end"
    )


def template_subtrees(pages: DataFrame, min_pages: int) -> DataFrame:
    """(name, n) of subtrees that stand beside ``min_pages`` or more different texts of a host.

    Copies of a page, and near copies that share their longest block, have one text beside
    each subtree, so they count as one page.  Counts are combined before the shuffle, so one
    host may hold most pages; only what stands on enough pages is counted by text.
    """
    found = exploded(pages)
    often = found.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_pages).select("name")
    often = common.written(often, "often")
    return (
        found.select("name", "rest").join(often, "name", "left_semi").distinct()
        .groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_pages)
    )


def main_text(
    pages: DataFrame, min_pages: int = MIN_PAGES, border_share: float = BORDER_SHARE, min_share: float = MIN_SHARE,
) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Blocks of boilerplate elements are left out, then those inside subtrees that recur over
    the pages of the host, in an article and outside.  A subtree recurs if it stands beside
    different texts on ``min_pages`` pages and on ``border_share`` of the host's different
    pages: its blocks go where they lie before the first or after the last block of the
    page's own.  On ``min_share`` of the pages they go between own blocks as well.  Equal
    blocks of a page go together or stay together, and a page without a block of its own
    stays whole.  White space within a block becomes one blank; blocks are joined by a line
    feed in page order.  A page without text, or with null html, gives "".  Pages without a
    host share the empty one; equal pages have a row each.

    Pages are parsed twice: first for their subtrees only, which are small and written,
    then for their text, which is shuffled once and never stored in between.
    """
    subtrees = common.written(parsed(pages).select("page_id", "key", "host", "subtrees", "content"), "subtrees")
    templates = common.written(template_subtrees(subtrees, min_pages), "templates")
    sizes = subtrees.select("host", "content").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"))
    gone = (
        exploded(subtrees).join(templates, "name").join(common.written(sizes, "hosts"), "host")
        .filter(F.col("n") >= border_share * F.col("n_pages"))
        .groupBy(F.col("page_id").alias("gone_id"), F.col("key").alias("gone_key"))
        .agg(F.collect_set(F.struct("first", "end", (F.col("n") < min_share * F.col("n_pages")).alias("border"))).alias("gone"))
    )
    read = parsed(pages).select("page_id", "url", "key", "blocks")
    same = read["page_id"].eqNullSafe(gone["gone_id"]) & (read["key"] == gone["gone_key"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                "\n".join(own_blocks(blocks or [], found))
                for blocks, found in zip(batch.column("blocks").to_pylist(), batch.column("gone").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    joined = read.join(gone, same, "left").select("page_id", "url", "blocks", "gone")
    out = joined.mapInArrow(join, "page_id long, url string, text string")
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
