"""Main text of web pages by a site style tree: what all pages of a host repeat is unimportant.

Pages of a host are merged by the paths of their elements. For every path the
entropy of its presentation (the sequence of child elements) and of its content (how evenly the
same text lies on all pages) gives an importance; branches of low importance are cut from
each page. What an element says of itself counts first: navigation, forms, adverts and the
like are unimportant by their tag or class, ``article`` and ``main`` are important.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberscope.llm.common import steps, stored


@dataclass(frozen=True)
class Settings:
    """Branches below ``least`` are cut; ``damping`` is the weight that content keeps for each style a node is seen with."""

    least: float = 0.3
    damping: float = 0.9


# Element names of HTML by what they mean for running text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript iframe textarea svg math title object canvas audio video".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split()
)
NOISE_TAGS = frozenset("nav footer aside form button select option dialog menu head fieldset".split())
NOISE_WORDS = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header login masthead menu "
    "modal nav navbar navigation newsletter notice notices popup promo promotion related search share sharing sidebar signup social sponsor sponsored subscribe "
    "toolbar widget".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
# Of these, words that also name headlines and sections of an article; there, like parts of longer names, they only cut with the tree.
UNSURE_WORDS = frozenset("banner footer header masthead menu notice notices promo promotion related search sidebar toolbar widget".split())
# Parts of longer class names that mean noise inside an article, where such a name does not begin with one of NEGATIONS.
SURE_PARTS = NOISE_WORDS - UNSURE_WORDS - {"consent", "login"}
LISTINGS = frozenset("articles content items links news posts reading stories".split())
NEGATIONS = frozenset("has is no non not with without".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Raw elements whose content is never markup: without an end they last to the end of the page.
ONLY_TEXT = frozenset("script style textarea title iframe".split())
MAIN_TAGS = frozenset(("article", "main"))
CLOSED_BY_BLOCK = frozenset(("p",))
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?|[\"'=/]")
_SELF_CLOSED = re.compile(r"(?:^|[\s\"'])/\s*\Z|(?:^|\s)[^\s=\"']+/\s*\Z")
_PARTS = re.compile(r"[^a-z0-9]+")


def _attributes(rest: str) -> dict[str, str]:
    """Attributes of a tag by their whole names in lower case; the first of a name counts."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(rest):
        if m[1]:
            found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return found


def _raw_ends(page: str, tag: str) -> dict[int, int]:
    """Where each raw element of a tag that is closed begins and ends, in one pass; elements may lie in each other."""
    ends, open_ = {}, []
    for m in _TOKEN.finditer(page):
        if (m["tag"] or "").lower() != tag:
            continue
        if m["close"]:
            if open_:
                ends[open_.pop()] = m.end()
        elif not _SELF_CLOSED.search(m["rest"]):
            open_.append(m.start())
    return ends


def _tokens(page: str) -> Iterator[tuple[re.Match[str], int]]:
    """Tags and comments, and where each ends; a raw element ends with its closing tag, or at its own tag if that closes itself."""
    at, ends = 0, {}
    while token := _TOKEN.search(page, at):
        at, tag = token.end(), (token["tag"] or "").lower()
        if tag in RAW and not token["close"] and not _SELF_CLOSED.search(token["rest"]):
            if tag in ONLY_TEXT:
                last = _RAW_END[tag].search(page, at)
                at = last.end() if last else len(page)
            else:
                if tag not in ends:
                    ends[tag] = _raw_ends(page, tag)
                at = ends[tag].get(token.start(), at)
        yield token, at


_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in ONLY_TEXT}


def host(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").removeprefix("www.")
    except ValueError:
        return ""


@dataclass
class Node:
    tag: str
    path: int
    noise: bool
    main: bool
    unsure: bool
    doubt: int
    children: list[str]


@dataclass
class Block:
    """Text of one block with the paths above it, outermost first; ``unsure`` are those whose class inside the article may mean noise.

    ``doubts`` number the branches of the page whose class names noise in a longer word.
    """

    text: str
    paths: tuple[int, ...]
    noise: bool
    main: bool
    unsure: tuple[int, ...] = ()
    doubts: tuple[int, ...] = ()


def _doubtful(tag: str, names: str, is_id: bool) -> bool:
    """Whether class names (or an id) of an element inside an article hold a noise word in a longer name, or are a sidebar's.

    Headings are text whatever their names; ids of sections are often made from headings.
    """
    if tag in HEADINGS or is_id and tag == "section":
        return False
    for name in names.split():
        parts = [w for w in _PARTS.split(name) if w]
        if name == "sidebar" or len(parts) > 1 and parts[0] not in NEGATIONS and (SURE_PARTS.intersection(parts) - {"related"} or "related" in parts and LISTINGS.intersection(parts) or "sidebar" in parts):
            return True
    return False


def parse(page: str) -> tuple[list[Block], list[tuple[int, int]]]:
    """Blocks of a page in order, and for each element path a hash of the styles (child sequences) it has there.

    Unclosed and stray tags are tolerated; comments, scripts and other raw elements are dropped; references are decoded.
    """
    root = Node("", 0, False, False, False, 0, [])
    stack, blocks, styles, words, doubts = [root], [], {}, [], 0

    def flush() -> None:
        text = " ".join("".join(words).split())
        words.clear()
        if text:
            named = tuple(n.doubt for n in stack if n.doubt)
            blocks.append(Block(text, tuple(n.path for n in stack[1:]), any(n.noise for n in stack), any(n.main for n in stack), tuple(n.path for n in stack if n.unsure), named))

    def close(down_to: int) -> None:
        while len(stack) > down_to:
            node = stack.pop()
            styles.setdefault(node.path, []).append(">".join(dict.fromkeys(node.children)))

    at = 0
    for token, end in _tokens(page):
        if token.start() > at:
            words.append(html.unescape(page[at : token.start()]))
        at = end
        tag = (token["tag"] or "").lower()
        if not tag or tag in INLINE or tag in RAW:
            continue
        flush()
        if tag in VOID:
            continue
        if token["close"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
            continue
        shut = SIBLINGS.get(tag, ())
        while len(stack) > 1 and (stack[-1].tag in CLOSED_BY_BLOCK or stack[-1].tag in shut):
            close(len(stack) - 1)
        names, noise, main = [], tag in NOISE_TAGS, tag in MAIN_TAGS
        inside = any(n.main for n in stack)
        noise = noise or tag == "header" and not inside
        unsure = doubtful = False
        given = _attributes(token["rest"]) if token["rest"] else {}
        noise = noise or "hidden" in given
        roles = given.get("role", "").lower().split()
        noise, main = noise or bool(NOISE_ROLES.intersection(roles)), main or "main" in roles
        for is_id, value in enumerate((given.get("class", "").lower(), given.get("id", "").lower())):
            found = [w for w in _PARTS.split(value) if w]
            names += [w for w in found if not any(c.isdigit() for c in w)]
            if tag not in ("html", "body") and not main and NOISE_WORDS.intersection(found):
                if not inside or (NOISE_WORDS - UNSURE_WORDS).intersection(value.split()):
                    noise = True
                else:
                    unsure, doubtful = True, doubtful or _doubtful(tag, value, bool(is_id))
        name = ".".join([tag, *sorted(set(names))])
        stack[-1].children.append(name)
        doubts += doubtful
        stack.append(Node(tag, xxhash.xxh64_intdigest(f"{stack[-1].path}/{name}") >> 1, noise, main, unsure, doubts if doubtful else 0, []))
    if at < len(page):
        words.append(html.unescape(page[at:]))
    flush()
    close(1)
    return blocks, [(p, xxhash.xxh64_intdigest("|".join(s)) >> 1) for p, s in styles.items()]


def main_text(page: str, low: set[int]) -> str:
    """Blocks joined by a space, without those that are noise or under a path of low importance.

    Where an element calls itself the article, only text inside such elements counts. The site's statistics cut it only where a class may mean noise.
    A branch whose class names noise in a longer word (``comment-list``, ``ad_banner``) is cut there without
    statistics, unless it holds most of the article's text.
    """
    blocks, _ = parse(page)
    kept = [b for b in blocks if not b.noise]
    if any(b.main for b in kept):
        article = [b for b in kept if b.main]
        held: Counter[int] = Counter()
        for b in article:
            for d in b.doubts:
                held[d] += len(b.text)
        half = sum(len(b.text) for b in article) / 2
        noise = {d for d, n in held.items() if n <= half}
        return " ".join(b.text for b in article if not noise.intersection(b.doubts) and not low.intersection(b.unsure))
    return " ".join(b.text for b in kept if not low.intersection(b.paths))


def nodes(pages: DataFrame) -> DataFrame:
    """A row for each page (key), element path and text under it: host, path, style, content, all hashes.

    A path without text has one row with content null.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "html"):
                out: list[tuple] = []
                for key, url, page in zip(*(part.column(c).to_pylist() for c in ("key", "url", "html")), strict=True):
                    blocks, styles = parse(page or "")
                    site = xxhash.xxh64_intdigest(host(url)) >> 1
                    under: dict[int, set[int]] = {p: set() for p, _ in styles}
                    for b in blocks:
                        content = xxhash.xxh64_intdigest(b.text) >> 1
                        for p in b.paths:
                            under[p].add(content)
                    for p, style in styles:
                        out += [(key, site, p, style, c) for c in under[p] or (None,)]
                columns = list(zip(*out, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["key", "host", "path", "style", "content"])

    return pages.select("key", "url", "html").mapInArrow(emit, "key long, host long, path long, style long, content long")


def importance(found: DataFrame, s: Settings) -> DataFrame:
    """host, path, pages and importance (0 to 1) of every element path of every host.

    With m pages and l styles of shares p: the presentation counts as -sum p log_m p, the
    content as one less the mean of log_m k over texts that lie on k pages. Content keeps
    the weight damping ** l. A path on one page has importance 1.
    """
    once = found.select("host", "path", "style", "key").distinct().groupBy("host", "path", "style").agg(F.count("*").alias("n"))
    shown = once.groupBy("host", "path").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("nlogn"), F.count("*").alias("l"))
    text = found.where("content IS NOT NULL").groupBy("host", "path", "content").agg(F.count("*").alias("k"))
    text = text.groupBy("host", "path").agg((F.sum(F.col("k") * F.log("k")) / F.sum("k")).alias("logk"))
    base = F.log(F.col("m").cast("double"))
    style = (base - F.col("nlogn") / F.col("m")) / base
    content = F.lit(1.0) - F.coalesce("logk", F.lit(0.0)) / base
    keep = F.pow(F.lit(s.damping), "l")
    both = F.when(F.col("m") <= 1, F.lit(1.0)).otherwise((F.lit(1.0) - keep) * style + keep * content)
    return shown.join(text, ["host", "path"], "left").select("host", "path", F.col("m").alias("pages"), both.alias("importance"))


def extract(pages: DataFrame, s: Settings = Settings()) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages`` (page_id, url, html, any others).

    A null or empty page, and one without main text, has the empty text; pages without a host share one. Equal rows give equal
    results, once each. The page is parsed twice, for the site's statistics and for its
    text; between, only hashes are kept, and compressed pages meet the list of their unimportant paths.
    """
    keyed = pages.select("page_id", "url", "html", F.xxhash64("page_id", "url", "html").alias("key"))
    found = stored(nodes(keyed), "nodes")
    low = stored(importance(found, s).where(F.col("importance") < s.least).select("host", "path"), "unimportant")
    cut = found.select("key", "host", "path").join(low, ["host", "path"]).groupBy("key").agg(F.collect_set("path").alias("low"))

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for part in steps(batch, "html"):
                small = pa.array([press((h or "").encode()) for h in part.column("html").to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("page_id", "url", "key")), small], ["page_id", "url", "key", "html"])

    kinds = {f.name: f.dataType.simpleString() for f in keyed.schema}
    small = keyed.mapInArrow(shrink, f"page_id {kinds['page_id']}, url string, key long, html binary")
    both = small.join(cut, "key", "left").select("page_id", "url", "html", "low")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [main_text(open_(h).decode(), set(low or ())) for h, low in zip(part.column("html").to_pylist(), part.column("low").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return both.mapInArrow(read, f"page_id {kinds['page_id']}, url string, text string, n_chars long")
