"""Main text of web pages by tag-path ratios.

A page's blocks of text are grouped by their root-to-leaf tag path (block-level tags with their classes). Each path
gets its text length and its punctuation per node; both are smoothed along the page and multiplied, article and main
elements count double, and paths above the scores' standard deviation are content. The containers of those paths then
contribute their blocks, so short paragraphs and headings of the article stay; parts of a main element without such
a path don't, and navigation, notices, forms, comments and the like never do.
"""
from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, small_batches, table

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""(?<!\S)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""\s(?:hidden(?=[\s/=]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search section select summary table "
    "tbody td template tfoot th thead tr ul button svg canvas object video audio math label".split())
EMPTY = frozenset("hr br img input meta link area base col embed source track wbr param".split())
#: Opening one of these ends an open element of these kinds, if no other block lies between.
ENDS = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
OUT_TAGS = frozenset("nav header footer aside form head title script style noscript template iframe select button textarea svg canvas object menu dialog search fieldset label video audio math option".split())
OUT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adbox adsense banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies "
    "disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted "
    "promotion recommended related replies reply respond share sharing sidebar sidebars signup skip social sponsor sponsored subscribe toolbar "
    "topbar widget widgets".split())
#: Last words of names that say only what kind of box a listed first word has.
BOX_NAMES = frozenset(
    "area bar block body box button buttons col column container content form group holder icon icons inner item items link links list outer overlay panel "
    "post posts row section slot stories text top unit wrap wrapper zone".split())
#: First words of names that say what an element or its page has or lacks, not what it is.
STATES = frozenset("has have no not non with without is show hide hides enable disable can".split())
#: Names that no main text has, however short it is beside them.
SURE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adbox adsense breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus "
    "gdpr nav navbar navigation pagination replies reply respond sponsor sponsored".split())
#: For any other name, a larger share of the page's unlinked text isn't excluded.
NAME_SHARE = 0.5
OUT_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
#: Within main, these are parts that need a content path, unless the text is in one of KEPT_PARTS.
PARTS = frozenset("div section article".split())
KEPT_PARTS = frozenset("table pre blockquote figure dl".split())
#: What a path's score counts for within an article or main element.
WEIGHT = 2.0
PUNCTUATION = re.compile(r"[.,;:!?。，、；：！？]")
NAME_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*")


class Block:
    __slots__ = ("path", "text", "links", "out")

    def __init__(self, path: tuple[str, ...], text: str, links: int, out: bool):
        self.path, self.text, self.links, self.out = path, text, links, out


def _listed(token: str) -> str | None:
    """The listed name that a class or id stands for: it is the whole of it, its last word, or its first word before a kind of box."""
    words = [x.lower() for x in NAME_PARTS.findall(token)]
    if not words or words[0] in STATES:
        return None
    if words[-1] in OUT_NAMES:
        return words[-1]
    return words[0] if words[0] in OUT_NAMES and words[-1] in BOX_NAMES else None


def _label(tag: str, attributes: str) -> tuple[str, bool, str | None]:
    """(the tag's name in paths, whether its text is never content, the listed name that it has)."""
    out = tag in OUT_TAGS
    label = tag
    listed = None
    if attributes:
        for name, a, b, c in ATTRIBUTE.findall(attributes):
            value = a or b or c
            if name.lower() == "role":
                out = out or value.lower() in OUT_ROLES
                continue
            if name.lower() == "class":
                label += "." + ".".join(value.split())
            if tag not in ("html", "body", "main", "article"):
                names = [x for x in map(_listed, value.split()) if x]
                listed = next((x for x in names if x in SURE_NAMES), names[0] if names else listed)
        out = out or HIDDEN.search(attributes) is not None
    return label, out, listed


def blocks_of(page: str) -> list[Block]:
    """The page's blocks of text in order; white space within one is a single space, character references are decoded."""
    found: list[Block] = []
    stack: list[tuple[str, str, bool, tuple[int, ...]]] = [("", "", False, ())]
    names: list[str] = []  # of the elements with a listed name
    within: list[tuple[int, ...]] = []  # of each block, the numbers of those around it
    path: tuple[str, ...] = ()
    parts: list[str] = []
    inline_out: list[str] = []  # open inline elements whose text is never content
    linked = link = 0

    def end_block() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                found.append(Block(path, text, linked, stack[-1][2]))
                within.append(stack[-1][3])
            parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text and not inline_out:
            parts.append(text)
            if link:
                linked += len(text.strip())

    at, match = 0, TOKEN.search(page)
    while match:
        add(page[at: match.start()])
        at = match.end()
        closing, tag, attributes = match.group(1, 2, 3) if match.group(2) else match.group(4, 5, 6)
        if tag:
            tag = tag.lower()
            if not closing and tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                at = end.end() if end else len(page)
            elif tag == "br":
                add(" ")
            elif tag == "a":
                link = 0 if closing else 1
            elif tag in BLOCKS:
                end_block()
                link = 0
                inline_out.clear()
                if closing:
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k][0] == tag or tag[0] == "h" and tag[1:].isdigit() and stack[k][0][:1] == "h" and stack[k][0][1:].isdigit():
                            del stack[k:]
                            break
                else:
                    ends = ENDS.get(tag, {"p"} if tag not in ("button", "label", "svg", "object", "video", "audio", "canvas", "math") else ())
                    while len(stack) > 1 and stack[-1][0] in ends:
                        stack.pop()
                    if tag not in EMPTY and not (attributes or "").rstrip().endswith("/"):
                        label, out, listed = _label(tag, attributes)
                        around = stack[-1][3]
                        if listed:
                            names.append(listed)
                            around += (len(names) - 1,)
                        stack.append((tag, label, out or stack[-1][2], around))
                path = tuple(x[1] for x in stack[1:])
            elif not closing and tag not in EMPTY and attributes and any(_label(tag, attributes)[1:]):
                inline_out.append(tag)
            elif closing and inline_out and tag == inline_out[-1]:
                inline_out.pop()
        match = TOKEN.search(page, at)
    add(page[at:])
    end_block()
    if names:
        _exclude_named(found, within, names)
    return found


def _exclude_named(blocks: list[Block], within: list[tuple[int, ...]], names: list[str]) -> None:
    """Marks the blocks in elements with a listed name as out, unless the element has most of the page's unlinked text (all of it, for a sure name)."""
    size = [0 if b.out else max(0, len(b.text) - b.links) for b in blocks]
    share = [0] * len(names)
    for n, around in zip(size, within):
        for k in around:
            share[k] += n
    total = sum(size)
    out = [x <= NAME_SHARE * total or name in SURE_NAMES and x < total for x, name in zip(share, names)]
    for b, around in zip(blocks, within):
        b.out = b.out or any(out[k] for k in around)


def _smooth(x: np.ndarray) -> np.ndarray:
    """Gaussian smoothing with one neighbour on either side."""
    if x.size < 3:
        return x
    w = np.exp(-0.5 * np.arange(-1, 2) ** 2)
    return np.convolve(np.pad(x, 1, mode="edge"), w / w.sum(), "valid")


def main_text(page: str | None) -> str:
    """The page's main text: its content blocks in page order, one a line; empty if there is none. Null counts as empty."""
    blocks = [b for b in blocks_of(page or "") if not b.out]
    if not blocks:
        return ""
    order: dict[tuple[str, ...], int] = {}
    for b in blocks:
        order.setdefault(b.path, len(order))
    at = np.array([order[b.path] for b in blocks])
    nodes = np.bincount(at)
    length = np.bincount(at, [max(0, len(b.text) - b.links) for b in blocks])
    marks = np.bincount(at, [len(PUNCTUATION.findall(b.text)) if b.links < len(b.text) else 0 for b in blocks])
    along = [np.bincount(at, _smooth((x / nodes)[at])) / nodes for x in (length, marks + 1)]
    weight = np.array([WEIGHT if any(_tag(x) in ("article", "main") for x in p) else 1.0 for p in order])
    fused = along[0] * along[1] * np.log1p(length) * weight
    content = [p for p, ok in zip(order, fused >= min(fused.std(), fused.max())) if ok]
    roots = {p[: _depth(p)] for p in content}
    parents = {p[:-1] for p in content}
    above = {p[:k] for p in content for k in range(len(p) + 1)}
    stays = {p: _stays(p, roots, parents, above) for p in order}
    linked, size = np.bincount(at, [b.links for b in blocks]), np.bincount(at, [len(b.text) for b in blocks])
    articles = {p[: k + 1] for p in content for k, x in enumerate(p) if _tag(x) == "article"}
    for k, p in enumerate(order):  # lists of links, but not those of the article
        if p and linked[k] >= 0.8 * size[k] and _tag(p[-1]) in ("li", "ul", "ol", "div", "td") and not any(p[:j] in articles for j in range(1, len(p) + 1)):
            stays[p] = False
    return "\n".join(b.text for b in blocks if stays[b.path])


def _tag(label: str) -> str:
    return label.partition(".")[0]


def _stays(path: tuple[str, ...], roots: set[tuple[str, ...]], parents: set[tuple[str, ...]], above: set[tuple[str, ...]]) -> bool:
    """Whether a path belongs to a content container: ``parents`` hold content blocks, ``above`` are all content paths and those of the elements around them."""
    k = next((k for k in range(len(path) + 1) if path[:k] in roots), None)
    if k is None:
        return False
    if k and _tag(path[k - 1]) == "main":
        for j in range(k, len(path)):
            if path[: j + 1] in above:
                if _tag(path[j]) == "article" or path[: j + 1] in parents:
                    return True
            elif _tag(path[j]) in PARTS:
                return any(_tag(x) in KEPT_PARTS for x in path[j:])
    return True


def _depth(path: tuple[str, ...]) -> int:
    """How much of a content path is its container: up to the article or main element, else up to the block's parent."""
    for k, x in enumerate(path):
        if _tag(x) in ("article", "main"):
            return k + 1
    return max(0, len(path) - 1)


def extract(df: DataFrame, page: str = "html") -> DataFrame:
    """(row, text, n_chars) for each row of ``df``: ``row`` is a struct of all its columns but ``page``, so that no name can clash.

    Null or empty pages and pages without content give an empty text. Whole pages are parsed; equal pages give equal texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "page"):
            texts = [main_text(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=["row", "text", "n_chars"])

    rows = small_batches(df).select(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != page] or [F.lit(None).alias("none")]).alias("row"), F.col(f"`{page}`").cast("string").alias("page"))
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, text string, n_chars long")


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("row.page_id", "row.url", "text", "n_chars")
