"""Main text of web pages by tag-path ratios.

A page is cut into blocks of text, each with its tag path from the root (tags with their
classes).  Per path the text length, the punctuation and the linked characters are summed over
its blocks.  The ratios per block are smoothed along the page, so that a short heading counts
with the paragraphs around it, and fused with what the labels on the path say (an article, a
menu, a comment list).  Paths above a threshold are content, and their blocks are the text.
A page is one row, so this is one narrow pass.
"""

from __future__ import annotations

import html
import re
from math import log1p

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelab.llm.common import reachable, small_slices

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body button canvas caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav noscript object ol optgroup option p pre section select summary svg "
    "table tbody td template tfoot th thead tr ul video audio".split())
#: Tags and words in class, id or role that mark what is no part of an article.
NO_CONTENT_TAGS = frozenset("nav footer aside form button select option dialog menu noscript template svg canvas object head legend audio video".split())
NO_CONTENT = frozenset(
    "ad ads adv advert advertisement advertising adsense advertorial sponsor sponsored sponsors promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar aside footer header masthead cookie cookies consent gdpr notice notices popup modal overlay subscribe subscription newsletter signup signin "
    "login register social share sharing related recommended recommendations widget toolbar pagination pager copyright legal disclaimer skip search "
    "hidden toc outbrain taboola paywall captcha alert".split())
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies discussion review reviews feedback guestbook".split())
CONTENT_TAGS = frozenset(("article", "main"))
CONTENT = frozenset("article articlebody content main post entry story text maintext prose bodytext".split())

#: Weights of the text ratio, the punctuation ratio and the share of linked characters.
TEXT, PUNCTUATION, LINKS = 0.6, 0.8, 3.0
#: Beyond these a block counts as long and as full of punctuation as any.
LONG, FULL = 200, 4
#: What labels on a path add: an article's tag, a word for content, anything else.
PRIORS = {"container": 6.0, "content": 3.0, "plain": 0.0, "out": -30.0}
#: A path passes from here on, more where the page's best label says more.
LEAST, SHARE = 2.5, 0.35
#: Weights of a block and its neighbours on either side.
KERNEL = (0.5, 0.2, 0.05)

NAMED = re.compile(r"</?[a-zA-Z]")
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|))*+)>""")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*))""")
LABEL = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
MARKS = re.compile(r"[.,;:!?…。，、；：！？]")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Path:
    """A node of the tree of tag paths: its label, its kind by the labels above it, and sums over its blocks."""

    __slots__ = ("above", "below", "chars", "inside", "kind", "label", "links", "marks", "n", "outer", "why")

    def __init__(self, above: Path | None, label: str, kind: str, why: str):
        self.above, self.label, self.kind, self.why, self.below = above, label, kind, why, {}
        self.n = self.chars = self.marks = self.links = 0
        # Whether an article or main tag is on the path, and the label that took it out, if one did.
        self.inside = bool(above) and above.inside or label.split(".")[0] in CONTENT_TAGS
        self.outer = (above.outer if above else "") or (label if why == "label" else "")

    def __str__(self) -> str:
        names, node = [], self
        while node.above is not None:
            names.append(node.label)
            node = node.above
        return "/".join(reversed(names))


def labels_of(attributes: str) -> tuple[str, frozenset[str], bool]:
    """Class words without digits, all words of class, id and role, and whether the element is hidden."""
    classes, words, hidden = "", set(), False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next(filter(None, values), "")
        if name in ("class", "id", "role", "itemprop"):
            words.update(w.lower() for w in LABEL.findall(value))
            if name == "itemprop" and value.lower() == "articlebody":
                words.add("articlebody")
            if name == "class":
                classes = ".".join(sorted(set(LABEL.findall(value))))
        elif name == "style" and HIDDEN.search(value) or name == "aria-hidden" and value.lower() == "true":
            hidden = True
    return classes, frozenset(words), hidden or bool(re.search(r"(?:^|\s)hidden(?:\s|$|=)", attributes, re.I))


def kind_of(above: Path, tag: str, words: frozenset[str], hidden: bool, layout: bool = False) -> tuple[str, str]:
    """(kind, why) of an element below ``above``.  What is out stays out further down.

    ``layout``: its words name the page's layout and say nothing of the part.
    """
    if above.kind == "out":
        return "out", above.why
    if tag in ("html", "body"):
        return "plain", ""
    if words & COMMENTS:
        return "out", "comments"
    # An article's own header holds its title; any other header is the site's.
    if hidden or tag in NO_CONTENT_TAGS or tag == "header" and above.kind != "container":
        return "out", "tag"
    if not layout and tag not in CONTENT_TAGS and words & (NO_CONTENT if above.kind != "container" else NO_CONTENT - {"header"}):
        return "out", "label"
    if tag in CONTENT_TAGS or words & {"articlebody"}:
        return "container", ""
    if above.kind == "container" or not words & CONTENT:
        return above.kind, ""
    return "content", ""


#: Start tags that end an open element of these kinds, unless one of the others lies between.
ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), ("table",)),
        "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",))}
FENCES = frozenset("table caption td th button object template".split())


def blocks_of(page: str, layout: frozenset[str] = frozenset()) -> list[tuple[Path, str, int]]:
    """(path, text, linked characters) of every block, in page order; labels in ``layout`` are no reason to leave.

    Reads the page once from left to right; unclosed tags, quotes, comments and scripts end with
    the page at the latest.
    """
    top = Path(None, "", "plain", "")
    stack: list[tuple[str, Path]] = [("", top)]
    open_tags: dict[str, int] = {}
    paragraphs, fences = [], [0]  # depths of open paragraphs, and of elements that keep them open
    found: list = []
    held: list[str] = []
    linked, link_depth = 0, 0

    def flush():
        nonlocal linked
        if held:
            text = " ".join("".join(held).split())
            if text:
                found.append((stack[-1][1], text, min(linked, len(text))))
            held.clear()
        linked = 0

    def close(depth):
        nonlocal link_depth
        flush()
        while len(stack) > depth:
            open_tags[stack.pop()[0]] -= 1
        for depths in (paragraphs, fences):
            while depths and depths[-1] >= len(stack):
                depths.pop()
        if link_depth > len(stack):
            link_depth = 0

    def add(text):
        nonlocal linked
        if text:
            text = html.unescape(text) if "&" in text else text
            held.append(text)
            if link_depth:
                linked += len(text.strip())

    at, n = 0, len(page)
    while at < n:
        start = page.find("<", at)
        if start < 0:
            add(page[at:])
            break
        add(page[at:start])
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = n if end < 0 else end + 3
            continue
        if not NAMED.match(page, start):
            # Declarations and broken end tags go, a bare < is text.
            if page[start + 1 : start + 2] in ("!", "?", "/"):
                end = page.find(">", start)
                at = n if end < 0 else end + 1
            else:
                add("<")
                at = start + 1
            continue
        match = TAG.match(page, start)
        if not match:
            break  # a tag that never ends takes the rest with it
        at = match.end()
        closing, tag, attributes = match[1], match[2].lower(), match[3]
        if closing:
            if tag == "a":
                link_depth = 0
            elif tag in ("br", "p") and not open_tags.get(tag):
                flush()
            elif open_tags.get(tag):
                depth = len(stack) - 1
                while stack[depth][0] != tag:
                    depth -= 1
                close(depth)
            continue
        if tag in RAW and not attributes.rstrip().endswith("/"):
            end = re.compile(rf"</{tag}(?=[\s/>]|$)", re.I).search(page, at)
            if not end:
                at = n
            else:
                stop = page.find(">", end.end())
                at = n if stop < 0 else stop + 1
            continue
        if tag in ("br", "hr"):
            flush()
            continue
        if tag in VOID:
            continue
        classes, words, hidden = labels_of(attributes) if "=" in attributes or "hidden" in attributes else ("", frozenset(), False)
        above = stack[-1][1]
        if tag not in BLOCKS:
            kind, why = kind_of(above, tag, words, hidden) if words or hidden else (above.kind, above.why)
            if kind != "out" or above.kind == "out":
                if tag == "a":
                    link_depth = len(stack)
                continue
        elif paragraphs and paragraphs[-1] > fences[-1]:
            close(paragraphs[-1])  # a block ends an open paragraph
        if tag in ENDS:
            ended, kept = ENDS[tag]
            depth, cut = len(stack) - 1, 0
            while depth and stack[depth][0] not in kept and stack[depth][0] in BLOCKS and not cut and len(stack) - depth <= 32:
                if stack[depth][0] in ended and (tag != "tr" or stack[depth][0] == "tr"):
                    cut = depth
                depth -= 1
            if cut:
                close(cut)
        flush()
        above = stack[-1][1]
        label = f"{tag}.{classes}" if classes else tag
        kind, why = kind_of(above, tag, words, hidden, label in layout)
        key = (label, kind)
        if key not in above.below:
            above.below[key] = Path(above, label, kind, why)
        if tag == "p":
            paragraphs.append(len(stack))
        elif tag in FENCES:
            fences.append(len(stack))
        stack.append((tag, above.below[key]))
        open_tags[tag] = open_tags.get(tag, 0) + 1
    flush()
    return found


def smoothed(values: list[float]) -> list[float]:
    """Weighted means along the page; at its ends the weights that are left count."""
    n, out = len(values), []
    for i in range(n):
        total = weight = 0.0
        for step, w in enumerate(KERNEL):
            for j in {i - step, i + step}:
                if 0 <= j < n:
                    total += w * values[j]
                    weight += w
        out.append(total / weight)
    return out


def scored(blocks: list[tuple[Path, str, int]]) -> tuple[dict[Path, float], float]:
    """The fused score of every path and the page's threshold."""
    for path, text, links in blocks:
        path.n += 1
        path.chars += len(text)
        path.links += links
        path.marks += len(MARKS.findall(text))
    inside = [b for b in blocks if b[0].kind != "out"]
    lengths = smoothed([log1p(min(p.chars / p.n, LONG)) for p, _, _ in inside])
    marks = smoothed([log1p(min(p.marks / p.n, FULL)) for p, _, _ in inside])
    sums: dict[Path, float] = {}
    for (path, _, _), length, mark in zip(inside, lengths, marks):
        sums[path] = sums.get(path, 0.0) + TEXT * length + PUNCTUATION * mark
    scores = {p: total / p.n - LINKS * p.links / p.chars + PRIORS[p.kind] for p, total in sums.items()}
    scores |= {p: PRIORS["out"] for p, _, _ in blocks if p.kind == "out"}
    best = max((PRIORS[p.kind] for p in sums), default=0.0)
    return scores, LEAST + SHARE * best


def layout_labels(blocks: list[tuple[Path, str, int]]) -> frozenset[str]:
    """Labels that took the page's article out: they name a layout, not a part.

    That is where more text of article and main tags lies below the label than is left without it,
    and at least half as much as is left at all.
    """
    out: dict[str, int] = {}
    inside = left = 0
    for path, text, _ in blocks:
        if path.why == "label" and path.inside:
            out[path.outer] = out.get(path.outer, 0) + len(text)
        elif path.kind != "out":
            left += len(text)
            inside += len(text) * path.inside
    return frozenset(label for label, chars in out.items() if chars > inside and 2 * chars > left)


def parts_of(page: str) -> list[tuple[Path, str, int]]:
    blocks = blocks_of(page)
    layout = layout_labels(blocks)
    return blocks_of(page, layout) if layout else blocks


def main_text(page: str | None) -> str:
    if not page:
        return ""
    blocks = parts_of(page)
    scores, least = scored(blocks)
    return " ".join(text for path, text, _ in blocks if scores[path] >= least)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages``.

    Null, empty and markup-only pages have the empty text; null ids and urls are kept, repeated
    rows keep their rows, other columns are ignored.
    """
    reachable(pages.sparkSession)

    def run(batches):
        for batch in small_slices(batches, "html"):
            texts = [main_text(page) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kept = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return kept.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def path_ratios(pages: DataFrame) -> DataFrame:
    """(page_id, path, kind, n_blocks, chars, marks, links, score, chosen) of every tag path, to see why text was kept."""
    reachable(pages.sparkSession)

    def run(batches):
        for batch in small_slices(batches, "html"):
            rows = []
            for page_id, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                scores, least = scored(parts_of(page or ""))
                rows += [(page_id, str(p), p.kind, p.n, p.chars, p.marks, p.links, s, s >= least) for p, s in scores.items()]
            if rows:
                types = [pa.int64(), pa.string(), pa.string(), *[pa.int64()] * 4, pa.float64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["page_id", "path", "kind", "n_blocks", "chars", "marks", "links", "score", "chosen"])

    kept = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html"))
    return kept.mapInArrow(run, "page_id long, path string, kind string, n_blocks long, chars long, marks long, links long, score double, chosen boolean")
