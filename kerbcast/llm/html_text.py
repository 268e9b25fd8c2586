"""Main text of web pages by block rules in two passes.

A page is cut into blocks at block-level tags. The first pass decides blocks by their marks (menus, headers,
footers, sidebars, notices, adverts, forms, reader comments), link density, length and stop-word density; what
is short or in between stays open. The second pass gives open blocks the label of the nearest decided ones.
Article and main elements that hold most of a page's text lower the limits for the blocks inside them.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbcast.llm.common import slices

GOOD, BAD, OPEN = 1, -1, 0
LIKELY, SURE = 1, 2
#: A likely mark on an element that holds more than this share of a page's text means nothing.
WRAPPER = 0.5
#: Code points; a block below the first is short, one above the second needs less evidence.
SHORT, LONG = 70, 200
LINKS_MOST = 0.33
STOP_LEAST, STOP_HIGH = 0.10, 0.25

#: Frequent function words (English, French, German, Spanish).
STOP_WORDS = frozenset("""
the of and to in is that for it was with as be by on not he this are or his from at which but have an had they you were
their one all we can her has there been if more when will would who so no a
le la les de des du un une et est en que qui dans pour pas sur au avec ce il par plus ne se son elle ou mais nous sont
der die das und ist von zu mit den im nicht ein eine als auch es an auf für dem sich aus er hat dass sie nach wird bei
el los las y del se con para una su lo como más o pero sus le ya al este sí porque esta entre cuando muy sin sobre
""".split())
#: Elements whose content is never text of the article.
SILENT = frozenset("script style noscript template svg math iframe object canvas audio video select textarea title head option".split())
RAW = frozenset("script style textarea title".split())
OUTER = frozenset("nav footer aside menu dialog button label".split())
FORMS = frozenset("form fieldset".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr
ul option select caption""".split()) - {"br"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
INNER = frozenset("article main".split())
PAGE = frozenset("html body main".split())
LAYOUT = frozenset("has with no without".split())
#: Names that mark a whole article element outside any other; compounds of them do not.
CARDS = frozenset("ad ads advert sponsored promo teaser related comment comments reply replies".split())
#: Words in class, id or role that mark boilerplate.
MARKS = frozenset("""ad ads advert advertisement adverts adsense sponsor sponsored promo promotion banner cookie cookies consent
gdpr notice notices alert popup modal newsletter subscribe signup comment comments reply replies disqus respond sidebar
navigation nav navbar menu breadcrumb breadcrumbs footer masthead topbar share sharing social related recommended
pagination pager widget copyright legal disclaimer search login toolbar skip teaser outbrain taboola complementary
contentinfo""".split())
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
INVISIBLE = re.compile(r"display\s*:\s*none", re.I)
NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: The rest of a tag, in one scan: quotes count behind an equals sign.
TAG_REST = re.compile(r"(?:[^=>]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)*+>")
#: Elements that may lie in a page's head; any other one ends it.
HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template head html".split())
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[.!?,;:…](?!\S)|[。！？、，]")


@dataclass
class Block:
    text: str
    linked: int
    place: int
    heading: bool


def hidden(attributes: str) -> bool:
    """Whether an element is not shown, by its own attributes; the word in a class or another value means nothing."""
    for name, *values in ATTRIBUTE.findall(attributes):
        value, name = "".join(values).strip().lower(), name.lower()
        if (name == "hidden" and not value.startswith("until") or name == "aria-hidden" and value == "true"
                or name == "style" and INVISIBLE.search(value)):
            return True
    return False


def marked(name: str, attributes: str, in_article: bool) -> int:
    """How surely class, id or role mark boilerplate: SURE if a whole name does or the element is hidden, LIKELY if the
    first or last part of a name does, else 0. Names such as ``has-sidebar`` describe a page's layout, page and body
    are never boilerplate, and an article element that lies in no other is so only if a whole name says that it is a
    comment, a teaser or an advert."""
    if not attributes or attributes.isspace():
        return 0
    lower = attributes.lower()
    if ("hidden" in lower or "none" in lower) and hidden(attributes):
        return SURE
    if name in PAGE:
        return 0
    whole, found = name == "article" and not in_article, 0
    for names in NAMED.finditer(attributes):
        for token in (names[1] or names[2] or names[3] or "").split():
            if whole:
                if token.lower() in CARDS:
                    return SURE
                continue
            if token.lower() in MARKS:
                return SURE
            words = re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower())
            if words[0] not in LAYOUT and (words[0] in MARKS or words[-1] in MARKS):
                found = LIKELY
    return found


def tag_end(page: str, at: int) -> tuple[int, bool]:
    """The place of the ``>`` that ends the tag begun before ``at``, and whether it was found by the quotes of
    attribute values, of whatever length. Quotes that are never closed, and quotes elsewhere, mean nothing; a tag
    that does not end by these rules ends at the first ``>``."""
    found = TAG_REST.match(page, at)
    return (found.end() - 1, True) if found else (page.find(">", at), False)


def blocks_of(page: str) -> list[Block]:
    """Blocks with text in page order. Unclosed, crossing and unknown tags are tolerated.

    Elements that are boilerplate only by a likely mark, forms among them, are wrappers if they hold most of the text
    outside sure marks; the others make what is in them boilerplate.
    """
    out: list[Block] = []
    stack: list[tuple[str, bool, bool, int]] = []  # name, whether surely outside the article, silent, likely mark
    parts: list[tuple[str, bool]] = []
    links = silent = inner = outer = 0
    heading, whole_tags = False, True
    likely: list[int] = []  # open elements with a likely mark
    held: list[int] = []  # text of every such element
    within: list[tuple[int, ...]] = []  # those around each block

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(p for p, _ in parts)).split())
            if text:
                linked = len(" ".join(html.unescape(" ".join(p for p, link in parts if link)).split()))
                out.append(Block(text, linked, BAD if outer else GOOD if inner else OPEN, heading))
                within.append(() if outer else tuple(likely))
                for mark in within[-1]:
                    held[mark] += len(text)
            parts.clear()

    def pop() -> str:
        nonlocal links, silent, inner, outer
        name, out_, quiet, mark = stack.pop()
        if mark >= 0:
            likely.remove(mark)
        links -= name == "a"
        silent -= quiet
        outer -= out_
        inner -= name in INNER
        return name

    def end_head() -> None:
        """An open head ends with all that hangs in it."""
        while open_names.get("head"):
            open_names[pop()] -= 1

    open_names: dict[str, int] = {}
    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if lt > at and stack and stack[-1][0] == "head" and not page[at:lt].isspace():
            end_head()
        if lt > at and not silent:
            parts.append((page[at:lt], links > 0))
        if lt == n:
            break
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        closing = page.startswith("/", lt + 1)
        named = NAME.match(page, lt + 1 + closing)
        if not named:
            if not silent:
                parts.append(("<", links > 0))
            at = lt + 1
            continue
        name = named[0].lower()
        # Once a tag ran to the end of the page without an end, quotes are not followed again.
        end, whole_tags = tag_end(page, named.end()) if whole_tags else (page.find(">", named.end()), False)
        if end < 0:
            break
        attributes, at = page[named.end():end], end + 1
        if name in BLOCK:
            flush()
        elif name == "br":
            parts.append((" ", False))
        if closing:
            if open_names.get(name):
                while True:
                    gone = pop()
                    open_names[gone] -= 1
                    if gone == name:
                        break
            if name in HEADINGS:
                heading = False
            continue
        if name == "body" or name not in HEAD and stack and stack[-1][0] == "head":
            end_head()
        if name in VOID or attributes.endswith("/"):
            continue
        if name in BLOCK and open_names.get("p"):
            # A block ends an open paragraph and what hangs in it, unless a container was opened since.
            deep = len(stack) - 1
            while deep >= 0 and stack[deep][0] != "p" and stack[deep][0] not in BLOCK:
                deep -= 1
            if deep >= 0 and stack[deep][0] == "p":
                while len(stack) > deep:
                    open_names[pop()] -= 1
        in_article = inner > 0
        sure = SURE if name in OUTER or (name == "header" and not in_article) else marked(name, attributes, in_article)
        away, quiet, mark = sure == SURE, name in SILENT, -1
        if not away and (sure or name in FORMS):
            mark = len(held)
            held.append(0)
            likely.append(mark)
        stack.append((name, away, quiet, mark))
        open_names[name] = open_names.get(name, 0) + 1
        links += name == "a"
        silent += quiet
        outer += away
        inner += name in INNER
        if name in HEADINGS:
            heading = True
        elif name in BLOCK:
            heading = False
        if name in RAW:
            close = re.compile(f"</{name}", re.I).search(page, at)
            at = close.start() if close else n
    flush()
    whole = sum(len(b.text) for b in out if b.place != BAD)
    for block, marks in zip(out, within):
        if any(held[m] <= WRAPPER * whole for m in marks):
            block.place = BAD
    return out


def stop_density(text: str) -> float:
    words = WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0


def first_pass(block: Block, lowered: bool = False, telling: bool = True) -> int:
    """Marks and links first, then length and the share of stop words; short or doubtful blocks stay open.

    ``lowered``: a block inside an article needs less evidence to be kept, and more to be left out (no stop word
    and no sentence). ``telling``: whether stop words say anything about this page; else long blocks are kept.
    """
    n = len(block.text)
    if block.place == BAD or block.linked > LINKS_MOST * n or block.text.startswith("©"):
        return BAD
    inside = lowered and block.place == GOOD
    short, least, high = (SHORT // 2, STOP_LEAST / 2, STOP_LEAST) if inside else (SHORT, STOP_LEAST, STOP_HIGH)
    if n < short or block.heading:
        return OPEN
    if not telling:
        return GOOD if n > LONG else OPEN
    density = stop_density(block.text)
    if density >= high or n > LONG and density >= least:
        return GOOD
    return BAD if n <= LONG and density == 0 and not (inside and SENTENCE.search(block.text)) else OPEN


def second_pass(labels: list[int], sizes: list[int], default: int = OPEN) -> list[int]:
    """Open blocks take the label of the nearest decided block, measured in blocks; if both sides are equally
    near, the one with more text; if none is decided, ``default``, or without one open blocks longer than short
    are kept."""
    before, after, last = [-1] * len(labels), [-1] * len(labels), -1
    for i, label in enumerate(labels):
        last = i if label else last
        before[i] = last
    last = -1
    for i in range(len(labels) - 1, -1, -1):
        last = i if labels[i] else last
        after[i] = last
    out = []
    for i, label in enumerate(labels):
        if label:
            out.append(label)
            continue
        sides = [j for j in (before[i], after[i]) if j >= 0]
        if not sides:
            out.append(default or (GOOD if sizes[i] >= SHORT else BAD))
        else:
            out.append(labels[min(sides, key=lambda j: (abs(j - i), -sizes[j]))])
    return out


def main_text(page: str) -> str:
    """Text of the blocks kept by both passes.

    Where article and main elements hold at least as much text as is kept outside them, limits are lower inside,
    and open blocks look for decided ones on their own side only: with none there, they are kept inside and left
    out outside. Otherwise these elements are cards beside the text, and all blocks are treated alike.
    """
    found = blocks_of(page)
    plain = [b for b in found if b.place != BAD and b.linked <= LINKS_MOST * len(b.text)]
    telling = stop_density(" ".join(b.text for b in plain)) >= STOP_LEAST / 2
    inside = sum(len(b.text) for b in plain if b.place == GOOD)
    labels = [first_pass(b, telling=telling) for b in found]
    outside = sum(len(b.text) for b, label in zip(found, labels) if b.place == OPEN and label == GOOD)
    if inside and inside >= outside:
        for side, default in ((GOOD, GOOD), (OPEN, BAD)):
            at = [i for i, b in enumerate(found) if b.place == side]
            first = [first_pass(found[i], True, telling) for i in at]
            for i, label in zip(at, second_pass(first, [len(found[i].text) for i in at], default)):
                labels[i] = label
    else:
        labels = second_pass(labels, [len(b.text) for b in found])
    return " ".join(b.text for b, label in zip(found, labels) if label == GOOD)


def main_texts(pages: DataFrame) -> DataFrame:
    """Main text of every whole page.

    ``pages``: ``page_id``, ``url``, ``html``; other columns are ignored. Result, one row per input row,
    repeated rows included: ``page_id``, ``url``, ``text`` (empty if there is none) and ``n_chars``, its code
    points. A null or empty ``html`` gives the empty text; null ids and addresses stay null; an empty table
    gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    chosen = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                          F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    return chosen.mapInArrow(run, "page_id long, url string, text string, n_chars long")
