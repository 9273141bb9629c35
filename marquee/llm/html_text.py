"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. Elements that never hold the article (menus, footers, side bars,
forms, scripts, and elements whose class, id or role says advert, notice, comments and the like) are left out with
all they hold. The first pass looks at each block alone: link density, length and stop-word density make it good,
bad or ambiguous; inside an ``article`` or ``main`` element only link density speaks against a block, and what stands
outside such elements is judged by all of them. In the
second pass ambiguous short blocks take the label of the nearest decided neighbours: of both if they agree, else of
the nearer one, and the one before at equal distance; neighbours are those on the same side, inside or outside. Headings follow the text below them.

Defined cases: null and empty html give an empty text; markup that is cut off or never closed ends with the page; the
first ``article`` or ``main`` ends any unclosed menu or advert before it if no good text stands before it; inside one that
is closed it counts only where the page has no other text; an empty table gives no rows; repeated
pages are read each; columns other than the three are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from marquee.llm import words as W
from marquee.llm.registry import query

#: HTML elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg math iframe object canvas audio video".split())
OUTSIDE = frozenset("head nav footer aside form button select dialog menu".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 "
                  "h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN = frozenset(("article", "main"))
#: Words in a class, id or role that mark what is not the article.
NOT_ARTICLE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner breadcrumb breadcrumbs comment comments "
    "commentlist disqus replies respond cookie cookies consent gdpr notice notices alert modal popup overlay footer header masthead menu menubar nav "
    "navbar navigation toolbar pager pagination related recommended recommendations sidebar sidebars widget widgets share sharing social "
    "newsletter subscribe subscription signup login search skip complementary contentinfo dialog tags metadata copyright disclaimer".split())
#: Frequent words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    "a about after all also an and are as at be been but by can for from had has have he her his if in into is it its more not of on one only or "
    "other she so than that the their there these they this to was we were which who will with would you "
    "aber als am an auch auf aus bei bis das dass dem den der des die durch ein eine einem einen einer es für hat ich im in ist mit nach nicht noch "
    "nur oder sein sich sie sind so über um und uns von vor war wie wird zu zum zur "
    "au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous on ont ou où par pas plus pour qu que qui sa se "
    "ses son sont sur un une vous "
    "al como con cuando de del el ella en entre era es esta este ha hasta la las lo los más me mi muy no o para pero por porque que se ser sin sobre "
    "son su sus también un una y ya".split())

LINK_DENSE, LONG, STOP_LOW, STOP_HIGH = 0.5, 140, 0.10, 0.20

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z|(?=<))", re.S)
_NAMES = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_NAME_PARTS = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")
_WORDS = re.compile(r"[^\W\d_]+")


class Block(NamedTuple):
    text: str
    linked: int
    heading: bool
    within: bool
    #: From an article inside an element that is left out: counts only where the page has no other text.
    spare: bool = False


def _excluded(tag: str, attributes: str, within: bool) -> bool:
    if tag in OUTSIDE or tag == "header" and not within:
        return True
    if not attributes or tag in ("html", "body") or tag in MAIN:
        return False
    if _HIDDEN.search(attributes):
        return True
    for groups in _NAMES.findall(attributes):
        parts = [p.lower() for p in _NAME_PARTS.findall("".join(groups))]
        for before, part in zip(["", *parts], parts):
            # "with-sidebar" names a frame around the article, and an article's own header holds its title.
            if part in NOT_ARTICLE and before not in ("with", "has", "no") and not (within and part == "header"):
                return True
    return False


def blocks(html: str) -> list[Block]:
    """Blocks of a page outside excluded elements, in page order."""
    out: list[Block] = []
    stack: list[tuple[str, bool, bool]] = []
    pieces: list[str] = []
    at = linked = anchors = 0
    excluded = inside = spare = False
    heading = False
    size = len(html)

    def close() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(pieces)).split()) if pieces else ""
        if text:
            out.append(Block(text, min(linked, len(text)), heading, inside, inside and spare))
        pieces.clear()
        linked = 0

    def unclosed() -> bool:
        """Whether the outermost element that excludes has fewer closing tags to come than elements of its kind are open."""
        opener = next(i for i, (_, before, _) in enumerate([*stack[1:], ("", True, False)]) if before)
        name = stack[opener][0]
        ahead = [bool(f[1]) for f in _MARKUP.finditer(html, at) if (f[2] or "").lower() == name]
        return 2 * sum(ahead) - len(ahead) < sum(t == name for t, _, _ in stack)

    def say(piece: str) -> None:
        nonlocal linked
        if piece and not excluded:
            pieces.append(piece)
            if anchors:
                linked += len(piece.strip())

    while at < size:
        found = _MARKUP.search(html, at)
        if not found:
            say(html[at:])
            break
        say(html[at:found.start()])
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if tag in BLOCK:
                close()
                heading = False
            elif tag in ("td", "th"):
                say(" ")
            elif tag == "a" and anchors:
                anchors -= 1
            if depth is not None:
                # A closing inline tag ends no block element that stands open inside it.
                if tag in BLOCK or not any(t in BLOCK for t, _, _ in stack[depth + 1:]):
                    _, excluded, inside = stack[depth]
                    del stack[depth:]
                else:
                    del stack[depth]
            continue
        if tag in RAW:
            if not found[3].rstrip().endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(html, at)
                at = end.end() if end else size
            continue
        if tag == "br" or tag in ("td", "th"):
            say(" ")
        if tag in BLOCK:
            close()
            heading = tag in HEADINGS
            anchors = 0
        if tag in VOID:
            continue
        if tag == "p" or tag in HEADINGS or tag == "li":
            # These end an open one of their kind that no closer container separates.
            for i in range(len(stack) - 1, -1, -1):
                t = stack[i][0]
                if t == tag or t == "p" and tag in HEADINGS:
                    _, excluded, inside = stack[i]
                    del stack[i:]
                    break
                if t in BLOCK and t != "p":
                    break
        if tag in MAIN and excluded and not inside and not any(b.within for b in out):
            # The first article ends what was never closed before it. Inside a closed element, or after the text of the
            # page, it may be a teaser or a comment, and later ones are.
            spare = any(first_pass(b) == "good" for b in out) or not unclosed()
            excluded = False
        stack.append((tag, excluded, inside))
        if tag in MAIN and not excluded:
            inside = True
        if not excluded and _excluded(tag, found[3], inside):
            excluded = True
        if tag == "a":
            anchors += 1
    close()
    return out


def first_pass(block: Block) -> str:
    """good, bad, or short (ambiguous)."""
    text = block.text
    if block.linked > LINK_DENSE * len(text):
        return "bad"
    if block.within:
        return "good" if len(text) >= LONG or block.heading else "short"
    found = _WORDS.findall(text.lower())
    density = sum(w in STOP_WORDS for w in found) / max(1, len(found))
    if len(text) < LONG:
        return "bad" if block.linked else "short"
    if density >= STOP_HIGH:
        return "good"
    return "short" if density >= STOP_LOW else "bad"


def second_pass(labels: list[str], found: list[Block]) -> list[bool]:
    """Give ambiguous blocks the label of their nearest decided neighbours."""
    n = len(labels)
    before, after = [-1] * n, [n] * n
    for i in range(1, n):
        before[i] = i - 1 if labels[i - 1] != "short" else before[i - 1]
    for i in range(n - 2, -1, -1):
        after[i] = i + 1 if labels[i + 1] != "short" else after[i + 1]
    out = []
    for i, label in enumerate(labels):
        if label == "short":
            b, a = before[i], after[i]
            left, right = labels[b] if b >= 0 else None, labels[a] if a < n else None
            if found[i].heading:
                label = right or "bad"
            elif left is None and right is None:
                label = "good" if found[i].within else "bad"
            elif left is None or right is None or left == right:
                label = left or right
            else:
                label = left if i - b <= a - i else right
            # Beside a link list inside the article, the article's own short lines stay.
            if label == "bad" and found[i].within:
                label = "good"
        out.append(label == "good")
    return out


def main_text(html: str | None) -> str:
    """The article of a page, blocks joined by an empty line."""
    every = blocks(html or "")
    for found in ([b for b in every if not b.spare], every):
        # Blocks follow neighbours of their own side: what stands beside an article is no part of it because it is near.
        keep = [False] * len(found)
        for side in (True, False):
            at = [i for i, b in enumerate(found) if b.within == side]
            own = [found[i] for i in at]
            for i, k in zip(at, second_pass([first_pass(b) for b in own], own)):
                keep[i] = k
        if any(keep):
            break
    return "\n\n".join(b.text for b, k in zip(found, keep) if k)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, html_col):
            texts = [main_text(h) for h in W.named(part, html_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([W.named(part, id_col), W.named(part, url_col), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             [id_col, url_col, "text", "n_chars"])

    kinds = {c: pages.schema[c].dataType.simpleString() for c in (id_col, url_col)}
    return pages.select(id_col, url_col, html_col).mapInArrow(run, f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string, n_chars bigint")


@query("op1_html_text")
def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
