"""Main text of web pages by two-pass block rules.

A page is cut into blocks at its block-level tags; what is never shown (scripts,
styles, hidden elements) is no block. Blocks are classified:

* first pass, from a block alone: one of mostly links is bad; a long block rich in
  stop words is good, a shorter or poorer one nearly good (a long one without links
  needs very few); a short block or a heading is undecided; the rest is bad. Text in a script without a list of stop
  words goes by length and links;
* second pass: nearly good blocks are kept unless bad ones stand on both
  sides (without any good block on the page, nearly good ones are good); undecided
  ones take the label of the nearest decided neighbour (the nearer side, good at
  equal distance). The ends of the page count as bad.

Markup gives priors. Where a page marks its article (``article``, ``main`` and
their likes), blocks inside start from good: a block without stop words is
undecided there, and the ends of the article count as good neighbours. Blocks
elsewhere go through the same two passes by themselves. An element that is a menu,
header, footer, sidebar, notice, advert, form or comment makes its blocks bad.
Where its tag, role or whole class name says so that is certain; where only a part
of a class name does (``layout no-sidebar``), or it is a form, the text decides:
when more than half of the dense text (good and nearly good blocks) of the page,
or of the article that it stands in, is inside, and no article stands beside
it, the name meant something else.

Character references are decoded, white space inside a block becomes one
space and the kept blocks are joined in page order by one space. Null and
empty pages and pages without main text give an empty text. Every row gives
one row; repeated page ids are extracted row by row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerline.llm.common import map_arrow

LENGTH_LOW = 70
LENGTH_HIGH = 200
STOPWORDS_LOW = 0.30
STOPWORDS_HIGH = 0.32
STOPWORDS_LEAST = 0.05      # of a long block without any link
MAX_LINK_DENSITY = 0.2
MAX_ARTICLE_LINK_DENSITY = 0.8

# fixed values: frequent function words (English, French, German, Spanish, Italian, Portuguese, Dutch)
STOP_WORDS = frozenset("""
a an and are as at be by for from has he in is it its of on or that the this to was were will with not
au aux avec ce des du elle en est et il je la le les ne ou par pas pour qu que qui sa se ses son sur un une
als auch auf aus das dem den der die ein eine er es für ich im ist mit nach nicht sich sie sind und von war wie zu zum
con de del el ella esta este las lo los más no para pero por se si sin su sus un una y
che da di della gli il ma nel non per più sono al do dos em foi mais na não o os uma
aan dat een het ik maar niet op te van voor zijn
""".split())

# fixed values: markup
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noframes noembed xmp svg object "
                "canvas audio video select annotation annotation-xml".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt "
                  "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend "
                  "li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead "
                  "tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LEFT_OUT = frozenset("head nav footer aside button menu dialog fieldset legend".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu "
                  "menubar toolbar".split())
LEFT_OUT_NAMES = frozenset("""
ad ads advert adverts advertisement advertisements advertising adsense banner sponsor sponsored promo promotion
promoted nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar widget widgets footer masthead topbar
cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login
signin search share sharing social related recommended recommendations comment comments disqus reply replies respond
pagination pager toolbar copyright skip feedback outbrain taboola
""".split())
COMMENT_NAMES = frozenset("comment comments disqus reply replies respond".split())
# words beside a name that say how something is, not what it is
MODIFIERS = frozenset("no not non without with has have is enabled disabled on off open closed allow allowed".split())
NOT_AN_ARTICLE = frozenset("comment comments reply replies ad ads advert advertisement promo sponsored related "
                           "teaser".split())
ARTICLE_NAMES = frozenset("article post entry story".split())
BODY_NAMES = frozenset("content body text main".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?>[^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*))>"""
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-a-zA-Z0-9_:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_WORD = re.compile(r"\w+")
_LETTER = re.compile(r"[^\W\d_]")
_LATIN = re.compile("[A-Za-zÀ-ɏḀ-ỿ]")
_WIDE = re.compile("[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\uf900-\ufaff]")
WIDE_LETTER = 3             # Latin characters that say as much as a Han, kana or hangul one
NO_HINT, WEAK, STRONG = 0, 1, 2


class Block:
    __slots__ = ("parts", "linked", "region", "heading", "hint", "text")

    def __init__(self, region: int, heading: bool, hint: int):
        self.parts: list[str] = []
        self.linked = 0
        self.region = region
        self.heading = heading
        self.hint = hint
        self.text = ""


class Hint:
    """An element that its markup calls something else than main text."""
    __slots__ = ("strong", "parent", "region", "article", "dense", "whole")

    def __init__(self, strong: bool, parent: int, region: int):
        self.strong, self.parent, self.region = strong, parent, region
        self.article = False        # holds a marked article
        self.dense = self.whole = 0


def _attributes(text: str) -> dict[str, str]:
    return {m[0].lower(): m[1] or m[2] or m[3] for m in _ATTRIBUTE.findall(text)} if text.strip(" /") else {}


def _names(attributes: dict[str, str]) -> list[set[str]]:
    """The words of each class name and of the id."""
    tokens = [*attributes.get("class", "").split(), attributes.get("id", "")]
    return [words for words in ({w.lower() for w in _NAME_WORD.findall(t) if not w.isdigit()} for t in tokens) if words]


def _not_an_article(names: list[set[str]]) -> bool:
    return any(words & NOT_AN_ARTICLE and not words & MODIFIERS for words in names)


def hint_of(name: str, attributes: dict[str, str], names: list[set[str]], region: int) -> int:
    """What the markup of an element says against its text."""
    if name in ("html", "body"):
        return NO_HINT
    if name in ("article", "main"):
        return STRONG if _not_an_article(names) else NO_HINT
    if name in LEFT_OUT or name == "header" and not region or attributes.get("role", "") in ROLES:
        return STRONG
    found = WEAK if name == "form" else NO_HINT
    for words in names:
        said = words & LEFT_OUT_NAMES
        if "header" in words and not region and not words & ARTICLE_NAMES:
            said = said | {"header"}
        if said and (words == said or said & COMMENT_NAMES and not words & MODIFIERS):
            return STRONG
        found = WEAK if said else found
    return found


def _hidden(attributes: dict[str, str]) -> bool:
    return ("hidden" in attributes or attributes.get("aria-hidden") == "true"
            or "display:none" in attributes.get("style", "").replace(" ", ""))


def _is_article(name: str, attributes: dict[str, str], names: list[set[str]]) -> bool:
    words = set().union(*names)
    return (name in ("article", "main") or attributes.get("role") in ("main", "article")
            or attributes.get("itemprop") == "articleBody"
            or bool(words & ARTICLE_NAMES and words & BODY_NAMES)) and not _not_an_article(names)


def blocks_of(page: str) -> tuple[list[Block], list[Hint]]:
    """The blocks of a page in order and the elements whose markup speaks
    against them. ``region`` numbers the marked articles, 0 is outside; ``hint`` is
    the number of the innermost such element round a block, or -1."""
    found: list[Block] = []
    hints: list[Hint] = []
    current: Block | None = None
    # open elements: name, innermost hint, region, inside a link, heading, not shown
    stack: list[tuple[str, int, int, bool, bool, bool]] = []
    hint, region, link, heading, unseen = -1, 0, False, False, False
    open_names: dict[str, int] = {}
    regions, at = 0, 0

    def text(piece: str) -> None:
        nonlocal current
        if unseen or not piece:
            return
        piece = unescape(piece) if "&" in piece else piece
        if current is None:
            if not piece.strip():
                return
            current = Block(region, heading, hint)
            found.append(current)
        current.parts.append(piece)
        if link:
            current.linked += len("".join(piece.split()))

    def state() -> None:
        nonlocal hint, region, link, heading, unseen
        _, hint, region, link, heading, unseen = stack[-1] if stack else ("", -1, 0, False, False, False)

    def close(name: str, among: frozenset[str] | None = None) -> None:
        if not open_names.get(name):            # nothing of that name is open: no search
            return
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == name:
                for element in stack[k:]:
                    open_names[element[0]] -= 1
                del stack[k:]
                state()
                return
            if among and stack[k][0] in among:
                return

    while True:
        m = _TAG.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing = bool(m[1] or m[4])
        if name == "br":
            if current is not None:
                current.parts.append(" ")
            continue
        if name in BLOCK:
            current = None
        if closing:
            close(name)
            continue
        raw = (m[3] if m[2] else m[6]) or ""
        if name in RAW:
            if not raw.endswith("/"):
                end = re.compile(rf"</{name}(?![a-zA-Z0-9:-])[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if name in VOID:
            continue
        if name in BLOCK:                       # an open paragraph ends where a block begins
            close("p", BLOCK - {"p"})
            if name in ("li", "dd", "dt", "tr", "td", "th", "option"):
                close(name, frozenset(("ul", "ol", "dl", "table", "menu", "select")))
        attributes = _attributes(raw)
        names = _names(attributes)
        inner_region, inner_hint = region, hint
        certain = hint >= 0 and hints[hint].strong
        if not certain and not region and _is_article(name, attributes, names):
            regions += 1
            inner_region, k = regions, hint
            while k >= 0 and not hints[k].article:
                hints[k].article, k = True, hints[k].parent
        if not certain:                         # inside a certain one nothing more is to be said
            said = hint_of(name, attributes, names, inner_region)
            if said:
                hints.append(Hint(said == STRONG, hint, inner_region))
                inner_hint = len(hints) - 1
        stack.append((name, inner_hint, inner_region, link or name == "a", heading or name in HEADINGS,
                      unseen or _hidden(attributes)))
        open_names[name] = open_names.get(name, 0) + 1
        state()
    for b in found:
        b.text = " ".join("".join(b.parts).split())
    return [b for b in found if b.text], hints


GOOD, NEAR, SHORT, BAD = "good", "near", "short", "bad"


def first_pass(block: Block) -> str:
    """A block's label from itself alone."""
    length = len(block.text)
    density = block.linked / max(1, length - block.text.count(" "))
    if density > (MAX_ARTICLE_LINK_DENSITY if block.region else MAX_LINK_DENSITY):
        return BAD
    if block.heading:
        return SHORT
    if not block.region and "©" in block.text:
        return BAD
    listed = True               # in a script with a list of stop words
    if not block.text.isascii():
        letters = len(_LETTER.findall(block.text))
        listed = 2 * len(_LATIN.findall(block.text)) >= letters
        if not listed:
            length += (WIDE_LETTER - 1) * len(_WIDE.findall(block.text))
    if length < LENGTH_LOW:
        return BAD if block.linked and not block.region else SHORT
    if not listed:
        return GOOD if length > LENGTH_HIGH else NEAR
    words = _WORD.findall(block.text.lower())
    share = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if share >= STOPWORDS_HIGH:
        return GOOD if length > LENGTH_HIGH else NEAR
    if share >= STOPWORDS_LOW or share >= STOPWORDS_LEAST and length > LENGTH_HIGH and not block.linked:
        return NEAR
    return SHORT if block.region else BAD


def ruled_out(blocks: list[Block], labels: list[str], hints: list[Hint]) -> list[bool]:
    """Which blocks stand in an element that is no main text: a certain one, or
    one without most of the dense text of the page or of its article."""
    dense: dict[int, int] = {}          # per article, and of the page
    whole: dict[int, int] = {}
    marked = False
    for b, label in zip(blocks, labels):
        if b.hint >= 0 and hints[b.hint].strong:
            continue
        size, unlinked = len(b.text) if label in (GOOD, NEAR) else 0, len(b.text) - b.linked
        for k in {b.region, -1}:
            dense[k] = dense.get(k, 0) + size
            whole[k] = whole.get(k, 0) + unlinked
        marked = marked or b.region > 0
        if b.hint >= 0:
            hints[b.hint].dense += size
            hints[b.hint].whole += unlinked
    for h in reversed(hints):           # what a hint holds its parent holds
        if h.parent >= 0:
            hints[h.parent].dense += h.dense
            hints[h.parent].whole += h.whole
    out: list[bool] = []
    for h in hints:                     # parents come first
        k = h.region or -1
        most = 2 * h.dense > dense.get(k, 0) if dense.get(k) else 2 * h.whole > whole.get(k, 0)
        beside = not h.region and marked and not h.article
        out.append(h.strong or beside or not most or h.parent >= 0 and out[h.parent])
    return [b.hint >= 0 and out[b.hint] for b in blocks]


def second_pass(labels: list[str], edge: str) -> list[bool]:
    """Which blocks of a run are kept; ``edge`` is the label beyond its ends."""
    n = len(labels)

    def nearest(decided: set[str]) -> tuple[list[tuple[str, int]], list[tuple[str, int]]]:
        before, after = [], [("", 0)] * n
        seen, at = edge, -1
        for i, label in enumerate(labels):
            before.append((seen, i - at))
            if label in decided:
                seen, at = label, i
        seen, at = edge, n
        for i in range(n - 1, -1, -1):
            after[i] = (seen, at - i)
            if labels[i] in decided:
                seen, at = labels[i], i
        return before, after

    strict_before, strict_after = nearest({GOOD, BAD})
    before, after = nearest({GOOD, BAD, NEAR})
    near_kept = [not (strict_before[i][0] == BAD and strict_after[i][0] == BAD) for i in range(n)]
    kept = []
    for i, label in enumerate(labels):
        if label == SHORT:
            sides = []
            for (seen, distance), step in ((before[i], -1), (after[i], 1)):
                good = seen == GOOD or seen == NEAR and near_kept[i + step * distance]
                sides.append((distance, not good))
            kept.append(not min(sides)[1])
        else:
            kept.append(label == GOOD or label == NEAR and near_kept[i])
    return kept


def main_text(page: str | None) -> str:
    """The main text of one page."""
    if not page:
        return ""
    blocks, hints = blocks_of(page)
    labels = [first_pass(b) for b in blocks]
    gone = ruled_out(blocks, labels, hints)
    # inside an article they are as if they were not there, elsewhere they are bad neighbours
    rows = [(b, BAD if out else label) for b, label, out in zip(blocks, labels, gone) if not (out and b.region)]
    if not any(b.region or label == GOOD for b, label in rows):         # a page of short paragraphs
        rows = [(b, GOOD if label == NEAR else label) for b, label in rows]
    kept: list[str] = []
    at = 0
    while at < len(rows):
        end = at
        while end < len(rows) and rows[end][0].region == rows[at][0].region:
            end += 1
        run = rows[at:end]
        inside = run[0][0].region > 0
        found = [label for _, label in run]
        if inside and GOOD not in found:
            found = [GOOD if x == NEAR else x for x in found]
        kept += [b.text for (b, _), keep in zip(run, second_pass(found, GOOD if inside else BAD)) if keep]
        at = end
    return " ".join(kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [main_text(x) for x in b.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page row."""
    return map_arrow(pages.select("page_id", "url", "html"), _extract,
                     "page_id long, url string, text string, n_chars long")
