"""Main text of web pages from flat text blocks, by a decision tree.

A page is cut into flat blocks at block-level tags.  The main article is the one with most words, of those outside
containers for comments and the like where there are any; a page may have none.  Each block has its word count and
link density, those of its neighbours, its kind of tag, whether it lies in the main article, beside it or on a page
without one, and how far tags, roles, classes or ids around it speak against it (a container that holds the main
article does not count).  A decision tree, grown on the labelled table below, keeps a block or not: in the main article what lies in no such container stays,
in doubtful containers and on pages without an article the looks of a block and its neighbours decide.
"""

from __future__ import annotations

import html as entities
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunks import _q, slices

BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table "
    "tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style title textarea noscript template iframe object svg select button canvas audio video".split())
NOT_CLOSED = {"button": frozenset(), "select": frozenset("option optgroup hr".split())}  # skipped, but ends with the block around; blocks it may hold
ASIDE = frozenset("nav footer aside form menu dialog search".split())
LEFT_OPEN = frozenset("p li dt dd option tr td th thead tbody tfoot b i u a em strong span font small br".split())  # often not closed
#: Words that a class or id is made of: those that speak against main text, those that may as well be said of it, and
#: those that say nothing.
AGAINST = re.compile(
    r"^(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|cookies?|consent|gdpr|popup\w*|modal\w*|overlay|newsletter\w*|subscri\w*|"
    r"signup|login|paywall|share|sharing|social\w*|comments?|commentlist|disqus\w*|reply|replies|respond|sidebar\w*|related|"
    r"recommend\w*|trending|breadcrumbs?|menus?|nav|navbar|navigation|toolbar|pager|pagination|footer|masthead|topbar|copyright)$", re.I)
DOUBTFUL = re.compile(r"^(?:notices?|alerts?|banners?|legal|disclaimer|header|foot|side|rail|skip|tags|widgets?)$", re.I)
NEUTRAL = re.compile(r"^(?:|\d+|area|bar|block|box|btn|buttons?|container|content|form|group|inner|item|left|links?|list|main|media|icons?|outer|page|panel|post|"
                     r"reader|right|row|section|site|slot|top|bottom|unit|user|wrap|wrapper)$", re.I)
#: Classes that say how a page is laid out, or what it has or lacks.
STATE = re.compile(r"^(?:no|has|have|with|without|left|right)[_-]|[_-](?:open|opened|closed|enabled|disabled|allowed)$", re.I)
NOT_MAIN_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
_TAG = re.compile(
    r"<!--(?:.*?-->|.*)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|"
    r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|</?[a-zA-Z][^>]*$", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
NOWHERE, ARTICLE, OUTSIDE = 0, 1, 2  # of a block: page without an article; in the main one; beside it
#: How far the containers of a block speak against it: not at all, by a doubtful word, by a plain one, by tag or role.
FREE, DOUBT, NAMED, CERTAIN = range(4)
OTHER, HEADING, PARAGRAPH, ITEM = range(4)  # the tag a block's text stands in
KINDS = {**dict.fromkeys("h1 h2 h3 h4 h5 h6 legend".split(), HEADING), **dict.fromkeys("p blockquote pre dd td figcaption".split(), PARAGRAPH),
         **dict.fromkeys("li dt".split(), ITEM)}

#: Words and link density of a block, of the one before and of the one after, as they are found anywhere on pages.
ANYWHERE = [
    (9, 0.0, 4, 0.0, 80, 0.0), (80, 0.0, 9, 0.0, 60, 0.0), (1, 0.0, 60, 0.0, 120, 0.0), (2, 0.0, 1, 1.0, 2, 0.0), (3, 1.0, 2, 1.0, 4, 1.0),
    (12, 0.5, 40, 0.0, 50, 0.0), (700, 0.0, 0, 0.0, 0, 0.0), (5, 0.0, 300, 0.0, 1, 1.0), (1, 1.0, 70, 0.0, 90, 0.0), (30, 0.1, 2, 0.9, 1, 0.8),
    (20, 0.0, 60, 0.0, 0, 0.0), (40, 0.8, 0, 0.0, 35, 0.1)]
#: Where such blocks are main text whatever they look like, and where they are not: place, containers, main text or not.
CLEAR = [(ARTICLE, FREE, 1), (ARTICLE, NAMED, 0), (ARTICLE, CERTAIN, 0), (OUTSIDE, FREE, 0), (OUTSIDE, DOUBT, 0), (OUTSIDE, NAMED, 0),
         (OUTSIDE, CERTAIN, 0), (NOWHERE, NAMED, 0), (NOWHERE, CERTAIN, 0)]
#: Where looks and neighbours tell: doubtful containers, and pages without an article.  Place, containers, kind, words, link
#: density, words and link density of the block before and after; main text or not.
TOLD_BY_LOOKS = [
    (NOWHERE, FREE, HEADING, 1, 0.0, 1, 1.0, 24, 0.0, 1), (NOWHERE, FREE, HEADING, 3, 0.0, 2, 1.0, 12, 0.0, 1), (NOWHERE, FREE, PARAGRAPH, 6, 0.0, 1, 1.0, 30, 0.0, 1),
    (NOWHERE, FREE, OTHER, 1, 1.0, 40, 0.0, 0, 0.0, 0), (NOWHERE, FREE, OTHER, 2, 1.0, 60, 0.0, 50, 0.0, 0), (NOWHERE, FREE, ITEM, 1, 1.0, 60, 0.0, 0, 0.0, 0),
    (NOWHERE, FREE, OTHER, 1, 1.0, 0, 0.0, 0, 0.0, 0), (NOWHERE, FREE, OTHER, 9, 0.9, 30, 0.0, 60, 0.0, 0),
    (ARTICLE, DOUBT, PARAGRAPH, 20, 0.0, 60, 0.0, 50, 0.0, 1), (ARTICLE, DOUBT, OTHER, 8, 0.0, 40, 0.0, 70, 0.0, 1),
    (ARTICLE, DOUBT, ITEM, 3, 0.0, 4, 0.0, 3, 0.0, 1), (ARTICLE, DOUBT, ITEM, 2, 0.0, 30, 0.0, 5, 0.0, 1),
    (ARTICLE, DOUBT, PARAGRAPH, 45, 0.1, 12, 0.0, 9, 0.0, 1), (ARTICLE, DOUBT, OTHER, 5, 0.0, 9, 0.0, 6, 0.1, 1),
    (ARTICLE, DOUBT, OTHER, 6, 0.0, 50, 0.0, 2, 1.0, 0), (ARTICLE, DOUBT, OTHER, 9, 0.0, 70, 0.0, 1, 0.9, 0),
    (ARTICLE, DOUBT, PARAGRAPH, 12, 0.0, 40, 0.0, 0, 0.0, 0), (ARTICLE, DOUBT, OTHER, 7, 0.0, 1, 1.0, 30, 0.0, 0),
    (ARTICLE, DOUBT, PARAGRAPH, 20, 0.0, 2, 0.9, 60, 0.0, 0), (ARTICLE, DOUBT, OTHER, 10, 0.0, 80, 0.0, 1, 1.0, 0),
    (ARTICLE, DOUBT, ITEM, 1, 1.0, 60, 0.0, 1, 1.0, 0), (ARTICLE, DOUBT, ITEM, 2, 1.0, 50, 0.0, 40, 0.0, 0),
    (ARTICLE, DOUBT, OTHER, 4, 0.8, 70, 0.0, 60, 0.0, 0), (NOWHERE, FREE, PARAGRAPH, 90, 0.0, 10, 0.0, 70, 0.0, 1),
    (NOWHERE, FREE, PARAGRAPH, 4, 0.0, 0, 0.0, 5, 0.0, 1), (NOWHERE, FREE, PARAGRAPH, 5, 0.0, 4, 0.0, 3, 0.0, 1),
    (NOWHERE, FREE, PARAGRAPH, 3, 0.0, 5, 0.0, 0, 0.0, 1), (NOWHERE, FREE, PARAGRAPH, 12, 0.2, 2, 1.0, 60, 0.0, 1),
    (NOWHERE, FREE, PARAGRAPH, 18, 0.0, 50, 0.0, 2, 1.0, 1), (NOWHERE, FREE, PARAGRAPH, 1, 0.0, 80, 0.0, 65, 0.0, 1),
    (NOWHERE, FREE, PARAGRAPH, 30, 0.4, 40, 0.0, 50, 0.0, 1), (NOWHERE, FREE, ITEM, 3, 0.0, 60, 0.0, 2, 0.0, 1),
    (NOWHERE, FREE, ITEM, 2, 0.0, 3, 0.0, 4, 0.0, 1), (NOWHERE, FREE, ITEM, 4, 0.0, 2, 0.0, 70, 0.0, 1),
    (NOWHERE, FREE, ITEM, 40, 0.1, 60, 0.0, 30, 0.0, 1), (NOWHERE, FREE, HEADING, 7, 0.0, 2, 1.0, 90, 0.0, 1),
    (NOWHERE, FREE, HEADING, 2, 0.0, 60, 0.0, 4, 0.0, 1), (NOWHERE, FREE, HEADING, 5, 0.0, 0, 0.0, 40, 0.0, 1),
    (NOWHERE, FREE, OTHER, 200, 0.2, 3, 0.0, 0, 0.0, 1), (NOWHERE, FREE, OTHER, 25, 0.0, 40, 0.0, 50, 0.0, 1),
    (NOWHERE, FREE, OTHER, 16, 0.0, 0, 0.0, 0, 0.0, 1), (NOWHERE, FREE, OTHER, 6, 0.0, 80, 0.0, 60, 0.0, 1),
    (NOWHERE, FREE, OTHER, 3, 0.0, 45, 0.0, 70, 0.0, 1), (NOWHERE, FREE, ITEM, 2, 1.0, 1, 1.0, 3, 1.0, 0),
    (NOWHERE, FREE, ITEM, 1, 1.0, 0, 0.0, 2, 1.0, 0), (NOWHERE, FREE, PARAGRAPH, 12, 0.9, 30, 0.0, 14, 0.8, 0),
    (NOWHERE, FREE, OTHER, 40, 0.8, 60, 0.0, 3, 0.5, 0), (NOWHERE, FREE, OTHER, 5, 0.0, 2, 1.0, 2, 1.0, 0),
    (NOWHERE, FREE, OTHER, 4, 0.0, 3, 1.0, 3, 0.0, 0), (NOWHERE, FREE, OTHER, 3, 0.0, 1, 1.0, 60, 0.0, 0),
    (NOWHERE, FREE, OTHER, 9, 0.6, 80, 0.0, 4, 1.0, 0), (NOWHERE, FREE, HEADING, 2, 0.0, 60, 0.0, 1, 1.0, 0),
    (NOWHERE, FREE, HEADING, 1, 0.0, 2, 1.0, 3, 1.0, 0), (NOWHERE, FREE, OTHER, 90, 0.7, 2, 1.0, 10, 0.9, 0),
    (NOWHERE, DOUBT, PARAGRAPH, 30, 0.0, 60, 0.0, 50, 0.0, 1), (NOWHERE, DOUBT, ITEM, 3, 0.0, 4, 0.0, 3, 0.0, 1),
    (NOWHERE, DOUBT, OTHER, 8, 0.0, 1, 1.0, 60, 0.0, 0), (NOWHERE, DOUBT, OTHER, 6, 0.0, 50, 0.0, 1, 1.0, 0),
    (NOWHERE, DOUBT, PARAGRAPH, 20, 0.0, 70, 0.0, 0, 0.0, 0),
]
LABELLED = np.array([(place, against, kind, *looks, label) for place, against, label in CLEAR for kind in range(4) for looks in ANYWHERE]
                    + TOLD_BY_LOOKS)


def grow(rows: np.ndarray) -> tuple | float:
    """A decision tree (feature, border, below, above) by Gini impurity; leaves are the share of kept rows."""
    label = rows[:, -1]
    if label.min() == label.max():
        return float(label[0])
    best = None
    for feature in range(rows.shape[1] - 1):
        values = np.unique(rows[:, feature])
        for border in (values[1:] + values[:-1]) / 2:
            below = rows[:, feature] < border
            impurity = sum(part.sum() * label[part].mean() * (1 - label[part].mean()) for part in (below, ~below))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, feature, border)
    if best is None:
        return float(label.mean())
    _, feature, border = best
    below = rows[:, feature] < border
    return feature, float(border), grow(rows[below]), grow(rows[~below])


@lru_cache(maxsize=1)
def block_tree() -> tuple | float:
    return grow(_spread(LABELLED))


def _spread(rows: np.ndarray) -> np.ndarray:
    """Places and kinds are no scales, so the table has a column for each."""
    places, kinds = [rows[:, :1] == place for place in range(3)], [rows[:, 2:3] == kind for kind in range(4)]
    return np.column_stack([*places, rows[:, 1:2], *kinds, rows[:, 3:]]).astype(float)


def judge(tree: tuple | float, rows: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(rows), tree >= 0.5)
    feature, border, below, above = tree
    low = rows[:, feature] < border
    out = np.empty(len(rows), dtype=bool)
    out[low], out[~low] = judge(below, rows[low]), judge(above, rows[~low])
    return out


def blocks_of(page: str) -> list[tuple[str, int, int, int, int, int]]:
    """(text, words, words in links, place, containers, kind) of each block with a word, in the order of the page."""
    out: list[tuple[str, int, int]] = []
    around: list[tuple[bool, tuple[int, ...], tuple[int, ...], int]] = []  # by block: certainly no main text; named containers, articles; kind
    text: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, int, bool, int]] = []  # open elements: tag, number as an article, certainly no main text, number as a named container
    named: list[int] = []
    inside: list[int] = []
    doubts: list[int] = [FREE]  # by named container: how far its name speaks against it
    articles: list[tuple[bool, bool, tuple[int, ...]]] = [(False, True, ())]  # by article: no `main` element; certainly no main text; named containers
    aside = link = kind = 0
    at, n = 0, len(page)

    def flush():
        joined = " ".join(entities.unescape("".join(text)).split())
        if joined:
            out.append((joined, joined.count(" ") + 1, len(entities.unescape(" ".join(linked)).split())))
            around.append((aside > 0, tuple(named), tuple(inside), kind))
        text.clear()
        linked.clear()

    for match in _TAG.finditer(page):
        if match.start() < at:
            continue
        if match.start() > at:
            piece = page[at:match.start()]
            text.append(piece)
            if link:
                linked.append(piece)
        at = match.end()
        name = match[2] or match[5]
        if not name:
            if match[0].startswith("<![CDATA["):
                text.append(match[0][9:-3])
            continue
        closing, name, attributes = match[1] or match[4], name.lower(), match[3] or match[6] or ""
        if name in SKIPPED:
            if not closing and name in NOT_CLOSED:
                at = _end_of(page, at, name)
            elif not closing and not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                at = end.end() if end else n
            continue
        if name == "br":
            text.append(" ")
            continue
        if name in BLOCKS:
            flush()
            kind = OTHER if closing else KINDS.get(name, OTHER)
        if name == "a":
            link = 0 if closing else 1
        if name in VOID or name in LEFT_OPEN and not _stands_out(attributes) and not closing:
            continue
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    for _, article, is_aside, container in stack[k:]:
                        aside -= is_aside
                        if container:
                            named.pop()
                        if article:
                            inside.pop()
                    del stack[k:]
                    link = 0 if name in BLOCKS else link
                    break
        elif not attributes.endswith("/"):
            hidden, doubt, role = _place(attributes) if attributes else (False, FREE, "")
            is_main = name == "main" or role == "main"
            is_article = is_main or name == "article" or role == "article"
            is_aside = not is_article and (name in ASIDE or name == "header" and not inside) or role in NOT_MAIN_ROLES or hidden
            is_aside = is_aside and name not in ("html", "body")
            article = container = 0
            if doubt and not is_article and not is_aside and name not in ("html", "body"):
                container = len(doubts)
                doubts.append(doubt)
                named.append(container)
            if is_article:
                article = len(articles)
                articles.append((not is_main, aside > 0 or is_aside, tuple(named)))
                inside.append(article)
            stack.append((name, article, is_aside, container))
            aside += is_aside
    if at < n:
        text.append(page[at:])
    flush()
    main = _main_articles([words for _, words, _ in out], around, articles, doubts)
    holds = {container for article in main for container in articles[article][2]}

    def place(sure, containers, within, kind_):
        against = max((doubts[c] for c in containers if c not in holds), default=FREE)
        return ARTICLE if main.intersection(within) else OUTSIDE if main else NOWHERE, CERTAIN if sure else against, kind_

    return [(*block, *place(*where)) for block, where in zip(out, around)]


def _main_articles(words: list[int], around: list, articles: list, doubts: list[int]) -> set[int]:
    """The article with most words, and others outside it that have a third of them or more.

    Words in containers that speak against main text, opened inside an article, are not its words.  Articles inside
    such containers are looked at only where there is no other, and `main` elements after articles.
    """
    size = [0] * len(articles)
    for n, (sure, containers, within, _) in zip(words, around):
        for article in within if not sure else ():
            if not any(doubts[c] >= NAMED for c in containers[len(articles[article][2]):]):
                size[article] += n
    for clear in (True, False):
        for plain in (True, False):
            found = [k for k, (is_plain, sure, containers) in enumerate(articles)
                     if size[k] and not sure and is_plain == plain and clear == all(doubts[c] < NAMED for c in containers)]
            if found:
                most = max(size[k] for k in found)
                return {k for k in found if 3 * size[k] >= most}
    return set()


def _end_of(page: str, at: int, name: str) -> int:
    """Where a button or select ends whose start tag ends at `at`: after its end tag; if there is none before the block
    around it ends or the next of its kind begins, at the first tag of a block."""
    opened: list[str] = []
    first = None
    for match in _TAG.finditer(page, at):
        tag = (match[2] or match[5] or "").lower()
        closing = match[1] or match[4]
        if tag == name:
            return match.end() if closing else match.start() if first is None else first
        if tag not in BLOCKS:
            continue
        if first is None and tag not in NOT_CLOSED[name]:
            first = match.start()
        if not closing:
            opened.append(tag)
        elif tag in opened:
            del opened[len(opened) - 1 - opened[::-1].index(tag):]
        else:
            return match.start() if first is None else first
    return len(page) if first is None else first


def _stands_out(attributes: str) -> bool:
    if not attributes:
        return False
    hidden, doubt, _ = _place(attributes)
    return hidden or doubt > FREE


def _place(attributes: str) -> tuple[bool, int, str]:
    """Whether an element's attributes hide it, how far its class or id speaks against main text, and its role."""
    found = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)}
    hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(found.get("style", ""))
    tokens = (found.get("class", "") + " " + found.get("id", "")).split()
    doubt = max((_doubt(token) for token in tokens if not STATE.search(token)), default=FREE)
    return bool(hidden), doubt, found.get("role", "").lower()


def _doubt(token: str) -> int:
    """A class or id that says nothing else than what is no main text is plain; one that says more, doubtful."""
    parts = re.split(r"[_-]+|(?<=[a-z])(?=[A-Z])", token)
    against, doubtful = (sum(bool(p.match(part)) for part in parts) for p in (AGAINST, DOUBTFUL))
    if not against + doubtful:
        return FREE
    alone = against + doubtful + sum(bool(NEUTRAL.match(part)) for part in parts) == len(parts)
    return NAMED if alone and (against or doubtful > 1) else DOUBT


def main_text(page: str | None, tree: tuple | float) -> str:
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    words, inside = (np.array([b[k] for b in blocks], dtype=float) for k in (1, 2))
    density = inside / words
    around = [np.append(0.0, words[:-1]), np.append(0.0, density[:-1]), np.append(words[1:], 0.0), np.append(density[1:], 0.0)]
    keep = judge(tree, _spread(np.column_stack([*([b[k] for b in blocks] for k in (3, 4, 5)), words, density, *around])))
    return "\n".join(b[0] for b, kept in zip(blocks, keep) if kept)


def extract_text(pages: DataFrame, page_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url and text (main text; empty if there is none), one row per row of `pages`.

    Character references are decoded, white space inside a block becomes one space, blocks are joined in page
    order by one line end; scripts, styles and markup go.

    Nulls: null html gives an empty text; a null id or url stays null.  Repeated rows are read each.  Empty
    tables give no rows.  Broken markup is read as far as it goes: an unclosed comment, script or tag at the
    end swallows the rest, elements left open end with the one around them.  Pages are never cut.
    """
    rows = pages.select(F.col(_q(page_col)).alias("page_id"), F.col(_q(url_col)).cast("string").alias("url"),
                        F.col(_q(html_col)).cast("string").alias("html"))
    tree = block_tree()

    def read(batches):
        for batch in slices(batches, "html"):
            texts = pa.array([main_text(page, tree) for page in batch.column("html").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), texts], names=["page_id", "url", "text"])

    return rows.mapInArrow(read, f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string")
