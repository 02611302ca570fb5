"""The main text of web pages by maximum-scoring subsequence.

A page is a row of words, which score positive, and tags, which score negative; the contiguous part of greatest sum, found in
one linear scan, is the article. The weights come from labelled pages, those that mark their article by an element of their own:
a tag costs the more, the less of its occurrences lie inside the marked parts, and words of links count as far as they lie
inside. Menus, headers, footers, sidebars, notices, adverts, forms and comments, told by element, role, class or id, are left out
of the text wherever they stand. A class or id tells one by its whole name or last part, and not where the element holds the page's
article or main, or other blocks with most of its words, or all of them: then it is a wrapper of the layout. The mark of a page
serves to learn only: all pages are read by the learned weights, as a mark may hold no more than a teaser or a short lead.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docwright.llm.common import slices

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)
    |<(?P<raw>script|style|noscript|template|svg|math|iframe|object|textarea|select|title|canvas|audio|video)\b(?:[^<>"']|"[^"]*+"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)
    |<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<rest>(?:[^<>"']|"[^"]*+"|'[^']*+')*+|[^>]*+)>
    |<[!?/][^>]*+>
    |(?P<text>[^<]+|<)""", re.S | re.I | re.X)
#: What can stand behind the last > of a page.
_TAIL = re.compile(r"<!--.*|(?P<raw>(?!))?(?P<tag>(?!))?(?P<text>[^<]+|<)", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|hidden|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_NAME = re.compile(r"[a-z]+", re.I)

#: Fixed values of the markup language: elements without content, elements that start a block, and ends that may be left out.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup "
    "hr html legend li main menu nav ol optgroup option p pre search section summary table tbody tfoot thead tr ul".split())
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
ASIDE = frozenset("nav header footer aside form dialog menu button fieldset label search".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
ASIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement adsense advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs header masthead footer "
    "sidebar aside widget related recommended comment comments commentlist disqus reply replies respond cookie cookies consent gdpr notice notices alert popup modal "
    "overlay newsletter subscribe subscription signup login social share sharing toolbar pagination pager skip copyright".split())
#: Last parts of names that say nothing of the content, and first parts that speak of the state of a layout.
NEUTRAL = frozenset("area bar bottom box buttons container content inner left links list right slot top unit wrap wrapper".split())
STATES = frozenset("has no not with without is hide show".split())
DEFAULT_TAG, FLOOR, SCALES = -3.25, -0.02, (0.5, 1.0, 2.0, 3.25, 6.0)


def _tokens(source: str) -> Iterator[re.Match]:
    """The tokens of a page, in time linear in its length.

    A tag that is tried finds its end or, where a quote in it is left open or a < stands outside quotes, takes the next >; behind
    the last > of the page none is tried.
    """
    last, at = source.rfind(">"), 0
    for token in _TOKEN.finditer(source) if last >= 0 else ():
        if token.start() > last:
            break
        yield token
        at = token.end()
    yield from _TAIL.finditer(source, at)


def _aside_name(name: str) -> bool:
    parts = _NAME.findall(name)
    while len(parts) > 1 and parts[-1] in NEUTRAL:
        parts.pop()
    return bool(parts) and parts[-1] in ASIDE_NAMES and not STATES.intersection(parts[:-1])


class Page:
    """What the scan needs: items (kind, weight class, text, block, inside the mark, left out), in page order."""

    def __init__(self, source: str) -> None:
        self.items: list[tuple[str, int, str, int, bool, bool]] = []  # class, words, text, block, marked, left out
        stack: list[str] = []
        opened: Counter[str] = Counter()  # of the stack
        aside = mark = link = article = None  # depth of the element that began it
        block, self.marked, shown = 0, False, 0
        named: list[list] = []  # open elements with the name of an aside: depth, first item, words before, holds article or main, block
        closed_named: list[tuple[int, int, int, bool]] = []  # first item, end, words, holds other blocks
        for token in _tokens(source):
            text, tag = token["text"], token["tag"]
            if text is not None:
                text = html.unescape(text)
                words = len(text.split())
                shown += words if aside is None else 0
                self.items.append(("link" if link is not None else "word", words, text, block, mark is not None, aside is not None))
                continue
            if tag is None:
                if token["raw"]:
                    self.items.append((token["raw"].lower(), 0, "", block, mark is not None, aside is not None))
                continue
            tag, end = tag.lower(), token["end"]
            if tag in BLOCK:
                block += 1
            elif tag in ("br", "td", "th"):
                self.items.append(("word", 0, " ", block, mark is not None, aside is not None))
            if end:
                while opened[tag]:
                    top = stack.pop()
                    opened[top] -= 1
                    if top == tag:
                        break
            else:
                closed = CLOSES.get(tag)
                while closed and stack and stack[-1] in closed:
                    opened[stack.pop()] -= 1
                if tag in BLOCK and tag != "p" and stack and stack[-1] == "p":
                    opened[stack.pop()] -= 1
            depth = len(stack)
            aside, mark, link, article = (d if d is not None and d < depth else None for d in (aside, mark, link, article))
            while named and named[-1][0] >= depth:
                self._close(named.pop(), block - (end != "" and tag in BLOCK), shown, closed_named)
            self.items.append((tag, 0, "", block, mark is not None, aside is not None))
            if end or tag in VOID or token["rest"].endswith("/"):
                continue
            stack.append(tag)
            opened[tag] += 1
            names, roles = self._names(token["rest"])
            if aside is None and (tag in ASIDE or roles & ASIDE_ROLES or "hidden" in roles):
                aside = depth
            if aside is None and (tag == "main" or "main" in roles or "articlebody" in roles or tag == "article" and article is None and not names):
                for wrapper in reversed(named):
                    if wrapper[3]:
                        break  # so have all around it
                    wrapper[3] = True
                if mark is None:
                    mark, self.marked = depth, True
            if article is None and tag == "article":
                article = depth
            if aside is None and names and tag not in ("html", "body", "main"):
                named.append([depth, len(self.items), shown, False, block])
            if link is None and tag == "a":
                link = depth
        for element in named:
            self._close(element, block, shown, closed_named)
        end = 0
        for first, last, words, wraps in sorted(closed_named):
            if 2 * words <= shown or not wraps and words < shown:
                for at in range(max(first, end), last):
                    self.items[at] = (*self.items[at][:4], False, True)
                end = max(end, last)

    def _close(self, element: list, block: int, shown: int, closed: list[tuple[int, int, int, bool]]) -> None:
        _, first, before, holds, own = element
        if not holds:
            closed.append((first, len(self.items), shown - before, block > own))

    @staticmethod
    def _names(rest: str) -> tuple[bool, set[str]]:
        """Whether a class or the id is the name of an aside; the roles."""
        names, roles = False, set()
        for key, value in _ATTRIBUTE.findall(rest) if rest else ():
            key, value = key.lower(), value.strip("\"'").lower()
            if key in ("class", "id"):
                names = names or any(map(_aside_name, value.split()))
            elif key in ("role", "itemprop"):
                roles.add(value)
            elif key == "hidden" or value == "true":
                roles.add("hidden")
        return names, roles

    def best(self, weights: dict[str, float]) -> tuple[int, int]:
        """Start and end of the items of greatest sum; the first and shortest of equal ones; nothing if no sum is positive."""
        best, total, start, found = 0.0, 0.0, 0, (0, 0)
        for at, (kind, words, _, _, _, out) in enumerate(self.items):
            if total <= 0:
                total, start = 0.0, at
            if kind in ("word", "link"):
                value = 0.0 if out else words * weights.get(kind, 1.0)
            else:
                value = weights.get(kind, DEFAULT_TAG)
            total += value
            if total > best:
                best, found = total, (start, at + 1)
        return found

    def text(self, start: int, end: int) -> str:
        blocks: dict[int, list[str]] = {}
        for kind, _, text, block, _, out in self.items[start:end]:
            if text and not out:
                blocks.setdefault(block, []).append(text)
        lines = (" ".join("".join(parts).split()) for parts in blocks.values())
        return "\n".join(line for line in lines if line)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of each class inside and outside the marked parts of labelled pages."""
    inside, outside = Counter(), Counter()
    for part in slices(batches, "html"):
        for source in part.column("html").to_pylist():
            page = Page(source or "")
            if page.marked:
                for kind, words, _, _, marked, out in page.items:
                    (inside if marked and not out else outside)[kind] += words if kind in ("word", "link") else 1
    kinds = sorted(inside.keys() | outside.keys())
    if kinds:
        yield pa.record_batch({"kind": kinds, "inside": pa.array([inside[k] for k in kinds], pa.int64()), "outside": pa.array([outside[k] for k in kinds], pa.int64())})


def _judged(trials: list[dict[str, float]]):
    """For each set of weights, the words that the scan gets right, takes wrongly and misses on labelled pages."""
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [[0, 0, 0] for _ in trials]
        for part in slices(batches, "html"):
            for source in part.column("html").to_pylist():
                page = Page(source or "")
                if not page.marked:
                    continue
                for k, weights in enumerate(trials):
                    a, b = page.best(weights)
                    for at, (_, words, _, _, marked, out) in enumerate(page.items):
                        if words and not out:
                            taken = a <= at < b
                            sums[k][0 if taken and marked else 1 if taken else 2] += words if taken or marked else 0
        yield pa.record_batch({"trial": list(range(len(trials))), **{n: pa.array([s[at] for s in sums], pa.int64()) for at, n in enumerate(("right", "wrong", "missed"))}})
    return judge


def learn(pages: DataFrame) -> dict[str, float]:
    """Weights from all labelled pages: one row per class of token and per scale reaches the driver."""
    texts = pages.select(F.col("html").cast("string").alias("html"))
    counts = texts.mapInArrow(_counted, "kind string, inside long, outside long").groupBy("kind").agg(F.sum("inside").alias("i"), F.sum("outside").alias("o"))
    shares = {r["kind"]: (r["i"] + 0.5) / (r["i"] + r["o"] + 1) for r in counts.where(F.col("i") + F.col("o") >= 5).collect()}
    if not shares:
        return {}
    link = max(0.05, min(1.0, 2 * shares.get("link", 0.5) - 0.5))
    trials = [{"word": 1.0, "link": link} | {k: min(FLOOR, -scale * 2 * (1 - s)) for k, s in shares.items() if k not in ("word", "link")} for scale in SCALES]
    judged = texts.mapInArrow(_judged(trials), "trial long, right long, wrong long, missed long").groupBy("trial").agg(*[F.sum(c).alias(c) for c in ("right", "wrong", "missed")])
    best = max(judged.collect(), key=lambda r: (2 * r["right"] / max(1, 2 * r["right"] + r["wrong"] + r["missed"]), -r["trial"]))
    return trials[best["trial"]]


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each page, from the whole html.

    A null or empty page has the empty text. References are decoded, white space inside a block is one space, blocks stand in page
    order with one line feed between. Repeated rows and null ids each keep their row. Without labelled pages every tag has one
    weight. Extra columns are not read.
    """
    weights = learn(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            texts = []
            for source in part.column("html").to_pylist():
                page = Page(source or "")
                texts.append(page.text(*page.best(weights)))
            yield pa.record_batch({"page_id": part.column("page_id"), "url": part.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string").alias("html")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
