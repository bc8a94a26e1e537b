"""Main text of web pages by line-block distribution.

Markup is stripped by one scan of the page: what never shows (scripts, styles, head, comments of the source, forms) goes, block elements break
lines, inline ones vanish, character references are decoded and white space in a line becomes one space. Each line weighs the characters that
are not in links; lines in menus, headers, footers, sidebars, notices, adverts and reader comments (by element, role, class or id) weigh
nothing. Where a page marks its article, and nothing outside has more than MARK times its weight, lines outside weigh nothing either.

Weights are summed over sliding windows of WINDOW lines. The sums rise from nothing at a surge and fall to nothing at a dive; the text between
is a stretch. Of a marked article all stretches stay, but for noise. Elsewhere stretches whose sums reach PEAK (all, if none does) tell where the content is:
the heaviest, those with at least SHARE of its weight and the page's main heading before them stand in one container, and in it every line
is kept that is not noise and has words outside links, however short; so no part of it is dropped. Marked lines stay there too.

Class names alone drop no body: a name counts only if all its parts are words of noise or of layout, not beside a name of content, and not where its
element holds more than half of the page's text. Markup may be cut off, badly nested or left open: end tags that HTML lets out are not needed; an
element that never ends hides nothing but a script's or style's rest; a quote that never ends ends with its tag. A page costs time in proportion to its length.

Nulls, empties: a null or empty html, and a page without a stretch, give an empty text. Rows are judged each for itself, repeated or
not. Extra columns are not read.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW, PEAK, SHARE, MARK = 3, 60, 0.3, 3
#: Pages of a batch to Python.
PAGES = 200

_words = lambda s: frozenset(s.split())
#: Elements by what they do; fixed values of HTML.
INLINE = _words("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter picture q ruby rp rt s samp small source span strike strong sub sup time tt u var wbr math maction merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics")
VOID = _words("area base br col embed hr img input link meta param source track wbr")
CONTAINERS = _words("div section article main aside nav header footer form menu ul ol table dl details dialog figure fieldset center td body head")
NEVER = _words("nav aside footer form menu dialog fieldset")
#: What holds no text of a page. RAW is text up to its end tag; the others hold elements.
RAW = _words("script style title textarea iframe noscript xmp noembed noframes")
HIDDEN = _words("select button object canvas svg template annotation annotation-xml")
#: Starts of these end an open select or button, and the head.
ENDS_HIDDEN = _words("p h1 h2 h3 h4 h5 h6 article section main table ul ol blockquote figure header footer nav aside form pre dl hr")
OF_HEAD = _words("head base link meta title style script noscript template")
#: Words of class, id and role names: noise, reader comments, layout, content.
NOISE = _words(
    "ad ads advert adverts advertisement advertising adv banner breadcrumb breadcrumbs byline consent cookie cookies gdpr copyright disclaimer footer header masthead menu nav navbar navigation newsletter notice notices alert "
    "pagination pager popup modal overlay promo promos promotion promotions related recommend recommended recommendations share sharing sidebar skip social sponsor sponsored sponsors subscribe subscription signup login tags "
    "toolbar tracking widget widgets complementary contentinfo search"
)
COMMENTS = _words("comment comments commentlist respond disqus reply replies reaction reactions")
LAYOUT = _words("site page top bottom left right box block area section list item items wrapper wrap container inner outer bar link links button buttons icon icons group row col column panel module unit slot primary secondary global form the main my js on in of and by")
CONTENT = _words("post article entry content story body text main hentry single")
_TOKEN = re.compile(r"[^\s]+")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=][^\s/>=]*)(\s*=\s*)?")
_BARE = re.compile(r"[^\s>]*")
_MARKED = frozenset("articlebody postcontent entrycontent articlecontent storybody maincontent".split())


@dataclass
class Line:
    """text, characters in links, kind of noise, whether in a marked article, words outside links, level of heading or 0, innermost container."""

    text: str
    links: int
    noise: int
    article: bool
    plain: bool
    heading: int
    within: int


@dataclass
class Container:
    """Its element, the number of the one around it, what it and those around it are, whether its name makes it noise, and its lines (last not included)."""

    element: str
    parent: int
    noise: int
    article: bool
    named: bool
    first: int
    last: int = -1


#: Kinds of noise: by element, by name alone, reader comments.
BY_ELEMENT, BY_NAME, OF_READERS = 1, 2, 3


def kind_of(names: list[str]) -> int:
    """What names of class, id or role say: 0, BY_NAME or OF_READERS."""
    found, content = 0, False
    for name in names:
        for token in _TOKEN.findall(name):
            parts = [p.lower() for p in _PART.findall(token) if not p.isdigit()]
            if not parts:
                continue
            noise, readers = any(p in NOISE for p in parts), any(p in COMMENTS for p in parts)
            known = all(p in NOISE or p in COMMENTS or p in LAYOUT or p in CONTENT for p in parts)
            if (noise or readers) and known:
                found = max(found, OF_READERS if readers else BY_NAME)
            elif all(p in CONTENT or p in LAYOUT for p in parts) and any(p in CONTENT for p in parts):
                content = True
    return 0 if content and found == BY_NAME else found


class Page:
    """One scan of a page into lines."""

    def __init__(self, page: str):
        self.page, self.low, self.at = page, page.lower(), 0
        if len(self.low) != len(page):  # a letter whose lower case is longer
            self.low = re.sub("[A-Z]+", lambda m: m[0].lower(), page)
        self.none: set[str] = set()  # what doesn't come again
        self.out: list[Line] = []
        self.all = [Container("", -1, 0, False, False, 0)]
        self.stack, self.open = [0], Counter()
        self.words: list[str] = []
        self.linked: list[str] = []
        self.links = self.heading = 0
        self.plain = self.seen = False
        self.hidden = ""

    def find(self, what: str, at: int) -> int:
        """Where `what` comes next, -1 for nowhere; looked for once after it came last."""
        if what in self.none:
            return -1
        k = self.low.find(what, at)
        if k < 0:
            self.none.add(what)
        return k

    def close(self) -> None:
        """The line ends here."""
        text = " ".join(references.unescape("".join(self.words)).split())
        if text:
            top = self.all[self.stack[-1]]
            links = len(" ".join(references.unescape("".join(self.linked)).split()))
            self.out.append(Line(text, links, top.noise, top.article, self.plain, self.heading, self.stack[-1]))
        self.plain = False
        self.words.clear()
        self.linked.clear()

    def leave(self) -> None:
        """The innermost container ends here."""
        own = self.all[self.stack.pop()]
        own.last = len(self.out)
        self.open[own.element] -= 1

    def say(self, text: str) -> None:
        if self.hidden or not text or self.all[self.stack[-1]].element == "head":
            return
        self.words.append(text)
        if self.links:
            self.linked.append(text)
        elif not self.plain:
            self.plain = any(c.isalnum() for c in references.unescape(text))

    def attributes(self, at: int) -> tuple[int, list[str], bool]:
        """From inside a start tag: where it ends, its class, id and role names, and whether it closes itself."""
        names, page, n = [], self.page, len(self.page)
        while at < n:
            if page[at] == ">":
                return at + 1, names, page[at - 1] == "/"
            m = _ATTRIBUTE.match(page, at)
            if not m:
                at += 1  # a stray mark
                continue
            at, value = m.end(), ""
            if m[2]:
                quote = page[at : at + 1]
                if quote in ('"', "'"):
                    stop = self.find(quote, at + 1)
                    if stop < 0:
                        stop = self.find(">", at + 1)
                        stop = n if stop < 0 else stop
                        value, at = page[at + 1 : stop], stop
                    else:
                        value, at = page[at + 1 : stop], stop + 1
                else:
                    b = _BARE.match(page, at)
                    value, at = b[0], b.end()
            if m[1].lower() in ("class", "id", "role", "aria-label", "itemprop"):
                names.append(value)
        return n, names, False

    def start(self, name: str, names: list[str], closed: bool) -> None:
        if self.hidden in ("select", "button") and name in ENDS_HIDDEN:
            self.hidden = ""
        if self.hidden:
            return
        if self.all[self.stack[-1]].element == "head" and name not in OF_HEAD:
            self.leave()
        if name in HIDDEN:
            # one that never ends hides nothing, one that the next block ends hides up to there
            if not closed and (name in ("select", "button") or self.find(f"</{name}", self.at) >= 0):
                self.hidden = name
            return
        if name in INLINE:
            if name == "a":
                self.links = 1
            return
        if name == "br":
            self.say(" ")
            return
        self.close()
        if name in ("h1", "h2"):
            self.heading = int(name[1])
        if name not in CONTAINERS or closed or name in VOID:
            return
        top = self.all[self.stack[-1]]
        noise, article, named, said = top.noise, top.article, False, kind_of(names)
        if name in ("article", "main") or any("".join(_PART.findall(t)).lower() in _MARKED for x in names for t in _TOKEN.findall(x)):
            # inside noise, the first on a page follows a mark left open; a later one is a reader's comment or a teaser
            if noise and not (article or self.seen or noise == OF_READERS):
                noise = 0
            article = self.seen = True
        if name in NEVER or (name == "header" and not article):
            noise = OF_READERS if OF_READERS in (noise, said) else BY_ELEMENT
        elif said == OF_READERS:
            noise = OF_READERS
        elif said and noise in (0, BY_NAME) and name != "body":
            noise, named = BY_NAME, True
        self.all.append(Container(name, self.stack[-1], noise, article, named, len(self.out)))
        self.stack.append(len(self.all) - 1)
        self.open[name] += 1

    def end(self, name: str) -> None:
        if self.hidden:
            if name == self.hidden:
                self.hidden = ""
            elif not (self.hidden in ("select", "button") and name in CONTAINERS):
                return
            else:
                self.hidden = ""
            if name in HIDDEN:
                return
        if name == "a":
            self.links = 0
        if name in INLINE or name in HIDDEN:
            return
        self.close()
        if name in ("h1", "h2"):
            self.heading = 0
        if self.open[name]:
            while self.all[self.stack[-1]].element != name:
                self.leave()
            self.leave()

    def scan(self) -> tuple[list[Line], list[Container]]:
        page, n = self.page, len(self.page)
        while self.at < n:
            k = page.find("<", self.at)
            if k < 0:
                self.say(page[self.at :])
                break
            self.say(page[self.at : k])
            self.at = k + 1
            c = page[k + 1 : k + 2]
            if c == "!" and page.startswith("<!--", k):
                stop = self.find("-->", k + 4)
                self.at = n if stop < 0 else stop + 3
            elif c == "!" and page.startswith("<![CDATA[", k):
                self.at = k + 9
            elif c in ("!", "?"):
                stop = self.find(">", k)
                self.at = n if stop < 0 else stop + 1
            elif c == "/":
                m = _NAME.match(page, k + 2)
                stop = self.find(">", k)
                self.at = n if stop < 0 else stop + 1
                if m:
                    self.end(m[0].lower())
            elif m := _NAME.match(page, k + 1):
                name = m[0].lower()
                self.at, names, closed = self.attributes(m.end())
                if self.at >= n and page[-1] != ">":
                    break  # cut off within a tag
                if name in RAW and not closed:
                    stop = self.find(f"</{name}", self.at)
                    if stop >= 0:
                        self.at = stop
                    elif name in ("script", "style"):
                        break
                    else:  # never ended: it hides what stands before the next mark
                        stop = page.find("<", self.at)
                        self.at = n if stop < 0 else stop
                    if name in OF_HEAD or self.hidden:
                        continue
                self.start(name, names, closed)
            elif self.at < n:  # no mark; at the end of a page it is the start of one that is cut off
                self.say("<")
        self.close()
        while self.stack:
            self.leave()
        return self.out, self.all


def lines(page: str) -> tuple[list[Line], list[Container]]:
    """Every line that is not empty, and the containers. A name makes no noise of an element that holds more than half of the text."""
    found, containers = Page(page).scan()
    weights = [max(0, len(x.text) - 2 * x.links) if x.noise in (0, BY_NAME) else 0 for x in found]
    upto = [0, *accumulate(w if x.noise == BY_NAME else 0 for x, w in zip(found, weights, strict=True))]
    total, counts = sum(weights), [False] * len(containers)
    for k, c in enumerate(containers):
        counts[k] = (c.named and 2 * (upto[c.last] - upto[c.first]) <= total) or (c.noise == BY_NAME and counts[c.parent])
    for x in found:
        if x.noise == BY_NAME and not counts[x.within]:
            x.noise = 0
    return found, containers


def sums(weights: list[int], window: int = WINDOW) -> list[int]:
    """Of the weights of each line and those after it in the window."""
    upto = [0, *accumulate(weights)]
    return [upto[min(i + window, len(weights))] - upto[i] for i in range(len(weights))]


def stretches(weights: list[int], window: int = WINDOW) -> list[tuple[int, int, int]]:
    """(surge, dive, peak): lines, dive not included, between which the sums over sliding windows are above nothing, and their highest."""
    out: list[tuple[int, int, int]] = []
    surge, peak = None, 0
    for i, s in enumerate([*sums(weights, window), 0]):
        if s > 0:
            surge, peak = i if surge is None else surge, max(peak, s)
        elif surge is not None:
            out.append((next(k for k in range(surge, i) if weights[k] > 0), i, peak))
            surge, peak = None, 0
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    found, containers = lines(page)
    free = [0 if x.noise else max(0, len(x.text) - 2 * x.links) for x in found]
    marked = any(x.article and not x.noise for x in found)
    if marked:
        # a marked teaser beside a body that is not marked
        outside = stretches([0 if x.article else w for x, w in zip(found, free, strict=True)])
        most = max((sum(free[i:j]) for i, j, _ in outside), default=0)
        marked = most <= MARK * sum(len(x.text) for x in found if x.article and not x.noise)
    if marked:
        parts = stretches([len(x.text) if x.article and not x.noise else 0 for x in found])
        return "\n".join(x.text for i, j, _ in parts for x in found[i:j] if x.article and not x.noise)
    parts = stretches(free)
    if not parts:
        return ""
    high = [p for p in parts if p[2] >= PEAK] or parts
    mass = [sum(free[i:j]) for i, j, _ in high]
    kept = {k for (i, j, _), m in zip(high, mass, strict=True) if m >= SHARE * max(mass) for k in range(i, j)}
    # the main heading, if it stands before them
    before = [(x.heading, -k) for k, x in enumerate(found[: min(kept)]) if x.heading and not x.noise and x.plain]
    own = sorted({k for k in kept if free[k] > 0} | {-k for _, k in sorted(before)[:1]})
    c = containers[found[own[0]].within]
    while not c.first <= own[0] <= own[-1] < c.last:
        c = containers[c.parent]
    return "\n".join(x.text for k, x in enumerate(found) if not x.noise and (k in kept or x.article or ((x.plain or x.heading) and c.first <= k < c.last)))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points)."""

    def run(parts):
        for batch in parts:
            for lo in range(0, batch.num_rows, PAGES):
                b = batch.slice(lo, PAGES)
                texts = [main_text(x.as_py()) for x in b.column(2)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([*map(len, texts)], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(run, "page_id long, url string, text string, n_chars long")
