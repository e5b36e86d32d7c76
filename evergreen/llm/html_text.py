"""Main text of web pages as the maximum-scoring run of a page's tokens.

A page is a sequence of words and tags.  Words score positive, tags negative, and the
contiguous run with the highest sum, found in one linear scan, is the content region.
Only what is never shown as text leaves before the scan: scripts, styles, comments and
the like.  Everything else is a token.  A word's score depends on where it stands: in the
page's own article, outside of it, in a list item that is one link, or in an element whose
name, role, class or id marks it as a menu, header, footer, sidebar, notice, advert, form
or reader comment.  Such words score negative; those that lie inside the run are left out
of its text.  Names that only hint at other content (a word of a longer class or id, such
as ``has-sidebar`` or ``related-work``) score negative where the element starts and ends.

Elements are matched with their ends.  A marked element that nothing ends, one that holds
the main element or the page's only article, and a form with most of the page's words are
taken for markup slips or wrappers, and their words count as any others.

The weights come from labelled pages: a page that marks its one article or main element
itself tells which of its words and tags are content.  A token's weight is the log ratio
of its rate inside and outside, held above zero for plain words and below zero for tags and marks.

Null and empty html, and pages without words, give an empty text.  Of equal runs the
first is taken.  Repeated rows are extracted one by one; without labelled pages fixed
starting weights hold.  Only the named columns are read.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evergreen.llm.common import map_rows, read

# Fixed values of HTML: elements by what they do to text.
RAW = ("script", "style", "template", "textarea", "title", "iframe")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that stand in a paragraph without ending it.
PHRASING = frozenset("audio button canvas map math meter noscript object output picture progress select svg video".split())
#: Elements that end where the next of their kind starts, by their kind.
SELF_ENDING = {"p": "p", "li": "li", "dt": "dt", "dd": "dt", "tr": "tr", "td": "td", "th": "td", "option": "option"}
NEVER_TEXT = frozenset("head nav footer aside form dialog button select noscript svg".split())
#: Elements that are no part of an article unless they stand in it.
OUTER = frozenset("header menu".split())
WHOLE = frozenset("html body".split())
REGIONS = frozenset("article main".split())
#: Elements whose text is prose even if it is all links.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote dd figcaption".split())
# Words that mark an element as no part of an article if they make up a whole class, id or role.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored promo promotion sidebar nav navbar "
    "navigation breadcrumb breadcrumbs pagination pager masthead banner modal popup overlay newsletter subscribe cookie cookies "
    "consent gdpr notice notices menu menubar toolbar share sharing related recommended recommendations widget widgets footer "
    "login signup comment comments commentlist disqus respond reply replies complementary contentinfo search alertdialog dialog".split()
)
#: Words that may stand beside them in such a name.
BESIDE = frozenset(
    "site page user reader readers main top bottom left right box bar list area block section panel container wrapper wrap body "
    "content text message row item items inner outer links primary secondary global".split()
)
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies".split())
# Words that hint at the same in longer names.
HINTS = MARKS | frozenset("alert social subscription copyright legal disclaimer hidden".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])(?:\"[^\"]*\"|'[^']*'|[^\"'>])*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^\"'>])*(?:>|\Z)|[^>]*(?:>|\Z))",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.IGNORECASE)
HINT = "#"  # before the word of a hint among the tags
MARK = "@"  # before the word of a mark among the kinds of words
OUT, LINK = "out", "link"  # words outside the page's article; a short list item that is one link
LINK_WORDS = 5
#: Floor of a tag's score inside the page's own article, and ceiling of a marked word's, as parts of a word's.
PART = 0.25
WORD_PART = re.compile(r"[^A-Za-z0-9]+")
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


def attributes(attrs: str) -> dict[str, str]:
    """Values by lower-case name; of equal names the first counts."""
    found: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(attrs):
        found.setdefault(name.lower(), next(filter(None, values), ""))
    return found


def marks_of(name: str, attrs: str, in_article: bool) -> tuple[str, str]:
    """The word that marks the element as no article text, and the one that hints at it; empty texts if none."""
    if name in WHOLE or name == "main":
        return "", ""
    if name in NEVER_TEXT or name in OUTER and not in_article:
        return name, ""
    if "=" not in attrs and "hidden" not in attrs.lower():
        return "", ""
    has = attributes(attrs)
    if "hidden" in has or has.get("aria-hidden", "").lower() == "true" or NOT_SHOWN.search(has.get("style", "")):
        return "hidden", ""
    if not REGIONS.isdisjoint(has.get("role", "").lower().split()):
        return "", ""
    hint = ""
    for named in " ".join(has.get(n, "") for n in ("class", "id", "role")).split():
        parts = [w for w in WORD_PART.split(CAMEL.sub(" ", named).lower()) if w]
        marks = [w for w in parts if w in MARKS]
        if marks and all(w in MARKS or w in BESIDE for w in parts):
            if not (name in INLINE and parts == ["ad"]):  # "300 <span class=ad>AD</span>"
                return marks[0], ""
        elif not hint:
            hint = next((w for w in parts if w in HINTS), "")
    return "", hint if name not in REGIONS else ""


@dataclass
class Page:
    """Tokens of a page: (tag feature or None for text, text, whether inside the article or main element).

    ``kinds`` has, by token, where it stands: an empty text, ``OUT``, ``LINK`` or ``MARK`` and the word of the mark.
    """

    tokens: list[tuple[str | None, str, bool]]
    regions: int
    kinds: list[str] = field(default_factory=list)


@dataclass
class Element:
    """A marked element: what marks it, the marked one around it, whether it has an end, whether it is a wrapper."""

    mark: str
    around: int
    ended: bool = False
    wrapper: bool = False
    words: int = 0


class Reader:
    """Matches starts and ends of elements while the tokens of a page are gathered."""

    def __init__(self):
        #: (tag or None, text, nearest marked element, region, in a link)
        self.tokens: list[tuple[str | None, str, int, int, bool]] = []
        self.elements: list[Element] = []
        self.regions: list[int] = []  # by region, the marked element around it
        self.open: list[tuple[str, int, int, str]] = []  # name, mark and region outside of it, its hint
        self.names: Counter[str] = Counter()
        self.mark = self.region = -1
        self.link = False

    def add(self, tag: str | None, text: str = "") -> None:
        self.tokens.append((tag, text, self.mark, self.region, self.link))

    def leave(self) -> None:
        name, mark, region, hint = self.open.pop()
        self.names[name] -= 1
        if mark != self.mark:
            self.elements[self.mark].ended = True
        self.mark, self.region = mark, region
        if hint:
            self.add(HINT + hint)

    def end(self, name: str) -> None:
        if name in INLINE:
            self.link = self.link and name != "a"
            if self.open and self.open[-1][0] == name:
                self.leave()
        elif self.names[name] and name not in WHOLE:
            self.link = False
            while self.open[-1][0] != name:
                self.leave()
            if self.open[-1][1] != self.mark:  # its tags are marked as its words are
                self.add(name)
                self.leave()
                return
            self.leave()
        self.add("" if name in REGIONS else name)

    def start(self, name: str, attrs: str) -> None:
        if name in SELF_ENDING:
            at = len(self.open) - 1
            while at >= 0 and self.open[at][0] in SELF_ENDING:
                if SELF_ENDING[self.open[at][0]] == SELF_ENDING[name]:
                    while len(self.open) > at:
                        self.leave()
                    break
                at -= 1
        elif name not in INLINE and name not in VOID and name not in PHRASING and self.open and self.open[-1][0] == "p":
            self.leave()
        mark, hint = ("", "") if name in VOID else marks_of(name, attrs, self.region >= 0)
        if hint:
            self.add(HINT + hint)
        if not mark:
            self.add("" if name in REGIONS else name)
        if name == "a":
            self.link = True
        if name in VOID or name in WHOLE or attrs.endswith("/>") and name in ("svg", "math") or name in INLINE and not (mark or hint):
            if mark:
                self.add(name)
            return
        self.open.append((name, self.mark, self.region, hint))
        self.names[name] += 1
        if name == "main":
            around = self.mark
            while around >= 0 and not self.elements[around].wrapper:
                self.elements[around].wrapper = True
                around = self.elements[around].around
        if mark:
            self.elements.append(Element(mark, self.mark))
            self.mark = len(self.elements) - 1
            self.add(name)
        elif name in REGIONS and self.region < 0:
            self.regions.append(self.mark)
            self.region = len(self.regions) - 1

    def marks(self) -> list[int]:
        """By marked element, the nearest one from it outwards whose mark holds, or -1."""
        words = 0
        for tag, text, mark, _, _ in self.tokens:
            if tag is None:
                n = len(text.split())
                words += n
                if mark >= 0:
                    self.elements[mark].words += n
        for e in reversed(self.elements):
            if e.around >= 0:
                self.elements[e.around].words += e.words
        if len(self.regions) == 1:
            around = self.regions[0]
            while around >= 0 and self.elements[around].mark not in COMMENTS:
                self.elements[around].wrapper = True
                around = self.elements[around].around
        holds: list[int] = []
        for i, e in enumerate(self.elements):
            wrapper = e.wrapper or not e.ended or e.mark == "form" and 2 * e.words > words
            holds.append((holds[e.around] if e.around >= 0 else -1) if wrapper else i)
        return holds


def tokenise(page: str) -> Page:
    """Words and tags of all that can be text."""
    seen, at = Reader(), 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            seen.add(None, html.unescape(page[at : m.start()]))
        at = m.end()
        name = (m["name"] or "").lower()
        if name:
            if m["end"]:
                seen.end(name)
            else:
                seen.start(name, m["attrs"])
    if at < len(page):
        seen.add(None, html.unescape(page[at:]))

    holds = [*seen.marks(), -1]  # the last for no element
    valid = [holds[around] < 0 for around in seen.regions] + [False]
    inner = plain = 0
    for tag, text, mark, region, _ in seen.tokens:
        if tag is None and holds[mark] < 0:
            n = len(text.split())
            plain += n
            inner += n if valid[region] else 0
    trusted = 2 * inner >= plain and inner > 0  # a region with less is a teaser or the like
    tokens, kinds = [], []
    block: list[int] = []  # texts since the last tag that is not inline
    opener, linked, size = "", True, 0

    def close() -> None:
        if linked and 0 < size <= LINK_WORDS and opener not in PROSE:
            for i in block:
                if not kinds[i]:
                    kinds[i] = LINK

    for tag, text, mark, region, link in seen.tokens:
        inside = trusted and valid[region]
        if tag is None:
            n = len(text.split())
            linked, size = linked and (link or not n), size + n
            if not inside:
                block.append(len(tokens))
        elif tag not in INLINE and tag[:1] != HINT:
            close()
            block, opener, linked, size = [], tag, True, 0
        tokens.append((tag, text, inside))
        held = holds[mark]
        kinds.append(MARK + seen.elements[held].mark if held >= 0 else OUT if trusted and not inside and tag is None else "")
    close()
    return Page(tokens, sum(valid) if trusted else 0, kinds)


@dataclass
class Weights:
    word: float = 1.0
    tags: dict[str, float] = field(default_factory=dict)
    unknown_tag: float = -1.0
    unknown_hint: float = -10.0
    #: Scores of words by where they stand; of others, that of all marked words.
    words: dict[str, float] = field(default_factory=dict)

    def of_word(self, kind: str) -> float:
        return self.words.get(kind, self.words.get(kind[:1], -self.word)) if kind else self.word


def best_run(page: Page, weights: Weights) -> tuple[int, int]:
    """Token range with the highest sum; (0, 0) if no word is there."""
    best, best_range, total, start = 0.0, (0, 0), 0.0, 0
    kinds = page.kinds or [""] * len(page.tokens)
    for i, ((tag, text, inside), kind) in enumerate(zip(page.tokens, kinds, strict=True)):
        if tag is None:
            each = weights.of_word(kind)
            if each > 0 and total <= 0:
                total, start = 0.0, i
            if not (kind and inside):  # what is marked inside the article neither breaks nor joins
                total += each * len(text.split())
            if total > best:
                best, best_range = total, (start, i + 1)
        elif tag and not (kind and inside):
            unknown = weights.unknown_hint if tag[0] == HINT else weights.unknown_tag
            score = unknown if kind else weights.tags.get(tag, unknown)
            total += max(score, -PART * weights.word) if inside else score
    return best_range


def extract(page: str | None, weights: Weights) -> str:
    """Text of the best run: blocks in page order, white space collapsed to single spaces."""
    parsed = tokenise(page or "")
    start, stop = best_run(parsed, weights)
    parts = []
    for i in range(start, stop):
        tag, text, _ = parsed.tokens[i]
        if tag is not None:
            if tag not in INLINE and tag[:1] != HINT:
                parts.append(" ")
        elif parsed.kinds[i][:1] != MARK:
            parts.append(text)
    return " ".join("".join(parts).split())


def fit(pages: DataFrame, bound: int = 2000) -> Weights:
    """Weights from about ``bound`` pages with exactly one article or main element."""
    n = pages.count()
    share = 1 << 30 if n <= bound else int((1 << 30) * bound / n)
    sample = pages.filter(F.pmod(F.xxhash64(F.lit("sample"), "page_id"), F.lit(1 << 30)) < share).select("html")

    def make():
        def work(texts):
            seen: dict[str, list[int]] = {}
            for t in texts:
                page = tokenise(t or "")
                if page.regions != 1:
                    continue
                for (tag, text, inside), kind in zip(page.tokens, page.kinds, strict=True):
                    # Words by kind after a space, which no tag holds; what is marked is no article text wherever it stands.
                    marked = kind[:1] == MARK
                    key, size = (tag, 1) if tag is not None else (" " + kind, len(text.split()))
                    if key and not (tag is not None and marked):
                        seen.setdefault(key, [0, 0])[inside and not marked] += size
            return [list(seen), [v[1] for v in seen.values()], [v[0] for v in seen.values()]]

        return work

    totals = [F.sum("inside").alias("inside"), F.sum("outside").alias("outside")]
    counts = map_rows(sample, make, [("token", "string"), ("inside", "long"), ("outside", "long")]).groupBy("token").agg(*totals)
    # Names of tags are any text: those seen once are left to the weight of unknown tags, so the table is bounded by the sample.
    rows = counts.filter((F.col("inside") + F.col("outside") > 1) | F.col("token").startswith(" ")).collect()
    seen = {r["token"]: (r["inside"], r["outside"]) for r in rows}
    if not any(k[:1] == " " for k in seen):
        return Weights()
    # Plain words of pages without a region may stand anywhere.
    plain = [seen.get(" " + k, (0, 0)) for k in ("", OUT, LINK)]
    marked = [v for k, v in seen.items() if k.startswith(" " + MARK)]
    ins, outs = (sum(v[j] for v in seen.values()) for j in (0, 1))

    def ratio(inside: int, outside: int) -> float:
        return math.log((inside + 1) / (ins + 1)) - math.log((outside + 1) / (outs + 1))

    word = max(0.05, ratio(*map(sum, zip(*plain))))

    def below(value: float, ceiling: float) -> float:
        return min(-ceiling * word, max(-word, value))

    words = {k[1:]: below(ratio(*v), PART) for k, v in seen.items() if k[:1] == " " and k != " "}
    words[MARK] = below(ratio(*map(sum, zip(*marked))), PART) if marked else -word
    tags = {
        k: min(-0.05 * word, max(Weights.unknown_hint * word, ratio(*v))) if k[0] == HINT else below(ratio(*v), 0.05)
        for k, v in seen.items()
        if k[:1] != " "
    }
    return Weights(word, tags, -PART * word, Weights.unknown_hint * word, words)


def extract_pages(pages: DataFrame, weights: Weights) -> DataFrame:
    """(page_id, url, text, n_chars) for every page."""

    def make():
        def work(ids, urls, texts):
            found = [extract(t, weights) for t in texts]
            return [ids, urls, found, [len(t) for t in found]]

        return work

    fields = [("page_id", "long"), ("url", "string"), ("text", "string"), ("n_chars", "long")]
    return map_rows(pages.select(F.col("page_id").cast("long"), "url", "html"), make, fields)


def op4_html_text(spark, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return extract_pages(pages, fit(pages))
