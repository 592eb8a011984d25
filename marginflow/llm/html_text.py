"""Main text of web pages by two passes over their blocks.

The markup is cut into blocks of text, in one linear scan. Menus, footers, forms, adverts, comments
and the like are out by where they stand, unless that would take most of the page's good
text: then the name of a container says nothing. The first pass decides every other
block by its link density, length and stop-word density; short blocks, and those
of middling density, stay undecided. An article or main element is evidence on
the undecided blocks in it: they are in, unless it is an article without one
good block and there is more good text beside it (a teaser). The second pass
gives the others the label of their nearest decided neighbours on their side of
the element's border.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_LINK_DENSITY = 0.33
SHORT_CHARS = 70
LONG_CHARS = 200
LOW_STOP_DENSITY = 0.15
HIGH_STOP_DENSITY = 0.30

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset("""
    the of and to in a is that for it was on with as be by this are at from or an not which but have
    der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden
    le la les de des et en un une du que qui dans pour pas sur au est par ce il plus avec ne se
    el los las y del que por con para una su al lo como más pero sus este es se no o
""".split())

# Elements by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style noscript template textarea title iframe svg math select button object canvas "
                    "audio video head".split())
#: Of these: what holds no markup, so that it ends at its close tag only, and what may close itself.
RAW = frozenset("script style textarea title".split())
FOREIGN = frozenset("svg math".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table "
                  "tbody td tfoot th thead tr ul".split())
#: Never part of the article, whatever they hold; a form may be wrapped around a whole page.
OUTSIDE = frozenset("nav footer aside menu dialog".split())
ENDS_ITSELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
               "th": {"td", "th"}}
# Words of class, id and role that name what is not the article.
OUTSIDE_NAMES = frozenset("""
    ad ads advert adverts advertisement advertising banner bottombar breadcrumb breadcrumbs byline-links comment comments
    consent contentinfo cookie cookies copyright dialog disclaimer disqus footer gdpr header links login masthead menu
    menubar modal nav navbar navigation newsletter notice notification pagination paywall popup promo promotion recommended
    related replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription
    toolbar topbar tracking widget
""".split())

# Parts of such words that are telling wherever they stand.
OUTSIDE_STEMS = tuple("advert breadcrumb comment cookie disqus footer navbar navigation newsletter popup sidebar sponsor "
                      "subscri".split())

# Of these words and stems, those that name a part of the page and not what it is about.
PLAIN_PARTS = ("breadcrumb comment consent cookie disqus footer gdpr menu nav replies respond sidebar").split()

_COMMENT = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
_NAME = re.compile(r"<(/?)([A-Za-z][^\s/>\"'<]*)")
_SPECIAL = re.compile(r"[>\"']")
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_MAIN = re.compile(r"\b(?:id|role)\s*=\s*[\"']?main(?=[\"'\s]|$)", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_WORD = re.compile(r"[^\W\d_]+")


class _Scanner:
    """The tags and comments of a page. Each is found in time that is linear in what it takes, and
    whatever is learned on the way about what lies ahead is kept."""

    def __init__(self, page: str):
        self.page = page
        self.last_end = page.rfind(">")
        #: quotes and ends from which no unquoted end lies ahead
        self.dead: set[int] = set()
        self.no_close: set[str] = set()

    def next(self, at: int) -> tuple[int, int, str, str, str] | None:
        """(start, end, slash, name, attributes) of the next tag, or with an empty name of the next comment."""
        page = self.page
        while (at := page.find("<", at)) >= 0:
            if page.startswith(("<!", "<?"), at):
                return at, _COMMENT.match(page, at).end(), "", "", ""
            if at > self.last_end:
                return self._comment_after(at)
            m = _NAME.match(page, at)
            if m is not None:
                end = self._end(m.end())
                return at, end + 1, m[1], m[2].lower(), page[m.end():end]
            at += 1
        return None

    def _comment_after(self, at: int) -> tuple[int, int, str, str, str] | None:
        """Where no tag ends any more, a comment may still take the rest."""
        found = [i for i in (self.page.find("<!", at), self.page.find("<?", at)) if i >= 0]
        return (min(found), len(self.page), "", "", "") if found else None

    def _end(self, at: int) -> int:
        """The ``>`` that ends a tag: the first outside quotes, or if there is none the first."""
        start, passed = at, []
        while (m := _SPECIAL.search(self.page, at)) is not None and m.start() not in self.dead:
            if m[0] == ">":
                return m.start()
            passed.append(m.start())
            closing = self.page.find(m[0], m.end())
            if closing < 0:
                break
            at = closing + 1
        self.dead.update(passed)
        return self.page.find(">", start)

    def raw_end(self, name: str, at: int) -> int:
        """Where an element ends that holds no markup; unclosed, it takes the rest, a head its tag alone."""
        if name not in self.no_close:
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(self.page, at)
            close = -1 if end is None else self.page.find(">", end.end())
            if close >= 0:
                return close + 1
            self.no_close.add(name)
        return at if name == "head" else len(self.page)


@dataclass
class Block:
    text: str
    link_chars: int
    #: the innermost container around it that is marked as not the article, by number (0: none)
    region: int
    #: the nearest article or main element around it, by number (0: none), and whether that is a main one
    frame: int
    main: bool
    heading: bool
    label: str = ""


@dataclass
class Region:
    """A marked container: the one around it, how sure the mark is (0: a word that may mean
    something else, 1: the name of a part, 2: an element that is never the article), and whether it holds
    a main element or a first heading."""
    parent: int
    sure: int
    main: bool = False


@dataclass
class _Open:
    name: str
    region: int
    marked: bool
    frame: int
    closed: bool = False


def _is_heading(name: str) -> bool:
    return len(name) == 2 and name[0] == "h" and name[1].isdigit()


@dataclass
class _Parser:
    blocks: list[Block] = field(default_factory=list)
    stack: list[_Open] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    links: list[str] = field(default_factory=list)
    #: whether each frame is a main element; the first stands for the page
    mains: list[bool] = field(default_factory=lambda: [False])
    regions: list[Region] = field(default_factory=lambda: [Region(0, 0)])
    #: the open elements of each name, and how many headings are open
    named: dict[str, list[_Open]] = field(default_factory=dict)
    headings: int = 0

    def top(self) -> _Open:
        return self.stack[-1] if self.stack else _Open("", 0, False, 0)

    def flush(self) -> None:
        text = " ".join(html.unescape("".join(self.parts)).split())
        if text:
            top = self.top()
            linked = " ".join(html.unescape("".join(self.links)).split())
            self.blocks.append(Block(text, len(linked), top.region, top.frame, self.mains[top.frame], self.headings > 0))
        self.parts, self.links = [], []

    def text(self, s: str) -> None:
        if not s:
            return
        self.parts.append(s)
        if self.named.get("a"):
            self.links.append(s)

    def _drop(self, x: _Open) -> None:
        """An element is no longer open; it leaves the stack when it is on top."""
        x.closed = True
        self.headings -= _is_heading(x.name)
        mine = self.named[x.name]
        if mine[-1] is x:
            mine.pop()
        else:
            mine.remove(x)

    def pop(self) -> None:
        x = self.stack.pop()
        if not x.closed:
            self._drop(x)
        while self.stack and self.stack[-1].closed:
            self.stack.pop()

    def open(self, name: str, attributes: str) -> None:
        if name in BLOCK:
            self.flush()
            while self.stack and self.stack[-1].name not in BLOCK and self.stack[-1].name != "a":
                if self.stack[-1].marked:
                    break
                self.pop()
            if self.stack and (self.stack[-1].name == "p" or self.stack[-1].name in ENDS_ITSELF.get(name, ())):
                self.pop()
        under = self.top()
        named = {w for m in _NAMES.finditer(attributes) for w in
                 re.split(r"[\s_-]+", (m[1] or m[2] or m[3] or "").lower())} if attributes else set()
        frame = under.frame
        if name in ("article", "main") or "main" in named and name in BLOCK:
            frame = len(self.mains)
            self.mains.append(name == "main" or bool(_MAIN.search(attributes)))
            self.regions[under.region].main |= self.mains[-1]
        if name == "h1":
            self.regions[under.region].main = True
        sure = _mark(name, attributes, named, under.frame)
        region = under.region
        if sure is not None:
            region = len(self.regions)
            self.regions.append(Region(under.region, sure))
        if name not in BLOCK and sure is not None:
            self.flush()  # a marked piece inside a block is a block of its own
        x = _Open(name, region, sure is not None, frame)
        self.stack.append(x)
        self.named.setdefault(name, []).append(x)
        self.headings += _is_heading(name)

    def close(self, name: str) -> None:
        if name in BLOCK:
            self.flush()
        if not self.named.get(name):
            return
        x = self.named[name][-1]
        if name in BLOCK:
            while not x.closed:
                self.pop()
        else:
            if x.marked:
                self.flush()
            self._drop(x)
            while self.stack and self.stack[-1].closed:
                self.stack.pop()


def _mark(name: str, attributes: str, named: set[str], frame: int) -> int | None:
    """How surely an element is not the article; None if nothing says so."""
    if name in OUTSIDE or attributes and _HIDDEN.search(attributes):
        return 2
    if name in ("body", "html", "article", "main"):
        return None
    words = named & OUTSIDE_NAMES
    if frame:
        words = words - {"header"}  # an article's own heading
    words |= {w for w in named if any(x in w for x in OUTSIDE_STEMS)}
    if any(w.startswith(x) or x in w and x in OUTSIDE_STEMS for w in words for x in PLAIN_PARTS):
        return 1
    return 0 if words or name == "form" or name == "header" and not frame else None


def _ends(scan: _Scanner) -> dict[int, int]:
    """Where the skipped elements end, by the place after their opening tag. One that
    is still open where an element around it closes, or at the end, is left out."""
    ends: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    held: dict[str, int] = {}
    at = 0
    while (tag := scan.next(at)) is not None:
        _, at, slash, name, attributes = tag
        if name in RAW:
            at = at if slash else scan.raw_end(name, at)
        elif name not in SKIPPED and name not in BLOCK or name in VOID or name == "head":
            continue
        elif not slash:
            if not (name in FOREIGN and attributes.endswith("/")):
                stack.append((name, at))
                held[name] = held.get(name, 0) + 1
        elif held.get(name):
            while True:
                last, start = stack.pop()
                held[last] -= 1
                if last == name:
                    break
            if name in SKIPPED:
                ends[start] = at
    return ends


def parse(page: str) -> tuple[list[Block], list[Region]]:
    """The blocks of text of a page, in order, without scripts, styles and comments, and its marked containers."""
    parser, scan, at, ends = _Parser(), _Scanner(page), 0, None
    while (tag := scan.next(at)) is not None:
        start, end, slash, name, attributes = tag
        parser.text(page[at:start])
        at = end
        if not name:
            continue
        if slash:
            parser.close(name)
        elif name == "br":
            parser.text(" ")
        elif name == "hr":
            parser.flush()
        elif name in SKIPPED:
            if name in RAW or name == "head":
                at = scan.raw_end(name, at)
            elif not (name in FOREIGN and attributes.endswith("/")):
                ends = _ends(scan) if ends is None else ends
                at = ends.get(at, at)
        elif name not in VOID and not attributes.endswith("/"):
            parser.open(name, attributes)
        elif name in BLOCK:
            parser.flush()
    parser.text(page[at:])
    parser.flush()
    return parser.blocks, parser.regions


def blocks_of(page: str) -> list[Block]:
    return parse(page)[0]


def outside(blocks: list[Block], regions: list[Region]) -> list[bool]:
    """For each region, whether it, or one around it, is out.

    A region that holds most of the page's good text is not out for a word that may
    mean something else (if that is two blocks or more, or all the text there is beside other regions), and
    not for the name of a part if it holds the page's main element or first heading."""
    chars, count = [0] * len(regions), [0] * len(regions)
    total = plain = 0
    for b in blocks:
        if b.label == "good":
            chars[b.region] += len(b.text)
            count[b.region] += 1
            total += len(b.text)
        plain += not b.region
    main = [r.main for r in regions]
    for i in range(len(regions) - 1, 0, -1):  # containers come before what they hold
        up = regions[i].parent
        chars[up] += chars[i]
        count[up] += count[i]
        main[up] |= main[i]
    out = [False] * len(regions)
    for i, r in enumerate(regions[1:], 1):
        most = 2 * chars[i] > total
        excused = most and (r.sure == 0 and (count[i] > 1 or not plain) or r.sure < 2 and main[i])
        out[i] = out[r.parent] or not excused
    return out


def classify(blocks: list[Block], regions: list[Region] | None = None) -> None:
    """Sets each block's label to ``good`` or ``bad``."""
    for b in blocks:
        b.label = _by_words(b)
    out = outside(blocks, regions or [Region(0, 0)])
    kept = [b for b in blocks if not out[b.region]]
    if not any(b.label == "good" for b in kept):
        for b in kept:  # a language without known words: length and links decide alone
            if not b.frame and not b.link_chars and len(b.text) >= SHORT_CHARS:
                b.label = "good"
    for b in blocks:
        if out[b.region]:
            b.label = "bad"
    good, undecided = Counter(), Counter()  # characters by frame
    for b in blocks:
        if b.label == "good":
            good[b.frame] += len(b.text)
        elif b.label != "bad":
            undecided[b.frame] += len(b.text)
    stated = any(b.main for b in kept)
    if stated or good.total() > 2 * good[0]:  # then text beside the frames must speak for itself
        for b in blocks:
            if not b.frame and b.label == "good" and len(b.text) <= LONG_CHARS:
                b.label = "near"
                good[0] -= len(b.text)
    total = good.total()
    framed = any(b.frame for b in kept)
    for b in blocks:
        if b.label in ("near", "short"):
            if b.frame and (b.main or good[b.frame] or undecided[b.frame] >= total):
                b.label = "good"
            elif framed and not b.frame and not good[0]:
                b.label = "bad"
    _inherit(blocks)


def _by_words(b: Block) -> str:
    """Good, bad, or undecided: near or short. What a frame holds is bad only for its links."""
    ws = _WORD.findall(b.text.lower())
    stops = sum(w in STOP_WORDS for w in ws) / max(len(ws), 1)
    n, links = len(b.text), b.link_chars / len(b.text)
    if b.frame and b.heading:
        return "short"  # often a link to the article itself
    if links > MAX_LINK_DENSITY or "©" in b.text and not b.frame:
        return "bad"
    if n < SHORT_CHARS:
        return "bad" if links > 0 and not b.heading and not b.frame else "short"
    if stops >= HIGH_STOP_DENSITY:
        return "good"
    return "near" if b.frame or stops >= LOW_STOP_DENSITY or n > LONG_CHARS and not links else "bad"


def _inherit(blocks: list[Block]) -> None:
    """Decides the undecided blocks of each frame by the others of that frame."""
    sides: dict[int, list[Block]] = {}
    for b in blocks:
        sides.setdefault(b.frame, []).append(b)
    for own in sides.values():
        for undecided in ("near", "short"):  # the longer ones first, so that they count as decided
            labels = [b.label for b in own]
            decided = [i for i, x in enumerate(labels) if x in ("good", "bad")]
            for i, b in enumerate(own):
                if b.label == undecided:
                    j = bisect_left(decided, i)
                    before = decided[j - 1] if j else None
                    after = decided[j] if j < len(decided) else None
                    b.label = _inherited(b, i, before, after, labels)


def _inherited(b: Block, i: int, before: int | None, after: int | None, labels: list[str]) -> str:
    """The label of the nearest decided neighbours; where they differ, a heading
    goes with what follows, a longer block stays, and a short one goes with the nearer."""
    if before is None or after is None:
        only = after if before is None else before
        return "bad" if only is None else labels[only]
    if labels[before] == labels[after]:
        return labels[before]
    if b.heading:
        return labels[after]
    if b.label == "near":
        return "good"
    return labels[before if i - before < after - i else after if after - i < i - before else before]


def main_text(page: str | None) -> str:
    """The page's article: its good blocks in order, one a line. Null: empty."""
    blocks, regions = parse(page or "")
    classify(blocks, regions)
    return "\n".join(b.text for b in blocks if b.label == "good")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) for every row.

    Null or empty markup, and pages without an article, give an empty text;
    broken markup is read as far as it goes; repeated rows each get a row; an
    empty table gives no rows; further columns are ignored."""
    def run(batches):
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    kind = pages.schema[id_col].dataType.simpleString()
    return (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                         F.col(html_col).cast("string").alias("html"))
            .mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long"))
