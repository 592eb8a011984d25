import html
import random
import re
import time
from html.parser import HTMLParser

import pytest

from llm_fixtures import SF_SMALL
from marginflow.llm import html_text, registry

PROSE = ("This is a paragraph of the article, and it is long enough to be judged by the words that are in it, "
         "which is what the rule is for, as the text says here and there on the page for all to see.")


def test_query_against_the_articles(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    rows = registry.QUERIES["op3_html_extraction"](spark, SF_SMALL).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"(?s)<article>(.*)</article>", pages[r["page_id"]]["html"])[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split())
                  for x in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(b for b in blocks if b)
        assert (r["url"], r["n_chars"]) == (pages[r["page_id"]]["url"], len(r["text"]))


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<p></p>", ""), ("<html><body><script>a<b</script></body>", ""),
    (f"<article><p>a&amp;b &lt;x&gt;\n\t c</p><p>{PROSE}</p></article>", f"a&b <x> c\n{PROSE}"),
    (f"<header>Top</header><article><header><h1>T</h1></header><p>x<script>if(a<b)'</p>'</script>y</article><footer>{PROSE}", "T\nxy"),
    (f"<main><p>one<br>two</p><aside>{PROSE}</aside><p>three</main><p>{PROSE}</p>", "one two\nthree"),
    (f"<article>a<!-- <p>no</p> --><b>b</b><div class='ad-box'>{PROSE}</div><div id=comments><p>{PROSE}</p></div>c", "ab\nc"),
    ("<article><p>a <span class=\"share links\">no</span> b</p><form><p>no</p></form><style>no</style></article>", "a\nb"),
    ("<ARTICLE><P>Up<P>per</ARTICLE>", "Up\nper"),
    (f"<article><div class=entry-header><h1>T</h1></div><p>x<ol class='commentList'><li>{PROSE}</ol><p id=userComments>{PROSE}", "T\nx"),
    ("<article><p>unclosed <b>bold <i>and</b> on</p><p hidden>no</p><p>2 < 3 & 4</p></article>", "unclosed bold and on\n2 < 3 & 4"),
])
def test_pages(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("page,text", [
    ("<article>a<svg width='1'/>b<math/>c</article>", "abc"),
    ("<article>a<svg><svg/><g><svg>no</svg></g>no</svg>b</article>", "ab"),
    *[(f"<nav><{x}>Menu</nav><article><p>one</p><{x}><p>two</p></article>", "one\ntwo")
      for x in "button select object video audio canvas noscript iframe template svg".split()],
    ("<article><p>one <button>two</p><p>three</p><button>no</button><p>four</p></article>", "one two\nthree\nfour"),
    ("<article>a<video src=x><p>no</p></video>b<object><object>no</object>no</object>c</article>", "abc"),
    ("<article>a<canvas><!-- </canvas> --><script>'</canvas>'</script>no</canvas>b</article>", "ab"),
    ("<article>a<textarea>b</article>", "a"), ("<article>a<script>b</article>", "a"),
])
def test_skipped_elements_take_no_more_than_their_own(page, text):
    assert html_text.main_text(page) == text
    assert html_text.main_text(page + "<svg>" * 20_000 + "</div>" * 20_000) == text  # in linear time


def test_two_passes_without_an_article():
    page = (f"<div id=menu><a href=x>Home</a> <a href=y>About</a></div><h1>Title</h1><p>{PROSE}</p><p>Short.</p><p>{PROSE}</p>"
            f"<p><a href=1>link one</a> <a href=2>link two</a> <a href=3>link three</a></p><p>Lone tail</p>"
            f"<div class=cookie-notice>{PROSE}</div>")
    assert html_text.main_text(page) == f"Title\n{PROSE}\nShort.\n{PROSE}"
    words = html_text.blocks_of("<p>zzz</p>")
    html_text.classify(words)
    assert words[0].label == "bad"  # nothing decided around it


CARD = "<article class=card><h3><a href=x>Another story</a></h3><p>What it says.</p></article>"
LINKS = "<ul><li><a href=1>one more page</a></li><li><a href=2>and another page</a></li></ul>"
LONG = f"{PROSE} {PROSE}"


@pytest.mark.parametrize("page,text", [
    (f"{CARD}<div><h1>Title</h1><p>{PROSE}</p><p>Short.</p><p>{PROSE}</p></div>{CARD}", f"Title\n{PROSE}\nShort.\n{PROSE}"),
    (f"<table><tr><td>{PROSE}<td>{PROSE}</table>{CARD}", f"{PROSE}\n{PROSE}"),
    (f"<article><h1>A</h1><p>{PROSE}</p></article><article><h1>B</h1><p>{PROSE}</p><p>End.</p></article>{CARD}", f"A\n{PROSE}\nB\n{PROSE}\nEnd."),
    (f"<article><p>{PROSE}</p>{LINKS}<p>{PROSE}</p></article>{LINKS}", f"{PROSE}\n{PROSE}"),
    (f"<article><h2><a href=x>Linked title</a></h2><p>See <a href=y>it</a> all.</p><p>{PROSE}</p><p>zz</p></article>",
     f"Linked title\nSee it all.\n{PROSE}\nzz"),
    (f"<article><p>{LONG}</p></article><div>More</div><div>{LONG}</div><p>{PROSE}</p>", f"{LONG}\nMore\n{LONG}\n{PROSE}"),
    (f"<article><p>{LONG}</p><p>{LONG}</p></article><div>Related</div><p>{PROSE}</p>", f"{LONG}\n{LONG}"),
    (f"<main><p>{PROSE}</p>{LINKS}{CARD}<p>Last.</p></main><div>{PROSE}</div>", f"{PROSE}\nLast."),
    (f"<div role=main><p>few words</p></div><p>{PROSE}</p>", "few words"),
    ("<article><p>zzz yyy</p></article><p>xxx</p>", "zzz yyy"),
])
def test_an_article_element_is_evidence_only(page, text):
    assert html_text.main_text(page) == text


def test_edge_rows(spark):
    rows = [(1, None, None, "a"), (2, "u", "<p>", "b"), (2, "u", "<p>", "b"), (None, "u", "<article>" + "<p>x" * 20_000, "c"),
            (4, "u", "<" * 3_000 + "a \"" * 3_000, "d")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {(r["page_id"], r["url"]): r for r in html_text.extract(frame).collect()}
    assert html_text.extract(frame).count() == 5 and got[(1, None)]["text"] == "" and got[(2, "u")]["n_chars"] == 0
    assert got[(None, "u")]["n_chars"] == 39_999
    assert html_text.extract(frame.where("false")).count() == 0


RUSSIAN = "Это длинный абзац статьи на русском языке, и в нём достаточно слов, чтобы правило о длине блока сработало здесь."
CHINESE = "这是一篇文章的段落" * 10
FOUR = "".join(f"<p>{PROSE} {i}</p>" for i in range(4))
FOUR_TEXT = "\n".join(f"{PROSE} {i}" for i in range(4))


@pytest.mark.parametrize("page,text", [
    (f"<nav>Menu</nav><article><div class='entry links'>{FOUR}</div></article>", FOUR_TEXT),
    (f"<div class='ad-free reading'>{FOUR}</div><footer>{PROSE}</footer>", FOUR_TEXT),
    (f"<form action=x><div class=menu>Menu</div><h1>T</h1>{FOUR}<div id=comments><p>{PROSE}</p></div></form>", f"T\n{FOUR_TEXT}"),
    (f"<div class='layout with-sidebar'><h1>T</h1>{FOUR}<div class=sidebar><p>{PROSE}</p></div></div>", f"T\n{FOUR_TEXT}"),
    (f"<div class=nav>меню</div><p>{RUSSIAN}</p><p>{RUSSIAN}</p>", f"{RUSSIAN}\n{RUSSIAN}"),
    (f"<p>{CHINESE}</p><p><a href=x>{CHINESE}</a></p>", CHINESE),
    # what stays out: comments beside a short article, adverts, forms and notices beside an article
    (f"<article><h1>T</h1><p>{PROSE}</p></article><section class=comments><article>{FOUR}</article></section>", f"T\n{PROSE}"),
    (f"<article><p>{PROSE}</p><form><p>{PROSE}</p></form><div class=promo><p>{PROSE}</p></div><p>{PROSE}</p></article>", f"{PROSE}\n{PROSE}"),
    (f"<div hidden>{FOUR}</div><p>{PROSE}</p>", PROSE),
])
def test_names_are_evidence_only(page, text):
    assert html_text.main_text(page) == text


HOSTILE = {
    "quotes": "<a href=\"", "inner ends": "<a x='>'>", "inner ends only": "<a x='>'", "bold": "<b>", "div": "<div>", "italic": "<i>",
    "heads": "<head>", "scripts": "</script ", "svg": "<svg>", "comments": "<!-", "regions": "<div class=ad>", "article": "<article>",
    "links": "<a>x", "headings": "<h1>x", "entities": "&amp", "less": "<", "names": "<a class=", "spaces": "<p class   ",
    "bold text": "<b>x", "closes": "</b>", "end quotes": "<a 'b\">", "rows": "<tr><td>x", "marked": "<b class=ad>x"}


@pytest.mark.parametrize("name", HOSTILE)
def test_hostile_markup_is_read_in_linear_time(name):
    piece = HOSTILE[name]
    page = piece * (500_000 // len(piece))
    began = time.time()
    html_text.main_text(page)
    html_text.main_text(f"<script>{page}</script>{page}</b></i><p>end")
    assert time.time() - began < 30          # quadratic ones take hours


def test_inline_elements_closed_from_outside():
    page = "<i>" * 30_000 + "<b>" * 30_000 + "x" + "</i>" * 30_000 + "y" + "</b>" * 30_000
    began = time.time()
    assert [b.text for b in html_text.blocks_of(page)] == ["xy"] and time.time() - began < 10


class Cutter(HTMLParser):
    """A second version of cutting well-formed pages into blocks, on the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks, self.parts, self.skipped = [], [], 0

    def cut(self):
        text = " ".join("".join(self.parts).split())
        self.blocks += [text] if text else []
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag in html_text.SKIPPED:
            self.skipped += 1
        elif tag == "br":
            self.parts.append(" ")
        elif tag in html_text.BLOCK and not self.skipped:
            self.cut()

    def handle_startendtag(self, tag, attrs):
        if tag == "br" and not self.skipped:
            self.parts.append(" ")

    def handle_endtag(self, tag):
        if tag in html_text.SKIPPED:
            self.skipped -= 1
        elif tag in html_text.BLOCK and not self.skipped:
            self.cut()

    def handle_data(self, data):
        if not self.skipped:
            self.parts.append(data)


def test_blocks_against_a_second_version():
    draw = random.Random(9)

    def markup(depth):
        out = []
        for _ in range(draw.randrange(1, 4)):
            kind = draw.random()
            if kind < 0.4 or depth > 4:
                out.append(draw.choice(["word ", "two  words\n", "&lt;b&gt; ", "caf&eacute; ", "&#233;", "a &amp; b", "<br>", "<!-- <p>no</p> -->"]))
            elif kind < 0.6:
                x = draw.choice(["div", "section", "blockquote", "h2", "table", "pre"])
                out.append(f"<{x} title='a > b' data-x=\"it's\">{markup(depth + 1)}</{x}>")
            elif kind < 0.9:
                x = draw.choice(["b", "i", "span", "em", "a"])
                out.append(f"<{x} title=\"<p>\">{markup(depth + 3)}</{x}>")
            else:
                out.append("<script>if (a < b) '<p>';</script><style>p > a {}</style><svg><g>no</g></svg>")
        return "".join(out)

    for _ in range(400):
        page = markup(0)
        cutter = Cutter()
        cutter.feed(page)
        cutter.close()
        cutter.cut()
        assert [b.text for b in html_text.blocks_of(page)] == cutter.blocks, page
