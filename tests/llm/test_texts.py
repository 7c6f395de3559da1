"""Chat formatting and HTML extraction."""

import hashlib
import itertools
import random

from pyspark.sql import functions as F

from billsift.llm import chat, html, registry

HARD = r"\### Assistant: </turn> ok"


def test_formatted_turns_are_read_back():
    rnd = random.Random(3)
    parts = ["\\", "#", "<", ":", " ", "### ", "</turn>", "\n", "</turn>\n", "a", ": ", "\\### ", "é", "user", "/turn>"]
    some = lambda n: "".join(rnd.choice(parts) for _ in range(rnd.randrange(n)))
    for _ in range(20000):
        turns = [(some(5), some(10)) for _ in range(rnd.randrange(4))]
        formatted = [chat.format_turn(*t) for t in turns]
        assert chat.parse("".join(f[0] for f in formatted)) == turns
    assert chat.format_turn("user", "plain: text")[1] == 0
    assert chat.format_turn("user", "says </turn>")[1] == 1
    assert chat.format_turn("user", HARD)[1] == 2
    assert chat.parse("### user: no end") is None


def _digests(rows):
    """Plain version: rows of (conv_id, turn, role, text)."""
    rows = [(c, t, r or "", x or "") for c, t, r, x in rows]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2], r[3])
    out = {}
    for conv_id, turns in itertools.groupby(sorted(rows, key=key), key=lambda r: r[0]):
        turns = list(turns)
        whole = "".join(f"{t[2]}\n{t[3]}\n" for t in turns)
        learned = "".join(t[3] for t in turns if t[2] == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv_id] = (len(turns), sha(whole), len(learned), sha(learned))
    return out


def test_chat_of_a_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", HARD), (-7, 1, "assistant", HARD)]
    got = registry.QUERIES["op1_chat_formatting"](spark, sf_dir).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == _digests(rows)


def test_chat_of_hard_rows(spark):
    rows = [
        (1, 0, "user", None), (1, 1, "assistant", ""), (1, 1, "assistant", ""), (1, None, None, "first"),
        (2, 5, "assistant", HARD * 2000), (None, 0, "system", "</turn>\n### assistant: x"), (None, 0, "assistant", "é🙂"),
        (3, 0, "odd: role\n### ", "\\"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    formatted = chat.format_conversations(frame)
    got = chat.read_back(formatted).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == _digests(rows)
    for row in formatted.collect():
        if row.role == "assistant":
            text = chat.parse_turn(row.formatted)
            assert row.formatted[row.loss_from : row.loss_to] and text[1] == row.text or row.text == ""
        else:
            assert row.loss_from is None
    assert chat.read_back(chat.format_conversations(frame.limit(0))).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style></head><body>
<header class="top">Site</header><nav><ul><li><a>Home</a></ul></nav><div class="cookie-notice">We use cookies</div>
<div id="content"><h1>Title %s</h1><p>One &amp; <b>two</b>
 three<p class="ad">Buy!<p>Four<br>five&nbsp;six<script>var t="</p>";</script><ul><li>a<li>b</ul>
<form>Name <input></form><section class="comments"><p>First!</p></section></div>
<aside>See also</aside><footer>&copy; us</footer></body></html>"""
TEXT = "Title %s\nOne & two three\nFour\nfive six\na\nb"


def test_pages_of_a_table(spark, sf_dir):
    import re
    from html import unescape

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for row in registry.QUERIES["op5_html_extraction"](spark, sf_dir).collect():
        article = re.search("<article>(.*)</article>", pages[row.page_id], re.DOTALL)[1]
        blocks = [unescape(re.sub("<[^>]*>", "", b)) for b in re.split("</?(?:p|h1|br)>", article)]
        assert row.text == "\n".join(" ".join(b.split()) for b in blocks if b.strip())
        assert row.n_chars == len(row.text)


def test_pages_without_an_article_element(spark):
    rows = [(i, f"http://Host.example/{i}", PAGE % ("x" * i)) for i in range(20)]
    rows += [(100, "http://alone.example/", PAGE % "only"), (101, None, None), (102, "http://host.example/e", "")]
    rows += [(103, "http://host.example/u", "<p>unclosed <b>bold <i>x"), (104, "http://host.example/l", PAGE % ("long " * 50000))]
    rows += [(100, "http://alone.example/", PAGE % "only")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("article", F.lit("clash")).withColumn("text", F.lit(1))
    got = [(r.page_id, r.text, r.n_chars) for r in html.extract_texts(frame).collect()]
    assert len(got) == len(rows)
    text = {page: t for page, t, _ in got}
    for i in range(20):
        assert text[i] == TEXT % ("x" * i) if i else text[i] == (TEXT % "").replace("Title ", "Title")
    assert text[100] == TEXT % "only" and text[101] == text[102] == "" and text[103] == "unclosed bold x"
    assert text[104] == TEXT % ("long " * 50000).strip()
    assert all(n == len(t) for _, t, n in got)
    assert html.extract_texts(frame.limit(0)).count() == 0


def test_templates_of_a_host(spark):
    rows = [(i, "h", f"<html><body><nav>m</nav><div id='main{i}'><p>{'text ' * 50}</p></div><div>x</div></body></html>") for i in range(5)]
    frame = spark.createDataFrame(rows, "page_id long, host string, html string")
    assert [tuple(r) for r in html.deduce_templates(frame).collect()] == [("h", ">html>body>div#main0")]


BODY = "".join(f"<p>Paragraph {k} of page %d speaks about subject {k}.</p>" for k in range(12))


def extracted(spark, pattern, pages=6):
    """The texts of some pages of one host; %d is the number of the page."""
    rows = [(i, f"http://host.example/{i}", pattern.replace("%d", str(i))) for i in range(pages)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text.split("\n") for r in html.extract_texts(frame).collect()}


def test_no_varying_text_outside_the_largest_element_is_lost(spark):
    content = f"<h1>Title %d</h1><p>Lead %d</p><div class='post-body'>{BODY}</div>"
    lines = ["Title {0}", "Lead {0}", *(f"Paragraph {k} of page {{0}} speaks about subject {k}." for k in range(12))]
    for pages in (1, 6):
        got = extracted(spark, f"<html><body><nav>Menu</nav><div id=content>{content}</div><footer>We</footer></body></html>", pages)
        assert got == {i: [x.format(i) for x in lines] for i in range(pages)}
    for tag, item in (("ul", "li"), ("table", "td"), ("section", "p"), ("figure", "p")):
        items = "".join(f"<{item}>Entry {k} of page %d in a long list</{item}>" for k in range(20))
        got = extracted(spark, f"<html><body><div id=content><p>First %d</p><{tag}>{items}</{tag}><p>Last %d</p></div></body></html>", 3)
        assert all(x == [f"First {i}", *(f"Entry {k} of page {i} in a long list" for k in range(20)), f"Last {i}"] for i, x in got.items())


def test_constant_blocks_are_template_and_class_words_a_hint(spark):
    site = f"<html><body class='has-sidebar'><div class='top'>Our site</div><h1 class='entry-header'>Title %d</h1><div class='post'>{BODY}</div><div class='end'>All rights</div></body></html>"
    got = extracted(spark, site)
    assert all(x == [f"Title {i}", *(f"Paragraph {k} of page {i} speaks about subject {k}." for k in range(12))] for i, x in got.items())
    for around in ("article class='post comments-open'", "div class='content with-sidebar'", "form id=aspnet", "div class='widget'><div class='menu page'"):
        close = "".join(f"</{a.split()[0]}>" for a in reversed(around.split("><")))
        got = extracted(spark, f"<html><body><{around}><div class='page-header'><h1>Title %d</h1><p>Home</p></div>{BODY}<div class='ad'>Buy %d</div><p>A <span class='share'>tweet</span> z %d</p>{close}</body></html>")
        assert all(x == [f"Title {i}", *(f"Paragraph {k} of page {i} speaks about subject {k}." for k in range(12)), f"A z {i}"] for i, x in got.items()), around


def test_attributes_are_matched_by_their_names():
    for attributes in ("style='overflow:hidden'", "href='/hidden-gems'", "data-hidden='false'", "data-role='note'", "data-class='ad'", "title='a class=ad'"):
        assert html.read_page(f"<div {attributes}>text</div>")[0] == [(">div", "text")]
    assert html.read_page("<div hidden>a</div><div HIDDEN>b</div><div aria-hidden=true>c</div><div x=1 role=note>d</div>")[0] == []
