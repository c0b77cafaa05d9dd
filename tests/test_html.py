"""HTML pages against the standard library's tokenizer with depth counters."""

import random
import re
from html.parser import HTMLParser

from pyspark.sql import functions as F

from slantwise import constants as K
from slantwise.functions import text as tx
from slantwise.sources.documents import html_documents

SF = "/root/testdata/sf0.01"
DROPPED = [t for t in K.DROPPED_TAGS if t not in K.RAW_TAGS]


class Reader(HTMLParser):
    """Text nodes outside dropped subtrees; one node ends where markup stands."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.nodes, self.raw, self.title, self.in_title = dict.fromkeys(DROPPED, 0), [""], False, None, False

    def close_node(self):
        self.nodes.append("")

    def handle_starttag(self, tag, attrs):
        self.close_node()
        self.raw = tag in K.RAW_TAGS
        if tag in self.depth:
            self.depth[tag] += 1
        if tag == "title" and self.title is None and not any(self.depth.values()):
            self.title, self.in_title = [""], True
        elif self.in_title:
            self.title.append("")

    def handle_startendtag(self, tag, attrs):
        self.close_node()

    def handle_endtag(self, tag):
        self.close_node()
        self.raw = False
        if tag in self.depth:
            self.depth[tag] = max(0, self.depth[tag] - 1)
        if tag == "title":
            self.in_title = False
        elif self.in_title:
            self.title.append("")

    def handle_comment(self, data):
        self.close_node()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def handle_data(self, data):
        if not self.raw and not any(self.depth.values()):
            self.nodes[-1] += data
            if self.in_title:
                self.title[-1] += data


def plain(html):
    reader = Reader()
    reader.feed(html)
    reader.close()
    return " ".join(n.strip() for n in reader.nodes if n.strip()), "".join(t.strip() for t in reader.title or [])


def read(spark, pages):
    df = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string")
    return [(r.text, r.title) for r in html_documents(df).orderBy("doc_id").collect()]


CASES = {
    "<nav>a<nav>b</nav>x</nav>": "",
    "<nav>a<nav>b</nav>leak</nav><p>t</p>": "t",
    '<a title="x>y">t</a>': "t",
    "<a title='x>y' b=\"'>\">t</a>": "t",
    "a &lt b &lt;c &copy 1 &nosuch x &#60 &#x3E;y &#1; &amp;lt;": "a < b <c © 1 &nosuch x < >y � &lt;",
    "</nav>a<nav>b</nav>c": "a c",
    "<nav/>a<NAV class=x>b</NAV >c": "a c",
    "<navigation>a</navigation>": "a",
    "<header>a<footer>b</header>c</footer>d": "d",
    "<script>if (a<b) '</nav>' + \"<nav>\"</script>t": "t",
    "<script src='a>b'>x</SCRIPT\n>t<style>p{}": "t",
    "a<!-- <nav> -->b<!-- open <p>c": "a b",
    "a < b <3 c<>d</>e": "a < b <3 c<>d e",
    "x<p>y": "x y",
    "a<b": "a<b",
    "": "",
    "<p " + "a='b' " * 20_000 + ">t": "t",
    "<p>" + "x" * 300_000: "x" * 300_000,
    "\x01a\x02b\x03<p>c": "a b c",
}


def test_states(spark):
    got = read(spark, list(CASES))
    for (html, want), (text, _) in zip(CASES.items(), got):
        assert text == want, html[:60]


def test_titles(spark):
    pages = {
        "<title> A <b>c</b> &amp; d</title><title>no</title>": "Ac& d",
        "<nav><title>no</title></nav><TITLE lang=x>yes</TITLE>": "yes",
        "<title>open": "open",
        "<p>none</p>": "",
    }
    assert [t for _, t in read(spark, list(pages))] == list(pages.values())


def test_null_page(spark):
    df = spark.createDataFrame([(1, None)], "page_id int, html string")
    assert html_documents(df).count() == 1


def test_pages_and_random_markup_match_the_standard_library(spark):
    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").select("html").collect()]
    rng = random.Random(4)
    bits = ["<nav>", "</nav>", "<header a='>'>", "</header>", "<footer>", "</footer>", "<p class=\"x\">", "</p>", "t1", " t2 ", "&lt;", "&amp;amp;", "<br/>",
            "<script>var a='<nav>'</script>", "<style>p{}</style>", "<!-- c -->", "<title>T</title>", "<nav/>", "\n", "<!DOCTYPE html>"]
    pages += ["".join(rng.choices(bits, k=rng.randint(1, 40))) for _ in range(300)]
    # The library reads a title's content as text only; these have no markup in one.
    assert not any(re.search("(?is)<title[^>]*>[^<]*<(?!/title)", p) for p in pages)
    for page, got in zip(pages, read(spark, pages)):
        assert got == plain(page), page[:200]


def test_other_tags_can_be_dropped(spark):
    df = spark.createDataFrame([("<nav>a</nav><aside>b<aside>c</aside></aside>d",)], "t string")
    assert df.select(tx.html_text(tx.drop_subtrees(F.col("t"), ["aside"]))).first()[0] == "a d"
    assert df.select(tx.html_text(tx.drop_subtrees(F.col("t"), []))).first()[0] == "a b c d"
