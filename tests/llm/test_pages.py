"""WARC round trips, HTML extraction and neighbour search."""

import base64
import collections
import gzip
import hashlib
import html
import io
import re
import time

import numpy as np
import pytest

from docwright.llm import html_content, neighbours, warc
from docwright.llm.common import new_folder

SF = "/root/testdata/sf0.001"
TRAP = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nxyz\r\n\r\n<p>é"
PAGES = [
    (5, "http://a/1", "<p>same</p>", "x"), (2, "http://a/2", "<p>same</p>", "x"), (9, None, TRAP, None), (7, "http://a/7", None, None), (8, "http://a/8\r\nX: y", "", None),
    (None, "http://a/9", "<p>same</p>", None), (2, "http://a/2", "<p>same</p>", "x"), (30, "http://a/30", "<p>" + "long words here " * 30_000, None),
]
SCHEMA = "page_id long, url string, html string, digest string"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, SCHEMA)


def test_round_trip_of_odd_pages(spark, pages):
    got = collections.Counter(map(tuple, warc.round_trip(pages).collect()))
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    expected = collections.Counter()
    for page, _, text, _ in PAGES:
        first = {"<p>same</p>": 2, None: 7, "": 7}.get(text, page)
        response = page == first
        expected[page, len((text or "").encode()), digest(text), "response" if response else "revisit", None if response else first] += 1
    assert got == expected
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_small_payloads_can_all_be_responses(pages):
    kinds = collections.Counter(r["record_type"] for r in warc.round_trip(pages, least_bytes=12).collect())
    assert kinds == {"response": len(PAGES)}


def test_archives_are_records_by_their_lengths(spark, pages):
    folder = new_folder(spark, "test-warc")
    warc.write(pages, folder)
    kinds = collections.Counter()
    for row in spark.read.format("binaryFile").load(folder).select("content").collect():
        for fields, block in warc.parsed(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(row["content"])))):
            kinds[fields["warc-type"][0]] += 1
            assert len(block) == int(fields["content-length"][0])
    assert kinds == {"request": 8, "metadata": 8, "response": 5, "revisit": 3}


def test_assembly_in_both_directions_and_through_another_record(spark):
    record = "record_id string, type string, target string, concurrent_to array<string>, refers_to string, page_id long"
    rows = [("r1", "response", "u", ["q1"], None, None), ("q1", "request", "u", [], None, None), ("m1", "metadata", "u", ["q1"], None, 4), ("m2", "metadata", "u", ["r1"], None, 5),
            ("r2", "revisit", "v", [], "r1", None), ("m9", "metadata", "w", ["gone"], None, 6)]
    got = {r["record_id"]: r for r in warc.assemble(spark.createDataFrame(rows, record)).collect()}
    assert set(got) == {"r1", "r2", "m9"} and got["r1"]["request"]["record_id"] == "q1"
    assert [m["record_id"] for m in got["r1"]["metadata"]] == ["m1", "m2"] and got["r2"]["refers_to"] == "r1" and got["r2"]["metadata"] == []
    assert got["m9"]["type"] is None and got["m9"]["target"] == "w"


ARTICLE = "<h1>The title of it</h1><p>First para&shy;graph &amp; more, with <b>bold</b>ness and   white\nspace in it.</p><ul><li>one item of a list</li><li>two</li></ul><p>Last paragraph of the text, short."
SAID = "The title of it\nFirst para­graph & more, with boldness and white space in it.\none item of a list\ntwo\nLast paragraph of the text, short."
PAGE = (
    '<!DOCTYPE html><html><head><title>no</title><style>p{{}}</style><script>var t="</p><p>no";</script></head><body><header>Site name</header><nav><ul><li><a href="/x">Menu</a></li></ul></nav>'
    '<div class="cookie-notice">We use cookies, many words about them here</div><aside>Side text of several words</aside><!-- <p>no</p> --><{mark}>{text}'
    '<div id="comments"><p>Reader: I think that this comment has many words as well</p></div></{mark}><form>Send <input name="a>b"><button>ok</button></form><footer>&copy; someone</footer></body></html>')


def test_article_without_what_surrounds_it(spark):
    rows = [(n, "u", PAGE.format(mark=mark, text=ARTICLE), "x") for n, mark in enumerate(["article", "main", "div", "div class='post'"])]
    rows += [(10, "u", None, "x"), (11, "u", "", "x"), (12, None, "just words & no tags", "x"), (None, "u", "<p>a<p>b", "x"), (13, "u", "<nav>only menu</nav>", "x"), (14, "u", "<p " * 2000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r["page_id"]: r for r in html_content.extract(pages.unionByName(spark.read.parquet(f"{SF}/pages.parquet").selectExpr("page_id + 1000 AS page_id", "url", "html", "'' AS text"))).collect()}
    assert [got[n]["text"] for n in range(4)] == [SAID] * 4 and got[0]["n_chars"] == len(SAID)
    assert got[10]["text"] == got[11]["text"] == got[13]["text"] == "" and got[12]["text"] == "just words & no tags" and got[None]["text"] == "a\nb"
    assert html_content.extract(pages.limit(0)).collect() == []


def test_real_pages_give_the_marked_article_with_and_without_the_mark(spark):
    frame = spark.read.parquet(f"{SF}/pages.parquet")
    weights = html_content.learn(frame)
    for r in frame.collect():
        inner = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        plain = html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br>", " ", re.sub(r"</?(?:p|h1)>", "\n", inner))))
        expected = "\n".join(line for line in (" ".join(x.split()) for x in plain.split("\n")) if line)
        for source in (r["html"], re.sub(r"</?article>", "", r["html"])):
            page = html_content.Page(source)
            assert page.text(*page.best(weights)) == expected


def test_a_marked_teaser_does_not_hide_the_main_text(spark):
    given = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")
    main = "".join(f"<p>Paragraph {n} of the main text with a good many words in plain divisions.</p>" for n in range(12))
    page = f"<html><body><article><p>Short teaser.</p></article><nav>Menu</nav><div><div>{main}</div></div><footer>end</footer></body></html>"
    got = html_content.extract(given.unionByName(spark.createDataFrame([(-1, "u", page)], "page_id long, url string, html string"))).where("page_id = -1").first()["text"]
    assert all(f"Paragraph {n} of the main text" in got for n in range(12)) and "Menu" not in got


@pytest.mark.parametrize("attribute", ["class='page has-sidebar'", "id='content' class='no-comments'", "class='nav-open wrapper'", "class='post-header'", "class='widget'"])
def test_layout_wrappers_keep_their_content(attribute):
    text = "<p>Main text of the page.</p>" * 20
    for inner in (f"<article>{text}</article>", f"<main><div class='widget'><article>{text}</article></div></main>", f"<div>{text}</div>"):
        aside = "<div class='post-comments'>A comment</div><div id='sidebar'>Side</div><ul class='related'><li>Other</li></ul>"
        page = html_content.Page(f"<body><nav>Menu</nav><div {attribute}>{inner}{aside}</div></body>")
        assert page.text(0, len(page.items)) == "\n".join(["Main text of the page."] * 20)
        assert page.marked == ("<article>" in inner)
    both = html_content.Page(f"<div {attribute}><article>Short article.</article></div><div>{text}</div>")
    assert "Short article." in both.text(0, len(both.items)) and both.marked


@pytest.mark.parametrize("hostile", ["<a ", "<a '", "<a \"><a '>", "<a \">\"", "<!--", "<script '", "<b></i>", "<div class=ad><main>", "</", "<x" + "y" * 40, "< ", "class='"])
@pytest.mark.parametrize("tail", ["", "'>", ">", "\"", "<" + "a" * 50_000])
def test_hostile_pages_take_linear_time(hostile, tail):
    def seconds(n):
        start = time.process_time()
        html_content.Page(hostile * (n // len(hostile)) + tail)
        return time.process_time() - start

    assert seconds(400_000) < 0.5 + 4 * seconds(200_000)


def test_what_stands_behind_the_last_mark():
    text = lambda source: "".join(t for _, _, t, *_, out in html_content.Page(source).items if not out)
    assert text("<p>a</p> b <c d") == "a b <c d" and text("a <!-- b > c") == "a " and text("a <script> b") == "a " and text("1 < 2") == "1 < 2"
    assert text("x <i title='a > b'>y</i> <!-- z") == "x y " and text("no marks &amp; none") == "no marks & none" and text("") == ""


def test_comments_as_articles_are_left_out():
    comments = "<section class='comments-area'><ol><li class='comment'><article id='div-comment-2' class='comment-body'><p>I say</p></article></li></ol></section>"
    page = html_content.Page(f"<main><article><p>Main text of the page, long enough.</p>{comments}</article></main>")
    assert page.text(0, len(page.items)) == "Main text of the page, long enough."


@pytest.mark.parametrize("folder", [SF, SF.replace("sf0.001", "sf0.1")])
def test_neighbours_recall_and_scores(spark, folder):
    frame = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = {r["vec_id"]: np.array(r["embedding"], dtype=float) for r in frame.collect()}
    ids, x = np.array(list(rows)), np.array(list(rows.values()))
    got = collections.defaultdict(list)
    for r in neighbours.nearest(frame).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == [i for i in sorted(rows) if i % 20 == 0]
    recall = []
    for q, found in got.items():
        scores = x @ rows[q]
        best = [int(ids[i]) for i in np.lexsort((ids, -scores)) if ids[i] != q][:20]
        assert [r for r, *_ in sorted(found)] == list(range(1, 21)) and all(np.isclose(s, x[ids == v][0] @ rows[q], rtol=1e-12) for _, v, s in found)
        recall.append(len({v for _, v, _ in found} & set(best)) / 20)
    assert np.mean(recall) >= 0.9


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (20, [0.0, 2.0], 1), (1, [1.0, 1.0], 1), (2, [1.0, 1.0], 1), (3, None, 1), (4, [0.0, 0.0], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1),
            (7, [None, 1.0], 1), (8, [1.0, 2.0, 3.0], 1), (None, [1.0, 1.0], 1), (40, [], 1), (0, [1.0, 0.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = [tuple(r) for r in neighbours.nearest(frame).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 8, 1.0), (0, 4, 20, 0.0),
                   (20, 1, 8, 4.0), (20, 2, 1, 2.0), (20, 3, 2, 2.0), (20, 4, 0, 0.0), (20, 5, 0, 0.0)]
    assert neighbours.nearest(frame.limit(0)).collect() == []
