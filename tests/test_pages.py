"""From HTML to documents."""

import pytest
from pyspark.sql import functions as F

from tessella.constants import END_OF_DOCUMENT as EOD
from tessella.plans.flows import pages_to_documents
from tessella.sources.dom import parse_nodes

CASES = {
    # separators come from the tags between two texts
    "<p>a</p><p>b</p>": ["a\n\nb"],
    "<div>a</div><div>b</div>": ["a\nb"],
    "<b>a </b><i>b</i>": ["a b"],
    "a<b>b</b>": ["ab"],
    "<p>a</p> <p>b</p>": ["a\n\nb"],
    "<div>a<p>b</p></div>": ["a\n\nb"],
    "a<br>b<br/>c": ["a\nb\nc"],
    "<p>a<br></p>b": ["a\n\nb"],
    # unclosed and misplaced tags
    "<p>a<p><b>b<p>c": ["a\n\nb\n\nc"],
    "</div>a</p>b": ["ab"],
    # removed parts
    "a<script>x</script><!-- c --><style>y</style><nav>z</nav><ul><li>l</li></ul>": ["a"],
    '<div class="big footer">x</div><div class="footers">y</div>': ["y"],
    '<div id="nav">x</div><div class="menu">y</div><div title="menu bar">z</div>': ["z"],
    '<div class="update">x<p>y</p></div>': ["y"],
    '<p>a</p><p class="more-link">m</p><p>b</p>': [f"a\n\n{EOD}\n\nb"],
    "<p> </p><div><span></span></div>": [],
    "": [],
    # images
    'a<img src="/i.png" alt="A">b': ["a", "@https://h.org/i.png", "b"],
    'a<img src="">b<img alt="no">c': ["abc"],
    '<img src="x y" data-src="z.png">': ["@https://h.org/z.png"],
    '<img src="data:image/png;base64,AA==">': [],
    '<picture><source srcset="s"><img src="i.png"></picture>': ["@https://h.org/i.png"],
    '<iframe><img src="i.png"></iframe>x': ["x"],
    '<figure><a href="#"><img src="i.png"></a><figcaption>cap <b>b</b></figcaption></figure>': ["@https://h.org/i.png", "cap b"],
    "&lt;p&gt; &amp; &eacute;": ["<p> & é"],
}


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i, "https://h.org/d/p", "w", html) for i, html in enumerate(CASES)]
    pages = spark.createDataFrame(rows, "doc_id long, url string, warc_filename string, html string")
    return {r.doc_id: r for r in pages_to_documents(pages).collect()}


@pytest.mark.parametrize("i, html", list(enumerate(CASES)))
def test_page(documents, i, html):
    got = [n["text"] if n["kind"] == "text" else "@" + n["src"] for n in documents[i]["nodes"]]
    assert got == CASES[html]


def test_captions_and_records(documents):
    by_html = {h: documents[i] for i, h in enumerate(CASES)}
    figure = next(d for h, d in by_html.items() if h.startswith("<figure>"))
    assert figure["nodes"][0]["caption"] == "cap b"
    image = by_html['a<img src="/i.png" alt="A">b']["nodes"][1]
    assert image["caption"] == "A" and image["meta"]["unformatted_src"] == "/i.png"
    assert image["meta"]["document_url"] == "https://h.org/d/p"


def test_more_link_becomes_the_marker(spark):
    html = 'x<div class="a more-link"><p>read</p></div><img src="i.png">y'
    page = spark.createDataFrame([(1, "https://h.org/p", html)], "doc_id long, url string, html string")
    nodes = pages_to_documents(page).first()["nodes"]
    assert [n["text"] for n in nodes] == [f"x {EOD}", None, "y"]


def test_empty_page_stays_as_empty_document(spark):
    pages = spark.createDataFrame([(1, "https://h.org/p", None)], "doc_id long, url string, html string")
    row = pages_to_documents(pages).first()
    assert row["nodes"] == [] and row["dom_error"] == "no page"


def test_node_numbers_and_paths():
    rows = parse_nodes("<body><div>a<img src=x>b</div></body>")
    assert [r["tag"] for r in rows] == ["html", "body", "div", "-text", "img", "-text"]
    assert [e["tag"] for e in rows[-1]["path"]] == ["html", "body", "div", "-text"]
    assert [r["pos"] for r in rows] == [r["path"][-1]["no"] for r in rows] == list(range(6))


PLAIN = [
    '<div class="more-link footer">x</div><nav class="more-link"><p>y</p></nav><p>z<b class="update">u</b></p>',
    '<div class="post-date">a<i>b<p>c</p></i><div class="more-link">m</div></div>',
    '<video><source src=""><source src="v.mp4"></video><video><b class="footer"><source src="w.mp4"></b></video><p> </p>',
    '<div><div><div> <p>a</p></div></div></div><figure><figure><img src="a.png"><figcaption>c<b> d</b></figcaption></figure>e</figure>',
    "<p> </p><section><h2>t</h2><foo>l</foo><iframe>in<img src=i></iframe></section><table><tr><td> <td>x",
]


def test_one_sweep_gives_what_the_steps_give(spark):
    from tessella.operators import html as H
    from tessella.sources.dom import build_dom_nodes

    pages = spark.createDataFrame([(i, "https://h.org/p", h) for i, h in enumerate([*CASES, *PLAIN])], "doc_id long, url string, html string")
    nodes = build_dom_nodes(pages)
    steps = nodes
    for step in H.SIMPLIFICATIONS:
        steps = H.drop_empty_nodes(steps) if step is H.drop_empty_leaves else steps.withColumn("nodes", step(F.col("nodes")))
    swept = H.simplify(nodes)
    assert sorted(swept.select("doc_id", "nodes").collect()) == sorted(steps.select("doc_id", "nodes").collect())


def test_page_flow_crosses_to_python_four_times(spark):
    """The parser, the sweep over subtrees, the nested elements and the captions; it was eleven."""
    pages = spark.createDataFrame([(1, "https://h.org/p", "<p>a</p>")], "doc_id long, url string, html string")
    plan = pages_to_documents(pages)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") + plan.count("MapInArrow") == 4


@pytest.mark.parametrize("text", ["a", " a ", "\ta\n b", "a#BR_TAG# b", " #BR_TAG#", "a  b", "\u00a0a\u2003", "", "é  "])
def test_format_text(spark, text):
    from tessella.functions.text import format_text

    flat = text.replace("\n", " ").replace("\t", " ")
    while "  " in flat:
        flat = flat.replace("  ", " ")
    head, tail = " " * flat.startswith(" "), " " * (flat.endswith(" ") and len(flat) > 1)
    lines = "\n".join(x.strip() for x in flat.split("#BR_TAG#"))
    assert spark.range(1).select(format_text(F.lit(text))).first()[0] == head + lines + tail


def test_clean_html(spark):
    from tessella.operators.html import clean_html

    html = "a\n\n\nb   c<!-- x\n -->d<br>e<br/>f<br />g</br>h<br  />"
    assert spark.range(1).select(clean_html(F.lit(html))).first()[0] == "a\nb cd#BR_TAG#e#BR_TAG#f#BR_TAG#g#BR_TAG#h#BR_TAG#"


def test_no_shuffle_from_page_to_document(spark):
    pages = spark.createDataFrame([(1, "https://h.org/p", "<p>a</p>")], "doc_id long, url string, html string")
    plan = pages_to_documents(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_incremental_extraction(spark, tmp_path):
    from tessella.streaming.incremental import PAGES, extract_new_pages

    def add(doc_id):
        row = [(doc_id, "https://h.org/p", "w", f"<p>t{doc_id}</p>")]
        spark.createDataFrame(row, PAGES).write.mode("append").parquet(str(tmp_path / "pages"))

    def run():
        query = extract_new_pages(spark, *(str(tmp_path / n) for n in ("pages", "docs", "state")))
        assert query.awaitTermination(120)
        docs = spark.read.parquet(str(tmp_path / "docs"))
        return sorted(docs.select("doc_id", F.col("nodes")[0]["text"]).collect())

    add(1)
    assert [tuple(r) for r in run()] == [(1, "t1")]
    add(2)
    assert [tuple(r) for r in run()] == [(1, "t1"), (2, "t2")]
