from __future__ import annotations

import datetime as dt

import pytest

from strata.operators.documents import body, chunk_rows, doc_blocks, front_matter, html_blocks, markdown_html
from strata.plans.documents import corpus_chunks, index_chunks, load_corpus, search_chunks
from tests.conftest import rows

POST = """---
title: "AI safety: a start"
date: 2024-11-19 08:30:00 -0500
categories: [GenAI, Safety]
tags:
  - rag
  - 'llm ops'
---
{% raw %}
# Heading

First line
second line with `code`.

- item one
- item two

```
x = 1
```
{% endraw %}
Last.
"""


def test_html_blocks_in_order():
    html = "<h1> T </h1><div><p>one <b>bold</b></p><ul><li>a</li><li><p>b</p></li></ul><p>after list</p><p>kept</p></div><p> </p>"
    assert html_blocks(html) == [
        ("h1", "T"), ("p", "one bold"), ("ul", "ab"), ("li", "a"), ("li", "b"),
        # The paragraph inside an item and the one after the list are skipped:
        # every paragraph moves "before" on, so the next one is kept.
        ("p", "after list"), ("p", "kept"),
    ]


def test_paragraph_after_a_list_is_skipped_once():
    assert html_blocks("<ul><li>a</li></ul><p>skipped</p><p>kept</p>") == [("ul", "a"), ("li", "a"), ("p", "kept")]


def test_scripts_and_entities_and_open_tags():
    html = "<h2>A &amp; B</h2><script>var t='<p>no</p>'</script><style>p{}</style><p>one<p>two<h3>three"
    assert html_blocks(html) == [("h2", "A & B"), ("p", "one"), ("p", "two"), ("h3", "three")]
    assert html_blocks(None) == []


def test_markdown_structure():
    blocks = html_blocks(markdown_html("# A #\n\ntext `c` <b>\n\n1. one\n2. two\n\n```\ncode\n```\nend"))
    assert blocks == [("h1", "A"), ("p", "text c <b>"), ("code", "c"), ("li", "one"), ("li", "two"), ("code", "code"), ("p", "end")]


def test_front_matter(spark):
    df = spark.createDataFrame([(1, POST), (2, "no matter\n---\ntitle: x\n---\n"), (3, "---\ntags: solo\n---\nBody")], "id int, md string")
    got = {r["id"]: r["m"] for r in df.select("id", front_matter("md").alias("m")).collect()}
    assert got[1]["title"] == "AI safety: a start" and got[1]["date"] == dt.datetime(2024, 11, 19, 8, 30)
    assert got[1]["categories"] == ["GenAI", "Safety"] and got[1]["tags"] == ["rag", "llm ops"]
    assert (got[2]["title"], got[2]["date"], got[2]["tags"]) == ("", None, [])
    assert got[3]["tags"] == ["solo"]
    bodies = {r["id"]: r["b"] for r in df.select("id", body("md").alias("b")).collect()}
    assert "raw" not in bodies[1] and bodies[3] == "Body" and bodies[2].startswith("no matter")


def test_blocks_and_stable_row_ids(spark):
    df = spark.createDataFrame([("a.md", POST), ("b.md", None)], "path string, md string")
    blocks = chunk_rows(doc_blocks(df, "path", "md", "md"), "path")
    tags = [r["html_tag"] for r in blocks.orderBy("position").collect()]
    assert tags == ["h1", "p", "code", "ul", "li", "li", "code", "p"]
    again = chunk_rows(doc_blocks(df.repartition(3), "path", "md", "md"), "path")
    assert rows(blocks, "row_id", "content") == rows(again, "row_id", "content")
    with pytest.raises(ValueError):
        doc_blocks(df, "path", "md", "pdf")


def test_corpus_to_search(spark, tmp_path):
    (tmp_path / "one.md").write_text(POST)
    (tmp_path / "two.md").write_text("---\ntitle: two\ntags: [other]\n---\n# Heading\n\nVectors and search.\n")
    chunks = load_corpus(spark, str(tmp_path / "*.md"))
    assert set(rows(chunks.select("title").distinct())) == {("AI safety: a start",), ("two",)}
    index = index_chunks(None, chunks)
    vector = list(index.join(chunks.filter("content = 'Vectors and search.'"), "row_id").select("embedding").first()[0])
    best = search_chunks(index, chunks, vector, 2).first()
    assert best["content"] == "Vectors and search." and best["score"] == pytest.approx(1.0)
    without = search_chunks(index, chunks, vector, 20, without_tag="other")
    assert set(rows(without.select("title").distinct())) == {("AI safety: a start",)}
    assert index_chunks(index, corpus_chunks(spark.createDataFrame([], "content string, file_path string, file_name string"))).count() == index.count()


@pytest.mark.parametrize("text, html", [
    ("###### six ######", "<h6>six</h6>"), ("#no heading", "<p>#no heading</p>"), ("Two\n---", "<h2>Two</h2>"), ("a\n# b\nc", "<p>a</p>\n<h1>b</h1>\n<p>c</p>"),
    ("**b** *i* ***x*** __s__ _e_ ~~d~~ 2*3*4 a_b_c", "<p><strong>b</strong> <em>i</em> <strong><em>x</em></strong> <strong>s</strong> <em>e</em> <del>d</del> 2<em>3</em>4 a_b_c</p>"),
    ("`a ** b` ``x ` y`` \\*no\\* <t>", "<p><code>a ** b</code> <code>x ` y</code> *no* &lt;t&gt;</p>"),
    ('[t](u "x") [a `c`](u_(v)) ![i](p.png) [![i](p)](u) <https://x.y?a&b>', '<p><a href="u">t</a> <a href="u_(v)">a <code>c</code></a> <img src="p.png" alt="i"> <a href="u"><img src="p" alt="i"></a> <a href="https://x.y?a&amp;b">https://x.y?a&amp;b</a></p>'),
    ("- a\n- b\n  1. c\n  2. d\n- e", "<ul>\n<li>a</li>\n<li>b\n<ol>\n<li>c</li>\n<li>d</li>\n</ol></li>\n<li>e</li>\n</ul>"),
    ("* a\n\n* b", "<ul>\n<li><p>a</p></li>\n<li><p>b</p></li>\n</ul>"), ("1. a\n- b", "<ol>\n<li>a</li>\n</ol>\n<ul>\n<li>b</li>\n</ul>"),
    ("> a\nb\n> > c", "<blockquote>\n<p>a\nb</p>\n<blockquote>\n<p>c</p>\n</blockquote>\n</blockquote>"),
    ("~~~\n```\n# x\n~~~\nend", "<pre><code>```\n# x\n</code></pre>\n<p>end</p>"), ("```\nopen", "<pre><code>open\n</code></pre>"),
    ("a\n\n    code\n\n    more\n\nb", "<p>a</p>\n<pre><code>code\n\nmore\n</code></pre>\n<p>b</p>"), ("- - -", "<hr>"), ("a  \nb", "<p>a<br>\nb</p>"), ("", ""), ("\n \n", ""),
])
def test_markdown_syntax(text, html):
    assert markdown_html(text) == html


def test_markdown_of_any_text_ends(spark):
    import random

    rnd = random.Random(9)
    for _ in range(300):
        text = "".join(rnd.choice(["*", "_", "`", "[", "](", ")", "> ", "- ", "1. ", "#", "\n", "    ", "x ", "```\n", "~~", "\\", "\0", "<", "&"]) for _ in range(rnd.randint(0, 60)))
        markdown_html(text)


def test_markdown_table_function(spark):
    from strata.operators.documents import markdown_blocks

    docs = spark.createDataFrame([(1, "---\ntitle: t\n---\n# A\n\n1. x\n2. y"), (2, None), (3, ""), (4, "plain")], "id int, t string")
    assert [tuple(r) for r in markdown_blocks(docs, "id", "t").orderBy("id", "position").collect()] == [(1, 0, "h1", "A"), (1, 1, "li", "x"), (1, 2, "li", "y"), (4, 0, "p", "plain")]


def test_markdown_documents_are_dealt_over_all_cores(spark, data):
    from strata.queries import QUERIES

    plan = QUERIES["markdown_blocks"].run(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning" in plan and "ArrowEvalPythonUDTF" in plan
