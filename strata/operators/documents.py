"""Documents to rows: front matter, ordered text blocks, chunk rows."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from strata.functions.markdown import markdown_html

# The elements that become blocks.
BLOCK_TAGS = ["h1", "h2", "h3", "p", "ul", "li", "code"]
# Elements whose start ends an open paragraph.
ENDS_PARAGRAPH = {
    "h1", "h2", "h3", "h4", "h5", "h6", "p", "ul", "ol", "pre", "div", "table", "section", "article",
    "blockquote", "nav", "header", "footer", "main", "form", "hr",
}
# Elements whose text is no content.
NO_CONTENT = {"script", "style"}

FRONT_MATTER = r"(?s)\A---\r?\n(.*?)\r?\n---[ \t]*(?:\r?\n|\z)"
RAW_TAGS = r"\{%\s*(?:end)?raw\s*%\}"


def _matter_value(block: Column, name: str) -> Column:
    """Text after ``name:`` on one line, without quotes; null when absent."""
    found = F.regexp_extract(block, rf"(?m)^{name}:[ \t]*(.*?)[ \t]*$", 1)
    bare = F.regexp_replace(found, r"^(['\"])(.*)\1$", "$2")
    return F.when(F.length(bare) > 0, bare)


def _matter_list(block: Column, name: str) -> Column:
    """``[a, b]``, a single value, or ``- a`` lines below the name; else empty."""
    inline = F.regexp_extract(block, rf"(?m)^{name}:[ \t]*\[(.*?)\][ \t]*$", 1)
    lines = F.regexp_extract(block, rf"(?m)^{name}:[ \t]*\r?\n((?:[ \t]*-[ \t]+.*(?:\r?\n|\z))+)", 1)
    single = _matter_value(block, name)
    items = (
        F.when(F.length(inline) > 0, F.split(inline, r",\s*"))
        .when(F.length(lines) > 0, F.transform(F.split(F.trim(lines), r"\r?\n"), lambda x: F.regexp_replace(x, r"^[ \t]*-[ \t]+", "")))
        .when(single.isNotNull() & ~single.startswith("["), F.array(single))
        .otherwise(F.array().cast("array<string>"))
    )
    cleaned = F.transform(items, lambda x: F.regexp_replace(F.trim(x), r"^(['\"])(.*)\1$", "$2"))
    return F.filter(cleaned, lambda x: F.length(x) > 0)


def front_matter(text: str | Column) -> Column:
    """``struct<title, date, categories, tags>`` of a Markdown document."""
    c = F.col(text) if isinstance(text, str) else text

    def fields(block: Column) -> Column:
        return F.struct(
            F.coalesce(_matter_value(block, "title"), F.lit("")).alias("title"),
            F.coalesce(
                F.try_to_timestamp(F.regexp_extract(_matter_value(block, "date"), r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}", 0)),
                F.try_to_timestamp(F.regexp_extract(_matter_value(block, "date"), r"^\d{4}-\d{2}-\d{2}", 0)),
            ).alias("date"),
            _matter_list(block, "categories").alias("categories"),
            _matter_list(block, "tags").alias("tags"),
        )

    # Over a one-element array, so that the block is cut out of the text once.
    return F.transform(F.array(F.regexp_extract(c, FRONT_MATTER, 1)), fields)[0]


def body(text: str | Column) -> Column:
    """Document without front matter and raw tags."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.regexp_replace(c, FRONT_MATTER, ""), RAW_TAGS, "")


class _Blocks(HTMLParser):
    """Collects the text of every block element, in order of their start tags."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, list[str]]] = []
        self.open: list[tuple[str, list[str]]] = []
        self.muted = 0

    def _close(self, tag: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return

    def handle_starttag(self, tag, attrs):
        if tag in NO_CONTENT:
            self.muted += 1
        if tag in ENDS_PARAGRAPH:
            self._close("p")
        if tag == "li" and self.open and self.open[-1][0] in ("li", "p"):
            self._close("li")
        if tag in BLOCK_TAGS:
            block = (tag, [])
            self.found.append(block)
            self.open.append(block)

    def handle_endtag(self, tag):
        if tag in NO_CONTENT:
            self.muted = max(0, self.muted - 1)
        elif tag in BLOCK_TAGS:
            self._close(tag)

    def handle_data(self, data):
        if not self.muted:
            for _, parts in self.open:
                parts.append(data)


def html_blocks(text: str | None) -> list[tuple[str, str]]:
    """Blocks with text; a paragraph right after a list or list item is skipped."""
    parser = _Blocks()
    parser.feed(text or "")
    parser.close()
    out, before = [], None
    for tag, parts in parser.found:
        content = "".join(parts).strip()
        if content:
            if not (tag == "p" and before in ("li", "ul")):
                out.append((tag, content))
            before = tag
    return out


@udtf(returnType="position int, html_tag string, content string", useArrow=True)
class MarkdownBlocks:
    """Table function: the blocks of one Markdown body, for a lateral join."""

    def eval(self, text: str):
        for position, (tag, content) in enumerate(html_blocks(markdown_html(text))):
            yield position, tag, content


def markdown_blocks(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per block of Markdown documents: id, position, tag, text. Front
    matter and raw tags go first, in the JVM; a lateral join calls the table
    function per document, so a document's blocks never wait for another's."""
    bodies = df.select(id_col, body(text_col).alias("_text")).filter(F.col("_text").isNotNull())
    return bodies.lateralJoin(MarkdownBlocks(F.col("_text").outer())).drop("_text")


def doc_blocks(df: DataFrame, id_col: str, text_col: str, kind: str = "html", carry: str | None = None) -> DataFrame:
    """One row per block: id, position, tag, text. Documents are independent,
    so this is a narrow step over partitions, without any shuffle. ``carry``
    names a text column to repeat on every block of its document."""
    if kind not in ("html", "md"):
        raise ValueError("kind is 'html' or 'md'")
    kept = [id_col] + ([carry] if carry else [])
    source = df.select(*kept, (body(text_col) if kind == "md" else F.col(text_col)).alias("_text"))
    layout = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in kept)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            docs, positions, tags, texts = [], [], [], []
            for doc, text in enumerate(frame["_text"]):
                html = markdown_html(text or "") if kind == "md" else text
                for position, (tag, content) in enumerate(html_blocks(html)):
                    docs.append(doc)
                    positions.append(position)
                    tags.append(tag)
                    texts.append(content)
            if docs:
                repeated = {c: frame[c].take(docs).to_numpy() for c in kept}
                yield pd.DataFrame({**repeated, "position": positions, "html_tag": tags, "content": texts})

    return source.mapInPandas(work, f"{layout}, position int, html_tag string, content string")


def chunk_rows(blocks: DataFrame, id_col: str) -> DataFrame:
    """A row id that is the same in every run: hash of document and position."""
    return blocks.withColumn("row_id", F.xxhash64(F.col(id_col).cast("string"), "position"))
