"""Markdown as HTML, in two phases: container blocks first, then inline marks.

Headings (both kinds), paragraphs, quotes, ordered and nested lists, fenced and
indented code and rules; then code spans, escapes, links, images, emphasis and
line breaks inside what is not code. Raw tags stay as text.
"""

from __future__ import annotations

import re

FENCE = re.compile(r"^ {0,3}(`{3,}|~{3,})\s*([^`]*)$")
HEADING = re.compile(r"^ {0,3}(#{1,6})(?:[ \t]+(.*?))?(?:[ \t]+#+)?[ \t]*$")
RULE = re.compile(r"^ {0,3}([-*_])[ \t]*(?:\1[ \t]*){2,}$")
QUOTE = re.compile(r"^ {0,3}> ?")
ITEM = re.compile(r"^( {0,3})([-*+]|\d{1,9}[.)])([ \t]+|$)(.*)$")
UNDERLINE = re.compile(r"^ {0,3}(=+|-+)[ \t]*$")

_SPAN = re.compile(r"(?<!`)(`+)(?!`)(.+?)(?<!`)\1(?!`)", re.S)
_ESCAPE = re.compile(r"\\([\\`*_{}\[\]()#+\-.!>~|])")
_AUTOLINK = re.compile(r"&lt;((?:https?|mailto):[^\s&]*(?:&amp;[^\s&]*)*)&gt;")
_LINK = re.compile(r"(!?)\[([^\[\]]*)\]\(\s*([^()\s]*(?:\([^()\s]*\)[^()\s]*)*)(?:\s+(?:&quot;|\")[^\"]*\")?\s*\)")
_STRONG = re.compile(r"\*\*(?=\S)([^\n]*?\S)\*\*(?!\*)|(?<!\w)__(?=\S)([^\n]*?\S)__(?!\w)")
_EMPHASIS = re.compile(r"(?<!\*)\*(?=[^\s*])([^*\n]*?[^\s*])\*(?!\*)|(?<!\w)_(?=[^\s_])([^_\n]*?[^\s_])_(?!\w)")
_STRUCK = re.compile(r"~~(?=\S)([^\n]*?\S)~~")


def escaped(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def inline(text: str) -> str:
    """Inline marks of one block's text. Code spans and escapes are set aside
    first, so nothing inside them is a mark."""
    aside: list[str] = []

    def keep(html: str) -> str:
        aside.append(html)
        return f"\0{len(aside) - 1}\0"

    text = text.replace("\0", "")
    text = _SPAN.sub(lambda m: keep(f"<code>{escaped(' '.join(m[2].split()) if m[2].strip() else m[2])}</code>"), text)
    text = escaped(_ESCAPE.sub(lambda m: keep(escaped(m[1])), text))
    text = _AUTOLINK.sub(lambda m: keep(f'<a href="{m[1]}">{m[1]}</a>'), text)
    for _ in range(2):  # a linked image is an image inside a link
        text = _LINK.sub(lambda m: keep(f'<img src="{m[3]}" alt="{m[2]}">') if m[1] else f"{keep(f'<a href=\"{m[3]}\">')}{m[2]}{keep('</a>')}", text)
    text = _STRONG.sub(lambda m: f"<strong>{m[1] or m[2]}</strong>", text)
    text = _EMPHASIS.sub(lambda m: f"<em>{m[1] or m[2]}</em>", text)
    text = _STRUCK.sub(lambda m: f"<del>{m[1]}</del>", text)
    text = re.sub(r"(?: {2,}|\\)\n", "<br>\n", text)
    while "\0" in text:
        text = re.sub("\0(\\d+)\0", lambda m: aside[int(m[1])], text)
    return text


def _starts_block(line: str) -> bool:
    item = ITEM.match(line)
    return bool(FENCE.match(line) or HEADING.match(line) or RULE.match(line) or QUOTE.match(line) or (item and item[4].strip()))


def _indent(line: str) -> int:
    return len(line) - len(line.lstrip(" "))


def blocks(lines: list[str], tight: bool = False) -> list[str]:
    """HTML of some lines; in a ``tight`` list item paragraphs are bare text."""
    out: list[str] = []
    i, n = 0, len(lines)
    while i < n:
        line = lines[i]
        if not line.strip():
            i += 1
        elif m := FENCE.match(line):
            mark, indent, i = m[1], _indent(line), i + 1
            code = []
            while i < n and not (lines[i].strip().startswith(mark) and not lines[i].strip().strip(mark[0])):
                code.append(lines[i][min(indent, _indent(lines[i])):])
                i += 1
            i += 1
            out.append("<pre><code>" + escaped("\n".join(code)) + "\n</code></pre>")
        elif _indent(line) >= 4:
            code = []
            while i < n and (not lines[i].strip() or _indent(lines[i]) >= 4):
                code.append(lines[i][4:])
                i += 1
            out.append("<pre><code>" + escaped("\n".join(code).rstrip()) + "\n</code></pre>")
        elif m := HEADING.match(line):
            out.append(f"<h{len(m[1])}>{inline((m[2] or '').strip())}</h{len(m[1])}>")
            i += 1
        elif RULE.match(line):
            out.append("<hr>")
            i += 1
        elif QUOTE.match(line):
            inner = []
            while i < n and lines[i].strip() and (QUOTE.match(lines[i]) or not _starts_block(lines[i])):
                inner.append(QUOTE.sub("", lines[i], count=1))
                i += 1
            out.append("<blockquote>\n" + "\n".join(blocks(inner)) + "\n</blockquote>")
        elif ITEM.match(line):
            html, i = _list(lines, i)
            out.append(html)
        else:
            para = []
            under = None
            while i < n and lines[i].strip() and not (para and _starts_block(lines[i])):
                if para and (under := UNDERLINE.match(lines[i])):
                    i += 1
                    break
                para.append(lines[i].lstrip())
                i += 1
                if i < n and (under := UNDERLINE.match(lines[i])):
                    i += 1
                    break
            text = inline("\n".join(para).rstrip())
            tag = {"=": "h1", "-": "h2"}[under[1][0]] if under else "" if tight else "p"
            out.append(f"<{tag}>{text}</{tag}>" if tag else text)
    return out


def _list(lines: list[str], i: int) -> tuple[str, int]:
    """The list that starts at a line, and the line behind it."""
    first = ITEM.match(lines[i])
    ordered, kind = first[2][0].isdigit(), first[2][-1]
    items: list[list[str]] = []
    loose = gap = False
    while i < len(lines):
        line = lines[i]
        m = ITEM.match(line)
        if not (m and (m[2][0].isdigit() == ordered) and m[2][-1] == kind) or RULE.match(line):
            break
        loose = loose or (gap and bool(items))
        gap = False
        width = len(m[1]) + len(m[2]) + (min(len(m[3].expandtabs(4)), 4) if m[4].strip() else 1)
        own, i = [m[4]], i + 1
        while i < len(lines):
            line = lines[i]
            if not line.strip():
                gap = True
                own.append("")
            elif _indent(line) >= width or (_indent(line) >= 2 and ITEM.match(line.lstrip(" ")) and _indent(line) > len(m[1]) + 1):
                # Children may be indented less than the item's text, as many writers do.
                loose = loose or (gap and _indent(line) < width + 2 and not ITEM.match(line.lstrip(" ")))
                gap = False
                own.append(line[min(width, _indent(line)):])
            elif not gap and not _starts_block(line) and own and own[-1].strip():
                own.append(line.lstrip())
            else:
                break
            i += 1
        items.append(own)
    tag = "ol" if ordered else "ul"
    inner = "\n".join("<li>" + "\n".join(blocks(own, tight=not loose)) + "</li>" for own in items)
    return f"<{tag}>\n{inner}\n</{tag}>", i


def markdown_html(text: str) -> str:
    """HTML of a Markdown text."""
    return "\n".join(blocks([line.expandtabs(4) for line in (text or "").splitlines()]))
