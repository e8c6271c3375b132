"""Documents as elements: plain text, Markdown and HTML files are read without any external engine."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ELEMENT = "seq int, page int, kind string, text string"
_HEADINGS = {f"h{i}" for i in range(1, 7)}
_KINDS = {**dict.fromkeys(_HEADINGS, "Title"), "p": "NarrativeText", "li": "ListItem", "table": "Table", "td": "Table", "th": "Table", "tr": "Table", "pre": "Text", "blockquote": "NarrativeText", "figcaption": "Caption", "title": "Title"}
_SKIPPED = {"script", "style", "noscript", "template"}


class _Elements(HTMLParser):
    """The blocks of a page in order; a table is one element, its rows on lines and its cells parted by bars."""

    def __init__(self):
        super().__init__()
        self.out: list[tuple[str, str]] = []
        self.kind, self.held, self.skip, self.depth = "Text", [], 0, 0

    def flush(self, kind: str = "Text") -> None:
        text = "".join(self.held)
        text = "\n".join(" ".join(line.split()) for line in text.split("\n")) if self.kind == "Table" else " ".join(text.split())
        text = text.strip(" \n|")
        if text:
            self.out.append((self.kind, text))
        self.held, self.kind = [], kind

    def handle_starttag(self, tag, attrs):
        if tag in _SKIPPED:
            self.skip += 1
        elif tag == "table":
            if not self.depth:
                self.flush("Table")
            self.depth += 1
        elif self.depth:
            if tag == "tr":
                self.held.append("\n")
            elif tag == "br":
                self.held.append(" ")
        elif tag in _KINDS:
            self.flush(_KINDS[tag])
        elif tag in ("div", "section", "article", "ul", "ol", "body"):
            self.flush()
        elif tag == "br":
            self.held.append(" ")

    def handle_endtag(self, tag):
        if tag in _SKIPPED:
            self.skip = max(0, self.skip - 1)
        elif tag == "table" and self.depth:
            self.depth -= 1
            if not self.depth:
                self.flush()
        elif self.depth:
            if tag in ("td", "th"):
                self.held.append(" | ")
        elif tag in _KINDS or tag in ("div", "section", "article", "ul", "ol", "body"):
            self.flush()

    def handle_data(self, data):
        if not self.skip:
            self.held.append(data if not self.depth else data.replace("\n", " "))


def html_elements(text: str) -> list[tuple[int, int, str, str]]:
    p = _Elements()
    p.feed(text)
    p.close()
    p.flush()
    return [(i, 1, kind, t) for i, (kind, t) in enumerate(p.out)]


def plain_elements(text: str) -> list[tuple[int, int, str, str]]:
    """Paragraphs parted by blank lines; a form feed begins a page."""
    out = []
    for page, part in enumerate(text.split("\f"), 1):
        for block in re.split(r"\n[ \t]*\n", part):
            if block.strip():
                out.append((len(out), page, "NarrativeText", block.strip()))
    return out


def markdown_elements(text: str) -> list[tuple[int, int, str, str]]:
    """Headings, list items, pipe tables, fenced blocks and paragraphs."""
    out: list[list] = []
    fence, kind = None, None

    def add(k: str, line: str, own: bool) -> None:
        if not own and out and kind == k:
            out[-1][3] += "\n" + line
        else:
            out.append([len(out), 1, k, line])

    for line in text.split("\n"):
        s = line.strip()
        if fence:
            if s.startswith(fence):
                fence = kind = None
            else:
                add("Text", line, False)
                kind = "Text"
        elif s.startswith(("```", "~~~")):
            fence, kind = s[:3], None
        elif not s:
            kind = None
        elif s.startswith("#") and s.lstrip("#")[:1] in (" ", "\t"):
            add("Title", s.lstrip("#").strip().rstrip("#").strip(), True)
            kind = None
        elif s.startswith(("- ", "* ", "+ ")) or re.match(r"[0-9]+[.)] ", s):
            add("ListItem", s.split(" ", 1)[1].strip(), True)
            kind = None
        elif s.startswith("|"):
            add("Table", s, False)
            kind = "Table"
        else:
            add("NarrativeText", s, False)
            kind = "NarrativeText"
    return [tuple(r) for r in out]


def elements_of_file(name: str | None, content: bytes | str | None) -> list[tuple[int, int, str, str]]:
    """The elements of one file, by its extension; other formats, and what is no text, have none."""
    if content is None or name is None:
        return []
    text = bytes(content).decode("utf-8", "replace") if not isinstance(content, str) else content
    ext = name.lower().rpartition(".")[2]
    if ext in ("html", "htm", "xhtml"):
        return html_elements(text)
    if ext in ("md", "markdown"):
        return markdown_elements(text)
    return plain_elements(text.replace("\r\n", "\n")) if ext in ("txt", "text", "log") else []


def elements(files: DataFrame, key: str, name: str, content: str) -> DataFrame:
    """(key, seq, page, kind, text) of (key, name, content); null contents and other formats have no elements.

    Formats that need an engine (layout, OCR) go through ``plans.registry.extract_with``.
    """
    kind = dict(files.dtypes)[key]

    def run(batches):
        for pdf in batches:
            rows = [(k, *r) for k, n, c in zip(pdf[key], pdf[name], pdf[content]) for r in elements_of_file(n, c)]
            yield pd.DataFrame(rows, columns=[key, "seq", "page", "kind", "text"])

    return files.select(key, name, content).mapInPandas(run, f"{key} {kind}, {ELEMENT}")


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    """(path, seq, page, kind, text) of all files under ``path``; each file is read by one task."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return elements(files.select("path", F.col("path").alias("name"), "content"), "path", "name", "content")


def edmx_entities(xml: str) -> list[tuple[str, str, list[str]]]:
    """(name, description, relations) of the entity types of an entity model in any of its name spaces.

    Without documentation the description names the model; a text that is no XML raises.
    """
    local = lambda e: e.tag.rpartition("}")[2]
    out = []
    for e in ET.fromstring(xml).iter():
        if local(e) != "EntityType":
            continue
        summary = next((s.text for d in e if local(d) == "Documentation" for s in d if local(s) == "Summary"), None)
        out.append((e.get("Name"), summary if summary is not None else f"Entity Model: {e.get('Name')}", [n.get("Name") for n in e.iter() if local(n) == "NavigationProperty"]))
    return out


def edmx_designs(files: DataFrame, key: str, content: str) -> DataFrame:
    """(key, domain, entity, description, relations) of entity models; the domain is the first segment of the key, in capitals."""

    def run(batches):
        for pdf in batches:
            rows = [(k, k.split("/")[0].upper() if "/" in k else None, *e) for k, c in zip(pdf[key], pdf[content]) if c for e in edmx_entities(c)]
            yield pd.DataFrame(rows, columns=[key, "domain", "entity", "description", "relations"])

    return files.select(key, content).mapInPandas(run, f"{key} string, domain string, entity string, description string, relations array<string>")


def escaped_xml(c: Column | str) -> Column:
    """A string as the inside of an XML attribute or text."""
    s = F.col(c) if isinstance(c, str) else c
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return s
