"""Readers of document formats: pure parsers, and the tables they give over many files.

Each parser takes one text or blob and returns rows; ``read_with`` runs it over a DataFrame of files in
Arrow batches and keeps what a broken file raised as a reason instead of failing the job.
"""

from __future__ import annotations

import csv
import gzip
import io
import json
import re
import zipfile
import zlib
from collections.abc import Callable, Iterable
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame


def read_with(files: DataFrame, key: str, content: str, parser: Callable[[object], Iterable[tuple]], schema: str) -> DataFrame:
    """(key, *schema, reason): the parser's rows of every file; a file that cannot be parsed gives one row with a reason.

    ``schema`` is a DDL of the parser's columns; null content gives no row.
    """
    names = [c.strip().split()[0] for c in schema.split(",")]
    kind = dict(files.dtypes)[key]

    def run(batches):
        for pdf in batches:
            rows = []
            for k, c in zip(pdf[key], pdf[content]):
                if c is None:
                    continue
                try:
                    rows += [(k, *r, None) for r in parser(c)]
                except Exception as e:  # noqa: BLE001 - the reason is the result
                    rows.append((k, *[None] * len(names), f"{type(e).__name__}: {e}"[:200]))
            yield pd.DataFrame(rows, columns=[key, *names, "reason"])

    return files.select(key, content).mapInPandas(run, f"{key} {kind}, {schema}, reason string")


class _Grid(HTMLParser):
    def __init__(self):
        super().__init__()
        self.tables, self.row, self.cell, self.span, self.depth = [], None, None, 1, 0

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.depth += 1
            self.tables.append([])
        elif tag == "tr" and self.tables:
            self.row = []
        elif tag in ("td", "th") and self.row is not None:
            self.cell, self.span = [], max(1, int(dict(attrs).get("colspan") or 1))
        elif tag == "br" and self.cell is not None:
            self.cell.append("\n")

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self.cell is not None and self.row is not None:
            self.row += ["".join(self.cell).strip()] + [""] * (self.span - 1)
            self.cell = None
        elif tag == "tr" and self.row is not None:
            self.tables[-1].append(self.row)
            self.row = None

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)


def html_cells(html: str) -> list[tuple[int, int, int, str]]:
    """(table_no, row, col, cell) of all tables; spanned columns are empty cells."""
    p = _Grid()
    p.feed(html)
    p.close()
    return [(t, r, c, cell) for t, rows in enumerate(p.tables) for r, row in enumerate(rows) for c, cell in enumerate(row)]


def markdown_grid(html: str) -> str:
    """The first table of an HTML text as a pipe grid, its first row the header."""
    rows: dict[int, list[str]] = {}
    for t, r, _, cell in html_cells(html):
        if t == 0:
            rows.setdefault(r, []).append(cell.replace("|", "\\|").replace("\n", " "))
    lines = [f"| {' | '.join(v)} |" for _, v in sorted(rows.items())]
    return "\n".join(lines[:1] + ["|" + "---|" * len(rows.get(0, []))] + lines[1:]) if lines else ""


def element_lines(dump: str) -> list[tuple[int, int, str, str]]:
    """(seq, page, kind, text) of a dump with ``--- Page N ---`` dividers and ``[Kind] text`` lines; other lines continue."""
    out: list[list] = []
    page = 0
    for line in dump.split("\n"):
        if m := re.fullmatch(r"-+\s*Page\s+(\d+)\s*-+", line.strip()):
            page = int(m[1])
        elif m := re.match(r"\[([A-Za-z]+)\]\s?(.*)$", line):
            out.append([len(out), page, m[1], m[2]])
        elif out and line.strip():
            out[-1][3] += "\n" + line
    return [tuple(r) for r in out]


def slug(text: str) -> str:
    return re.sub(r"[^a-z0-9]+", "-", text.lower()).strip("-") or "section"


def markdown_sections(text: str, title: str = "document") -> list[tuple[str, str, str, int, str]]:
    """(section_id, parent_id, heading, level, body) of ATX headings outside fences, repeats numbered.

    Text before the first heading is a section under the title; headings without own text are listed
    with an empty body.
    """
    heads: list[tuple[int, str, list[str]]] = []
    lead: list[str] = []
    fence = None
    for line in text.split("\n"):
        m = re.match(r" {0,3}(`{3,}|~{3,})", line)
        if m and fence is None:
            fence = m[1]
        elif m and m[1][0] == fence[0] and len(m[1]) >= len(fence) and not line.strip(" `~"):
            fence = None
        elif fence is None and (h := re.match(r" {0,3}(#{1,6})[ \t]+(.*?)[ \t]*#*[ \t]*$", line)) and h[2]:
            heads.append((len(h[1]), h[2], []))
            continue
        (heads[-1][2] if heads else lead).append(line)
    out, seen, stack = [], {}, []

    def unique(base: str) -> str:
        seen[base] = seen.get(base, 0) + 1
        return base if seen[base] == 1 else f"{base}_{seen[base]}"

    if "\n".join(lead).strip():
        out.append((unique(slug(title)), None, title, 0, "\n".join(lead).strip()))
    for level, name, body in heads:
        while stack and stack[-1][0] >= level:
            stack.pop()
        sid = unique("__".join([s[1] for s in stack][-1:] + [slug(name)]))
        out.append((sid, stack[-1][1] if stack else None, name, level, "\n".join(body).strip()))
        stack.append((level, sid))
    return out


def prompt_sections(text: str) -> list[tuple[str, str]]:
    """(name, body) of ``## name`` sections; text before the first is dropped."""
    parts = re.split(r"(?m)^## +(.+?)\s*$", text)
    return [(parts[i], parts[i + 1].strip()) for i in range(1, len(parts), 2)]


def requirement_objects(text: str) -> list[tuple[int, str, int, str, str, str]]:
    """(seq, identifier, level, heading, body, path) of a requirements export.

    ``Key: value`` lines, a blank line, then CSV. The path holds the nearest headings above with
    falling levels.
    """
    head, _, body = text.replace("\r\n", "\n").partition("\n\n")
    if not body:
        raise ValueError("no object section")
    rows = csv.DictReader(io.StringIO(body))
    if "Object Identifier" not in (rows.fieldnames or []):
        raise ValueError("no object identifiers")
    out, stack = [], []
    for seq, r in enumerate(rows):
        level = int(r.get("Object Level") or 1)
        while stack and stack[-1][0] >= level:
            stack.pop()
        out.append((seq, r["Object Identifier"], level, r.get("Object Heading") or "", r.get("Object Text") or "", " / ".join(h for _, h in stack)))
        if r.get("Object Heading"):
            stack.append((level, r["Object Heading"]))
    return out


def preamble(text: str) -> dict[str, str]:
    """The ``Key: value`` lines before the first blank line."""
    return {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in text.replace("\r\n", "\n").partition("\n\n")[0].split("\n")) if v}


_STEP_STRING = re.compile(r"'((?:[^']|'')*)'")


def step_strings(text: str) -> list[tuple[str, int, str]]:
    """(field, position, value) of the header of a STEP file and of its products; an unread field is absent."""
    if "ISO-10303-21" not in text[:200]:
        raise ValueError("no exchange file")
    out = []
    for name, most in (("FILE_SCHEMA", 1), ("FILE_NAME", 4)):
        if m := re.search(rf"\b{name}\s*\(((?:[^;']|'(?:[^']|'')*')*)\)\s*;", text):
            out += [(name, i, v.replace("''", "'")) for i, v in enumerate(_STEP_STRING.findall(m[1])[:most])]
    for name in ("PRODUCT", "PRODUCT_DEFINITION_FORMATION"):
        for i, m in enumerate(re.finditer(rf"=\s*{name}\s*\(\s*'((?:[^']|'')*)'", text)):
            out.append((name, i, m[1].replace("''", "'")))
    return out


def dxf_pairs(text: str) -> list[tuple[int, str]]:
    """(code, value) pairs of a DXF text; refuses NUL bytes, codes that are no numbers, and another beginning."""
    if "\x00" in text:
        raise ValueError("binary drawing")
    lines = [x.strip("\r") for x in text.split("\n")]
    while lines and not lines[0].strip():
        lines.pop(0)
    pairs = []
    for i in range(0, len(lines) - 1, 2):
        code = lines[i].strip()
        if not re.fullmatch(r"-?\d+", code):
            raise ValueError(f"no group code in line {i + 1}")
        if int(code) != 999:
            pairs.append((int(code), lines[i + 1].strip()))
    if not pairs or pairs[0] != (0, "SECTION"):
        raise ValueError("no section at the beginning")
    return pairs


def dxf_attributes(text: str) -> list[tuple[str, str]]:
    """(tag, value) of the attributes of a drawing, the first value of each tag; $PROJECTNAME is one of them."""
    out: dict[str, str] = {}
    kind, tag, value, project = None, None, None, False

    def close():
        if kind in ("ATTRIB", "ATTDEF") and tag and value is not None:
            out.setdefault(tag, value)

    for code, v in dxf_pairs(text):
        if code == 0:
            close()
            kind, tag, value = v, None, None
        elif code == 9:
            project = v == "$PROJECTNAME"
        elif project:
            out.setdefault("$PROJECTNAME", v)
            project = False
        elif code == 2:
            tag = v
        elif code == 1:
            value = v
    close()
    return list(out.items())


def schema_fields(text: str) -> list[tuple[str, str, str]]:
    """(name, type, description) of a JSON Schema: nested names joined by dots, array items marked ``[]``."""
    out: list[tuple[str, str, str]] = []

    def walk(node: dict, at: str, depth: int):
        for name, f in (node.get("properties") or {}).items():
            path = f"{at}.{name}" if at else name
            kind = f.get("type") or ("enum" if "enum" in f else "object" if "properties" in f else "any")
            kind = "|".join(kind) if isinstance(kind, list) else kind
            note = f.get("description") or ""
            if "enum" in f:
                note = (note + " " if note else "") + "one of " + ", ".join(map(str, f["enum"]))
            out.append((path, kind, note))
            if depth < 50:
                walk(f, path, depth + 1)
                if isinstance(f.get("items"), dict):
                    walk(f["items"], path + "[]", depth + 1)

    walk(json.loads(text), "", 0)
    return out


def idl_fields(text: str) -> list[tuple[str, str, str, str]]:
    """(struct, field, type, comment) of IDL structures, with modules as prefixes and comments of the same or previous line."""
    out, scope, comment = [], [], ""
    for line in text.split("\n"):
        s = line.strip()
        m = re.search(r"//\s*(.*)$", s) or re.search(r"/\*\s*(.*?)\s*\*/", s)
        note = m[1].strip("@ ").strip() if m else ""
        code = re.sub(r"//.*$|/\*.*?\*/", "", s).strip()
        if d := re.match(r"(module|struct|enum|union)\s+(\w+)[^{]*(\{)?", code):
            scope.append((d[1], d[2]))
        elif code.startswith("}"):
            if scope:
                scope.pop()
        elif scope and scope[-1][0] == "struct" and (f := re.match(r"(?:@\w+(?:\([^)]*\))?\s+)*([\w:<>, ]+?)\s+(\w+)((?:\[[^\]]*\])*)\s*;", code)):
            out.append(("::".join(n for _, n in scope), f[2], f[1].strip() + f[3], note or comment))
        comment = note if not code else ""
    return out


def xml_facts(text: str) -> list[tuple[str, str, str]]:
    """(subject, predicate, object) of a data module: code, title, tools, spares, warnings, figures, references and steps in order."""
    root = ElementTree.fromstring(text)
    for e in root.iter():
        e.tag = e.tag.rpartition("}")[2]
    code = root.find(".//identAndStatusSection//dmCode")
    if code is None:
        raise ValueError("no module code")
    get = lambda k: code.get(k, "")
    dmc = "-".join([get("modelIdentCode"), get("systemDiffCode"), get("systemCode"), get("subSystemCode") + get("subSubSystemCode"), get("assyCode"), get("disassyCode") + get("disassyCodeVariant"), get("infoCode") + get("infoCodeVariant"), get("itemLocationCode")]).upper()
    text_of = lambda e: " ".join("".join(e.itertext()).split())
    out = [(dmc, "type", "DataModule"), (dmc, "infoCode", get("infoCode"))]
    out += [(dmc, "title", text_of(e)) for e in root.iter("techName")]
    out += [(dmc, "tool", text_of(e)) for q in root.iter("supportEquipDescr") for e in [q.find("name") if q.find("name") is not None else q.find(".//partNumber")] if e is not None]
    out += [(dmc, "spare", text_of(e)) for q in root.iter("spareDescr") for e in [q.find("name")] if e is not None]
    out += [(dmc, "warning", text_of(e)) for e in root.iter("warning")]
    out += [(dmc, "figure", (e.get("id") or "") + ("|" + text_of(t) if (t := e.find("title")) is not None else "")) for e in root.iter("figure")]
    ident = root.find(".//identAndStatusSection")
    own = set(ident.iter("dmCode")) if ident is not None else set()
    for ref in root.iter("dmCode"):
        if ref not in own:
            out.append((dmc, "refersTo", "-".join(ref.get(k, "") for k in ("modelIdentCode", "systemCode", "infoCode"))))
    for proc in root.iter("mainProcedure"):
        out += [(dmc, f"step/{i}", text_of(p)) for i, st in enumerate(proc.findall("proceduralStep")) for p in [st.find("para")] if p is not None]
    return out


def topic_facts(text: str) -> list[tuple[str, str, str]]:
    """(subject, predicate, object) of a topic or task: title, short description, steps in order, notes, tables' cells and links.

    The subject is the topic's id; nested topics are subjects of their own, children of the outer one.
    """
    root = ElementTree.fromstring(text)
    for e in root.iter():
        e.tag = e.tag.rpartition("}")[2]
    kinds = ("topic", "concept", "task", "reference")
    words = lambda e: " ".join("".join(e.itertext()).split())
    out: list[tuple[str, str, str]] = []

    def walk(t, parent):
        sid = t.get("id") or ""
        if not sid:
            raise ValueError("a topic has no id")
        out.append((sid, "type", t.tag))
        if parent:
            out.append((parent, "child", sid))
        inner = [c for c in t if c.tag in kinds]
        own = [e for c in t if c.tag not in kinds for e in c.iter()]
        out.extend((sid, "title", words(e)) for e in own if e.tag == "title" and e in list(t))
        out.extend((sid, "summary", words(e)) for e in own if e.tag == "shortdesc")
        out.extend((sid, f"step/{i}", words(e)) for i, e in enumerate(x for x in own if x.tag == "cmd"))
        out.extend((sid, "note", words(e)) for e in own if e.tag == "note")
        out.extend((sid, "link", e.get("href")) for e in own if e.tag in ("xref", "link") and e.get("href"))
        for c in inner:
            walk(c, sid)

    if root.tag not in kinds:
        raise ValueError(f"{root.tag} is no topic")
    walk(root, None)
    return out


def work_package_facts(text: str) -> list[tuple[str, str, str]]:
    """(subject, predicate, object) of a work package: number, tag, title, tools, parts, warnings and steps in order."""
    root = ElementTree.fromstring(text)
    for e in root.iter():
        e.tag = e.tag.rpartition("}")[2].lower()
    number = root.get("wpno") or next((e.get("wpno") for e in root.iter() if e.get("wpno")), None)
    if not number:
        raise ValueError("no work package number")
    words = lambda e: " ".join("".join(e.itertext()).split())
    wp = number.lower()
    out = [(wp, "type", root.tag)]
    out += [(wp, "title", words(e)) for e in root.iter("title")][:1]
    for tag, p in (("name", "tool"), ("partno", "part"), ("warning", "warning"), ("caution", "caution")):
        out += [(wp, p, words(e)) for e in root.iter(tag)]
    return out + [(wp, f"step/{i}", words(e)) for i, e in enumerate(root.iter("step1"))]


def chunks_of_triples(triples: list[tuple[str, str, str]], least: int = 20) -> list[tuple[str, int, str]]:
    """(subject, order, text): title, then steps in order, warnings and figures, then other literals of ``least`` characters."""
    rank = {"title": 0, "step": 1, "warning": 2, "figure": 3}
    out = []
    for s, p, o in triples:
        kind = p.split("/")[0]
        if kind in rank or len(o) >= least and kind not in ("type", "refersTo"):
            out.append((s, rank.get(kind, 4) * 100_000 + (int(p.split("/")[1]) if "/" in p else 0), f"{kind}: {o}"))
    return sorted(out)


def isolation_paths(steps: dict[str, dict]) -> list[tuple[str, str]]:
    """(path id, action) of a fault isolation tree from step ``1``: ids grow by the answers yes and no; a cycle ends a path."""
    out: list[tuple[str, str]] = []

    def walk(at: str, path: str, seen: frozenset):
        step = steps.get(at)
        if step is None or at in seen:
            return
        out.append((path, step.get("action", "")))
        for answer in ("yes", "no"):
            if nxt := step.get(answer):
                walk(nxt, f"{path}-{answer}-1", seen | {at})

    walk("1", "1", frozenset())
    return out


def zip_members(blob: bytes, wanted: str = r"(?i).*\.(png|jpe?g|gif|emf|wmf|xml|txt)$") -> list[tuple[str, int, bytes]]:
    """(name, size, content) of the wanted members of a zip file (decks, packages)."""
    with zipfile.ZipFile(io.BytesIO(blob)) as z:
        return [(i.filename, i.file_size, z.read(i)) for i in z.infolist() if not i.is_dir() and re.fullmatch(wanted, i.filename)]


def gzip_slices(blob: bytes) -> list[tuple[int, int, bytes]]:
    """(slice_no, offset, content) of the gzip members embedded one after the other in a container; other bytes are skipped."""
    out, at = [], 0
    while (at := blob.find(b"\x1f\x8b\x08", at)) >= 0:
        d = zlib.decompressobj(wbits=31)
        try:
            data = d.decompress(blob[at:]) + d.flush()
        except zlib.error:
            at += 1
            continue
        if not d.eof:
            at += 1
            continue
        out.append((len(out), at, data))
        at = len(blob) - len(d.unused_data) if d.unused_data else len(blob)
    return out


def compressed(data: bytes) -> bytes:
    return gzip.compress(data, mtime=0)


def frontmatter(text: str) -> tuple[dict[str, str], str]:
    """({key: value}, body) of a text that begins with a block between ``---`` lines; values are plain scalars."""
    m = re.match(r"---\s*\n(.*?)\n---\s*\n?(.*)\Z", text, re.DOTALL)
    if not m:
        return {}, text
    pairs = (x.partition(":") for x in m[1].split("\n") if ":" in x and not x.startswith((" ", "-", "#")))
    return {k.strip(): v.strip().strip("\"'") for k, _, v in pairs}, m[2]


def compact_iri(value: str, prefixes: dict[str, str]) -> str | None:
    """``prefix:name`` as a full address; null for unknown prefixes and placeholders."""
    p, _, name = value.partition(":")
    return prefixes[p] + name if p in prefixes and name and not re.search(r"[<>{}]|TODO|TBD", name) else None
