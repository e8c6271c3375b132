"""Names that documents print, completed cuts, corrected boxes against a plain reading of the rules, readers, polls."""

import random

from weftline.operators import geometry as GE
from weftline.operators import graph as G
from weftline.operators import names as N
from weftline.sources import readers as R
from weftline.streaming import incremental as I


def test_contractions_go_beyond_the_first_word(spark):
    nominated = spark.createDataFrame([(1, "ON Semiconductor"), (2, "TE Connectivity"), (3, "Micro Devices Micronics"), (4, None), (5, "Acme")], "d int, name string")
    text = {1: "Dear onsem. customers, (onsemi) and onsemi write to info@onsemi.com", 2: "TE Connecvity", 3: "Micro", 4: "onsemi", 5: "Acme Acm"}
    words = spark.createDataFrame([(d, i, w) for d, t in text.items() for i, w in enumerate(t.split(" "))] + [(1, 99, None)], "d int, at int, word string")
    assert [tuple(r) for r in N.contracted_names(nominated, words, "d").collect()] == [(1, "onsemi")]


def test_standalone_names_by_tier(spark):
    e = [
        (1, 0, "Title", "Questions?"), (1, 1, "Title", "Analog Devices, Inc."), (1, 2, "UncategorizedText", "ANALOG DEVICES"),
        (2, 0, "Title", "SEMELAB"), (2, 1, "UncategorizedText", "SEMELAB PLC"), (2, 2, "Title", "SENSORS AND SPECIALIST COMPONENTS"), (2, 3, "NarrativeText", "Other Firm"),
        (3, 0, "Title", "Alpha Works"), (3, 1, "Title", "Beta Works"), (4, 0, "Title", "Devices Affected"), (4, 1, "Title", "www.x.com"), (4, 2, "Title", "Page 3"), (4, 3, "Title", None),
    ]
    df = spark.createDataFrame(e, "d int, at int, type string, text string")
    g = spark.createDataFrame([("Analog Devices",), (None,), ("",)], "name string")
    got = {r["d"]: (r["value"], r["tier"]) for r in N.printed_names(df, g, "d").collect()}
    assert got == {1: ("Analog Devices, Inc", "gazetteer"), 2: ("SEMELAB PLC", "heuristic")}
    assert N.printed_names(df.limit(0), g, "d").count() == 0


def test_cuts_are_completed_at_either_end_only_if_one_token_fits(spark):
    tokens = [(1, t) for t in ("AB-1234-567", "CD-1234-999", "X1", "LONE-77X", "LONE-77Y", None)]
    cuts = [(1, c) for c in ("AB-1234", "1234-567", "CD-1234-999", "LONE-77", "1234", "X1", "AB-", None)] + [(2, "AB-1234")]
    got = {(r["d"], r["mpn"]): r["whole"] for r in N.completed_cuts(spark.createDataFrame(cuts, "d int, mpn string"), spark.createDataFrame(tokens, "d int, token string"), "d").collect()}
    assert got[1, "AB-1234"] == got[1, "1234-567"] == "AB-1234-567"
    assert all(got[k] == k[1] for k in got if k not in ((1, "AB-1234"), (1, "1234-567")))


def plain_edge(edge, other, parts, near, far, sign, bound, most, ratio, allowance, limit):
    """The rule of one edge, read plainly."""
    clamp = lambda v: min(v, bound) if sign > 0 else max(v, bound)
    cap = lambda v: v if limit is None else min(v, limit)
    padded = clamp(edge + sign * cap(GE.PAD * (edge - other) * sign))
    if not parts:
        return padded
    within = [p for p in parts if (edge - p[near]) * sign > 0.5]
    if not within:
        return clamp(edge)
    sizes = sorted(abs(p[far] - p[near]) for p in within)
    ceiling = min(most, max(sizes[len(sizes) // 2] * ratio, allowance))
    reach = [p[far] * sign for p in within if abs(p[far] - p[near]) <= ceiling]
    if not reach:
        return padded
    gain = max(reach) - edge * sign
    return clamp(edge + sign * cap(gain)) if gain > 0 else clamp(edge)


def plain_words(box, words, siblings, w, h):
    x0, y0, x1, y1 = box
    lo = [v - GE.MOST_WORD for v in box]
    hi = [v + GE.MOST_WORD for v in box]
    live = [p for p in words if not any(s[0] - 1 <= p[0] and p[2] <= s[2] + 1 and s[1] - 1 <= p[1] and p[3] <= s[3] + 1 for s in siblings)]
    for _ in range(GE.PASSES):
        for a, b, c, d in live:
            rows, cols = d > y0 - 1 and b < y1 + 1, c > x0 - 1 and a < x1 + 1
            if rows and c > x0 + 0.5 and a < x0 - 0.5:
                x0 = max(a, lo[0], 0.0)
            if rows and a < x1 - 0.5 and c > x1 + 0.5:
                x1 = min(c, hi[2], w)
            cols = c > x0 - 1 and a < x1 + 1
            if cols and d > y0 + 0.5 and b < y0 - 0.5:
                y0 = max(b, lo[1], 0.0)
            if cols and b < y1 - 0.5 and d > y1 + 0.5:
                y1 = min(d, hi[3], h)
    return x0, y0, x1, y1


def test_boxes_follow_the_rules(spark):
    rng = random.Random(2)
    r = lambda a, b: round(rng.uniform(a, b), 2)
    box = lambda: (lambda x, y: (x, y, x + r(5, 120), y + r(5, 90)))(r(0, 250), r(0, 250))
    boxes, rows, cells, words, want = [], [], [], [], {}
    for page in range(60):
        own = [box() for _ in range(rng.randint(1, 3))]
        ws = [(lambda x, y: (x, y, x + r(5, 30), y + r(3, 12)))(r(0, 330), r(0, 330)) for _ in range(rng.randint(0, 40))]
        words += [(page, i, *b) for i, b in enumerate(ws)]
        for k, b in enumerate(own):
            boxes.append((page, k, *b, 330.0, 320.0))
            rs, cs = [box() for _ in range(rng.choice((0, 0, 1, 5)))], [box() for _ in range(rng.choice((0, 3, 6)))]
            rows += [(page, k, i, *x) for i, x in enumerate(rs)]
            cells += [(page, k, i, *x) for i, x in enumerate(cs)]
            row, cell = (GE.MOST_ROW, GE.ROW_RATIO, GE.LEAST_ROW, None), (GE.MOST_CELL, GE.CELL_RATIO, GE.LEAST_CELL, GE.MOST_SIDE)
            moved = (plain_edge(b[0], b[2], cs, 2, 0, -1, 0.0, *cell), plain_edge(b[1], b[3], rs, 3, 1, -1, 0.0, *row), plain_edge(b[2], b[0], cs, 0, 2, 1, 330.0, *cell), plain_edge(b[3], b[1], rs, 1, 3, 1, 320.0, *row))
            want[page, k] = plain_words(moved, ws, [x for j, x in enumerate(own) if j != k], 330.0, 320.0)
    at = "x0 double, y0 double, x1 double, y1 double"
    got = GE.corrected_boxes(
        spark.createDataFrame(boxes, f"page int, box_id int, {at}, width double, height double"), spark.createDataFrame(rows, f"page int, box_id int, seq int, {at}"),
        spark.createDataFrame(cells, f"page int, box_id int, seq int, {at}"), spark.createDataFrame(words, f"page int, seq int, {at}"),
    ).collect()
    assert len(got) == len(want)
    for g in got:
        assert all(abs(a - b) < 1e-9 for a, b in zip((g["x0"], g["y0"], g["x1"], g["y1"]), want[g["page"], g["box_id"]])), g
    assert sum(b != b0 for b, b0 in zip(want.values(), (x[2:6] for x in boxes))) > len(want) // 2


def test_files_become_elements(spark, tmp_path):
    (tmp_path / "a.html").write_text("<html><title>T</title><h1>One</h1><p>Two  <b>bold</b></p><ul><li>x</li></ul><table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2<br>3</td></tr></table>end<script>no()</script>")
    (tmp_path / "b.md").write_text("# Head #\n\ntext\nmore\n- item\n| a | b |\n|---|---|\n```\n# code\n```\n")
    (tmp_path / "c.txt").write_text("one\ntwo\n\n \nthree\fnext page")
    (tmp_path / "d.bin").write_bytes(b"\x00\xff")
    got = {}
    for r in R.read_elements(spark, f"file://{tmp_path}").orderBy("path", "seq").collect():
        got.setdefault(r["path"].rpartition("/")[2], []).append((r["page"], r["kind"], r["text"]))
    assert got["a.html"] == [(1, "Title", "T"), (1, "Title", "One"), (1, "NarrativeText", "Two bold"), (1, "ListItem", "x"), (1, "Table", "a | b |\n1 | 2 3"), (1, "Text", "end")]
    assert got["b.md"] == [(1, "Title", "Head"), (1, "NarrativeText", "text\nmore"), (1, "ListItem", "item"), (1, "Table", "| a | b |\n|---|---|"), (1, "Text", "# code")]
    assert got["c.txt"] == [(1, "NarrativeText", "one\ntwo"), (1, "NarrativeText", "three"), (2, "NarrativeText", "next page")]
    assert set(got) == {"a.html", "b.md", "c.txt"}
    assert R.elements_of_file(None, b"x") == R.elements_of_file("x.txt", None) == R.elements_of_file("x.txt", "") == []


def test_entity_models(spark):
    xml = '<E xmlns="urn:any"><EntityType Name="A"><Documentation><Summary>about</Summary></Documentation><NavigationProperty Name="b"/></EntityType><EntityType Name="B"/></E>'
    rows = R.edmx_designs(spark.createDataFrame([("sales/x.edmx", xml), ("bare", xml), ("n/y", None)], "p string, c string"), "p", "c").collect()
    assert [(r["domain"], r["entity"], r["description"], r["relations"]) for r in rows if r["p"] == "sales/x.edmx"] == [("SALES", "A", "about", ["b"]), ("SALES", "B", "Entity Model: B", [])]
    assert {r["domain"] for r in rows if r["p"] == "bare"} == {None}


def test_drift(spark):
    a = spark.createDataFrame([("x", "1 "), ("y", "2"), ("z", None), (None, "q")], "k string, c string")
    b = spark.createDataFrame([("x", "1"), ("y", "3"), ("w", "")], "k string, c string")
    assert {tuple(r) for r in G.drifted(a, b, "k", "c").collect()} == {("x", "in_sync"), ("y", "changed"), ("z", "missing"), ("w", "unexpected")}


def test_polls_start_once_for_one_content(spark):
    rows = spark.createDataFrame([("u", 3, {"b": "1", "a": "2"}), ("u", 2, {"a": "2", "b": "1"}), ("u", 1, {"a": "3"}), ("v", 4, None), (None, 9, {})], "k string, at int, p map<string,string>")
    got = [tuple(r) for r in I.approval_runs(rows, "k", "at", "p").collect()]
    assert len(got) == len(set(got)) == 3 and sorted(k for k, _ in got) == ["u", "u", "v"]
    assert len(I.approval_runs(rows, "k", "at", "p", 1).collect()) == 1


def test_heartbeats(spark, tmp_path):
    n = I.publish_heartbeats(spark, spark.createDataFrame([("notice",)], "kind string"), f"file://{tmp_path}/beats", "1 second", 3)
    assert n >= 3
    kept = sorted(tmp_path.glob("beats/beat=*"))
    assert 1 <= len(kept) <= 2
    assert spark.read.json(f"file://{kept[-1]}").first()["kind"] == "notice"
