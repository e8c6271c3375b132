import random

import pytest

from weftline.llm import canonical as C
from weftline.llm import makers as M
from weftline.llm import textdist, triejoin


def distance(a, b):
    d = [[i + j if i == 0 or j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


@pytest.fixture(scope="module")
def strings():
    rng = random.Random(5)
    return sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 11))) for _ in range(260)})


def test_distances_and_deletions(strings):
    for a in strings[:90]:
        for b in strings[:90]:
            d = distance(a, b)
            assert textdist.osa(a, b, 2) == min(d, 3)
            if d <= 2:
                assert textdist.deletions(a, 2) & textdist.deletions(b, 2)


def test_trie_join_is_complete(spark, strings):
    q = spark.createDataFrame([(s,) for s in strings], "q string")
    e = spark.createDataFrame([(s,) for s in strings], "e string")
    got = {(r.q, r.e): r.d for r in triejoin.trie_join(q, e).collect()}
    want = {(a, b): distance(a, b) for a in strings for b in strings if a != b and len(b) <= len(a) and distance(a, b) <= 2}
    assert got == want


def test_hot_shards_are_copied(spark, strings, monkeypatch):
    monkeypatch.setattr(triejoin, "CELL", 3)
    test_trie_join_is_complete(spark, strings)


def test_spellings_of_makers(spark):
    same = [
        ["Brahim Zotetel Optics Inc.", "BRAHIM ZOTETEL OPTICS INC.", "Brahim & Zotetel Opt.", "Zotetel Brahim Optics", "Brahimzotetel Optics", "Optics, Brahim Zotetel", "Brahim Zot3tel Optics", "BrahZote", "Brahim", "B. Zotetel Optics", "Brahim Zotetel", "The Brahim  Zotetel (Optics)"],
        ["William Gorap-Vidolek Relay Works", "Bill Gorap-Vidolek Rly Works", "Gorap-Vidolek, Bill (Relay Works)", "W. Gorap-Vidolek Relay Works", "Gorap-Vidolek Relay Works", "William Groap-Vidolek Relays"],
        ["Lumak Teserox Microwave Ltd", "Lumak Teserox Mwave", "Lumak Teserox Micro-wave Ltd."],
        ["Lumak Teserox Fasteners Ltd", "Lumak Tesreox Fasteners"],
        ["Lumak Teserox"],
    ]
    names = [(x,) for g in same for x in g] + [(None,), ("n/a",), ("-",), ("",), ("see letterhead",)]
    got = {r.mfr: r.maker for r in M.link_names(spark.createDataFrame(names, "mfr string")).collect()}
    assert set(got) == {x for g in same for x in g}
    for g in same:
        assert len({got[x] for x in g}) == 1, {x: got[x] for x in g}
    assert len({got[g[0]] for g in same}) == len(same)
    pairs = {tuple(r) for r in M.spelling_pairs(spark.createDataFrame(list(got.items()), "mfr string, maker string")).collect()}
    assert len(pairs) == sum(len(g) * (len(g) - 1) // 2 for g in same) and all(a < b for a, b in pairs)


def test_no_names(spark):
    assert M.link_names(spark.createDataFrame([(None,), ("-",)], "mfr string")).count() == 0


def test_mapping_of_entries(spark):
    terms = [
        (1, "standard", "VDM-STD-88454", []), (2, "standard", "ISQ 64280", None), (3, "material", "thermal pad", []), (4, "material", "lock washer", []),
        (5, "material", "isopropyl alcohol", ["IPA"]), (6, "material", "flat washer", []), (7, "concept", "root cause analysis", ["RCA"]),
    ]
    want = {
        ("standard", "VDM-Standard 88454"): 1, ("standard", "88,454 VDM-STD"): 1, ("standard", "vdm std 88454, Rev C"): 1, ("standard", "VDMSTD88454"): 1, ("standard", "VDM-STD 88455"): -1,
        ("standard", "ISQ-6428O"): 2, ("standard", "per ISQ 64280 para 3"): 2, ("standard", "ISQ 64280B"): 2, ("standard", "ISQ"): -1, ("standard", "?"): -1,
        ("material", "pad, thermal"): 3, ("material", "2x themral pads"): 3, ("material", "lockwasher"): 4, ("material", "Lock wahser"): 4, ("material", "ipa"): 5, ("material", "duct tape"): -1,
        ("material", "the flat washer"): 6, ("concept", "root-cause anlaysis"): 7, ("concept", "rca"): 7, ("concept", "team lunch"): -1, ("unknown", "x"): -1,
    }
    t = spark.createDataFrame(terms, "ref_id long, kind string, term string, aliases array<string>")
    e = spark.createDataFrame(list(want), "kind string, entry string")
    got = {(r.kind, r.entry): r.ref_id for r in C.map_entries(e, t).collect()}
    assert got == want
    assert C.map_entries(e, t.limit(0)).filter("ref_id <> -1").count() == 0
    assert C.map_entries(e.limit(0), t).count() == 0
