import pytest
from pyspark.sql import functions as F

from weftline.functions import recognise as R
from weftline.operators import review as V


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_outline_entries_are_resolved_forward_only():
    titles = [(1, "Intro"), (2, "Part  A"), (3, "Sub"), (5, "part a"), (6, "Sub")]
    entries = [(1, "Intro"), (1, "Missing"), (2, "Sub"), (1, "Part A"), (2, "Sub"), (2, "Sub")]
    assert V.resolved_outline(entries, titles) == [(1, "Intro", 1), (1, "Sub", 3), (1, "Part A", 5), (2, "Sub", 6)]


def test_outlines_by_deck(spark):
    e = spark.createDataFrame([("d", 0, 1, "A"), ("d", 1, 2, "B"), ("e", 0, 1, "A")], "deck string, seq int, level int, title string")
    t = spark.createDataFrame([("d", 3, "a"), ("d", 4, "b")], "deck string, page int, title string")
    assert rows(V.resolved_outlines(e, t, "deck"), "deck", "level", "page") == [("d", 1, 3), ("d", 2, 4)]


def test_profiles_fail_closed():
    known = {"notice": {"mfr"}, "part": {"iso"}}
    good = {"granularity": "notice", "columns": [{"output": "M", "source": {"container": "notice", "field": "mfr"}}]}
    assert V.profile_findings(good, known) == []
    bad = {"granularity": "x", "columns": [{"output": "M", "source": {"container": "notice", "field": "y"}}, {"output": "M", "source": {"container": "z"}}, {}]}
    assert len(V.profile_findings(bad, known)) == 6
    assert V.profile_findings({}, known)


def test_updates_are_scoped():
    assert V.scoped_update("INSERT DATA { <a> <b> \"{x}\" }", "urn:g") == "INSERT DATA { GRAPH <urn:g> { <a> <b> \"{x}\" } }"
    inside = "INSERT DATA { GRAPH <urn:g> { <a> <b> <c> } }"
    assert V.scoped_update(inside, "urn:g") == inside
    for bad in ("DELETE WHERE { ?s ?p ?o }", inside.replace("urn:g", "urn:h"), "INSERT DATA { { <a> <b> <c> } }"):
        with pytest.raises(ValueError):
            V.scoped_update(bad, "urn:g")


def test_roles_forms_and_rows(spark):
    roles = spark.createDataFrame([("d", 1, 0, "affected", 3), ("d", 1, 5, "customer", 3), ("d", 1, 2, "other", 3), ("d", 2, 1, "affected", 2), ("d", 2, 1, "customer", 2)], "doc string, seq int, col int, role string, width int")
    assert [r.refusal for r in V.forwarded_roles(roles).orderBy("seq", "col", "role").collect()] == [None, "no such role", "outside the grid", "given twice", "given twice"]
    cells = [(1, 0, 0, "Name:"), (1, 0, 1, "Date:"), (1, 1, 0, "Rev:"), (2, 0, 0, "AB-12"), (2, 1, 0, "AB-13"), (2, 1, 1, "a long sentence of prose that goes on here"), (2, 2, 0, None)]
    df = spark.createDataFrame(cells, "grid_id int, row int, col int, cell string")
    assert rows(V.form_regions(df).filter("is_form"), "grid_id") == [(1,)]
    assert rows(V.part_rows(df), "grid_id", "row") == [(2, 0)]
    assert rows(V.rebuilt_tables(df.filter("cell IS NOT NULL"), "grid_id").filter("tier = 1"), "grid_id") == []
    with_tier = V.rebuilt_tables(df.filter("grid_id = 2 AND col = 0"), "grid_id").first()
    assert (with_tier.rows, with_tier.width, with_tier.tier) == (3, 1, 1)


def test_joins_of_labels_crops_and_overrides(spark):
    labels = spark.createDataFrame([(1, "far", 5.0), (1, "near", 20.0), (1, "below", 60.0)], "page int, label string, foot double")
    grids = spark.createDataFrame([(1, "g", 19.0)], "page int, grid string, head double")
    assert rows(V.label_above(labels, grids, "page"), "label") == [("near",)]
    e = spark.createDataFrame([(1, "x/y/a.png"), (1, None)], "doc int, image_path string")
    u = spark.createDataFrame([(1, "a.png", "http://u")], "doc int, name string, url string")
    assert sorted(r.url or "" for r in V.crops_of(e, u, "doc").collect()) == ["", "http://u"]
    f = spark.createDataFrame([("k", "old"), ("l", "kept")], "key string, svg string")
    o = spark.createDataFrame([("k", "new"), ("k", "new")], "key string, svg string")
    assert rows(V.with_overrides(f, o, "key", "svg"), "key", "svg", "overridden") == [("k", "new", True), ("l", "kept", False)]


def test_affected_pages_and_recognition(spark):
    text = "Affected Parts\nFAM / AB1234\nFAM / CD5678\nParts list (3)"
    p = spark.createDataFrame([(1, 1, text), (1, 2, "and/or x / y"), (2, 1, "FAM / AB1234"), (3, 1, None)], "doc int, page int, text string")
    assert rows(V.affected_pages(p, "doc"), "doc", "page", "pairs", "stated", "shortfall") == [(1, 1, 2, 3, True)]
    one = lambda c, v: spark.createDataFrame([(v,)], "v string").select(c(F.col("v")).alias("x")).first().x
    assert one(R.composite_parts, "AB1,\nCD2") == ["AB1", "CD2"] and one(R.composite_parts, "AB1,\nsee note") == ["AB1,\nsee note"]
    assert one(R.is_label_echo, "Part Number / Rev:") and not one(R.is_label_echo, "Acme")
    assert one(R.answers, "Maker: Acme\nDate: null\nmaker: Other\nnoise") == {"maker": "Acme"}
    assert one(R.doc_title, "a/b/restart_the-pump.md") == "Restart The Pump"
    assert one(R.concept_name, "Ｃable  Bend") == "cable bend"
    box = spark.createDataFrame([([[1.0, 5.0], [3.0, 2.0]],), ([],)], "p array<array<double>>").select(R.bounding_box("p").alias("b")).collect()
    assert [r.b for r in box] == [[1.0, 2.0, 3.0, 5.0], None]


def test_counts_edges_and_exclusions(spark):
    c = spark.createDataFrame([("n", 1, 2, 0), ("n", 2, 1, 5)], "k string, fire int, top int, side int")
    assert rows(V.worst_seals(c, ["k"], ["top", "side"]), "top", "side", "cut") == [(2, 5, 7)]
    h = spark.createDataFrame([(10, 4), (10, 4)], "control int, ti int")
    assert rows(V.baseline_ratios(h, ["ti"]), "pair", "ratio") == [("ti", 0.4)]
    t = spark.createDataFrame([("a", "r", "b", {"x": "1"}), ("a", "r", "c", None)], "src string, rel string, dst string, props map<string,string>")
    assert V.registrations(t).count() == 2
    e = spark.createDataFrame([("a", "b"), ("a", "z")], "child string, parent string")
    assert rows(V.landed(e, spark.createDataFrame([("a",), ("b",)], "id string")), "parent", "landed") == [("b", True), ("z", False)]
    kept, why = V.excluded(spark.createDataFrame([("http://m#a",), ("owl:Thing",), ("x",), (None,)], "iri string"), "iri", ["owl:"])
    assert kept.count() == 1 and sum(r.n for r in why.collect()) == 4
    w = spark.createDataFrame([(1, "AB1", "b1"), (1, "CD2", "b2"), (1, "CD2", "b3")], "doc int, word string, box string")
    m = spark.createDataFrame([(1, "AB1"), (1, "CD2")], "doc int, mpn string")
    assert rows(V.unique_boxes(w, m, "doc"), "mpn", "box") == [("AB1", "b1")]
    assert ("t", "a.b", "int") in V.schema_rows(spark.createDataFrame([], "a struct<b int>"), "t")
    assert rows(spark.createDataFrame([("S1000D/x.xml",), ("y/z.xml",)], "p string").select(V.routed(F.col("p")).alias("r")).na.fill("-"), "r") == [("-",), ("s1000d",)]


def test_titles_and_packs(spark):
    t = spark.createDataFrame([(1, 0, "hello", True), (1, 1, "PDN 5", False), (2, 0, "PCN last order", True), (2, 1, "pdn", True)], "doc int, seq int, title string, is_title boolean")
    assert rows(V.first_title_type(t, "doc"), "doc", "source") == [(1, "title"), (2, "title-ambiguous")]
    assert rows(V.leaf_candidates(t, "doc"), "doc", "rank", "leaf", "score") == [(1, 1, "pdn", 0.8), (2, 1, "pdn", 0.9), (2, 2, "pcn", 0.3)]
    e = spark.createDataFrame([(1, i, "x" * n) for i, n in enumerate((40, 50, 30, 500, 10))] + [(1, 9, None)], "doc int, seq int, text string")
    assert rows(V.packed_elements(e, "doc", 100), "pack", "n") == [(0, 2), (1, 1), (2, 1), (3, 1)]
