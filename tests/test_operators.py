import io
import random
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from weftline.functions import text as X
from weftline.operators import components, concepts, elements, graph, identity, parts, scrub, skew, trust, vectors
from weftline.plans import registry
from weftline.sources import documents as D
from weftline.sources import tables as S


def values(spark, rows, column):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], "v string").select(column(F.col("v"))).collect()]


def test_components_against_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(260)] + [(500 + i, 501 + i) for i in range(40)] + [(9, 9)]
    got = dict(components.connected_components(spark.createDataFrame(edges + [(None, 1)], "a long, b long")).collect())
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    want = {}
    for x in list(up):
        want[x] = root(x)
    least = {}
    for x, r in want.items():
        least[r] = min(least.get(r, x), x)
    assert got == {x: least[r] for x, r in want.items()}


def test_components_of_nothing(spark):
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_join_of_counted_keys_with_a_hot_one(spark):
    rows = spark.createDataFrame([("h", i) for i in range(5000)] + [(f"k{i}", i) for i in range(50)] + [(None, 1)], "k string, v int")
    keyed = rows.filter("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"), F.min("v").alias("m"))
    out = skew.join_counted(rows, keyed, "k", "n", 5051)
    assert out.count() == 5050 and set(out.columns) == {"k", "v", "m"}


def test_revision_relations(spark):
    rows = [(1, "a", "d", "1.0"), (2, "a", "d", "1.2"), (3, "a", "d", "1.10"), (4, "a", "d", None), (5, "a", "d", "1.0"), (6, "a", "e", "b"), (7, "a", "e", "c"), (8, None, "d", "1")]
    k = spark.createDataFrame(rows, "notice_id long, mfr_key string, doc_key string, revision_key string")
    got = {(r.notice_a, r.notice_b): (r.relation, r.copies_a) for r in identity.revision_relations(k).collect()}
    assert got[1, 2] == ("superseded_by", 2) and got[2, 3] == ("superseded_by", 1) and got[1, 4][0] == "revision_order_unknown" and got[6, 7][0] == "superseded_by"
    assert all(8 not in p and 5 not in p for p in got)


def test_text_columns(spark):
    assert values(spark, ["ACME, Inc.", "Acme  Co", "inc", None, "  "], lambda c: X.without_suffix(X.component_key(c))) == ["acme", "acme", "inc", None, None]
    assert values(spark, ["05/12/2023", "13/12/2023", "05/05/2023", "12/25/2023", "2023-02-30", "1 May 2023", "May 1, 2023", " 2023-01-01", None], X.forced_date) == [None, "2023-12-13", "2023-05-05", "2023-12-25", None, "2023-05-01", "2023-05-01", None, None]
    assert values(spark, ['"""a"""', "''", "'x'", None], X.without_quotes) == ["a", "''", "x", None]
    assert values(spark, ["Alias Part Number", "Customer Part No", "Replacement", "Part Number", "Colour", None], X.header_role) == ["alias", "customer", "replacement", "affected", None, None]
    assert values(spark, ["a/b c", "///", None], X.slug) == ["b-c", "unknown", "unknown"]
    assert values(spark, ["Äb1 ", None], X.shape) == ["Aa9 ", None]
    assert values(spark, ["queryKnowledgeGraph"], X.human_verb) == ["query knowledge graph"]
    sig = spark.createDataFrame([("PCN last order",), ("pdn 1",), ("change notice",), ("hello",)], "v string").select(X.title_signal("v").alias("s")).select("s.*").collect()
    assert [tuple(r) for r in sig] == [(None, "ambiguous"), ("PDN", "code"), ("PCN", "keyword"), (None, None)]


def test_outline_nests_and_closes(spark):
    ls = spark.createDataFrame([(1, i, t) for i, t in enumerate(["1 One", "x y", "1.1 Sub", "1.1.1 Deep", "WARNING", "2 Two", "Page 3", "SHOUT"])], "d int, line_no int, line string")
    o = {r.line_no: (r.level, r.parent, r.end_line) for r in elements.outline(elements.recognised_headings(ls, "d"), "d").collect()}
    assert o == {0: (1, None, 4), 2: (2, 0, 4), 3: (3, 2, 4), 5: (1, None, 6), 7: (1, None, None)}


def test_upsert_keeps_vectors(spark):
    old = spark.createDataFrame([("a", "v"), ("b", None)], "k string, v string")
    new = spark.createDataFrame([("a", None), ("b", "w"), ("c", None)], "k string, v string")
    assert dict(elements.upsert_verdicts(old, new, "k", "v").collect()) == {"a": "skipped_would_strip_vector", "b": "written", "c": "written_without_vector"}
    once = elements.upserted(old, new, "k", "v")
    assert dict(once.collect()) == {"a": "v", "b": "w", "c": None} == dict(elements.upserted(once, new, "k", "v").collect())


def test_grid_pairs_stop_at_the_next_affected_column(spark):
    cells = [(1, 0, c, t) for c, t in enumerate(["Affected Part", "Note", "Part Number", "Replacement"])] + [(1, 1, c, t) for c, t in enumerate(["A1", "x", "'B2'", "C3"])] + [(1, 2, 0, None), (1, 2, 2, "see note")]
    df = spark.createDataFrame(cells, "grid_id int, row int, col int, cell string")
    got = sorted((r.affected, r.replacement) for r in parts.grid_parts(df).collect())
    assert got == [("A1", None), ("B2", "C3")]


def test_grounding(spark):
    needles = spark.createDataFrame([(1, "ab"), (1, "zz"), (1, " "), (2, "ab")], "d int, needle string")
    index = spark.createDataFrame([(1, 0, "x AB", False), (1, 1, "ab", True), (2, 0, "ab", False), (2, 1, None, True)], "d int, seq int, text string, preferred boolean")
    got = {(r.d, r.needle): (r.status, r.confidence, r.first_seq) for r in parts.grounded(needles, index, "d").collect()}
    assert got == {(1, "ab"): ("region_preferred", 0.7, 1), (1, "zz"): ("not_found", 0.0, None), (1, " "): ("not_found", 0.0, None), (2, "ab"): ("unique", 1.0, 0)}


def test_packing_of_calls(spark):
    placed = spark.createDataFrame([("c", i, "s" if i < 12 else None) for i in range(20)], "course_id string, slide int, section string")
    runs = concepts.call_runs(placed)
    assert sorted(r.n for r in runs.collect()) == [6, 6, 8]
    assert sum(r.n for r in concepts.packed_calls(runs).collect()) == 20


def test_reachability_ends_at_cycles(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "parent string, child string")
    assert graph.reachable(e).count() == 9


def test_triples_put_and_labels(spark):
    t = spark.createDataFrame([("g", "x#LSAFailureMode", "type", "C"), ("g", "y", "type", "C"), ("g", "y", "label", "Y"), ("h", "z", "p", "o")], "graph string, s string, p string, o string")
    assert [(r.label, r.opaque) for r in graph.missing_labels(t, "C", "label").collect()] == [("LSA Failure Mode", False)]
    new = spark.createDataFrame([("g", "n", "p", "o")], t.schema)
    assert graph.put_graphs(t, new).count() == 2


def test_nearest_handles_nulls_and_zero(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [0.9, 0.1]), (5, [1.0, 0.0])], "k long, v array<double>")
    got = [(r.query, r.key) for r in vectors.nearest(rows, rows, "k", "v", 1, block=2).orderBy("query").collect()]
    assert got == [(1, 1), (4, 4), (5, 1)]


def test_scrub_keeps_shapes_and_repeats(spark):
    b = spark.createDataFrame([(1, "use AB-12 and AB-12, not 12 kg or go1x"), (2, None), (3, "")], "k int, t string")
    out, ledger = scrub.scrubbed(b, "k", "t", b"s", [], [r"\d+ kg\b"])
    got = {r.k: r.scrubbed for r in out.collect()}
    a, c = got[1].split(" ")[1], got[1].split(" ")[3].rstrip(",")
    assert a == c != "AB-12" and a[0] in "QXZ" and "12 kg" in got[1] and got[2] is None
    assert {r.sites for r in ledger.collect()} == {2, 1}
    assert all(r.failures == 0 for r in scrub.ledger_checks(out, ledger, "k", "t").collect())


def test_dates_near_phrases():
    t = "The last-time-buy date is 22 Dec, 2024; ship by 01/02/2025. " + "x" * 130 + " 2026-01-01"
    assert [(r[0], r[2]) for r in trust.dated_phrases(t)] == [("2024-12-22", "last-time-buy"), ("2025-01-02", "last-time-buy")]  # as printed
    assert trust.dated_phrases("on 31 Feb 2024 LTB") == []


def test_readings_agree(spark):
    rows = [("acme", "acme", True), ("acme", "acme tools", True), ("acmtl", "acme tools", True), ("ace", "arcade", False), (None, "a", False), ("ab", "ba", False)]
    df = spark.createDataFrame(rows, "a string, b string, w boolean").select(trust.readings_agree("a", "b").alias("g"), "w")
    assert all(r.g == r.w for r in df.collect())


def test_boxes_are_completed(spark):
    b = spark.createDataFrame([(1, 1, 10.0, 0.0, 40.0, 50.0)], "page int, box_id int, x1 double, y1 double, x2 double, y2 double")
    w = spark.createDataFrame([(1, 5.0, 5.0, 12.0, 9.0), (1, 30.0, 5.0, 90.0, 9.0), (1, 20.0, 5.0, 25.0, 9.0)], "page int, x1 double, y1 double, x2 double, y2 double")
    assert [(r.x1, r.x2, r.cut) for r in trust.completed_boxes(b, w, "page").collect()] == [(5.0, 76.0, 2)]


def test_parsers():
    assert D.html_cells("<table><tr><td colspan=2>a<br>b</td><td>c</td></tr></table>") == [(0, 0, 0, "a\nb"), (0, 0, 1, ""), (0, 0, 2, "c")]
    assert D.markdown_grid("<table><tr><th>h</th></tr><tr><td>x|y</td></tr></table>").split("\n")[1] == "|---|"
    md = D.markdown_sections("lead\n# A #\ntext\n## B\n```\n# no\n```\n# A\n", "Doc")
    assert [(s[0], s[1], s[3]) for s in md] == [("doc", None, 0), ("a", None, 1), ("a__b", "a", 2), ("a_2", None, 1)]
    assert D.prompt_sections("x\n## one\nA\n## two\nB") == [("one", "A"), ("two", "B")]
    step = "ISO-10303-21;\nFILE_NAME('a''b','t',('x'),('y'));\nFILE_SCHEMA(('AP242'));\n#1=PRODUCT('P1','n');"
    assert ("FILE_NAME", 0, "a'b") in D.step_strings(step) and ("PRODUCT", 0, "P1") in D.step_strings(step)
    dxf = "0\nSECTION\n9\n$PROJECTNAME\n1\nPRJ\n0\nATTRIB\n2\nTITLE\n1\nT1\n0\nATTDEF\n2\nTITLE\n1\nT2\n"
    assert D.dxf_attributes(dxf) == [("$PROJECTNAME", "PRJ"), ("TITLE", "T1")]
    for bad in ("a\x00", "x\ny", "0\nEOF"):
        with pytest.raises(ValueError):
            D.dxf_pairs(bad)
    js = '{"properties": {"a": {"type": "object", "properties": {"b": {"enum": [1, 2]}}}, "c": {"type": "array", "items": {"properties": {"d": {"type": "string"}}}}}}'
    assert [(n, k) for n, k, _ in D.schema_fields(js)] == [("a", "object"), ("a.b", "enum"), ("c", "array"), ("c[].d", "string")]
    idl = "module M {\n // note\n struct S {\n  long id; // the id\n  sequence<string, 4> names;\n };\n};"
    assert D.idl_fields(idl) == [("M::S", "id", "long", "the id"), ("M::S", "names", "sequence<string, 4>", "")]
    assert D.frontmatter("---\na: 1\nb: 'x'\n---\nbody") == ({"a": "1", "b": "x"}, "body")
    assert D.compact_iri("m:Pump", {"m": "http://m#"}) == "http://m#Pump" and D.compact_iri("m:<x>", {"m": "h"}) is None
    tree = {"1": {"action": "look", "yes": "2", "no": "3"}, "2": {"action": "stop", "yes": "1"}, "3": {"action": "go"}}
    assert D.isolation_paths(tree) == [("1", "look"), ("1-yes-1", "stop"), ("1-no-1", "go")]
    assert [c[2] for c in D.chunks_of_triples([("d", "step/1", "b"), ("d", "step/0", "a"), ("d", "title", "t"), ("d", "note", "short")])] == ["title: t", "step: a", "step: b"]


def test_containers():
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("ppt/media/a.png", b"png")
        z.writestr("x.bin", b"no")
    assert D.zip_members(buf.getvalue()) == [("ppt/media/a.png", 3, b"png")]
    blob = b"head" + D.compressed(b"one") + b"gap" + D.compressed(b"two")
    assert [d for _, _, d in D.gzip_slices(blob)] == [b"one", b"two"]


def test_broken_files_give_reasons(spark):
    f = spark.createDataFrame([(1, "0\nSECTION\n0\nATTRIB\n2\nA\n1\nv\n"), (2, "junk"), (3, None)], "k int, c string")
    got = D.read_with(f, "k", "c", D.dxf_attributes, "tag string, value string").orderBy("k").collect()
    assert [(r.k, r.tag) for r in got] == [(1, "A"), (2, None)] and "ValueError" in got[1].reason


def test_paged_search_and_sinks(spark, tmp_path):
    (tmp_path / "p").mkdir()
    for i in range(3):
        (tmp_path / f"p/page-{i}.json").write_text(f'[{{"id": "{i}", "name": "n", "modified": {i}}}]')
    spark.dataSource.register(S.PagedSearch)
    df = spark.read.format("paged_search").option("path", str(tmp_path / "p")).load()
    assert df.count() == 3
    S.write_atomically(df, f"file://{tmp_path}/out")
    S.write_atomically(df.limit(1), f"file://{tmp_path}/out")
    assert spark.read.json(f"file://{tmp_path}/out").count() == 1
    S.write_csv(df, f"file://{tmp_path}/csv")
    assert spark.read.option("header", True).csv(f"file://{tmp_path}/csv").count() == 3
    S.write_marked(df, f"file://{tmp_path}/c", {"model": "m"})
    assert spark.read.json(f"file://{tmp_path}/c_marks").first().value == "m"


def test_passes_and_registry(spark):
    p = registry.Passes()
    p.register("a.len", lambda text, doc_id: len(text))
    p.register("a.later")
    assert p.run("a.len", text="abc", doc_id=1) == ("ok", 3)
    assert p.run("a.len", text=None)[0] == "refused"
    assert p.run("a.later") == ("unbuilt", None) and p.run("x::y") == ("external", None)
    for bad in (lambda other: other, dict):
        with pytest.raises(registry.ContractError):
            p.register("b", bad)
    with pytest.raises(registry.ContractError):
        p.run("nothing")
    kinds = [registry.Kind("a", "a", "m", suffixes=(".xml",)), registry.Kind("b", "b", "m", suffixes=("md",))]
    assert registry.fingerprint(kinds) == registry.fingerprint(kinds[::-1]) and "md|xml" in registry.gate(kinds, "m")
    df = spark.createDataFrame([(1, "a"), (2, "bb")], "k int, c string")
    out = registry.extract_with(df, "k", "c", lambda xs: [[(len(x),)] if len(x) > 1 else ValueError("short") for x in xs], "n int").orderBy("k").collect()
    assert out[0].reason == "ValueError: short" and out[1].n == 2


def test_topics_and_work_packages():
    t = '<task id="t"><title>Do</title><shortdesc>s</shortdesc><taskbody><steps><step><cmd>one</cmd></step><step><cmd>two <xref href="u#x"/></cmd></step></steps></taskbody><topic id="n"><title>In</title></topic></task>'
    f = D.topic_facts(t)
    assert ("t", "step/1", "two") in f and ("t", "child", "n") in f and ("t", "title", "Do") in f and ("n", "title", "In") in f and ("t", "link", "u#x") in f and ("t", "title", "In") not in f
    w = D.work_package_facts('<maintwp wpno="M0001-9-1"><title>Fix</title><tools><name>Saw</name></tools><warning>Hot</warning><proc><step1>a</step1><step1>b</step1></proc></maintwp>')
    assert w[0] == ("m0001-9-1", "type", "maintwp") and ("m0001-9-1", "step/1", "b") in w and ("m0001-9-1", "tool", "Saw") in w
    for bad in ("<x/>", "<task/>"):
        with pytest.raises(ValueError):
            D.topic_facts(bad)


def test_rows_under_captions(spark):
    rows = [(1, 0.0, "lead", False), (1, 10.0, "Parts", True), (1, 20.0, "a", False), (1, 30.0, "b", False), (1, 90.0, "c", False), (1, 95.0, "d", False), (1, 100.0, "More", True), (1, 110.0, "e", False)]
    df = spark.createDataFrame(rows, "page int, y double, text string, is_caption boolean")
    assert {r.text: r.caption for r in trust.rows_under_captions(df, "page", 25.0).collect()} == {"lead": None, "a": "Parts", "b": "Parts", "c": None, "d": None, "e": "More"}


def test_every_record_has_its_concept_id(spark, tmp_path):
    import hashlib
    import unicodedata

    from weftline.plans import concepts as plans

    rows = [(1, "TRAINING", "Torque  Control", None), (2, "training ", "ＴＯＲＱＵＥ\u00a0control", None), (3, "TRAINING", "Prüfmaß", None), (4, "TRAINING", "Pru\u0308fmass", None), (5, "TRAINING", "ﬂange “A”", "x"), (6, "TRAINING", None, "Flange"), (7, "TRAINING", None, None), (8, None, "a", None), (9, "A-B", "a", None), (10, "A_B", "a", None)]
    spark.createDataFrame(rows, "record_id long, domain string, name string, name_normalized string").write.parquet(str(tmp_path / "concept_records.parquet"))
    got = {r.record_id: (r.norm, r.concept_id) for r in plans.record_concept_ids(spark, str(tmp_path)).collect()}

    def want(domain, name):
        norm = " ".join(unicodedata.normalize("NFKC", name or "").split()).casefold()
        return norm, "concept_" + hashlib.sha256(f"{' '.join((domain or '').split()).upper()}␟{norm}".encode()).hexdigest()[:16]

    assert got == {i: want(d, n if n is not None else m) for i, d, n, m in rows}
    assert got[1] == got[2] and got[3] == got[4] and len({x for _, x in got.values()}) == 8


def test_concept_ids_are_part_of_all(spark, small):
    from weftline.plans import concepts as plans

    plain, every = ({tuple(r) for r in f(spark, small).collect()} for f in (plans.concept_ids, plans.record_concept_ids))
    assert plain < every and len(every) == spark.read.parquet(f"{small}/concept_records.parquet").count()


def test_witnessed_parts(spark):
    texts = spark.createDataFrame([(1, "Fit TI5521-1 and AB-1234-567/A, then ab-77 88 with XAB9Y"), (2, None), (3, "5521-1")], "doc int, text string")
    mpns = ("5521-1", "AB-1234-567", "AB-7788", "AB9", "TI5521", "I552-1", "ZZ-1234")
    parts = spark.createDataFrame([*((1, m) for m in mpns), (2, "5521-1"), (3, "521-1"), (1, "T5521"), (1, "T55211"), (1, "--")], "doc int, mpn string")
    got = {(r.doc, r.mpn): r.verdict for r in trust.witnessed(parts, texts, "doc").collect()}
    assert got[1, "I552-1"] == got[1, "5521-1"] == got[1, "AB-1234-567"] == got[1, "AB-7788"] == got[1, "AB9"] == got[1, "TI5521"] == "kept"
    assert got[1, "T55211"] == got[1, "T5521"] == "suspect" and got[1, "ZZ-1234"] == got[2, "5521-1"] == got[1, "--"] == "unseen" and got[3, "521-1"] == "kept"


def test_overlap_pairs_pass_no_shuffle(spark, monkeypatch, tmp_path):
    from weftline.plans import concepts as plans

    rng = random.Random(5)
    words = ["heat", "soak", "pin", "tool", "wear", "ab", "abcd", "valve", "check", "feed"]
    keys = sorted({" ".join(rng.choice(words) for _ in range(rng.randint(1, 5))) for _ in range(300)} | {"abba", "abba b b a", "aaaa", "aaaa aaaa aaaa aaaa", "pins", "tool s"})
    terms = {k: [rng.choice(keys)] for k in keys[::3]}
    rows = [("c", i, k.upper(), terms.get(k)) for i, k in enumerate(keys)]
    spark.createDataFrame(rows, "course_id string, slide int, name string, related_terms array<string>").write.parquet(str(tmp_path / "slide_concepts.parquet"))

    def signal(a, b):
        if b in terms.get(a, []) or a in terms.get(b, []):
            return "term"
        if len({re.sub("(?<=[^s])s$", "", re.sub("ies$", "y", k)) for k in (a, b)}) == 1:
            return "plural"
        if any(" " not in s and 2 <= len(s) <= 6 and " " in w and s == "".join(x[0] for x in w.split()) for s, w in ((a, b), (b, a))):
            return "acronym"
        x, y = set(a.split()), set(b.split())
        return "overlap" if any(len(t) >= 4 for t in x & y) and 2 * len(x & y) >= len(x | y) else None

    want = {(a, b): s for i, a in enumerate(keys) for b in keys[i + 1 :] if (s := signal(a, b))}
    for block in (100_000, 7):
        monkeypatch.setattr(concepts, "BLOCK", block, raising=False)
        df = plans.blocked_candidates(spark, str(tmp_path))
        got = [((r.a, r.b), r.signal) for r in df.collect()]
        assert len(got) == len(want) and dict(got) == want
        assert set(want.values()) == {"term", "plural", "acronym", "overlap"}
        above = df._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")[0]
        assert "Aggregate" not in above and "Repartition" not in above


def test_proposals_look_for_no_overlaps_and_shuffle_no_hot_pairs(spark, small, monkeypatch):
    import oracle

    from weftline.plans import concepts as plans

    def none(*_):
        raise AssertionError("no overlap is confident enough")

    monkeypatch.setattr(concepts, "overlap_pairs", none, raising=False)
    for hot in (1, 300, 1e9):  # no key is hot, some are, all are
        monkeypatch.setattr(concepts, "HOT_KEYS", hot, raising=False)
        assert oracle.compare(plans.proposal_topn(spark, small), oracle.connect(small), plans.SQL["proposal_topn"]) == ""
