import random
from collections import defaultdict

import pytest

from weftline.llm import ledger as L
from weftline.session import table


@pytest.mark.parametrize(
    ("a", "b", "same"),
    [
        ("Valve Check, Level 14", "valve check level 14.", True), ("a, b; c", "C / A / B", True), ("ｖａｌｖｅ", "VALVE", True), ("cross-feed", "crossfeed", True),
        ("tolé", "tolé", True), ("tolé", "tole", False), ("level 14", "level 41", False), ("a b, c", "c, a d", False),
    ],
)
def test_keys(a, b, same):
    x, y = L.spelling_keys(a), L.spelling_keys(b)
    assert (x[0] == y[0] or x[1] == y[1]) is same


def test_nothing_to_compare():
    assert L.spelling_keys(None) == L.spelling_keys(" ,; ") == (None, None)


def brute(rows):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for i, d, c, t in rows:
        a, b = L.spelling_keys(t)
        root(i)
        if a is not None:
            for k in (("f", d, c, a), ("s", d, c, b)):
                up[root(i)] = root(k)
    g = defaultdict(list)
    for i, *_ in rows:
        g[root(i)].append(i)
    return {(min(v), x) for v in g.values() for x in v if x != min(v)}


def test_found_against_brute_force(spark, small):
    r = table(spark, small, "concept_records").select("record_id", "domain", "course_id", "name", "name_normalized").collect()
    got = {tuple(x) for x in L.p2_found(spark, small).collect()}
    assert got == brute([(x[0], x[1], x[2], x[3] if x[3] is not None else x[4]) for x in r])


def test_batches_give_the_same_ledger(spark):
    rng = random.Random(1)
    names = ["a, b", "b; a", "a b", "c", "C.", "d / e", "e d", None, "  "]
    rows = [(i, "D", None if i % 5 == 0 else "c", rng.choice(names)) for i in range(200)]
    df = spark.createDataFrame(rows, "record_id long, domain string, course_id string, name string")
    keyed = L.with_keys(df, df.name, ["domain", "course_id"])
    one, many = (L.Ledger(spark, L.fresh_path(spark, "ledger"), 4) for _ in range(2))
    one.update(keyed, "record_id")
    for k in range(4):
        many.update(keyed.filter(f"record_id % 4 = {k}"), "record_id")
    rows_of = lambda g: {tuple(r) for r in g.groups().collect()}
    assert rows_of(one) == rows_of(many)
    assert sum(r.n for r in many.rows().collect()) == sum(t is not None and t.strip() != "" for *_, t in rows)


def test_an_update_touches_only_its_buckets(spark):
    df = spark.createDataFrame([(i, "D", "c", f"n{i}") for i in range(40)], "record_id long, domain string, course_id string, name string")
    keyed = L.with_keys(df, df.name, ["domain", "course_id"])
    led = L.Ledger(spark, L.fresh_path(spark, "ledger"), 8)
    led.update(keyed, "record_id")
    before = dict(led.table.state["at"])
    led.update(keyed.filter("record_id = 7"), "record_id")
    assert sum(led.table.state["at"][b] != v for b, v in before.items()) == 1


def test_a_later_process_goes_on(spark):
    rows = [(i, "D", "c", f"n{i % 3}") for i in range(12)]
    df = spark.createDataFrame(rows, "record_id long, domain string, course_id string, name string")
    keyed = L.with_keys(df, df.name, ["domain", "course_id"])
    path = L.fresh_path(spark, "ledger")
    for k in range(3):
        assert L.Ledger(spark, path).update(keyed.filter(f"record_id % 3 <> {k} OR record_id < 3"), "record_id", f"d{k}")
    assert not L.Ledger(spark, path).update(keyed, "record_id", "d1")
    assert {(r["keep_id"], r["copies"]) for r in L.Ledger(spark, path).groups().collect()} == {(0, 9), (1, 9), (2, 9)}


def test_long_chains_of_writings_are_one_group(spark):
    # f0-s0, s0-f1, f1-s1, ... : neighbours share one key, the ends share none.
    rows = [(f"f{i + j}", f"s{i}") for i in range(120) for j in (0, 1)]
    led = L.Ledger(spark, L.fresh_path(spark, "ledger"))
    keyed = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "record_id long, flat_key string, sorted_key string")
    led.update(keyed, "record_id")
    assert {(r["keep_id"], r["copies"]) for r in led.groups().collect()} == {(0, 240)}
    assert L.Ledger(spark, L.fresh_path(spark, "ledger")).groups().count() == 0
