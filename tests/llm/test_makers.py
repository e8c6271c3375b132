"""Spellings of makers: given names that contradict, orders of words, learnt trades, typing errors in short forms."""

import random

from weftline.llm import makers as M


def grouped(spark, names):
    rows = M.link_names(spark.createDataFrame([(n,) for n in names], "mfr string")).collect()
    out = {}
    for r in rows:
        out.setdefault(r["maker"], set()).add(r["mfr"])
    return sorted(map(sorted, out.values()))


def test_contradicting_given_names_are_not_linked_through_a_spelling_without_one(spark):
    names = ["Robert Alder Quinn Optics", "Bob Alder Quinn Optics Inc", "Susan Alder Quinn Optics", "S. Alder Quinn Optics", "Alder Quinn Optics"]
    assert grouped(spark, names) == [["Alder Quinn Optics"], ["Bob Alder Quinn Optics Inc", "Robert Alder Quinn Optics"], ["S. Alder Quinn Optics", "Susan Alder Quinn Optics"]]


def test_a_spelling_without_given_name_joins_the_only_one(spark):
    names = ["Robert Alder Quinn Optics", "R. Alder Quinn Optics", "Alder Quinn Optics", "Quinn Alder Optics"]
    assert len(grouped(spark, names)) == 1


def test_family_words_in_any_order(spark):
    names = ["Marlow Fenwick Stonehill Batteries", "Fenwick Marlow Stonehill Batteries", "Stonehill Fenwick Marlow Batteries", "Batteries, Stonehill Marlow Fenwik"]
    assert len(grouped(spark, names)) == 1


def test_initials_and_single_words_with_a_typing_error(spark):
    names = ["Alder Quinnett Lighting", "A. Quinnett Lighting", "A. Quinett Lighting", "Brahimol Zotetel Optics", "Brahmiol"]
    assert grouped(spark, names) == [["A. Quinett Lighting", "A. Quinnett Lighting", "Alder Quinnett Lighting"], ["Brahimol Zotetel Optics", "Brahmiol"]]


def test_trades_and_given_names_are_learnt(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice(("ba", "ko", "ri", "mu", "te", "sol")) for _ in range(3)).capitalize() + rng.choice("xnrt")
    firms = [(rng.choice(("Olga", "Sven", "Ivo", "Ulla", "Nils", "Asta", "")), word(), word(), rng.choice(("Wibblers", "Corn Mills", "Anvils", "Umbrellas", "Kettles", "Gliders", "Yarns", "Hedgers"))) for _ in range(500)]
    names = spark.createDataFrame([(" ".join(x for x in (*f, "Ltd") if x),) for f in firms], "mfr string").distinct()
    lexicon = M.learnt(names)
    assert lexicon.trade_of("wibblers") == lexicon.trade_of("wiblers") == "wibblers"
    assert lexicon.trade_of("corn") == lexicon.trade_of("mills") == "corn mills"
    assert {"olga", "sven"} <= set(lexicon.given)
    assert not {f[1].lower() for f in firms} & set(lexicon.words)
    f = firms[0]
    assert M.parse(f"{f[1]} {f[2]} Wibblers", lexicon)[3] == "wibblers"


def test_pairs_of_a_large_maker_are_made_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 3)
    linked = spark.createDataFrame([(f"n{i:02}", "m") for i in range(20)] + [("x", "alone"), ("y", "pair"), ("z", "pair")], "mfr string, maker string")
    pairs = [tuple(r) for r in M.spelling_pairs(linked).collect()]
    assert len(pairs) == len(set(pairs)) == 191
    assert M.spelling_pairs(linked.limit(0)).count() == 0
