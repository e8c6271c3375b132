"""Spam pages: markup, wrapped lines, several languages, edge cases."""

import random

import pytest

from weftline.llm import spam as S


def test_markup_is_no_text():
    page = '<p>The pump is old.</p><a href="http://a.test/x">buy pump</a><br>Next <b>line</b>'
    lines = [x.strip() for x in S.unmarked(page).split("\n") if x.strip()]
    assert lines[0] == "The pump is old."
    assert lines[1].startswith("https://xx") and lines[1].endswith("buy pump") and lines[2].split() == ["Next", "line"]
    assert S.unmarked("a < b and c > d") == "a < b and c > d"
    assert "href" not in S.prose_words(page) and "test" not in S.prose_words(page)


def test_wrapped_lines_are_one_sentence():
    assert S.segments("The pump that stands beside the\nold valve was painted again.") == ["The pump that stands beside the old valve was painted again."]
    assert len(S.segments("http://a.test/x\nhttp://b.test/y\nwww.c.test/z")) == 3


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(4)
    words = "pump valve gasket hinge rotor spring bolt panel".split()
    n = [10**9]

    def page(text, lang):
        n[0] += 1
        return (n[0], text, lang)

    prose = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang").collect()]
    link = lambda: f'<a href="http://{rng.choice(words)}.test/{rng.choice(words)}">cheap {rng.choice(words)}</a><br>'
    spam = [page("".join(link() for _ in range(30)), "en") for _ in range(4)]
    spam += [page("Please see our parts below.\n" + "".join(link() for _ in range(30)), None) for _ in range(4)]
    spam += [page(" ".join(rng.choice(("pump", "valve", "buy", "cheap")) for _ in range(90)), "fr") for _ in range(4)]
    same = "cheap pump buy valve cheap gasket buy hinge " * 12
    spam += [page(same, "en") for _ in range(400)]
    kept = [page(r[1].replace(". ", ".</p><p>"), r[2]) for r in prose if r[1].count(". ") > 3 and "http" not in r[1]][:10]
    df = spark.createDataFrame(prose + spam + kept + [(10**10, None, None), (10**10 + 1, "", "en")], "doc_id long, text string, lang string")
    found = {r[0] for r in S.spam_scores(df).filter("share > 0.5").select("doc_id").collect()}
    plain = {r[0] for r in prose} & found
    return {r[0] for r in spam}, {r[0] for r in kept}, found, plain, {r[0]: r[1] for r in prose}, kept


def test_link_lists_in_markup_are_found(pages):
    spam, _, found, *_ = pages
    assert sorted(spam - found) == []


def test_prose_in_markup_is_kept(pages):
    _, kept, found, plain, texts, rows = pages
    bad = [texts[b] for b in plain]
    wrong = [r for r in rows if r[0] in found]
    assert all(any(t.split(". ")[0] == r[1].split(".</p>")[0] for t in bad) for r in wrong)


def test_null_and_empty_texts_have_no_row(spark):
    df = spark.createDataFrame([(1, None, None), (2, "", "en"), (3, "<br>", "en")], "doc_id long, text string, lang string")
    assert S.spam_scores(df).count() == 0
    assert S.spam_scores(df.limit(0)).count() == 0
