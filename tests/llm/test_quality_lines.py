import re
from collections import Counter

import pytest

from conftest_llm import EDGES
from segwatch.llm.quality_lines import line_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text or "")
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(grams)
    repeated = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    base = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeated), base)


def measured(df):
    q = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return [(r["doc_id"], *(r["quality"][c] for c in q)) for r in df.collect()]


def test_edges(edges):
    got = Counter(measured(line_quality(edges)))
    assert got == Counter((i, *plain(t)) for i, t in EDGES)


def test_documents(documents):
    df, rows = documents
    assert Counter(measured(line_quality(df))) == Counter((i, *plain(t)) for i, t in rows)


def test_lines_that_fail(spark):
    good = "This line says something in a full sentence and it ends as it should do."
    bad = ["Home | News | Sports | Weather | Contact us", "Click here to find out all about it and more of the same, please do it now.",
           "a line of many words that just goes on and on without ever getting to its end"]
    other = "Another sentence tells of quite different things, and it also comes to a proper close!"
    text = "\n".join([good, bad[0], "", "Heading", other, bad[1], bad[2]])
    row = line_quality(spark.createDataFrame([(text,)], "text string")).head()["quality"]
    assert row["cleaned"] == "\n".join([good, "", "Heading", other])
    assert (row["n_lines"], row["n_failed_lines"], row["kept"]) == (6, 3, False)  # too much text lost
    more = "Enough good text follows here, written by somebody who cared for each word and closed every sentence with a full stop."
    row = line_quality(spark.createDataFrame([(text + "\n" + more,)], "text string")).head()["quality"]
    assert row["kept"] and not row["base_failed"]


def test_null_and_other_columns(edges, spark):
    rows = line_quality(edges).where("doc_id in (2, 3)").collect()
    assert {r["doc_id"]: r["quality"]["cleaned"] for r in rows} == {2: None, 3: ""}
    assert line_quality(edges).columns == [*[c for c in edges.columns]]
    assert line_quality(edges.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 4, 5, 6])
def test_short_repeats(spark, n):
    text = " ".join(["w"] * n)
    row = line_quality(spark.createDataFrame([(text,)], "text string")).head()["quality"]
    assert row["n_repeat_words"] == (n if n > 5 else 0)
