import random

import pytest
from samples import CLASHING, SCHEMA, prose, words_of


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text): prose with exact and near copies, shared lines, junk, and edge cases."""
    rng = random.Random(7)
    texts = [prose(rng, rng.choice([3, 20, 90, 200])) for _ in range(40)]
    shared = "This line stands in a number of documents"
    texts += [t + "\n" + shared + "\n" + prose(rng, 30) for t in texts[:6]]
    texts += [shared.upper() + "  \n" + prose(rng, 60)]
    texts += [texts[2], texts[2].replace(" ", "\t\t "), texts[2] + " end"]
    for i in (5, 7, 9):
        words = texts[i].split(" ")
        texts += [" ".join([*words[:-1], "changed"]), " ".join(["other", *words[1:]])]
    texts += [" ".join(w + rng.choice(["***", "$$$", "###"]) for w in words_of(texts[3])) for _ in range(3)]
    texts += [" ".join(["word"] * 80), "one two", "one two", "ONE TWO", "", "", None, " \t\n ", "\n\n", "a"]
    texts += ["x" * 30_000, "long text here, " * 9_000, "日本語のテキスト、漢字。" * 40, "e\u0301té \u00a0 \x1c ﬁ ▁ 🎉\x00"]
    return list(enumerate(texts))


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with other columns, nulls in them, names that clash, and a repeated row."""
    rows = [
        (i, t, None if i % 5 == 0 else ["en", "de"][i % 2], None if i % 7 == 0 else "src", None, 1, 2, "x", 3, "y", 4, "z")
        for i, t in corpus
    ]
    return spark.createDataFrame(rows + [rows[4]], f"{SCHEMA}, {CLASHING}").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark, corpus):
    rows = [(i, int("$$$" not in (t or "")), int("idiot" in (t or ""))) for i, t in corpus if i % 4]
    return spark.createDataFrame(rows + [(None, 1, 1), (3, None, None), (10**9, 0, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def rows_with(corpus):
    """What an operator should return for ``docs``: a row per document, the fourth one twice."""

    def make(expected):
        return sorted([*expected, expected[4]], key=repr)

    return make
