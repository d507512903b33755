import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rollbook.llm.quality_classifier import JUNK, NONE, classify, fit_votes, keep_good, measure, train, votes
from rollbook.llm.quality_rules import RULES, Risk, Rule, apply_rules, features, levels, select_cutoffs
from rollbook.llm.toxicity import CharacterModel, letter_triples, restore, score_texts, text_words, toxicity, train as train_toxicity, word_features
from rollbook.llm.url_filters import PATTERN_RULES, SITE_RULES, Rule as UrlRule, file_rules, judge, parse


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def counts(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    repeated = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    symbols = len(re.findall("[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines), len(lines) - len(set(lines)), len(repeated)


def test_features(docs, corpus, rows_with):
    assert found(features(docs).drop("stratum")) == rows_with([(i, *counts(t)) for i, t in corpus])


def test_rules_without_enough_labels_reject_only_the_base(spark, docs, labels):
    for row in apply_rules(spark, docs, labels).collect():
        base = row["n_words"] < 50 or 2 * row["n_repeat_words"] > row["n_words"]
        assert (row["base_failed"], row["kept"]) == (base, not base)


def tail(n, x, p):
    from math import comb

    return sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(x + 1))


def test_cutoffs_keep_the_bound(spark):
    """Cutoffs against the exact tail, worked out term by term."""
    rng = np.random.default_rng(2)
    rows, tags = [], []
    for i in range(3000):
        good, lang = i % 5 != 0, ["en", "de", "xx"][0 if i < 2000 else 1 if i < 2950 else 2]
        share = rng.beta(1, 60) if good else rng.beta(4, 4)
        rows.append((i, lang, 200, 1000, int(400 * share), 10, 0, 0))
        tags.append((i, int(good)))
    found_ = spark.createDataFrame(
        rows, "doc_id long, stratum string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"
    )
    labels = spark.createDataFrame(tags, "doc_id long, quality int")
    rule = Rule("symbols", "n_symbols / n_words", (0.8, 0.6, 0.4, 0.3, 0.2, 0.1, 0.05))
    risk = Risk(rate=0.05, error=0.05, worth=1)
    got = {r["stratum"]: r["cutoff_symbols"] for r in select_cutoffs(found_, labels, (rule,), risk).collect()}
    for lang in ("en", "de", "xx"):
        shares = [(r[4] / 200, t[1]) for r, t in zip(rows, tags) if r[1] == lang]
        good = [s for s, q in shares if q]
        allowed = []
        for cutoff in rule.cutoffs:
            lost = sum(s > cutoff for s in good)
            if lost < len(good) * 0.05 and tail(len(good), lost, 0.05) <= 0.05 / 3:
                allowed.append((sum(s > cutoff for s, q in shares if not q) - lost, cutoff))
        assert got[lang] == (max(allowed)[1] if allowed else None)
    assert got["en"] is not None and got["xx"] is None


def test_rules_of_nothing(spark, no_docs, labels):
    assert found(apply_rules(spark, no_docs, labels)) == []
    assert len({r.name for r in RULES}) == len(RULES)


def test_votes_find_junk():
    texts = ["The rain fell on the river and the stones. It was late, and we went home.\n" * 1] * 4
    texts += ["Rain*** fell$$$ on### the&&& river%%% now***", "RAIN!! FELL!! ON!! THE!! RIVER!!", "rain fell on " * 40]
    values, features_ = measure(pa.array(texts, pa.large_string()))
    assert features_.shape[0] == len(texts)
    cast = votes(values)
    share, accuracy = fit_votes(cast, np.ones(len(texts)))
    assert 0.2 < share < 0.7 and (accuracy > 0.5).all()


def test_classifier(spark, docs, corpus, no_docs):
    rows = {r["doc_id"]: r for r in classify(docs).collect()}
    assert len(rows) == len(corpus)
    junk = [i for i, t in corpus if t and "$$$" in t]
    prose = [i for i, _ in corpus[:40]]
    assert max(rows[i]["score"] for i in junk) < min(rows[i]["score"] for i in prose)
    assert all(rows[i]["kept"] for i in prose) and not any(rows[i]["kept"] for i in junk)
    kept = keep_good(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in rows.items() if r["kept"]}
    assert found(classify(no_docs)) == [] and keep_good(no_docs).count() == 0
    assert train(no_docs).bias == 0.0


@pytest.fixture(scope="module")
def characters(spark):
    texts = ["the idiot is a moron and a stupid loser", "what trash, the clown said to the disgusting idiot"] * 30
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return CharacterModel(letter_triples(docs))


def test_letter_triples_count_all_texts(spark):
    docs = spark.createDataFrame([(1, "Abc"), (2, None), (3, "abc")], "doc_id long, text string")
    assert letter_triples(docs).reshape(27, 27, 27)[0, 1, 2] == 2


@pytest.mark.parametrize(
    "word, clean",
    [("1d1ot", "idiot"), ("idiooot", "idiot"), ("m0r0n", "moron"), ("$tup1d", "stupid"), ("i.d.i.o.t", "idiot"), ("idiot", "idiot")],
)
def test_restore(characters, word, clean):
    assert restore(word, characters) == clean


def test_toxicity(spark, no_docs):
    rows, tags = [], []
    for i in range(400):
        toxic = i % 4 == 0
        word = ["idiot", "1d1ot", "i d i o t", "IDIOOOT."][i // 4 % 4] if toxic else f"friend{i}"
        rows.append((i, f"you are a {word} and the rain falls, number {i}", "en"))
        tags.append((i, int(toxic)))
    docs = spark.createDataFrame([*rows, (1000, None, None), (1001, "", None), (None, "idiot", None)], "doc_id long, text string, score string")
    labels = spark.createDataFrame([*tags, (7, None)], "doc_id long, toxic int")
    got = toxicity(docs, labels).collect()
    assert len(got) == len(rows) + 3
    by_id = {r["doc_id"]: r for r in got}
    assert all(by_id[i]["predicted"] == t for i, t in tags)
    assert by_id[1000]["score"] == by_id[1001]["score"] < 0.5
    crc = {r[0]: r[1] for r in docs.selectExpr("doc_id", "crc32(cast(doc_id AS string)) % 3 = 1").collect()}
    assert all(r["held_out"] == bool(crc[r["doc_id"]]) for r in got)
    assert found(score_texts(no_docs, train_toxicity(no_docs, labels))) == []


URLS = [
    "https://a.example.org/es/1", "http://EXAMPLE.org/en/12?x=1", "http://x.com/fr/", "http://x.com/de/y", "https://b.org/",
    "http://www.spam-farm.example.net/en/1", "http://notexample.org.net/es/", "http://x.net/login", "http://x.net/q?sid=1",
    "no scheme", "", None, "://", "http://org/a", "http://org", "http://x.com/FR/", "a://b.com/fr/x://c.org/", "http://é.org/É",
]


def brute(url, rules):
    host, path, text = parse(url)
    fit = [(r.weight, -n, r) for n, r in enumerate(rules) if re.search(r.pattern, text)]
    best = max(fit, key=lambda x: x[:2])[2] if fit else None
    return host, path, best.name if best else None, best.verdict if best else "allow"


def test_judge(spark):
    rules = [*SITE_RULES, *PATTERN_RULES, UrlRule("block", "example"), UrlRule("allow", "(?i)/en/", ("en",), "english", 50)]
    pages = spark.createDataFrame([*enumerate(URLS), (0, URLS[0]), (None, URLS[3])], "page_id long, url string").selectExpr(
        "*", "'x' AS host", "1 AS rule", "'<p>' AS html"
    )
    for used in (rules, list(SITE_RULES + PATTERN_RULES), []):
        expected = [(i, *brute(u, used)) for i, u in [*enumerate(URLS), (0, URLS[0]), (None, URLS[3])]]
        assert found(judge(spark, pages, used)) == sorted(expected, key=repr)
    assert found(judge(spark, pages.limit(0))) == []


def test_rules_are_filed_under_their_rarest_token():
    index, always = file_rules(SITE_RULES, {"org": 9, "example": 20, "es": 2, "en": 3, "com": 5, "fr": 8})
    assert index == {"org": [0], "es": [1], "en": [2], "com": [3], "de": [4]} and always == []


def test_site_rules():
    got = [brute(u, SITE_RULES)[2:] for u in URLS[:5]]
    assert got == [("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"), ("org/", "allow")]


def test_held_out_rows_teach_nothing(spark):
    docs = spark.createDataFrame([(i, "badword here" if i % 2 else "good words") for i in range(90)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    changed = labels.withColumn("toxic", F.when(F.expr("crc32(cast(doc_id AS string)) % 3 = 1"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert train_toxicity(docs, labels).odds == train_toxicity(docs, changed).odds


def test_cutoffs_of_all_rules_are_tested_together(spark):
    """600 good documents of a language are enough for four rules, 300 are not."""
    rows = [(i, "en" if i < 900 else "fr", 100, 500, 60 if i % 3 == 0 else 1, 10, 0, 0) for i in range(1350)]
    found_ = spark.createDataFrame(
        rows, "doc_id long, stratum string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"
    )
    labels = spark.createDataFrame([(r[0], int(r[0] % 3 != 0)) for r in rows], "doc_id long, quality int")
    got = {r["stratum"]: r for r in select_cutoffs(found_, labels).collect()}
    assert got["en"]["cutoff_symbols"] == 0.5
    assert all(got["fr"][f"cutoff_{r.name}"] is None for r in RULES)
    assert sorted(levels(RULES)) == sorted((k, c) for k, r in enumerate(RULES) for c in r.cutoffs)


@pytest.mark.parametrize(
    "text, clean",
    [
        ("you are a s t u p i d man", "stupid"), ("you s t u p i d, man", "stupid"), ("s t u p i d!", "stupid"),
        ("(s c u m)", "scum"), ("s c u m.", "scum"), ("i d i o t i s", "idiot"), ("s  c  u  m", "scum"),
        ("s / c / u / m", "scum"), ("s * c * u * m", "scum"), ("s/c/u/m", "scum"), ("idi07", "idiot"), ("dum8", "dumb"),
        ("1d107", "idiot"), ("tra5#", "trash"), ("a$$", "ass"), ("idi" + "o" * 60 + "t", "idiot"),
    ],
)
def test_disguises_reach_the_lattice(spark, text, clean):
    texts = ["the idiot is a stupid man and you are dumb scum", "what trash, an ass, a stupid idiot is a dumb man, you scum"] * 60
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    characters = CharacterModel(letter_triples(docs))
    unique, lists = text_words(pa.array([text], pa.large_string()))
    assert clean in {f for n in lists[0] for f in word_features(unique[n], characters)}


def test_votes_are_fitted_as_in_plain_python():
    """Expectation-maximisation a document and a heuristic at a time."""
    import math

    rng = np.random.default_rng(6)
    patterns = rng.choice([0, 1, 2], size=(40, 11), p=[0.2, 0.6, 0.2])
    counts = rng.integers(1, 50, 40).astype(float)
    share, accuracy = fit_votes(patterns, counts, rounds=25)
    right = [0.8] * 11

    def junk_odds(row):
        logs = sum((1 if v == JUNK else -1) * math.log(right[k] / (1 - right[k])) for k, v in enumerate(row) if v != NONE)
        return 1 / (1 + math.exp(-logs))

    for _ in range(25):
        junk = [junk_odds(row) for row in patterns.tolist()]
        fresh = []
        for k in range(11):
            hits = sum(n * (j if row[k] == JUNK else 1 - j) for row, n, j in zip(patterns.tolist(), counts, junk) if row[k] != NONE)
            cast = sum(n for row, n in zip(patterns.tolist(), counts) if row[k] != NONE)
            fresh.append((hits + 4) / (cast + 5))
        right = fresh
    assert np.allclose(accuracy, right, rtol=1e-9)
    junk = [junk_odds(row) for row in patterns.tolist()]
    assert np.isclose(share, sum(n * j for n, j in zip(counts, junk)) / counts.sum())


def test_rows_without_ids_are_drawn_like_others(spark):
    """One id, or none, in most rows: the sample stays within its bound, and is not empty."""
    text = "the of and rain stone river light over under green house walk " * 6
    rows = [(None if k % 3 else 5, f"{text} {k}" if k % 2 else "$$$ ### " * 30 + str(k % 7)) for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    fitted = []
    model = train(docs, most_fitted=200, seen=fitted.append)
    assert 100 < fitted[0] < 320
    assert model.weights.any()
