import hashlib
import itertools
import re

import numpy as np
import pyarrow as pa
import pytest

from rollbook.llm.exact_dedup import Chunking, chunk_store, exact_duplicates, normalised
from rollbook.llm.line_dedup import Sharing, drop_shared_lines
from rollbook.llm.near_dedup import Likeness, estimate, near_duplicates, registers, shingle_sets

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("chunking", [Chunking(), Chunking(least=4, most=30, id_bits=2)])
def test_exact_duplicates(spark, docs, corpus, rows_with, chunking):
    plain = [re.sub("[\x20\x09-\x0d]+", " ", t or "") for _, t in corpus]
    all_rows = [*plain, plain[4]]
    expected = [
        (i, plain.index(t), all_rows.count(t), plain.index(t) == i, hashlib.sha256(t.encode()).hexdigest())
        for i, t in enumerate(plain)
    ]
    assert found(exact_duplicates(spark, docs, chunking)) == rows_with(expected)


def test_chunks_make_up_the_text(spark, docs):
    chunking = Chunking(least=8, most=40)
    text = normalised(docs["text"])
    joined = docs.select(text.alias("t"), chunking.chunks(text).alias("c")).selectExpr("t <=> array_join(c, '') AS same")
    assert joined.filter("NOT same").isEmpty()
    store = chunk_store(docs, chunking)
    assert store.count() == store.select("chunk").distinct().count()


def test_exact_duplicates_of_nothing(spark, no_docs):
    assert found(exact_duplicates(spark, no_docs)) == []


def test_exact_duplicates_without_ids(spark):
    docs = spark.createDataFrame([(None, "a b"), (3, "a  b"), (None, "c")], "doc_id long, text string")
    rows = [r[:4] for r in found(exact_duplicates(spark, docs))]
    assert sorted(rows, key=repr) == sorted([(None, 3, 2, False), (3, 3, 2, True), (None, None, 1, True)], key=repr)


def line_dedup(corpus, least, documents):
    keys, where = {}, {}
    for i, t in corpus:
        for line in (t or "").split("\n"):
            key = line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
            keys[line] = key
            if i is not None:
                where.setdefault(key, set()).add(i)
    out = []
    for i, t in corpus:
        lines = (t or "").split("\n")
        stay = []
        for line in lines:
            key = keys[line]
            shared = len(key) >= least and len(where.get(key, ())) >= documents
            if not shared or max(where[key]) == i:
                stay.append(line)
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


@pytest.mark.parametrize("sharing", [Sharing(), Sharing(least_length=1, documents=2)])
def test_line_dedup(spark, docs, corpus, sharing):
    rows = [*corpus, corpus[4]]
    expected = line_dedup(rows, sharing.least_length, sharing.documents)
    assert found(drop_shared_lines(spark, docs, sharing)) == sorted(expected, key=repr)


def test_line_dedup_counts_documents_not_rows(spark):
    """One line in three rows of one id, in rows without an id, and in three documents."""
    a, b, c = ("line %s, which is long enough to count" % x for x in "abc")
    rows = [(1, a)] * 3 + [(2, a), (None, b), (None, b), (5, b), (6, b)]
    rows += [(7, c + "\nown of seven"), (8, c), (9, c), (9, c), (None, c + "\nown of none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(drop_shared_lines(spark, docs)) == sorted(line_dedup(rows, 20, 3), key=repr)
    texts = [r[3] for r in line_dedup(rows, 20, 3)]
    assert texts.count(a) == 4 and texts.count(b) == 4 and texts.count(c) == 2


def test_line_dedup_of_nothing(spark, no_docs):
    assert found(drop_shared_lines(spark, no_docs)) == []


def shingles(text, size=5):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def near(corpus, percent=85):
    sets = {i: shingles(t) for i, t in corpus}
    component = {i: i for i in sets}
    for a, b in itertools.combinations(sets, 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * len(sets[a] | sets[b]) and component[a] != component[b]:
            low, high = sorted((component[a], component[b]))
            component = {i: low if c == high else c for i, c in component.items()}
    return [(i, len(s), component[i], component[i] == i) for i, s in sets.items()]


def test_near_duplicates(spark, docs, corpus, rows_with):
    assert found(near_duplicates(spark, docs)) == rows_with(near(corpus))


def test_near_duplicates_in_chains_and_crowds(spark):
    """A chain in which only neighbours are alike, and a crowd of unlinked variants."""
    base = [f"w{i}" for i in range(300)]
    chain = [" ".join(f"c{i}" for i in range(4 * k, 4 * k + 200)) for k in range(12)]
    crowd = [" ".join(w if (i * 7 + k) % 9 else f"v{k}x{i}" for i, w in enumerate(base)) for k in range(12)]
    crowd += [" ".join([*base[:k], "odd", *base[k + 1 :]]) for k in (20, 150, 280)]
    corpus = list(enumerate(chain + crowd))
    docs = spark.createDataFrame(corpus, "doc_id long, text string")
    assert found(near_duplicates(spark, docs)) == sorted(near(corpus), key=repr)


def test_near_duplicates_of_nothing(spark, no_docs):
    assert found(near_duplicates(spark, no_docs)) == []


def test_registers_estimate_similarity():
    rng = np.random.default_rng(1)
    likeness = Likeness()
    for size in (1, 3, 40, 500, 5000):
        times = likeness.levels(size)[0]
        for share in (0.0, 0.5, 1.0):
            common = int(size * 2 * share / (1 + share))
            pool = rng.integers(0, 2**63, 2 * size, dtype=np.int64).astype(np.uint64)
            a, b = pool[:size], np.concatenate([pool[:common], pool[size : 2 * size - common]])
            true = common / (2 * size - common)
            got = estimate(*(registers(x, times, likeness.registers) for x in (a, b)), size, size, times)
            assert abs(got - true) < 0.25
            assert size > 1 or share != 1.0 or got == 1.0


def test_shingle_sets_do_not_confuse_orders():
    texts = pa.array(["a b c d e", "e d c b a", "x y y y x", "y x y x y", "a b", "b a", "A B"], pa.large_string())
    sets = [tuple(s.tolist()) for s in shingle_sets(texts)]
    assert len(set(sets)) == 6 and sets[4] == sets[6]


def test_alike_sizes_share_a_level():
    likeness = Likeness()
    for small in range(1, 1200):
        for large in range(small, small * 100 // 85 + 1):
            assert set(likeness.levels(small)) & set(likeness.levels(large))


def test_near_duplicates_of_variants(spark):
    """Variants of one text with a few changed, dropped or added words each, and of another."""
    import random

    rng = random.Random(11)
    corpus = []
    for base, n in ((150, 160), (90, 60)):
        words = [f"b{base}w{i}" for i in range(base)]
        for _ in range(n):
            text = list(words)
            for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 4])):
                at = rng.randrange(len(text))
                kind = rng.random()
                if kind < 0.5:
                    text[at] = rng.choice([f"x{rng.randrange(10**6)}", "same"])
                elif kind < 0.75:
                    del text[at]
                else:
                    text.insert(at, f"y{rng.randrange(9)}")
            if rng.random() < 0.1:
                text = text[: -rng.randrange(1, 12)]
            corpus.append(" ".join(text))
    corpus = list(enumerate(corpus))
    docs = spark.createDataFrame(corpus, "doc_id long, text string").repartition(4)
    assert found(near_duplicates(spark, docs)) == sorted(near(corpus), key=repr)


def test_near_duplicates_with_many_repeated_rows(spark):
    """Each id stands for one document, however often its rows repeat, also with other texts."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text)] * 150 + [(2, text + " end")] * 150 + [(3, "another text of a few words only"), (None, text), (None, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [(r["doc_id"], r["component_id"], r["kept"]) for r in near_duplicates(spark, docs).collect()]
    assert sorted(got, key=repr) == sorted(
        [(1, 1, True)] * 150 + [(2, 1, False)] * 150 + [(3, 3, True)] + [(None, None, True)] * 2, key=repr
    )
    mixed = spark.createDataFrame([(1, text), (2, text), (2, "quite another text of the id two"), (2, "")], "doc_id long, text string")
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_duplicates(spark, mixed).collect()]
    assert {g[2] for g in got if g[0] == 2 and g[1]} in ({1}, {2}) and (2, 0, 2) in got and (1, 56, 1) in got
