import math
import mmap
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from samples import prose, words_of

from rollbook.llm.elias_fano import EliasFano, Trie
from rollbook.llm.language_model import DISCOUNT, SLOTS, STEPS, Counts, _pack, _unpack, score

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
END = " "


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def tokens_of(text):
    return [*words_of((text or "").translate(UPPER)), END]


@pytest.mark.parametrize("n, top", [(0, 1), (1, 1), (1, 10**12), (7, 3), (900, 10**9), (900, 400), (30_000, 2**45)])
def test_elias_fano(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n))
    found = EliasFano.of(values)
    assert (found.access(np.arange(n)) == values).all()
    values = np.unique(values)
    found = EliasFano.of(values)
    asked = np.concatenate([values, values + 1, rng.integers(0, 3 * top + 5, 50)])
    places = {v: i for i, v in enumerate(values.tolist())}
    low, high = rng.integers(0, len(values) + 1, (2, len(asked)))
    got = found.find(asked, low, high)
    assert got.tolist() == [
        i if a <= (i := places.get(v, -1)) < b else -1 for v, a, b in zip(asked.tolist(), low.tolist(), high.tolist())
    ]


def test_trie_in_a_mapped_file(tmp_path):
    rng = np.random.default_rng(2)
    contexts = np.unique(rng.integers(0, 10**9, 500))
    lists = [np.unique(rng.integers(0, 10**6, k)) for k in rng.integers(1, 40, len(contexts))]
    lists[3] = np.array([0])
    sizes = np.array([len(x) for x in lists])
    starts, successors = np.cumsum(sizes) - sizes, np.concatenate(lists)
    built = Trie.of(contexts, starts, successors, np.arange(len(successors)) % 65536, -np.arange(len(contexts)))
    path = tmp_path / "trie"
    path.write_bytes(built.to_bytes())
    with path.open("rb") as file, mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ) as mapped:
        trie = Trie.read(mapped)
        number = trie.find_contexts(np.repeat(contexts, sizes))
        assert (number == np.repeat(np.arange(len(contexts)), sizes)).all()
        assert (trie.find(number, successors) == np.arange(len(successors))).all()
        assert (trie.find_contexts(contexts + 1) == [dict(zip(contexts.tolist(), range(500))).get(c + 1, -1) for c in contexts.tolist()]).all()
        known = [set(x.tolist()) for x in lists]
        missing = trie.find(number, successors + 1)
        assert [m >= 0 for m in missing.tolist()] == [s + 1 in known[c] for c, s in zip(number.tolist(), successors.tolist())]
        assert (trie.find(np.array([-1, 0]), np.array([5, 10**7])) == -1).all()
        assert trie.penalties[4] == -4
        del trie
    assert len(built.to_bytes()) < 8 * len(successors)


def test_packing_of_numbers():
    arrays = [np.array(x, dtype=np.int64) for x in ([], [0, 255], [256], [2**32 + 1, 7], range(1000))]
    again = _unpack(_pack(*arrays))
    assert [a.tolist() for a in again] == [a.tolist() for a in arrays]


def brute(rows, part_of=None, splits=None):
    """(id, held out, tokens, known, training tokens, base score, score), a text at a time.

    ``part_of(word, splits)`` and ``splits(count)`` say how contexts are split, if they are.
    """
    train = [tokens_of(t) for i, t in rows if not held_out(i)]
    c = Counter(w for t in train for w in t)
    pairs = Counter(p for t in train for p in zip([END, *t], t))
    n, v = sum(c.values()), len(c)
    own = lambda w: (c[w] + 1) / (n + v + 1)
    words = [*c, None]
    by_part = defaultdict(Counter)  # (context, part): successors
    mass = defaultdict(float)
    for k in {splits(c[w]) if splits else 1 for w in c}:
        for w in words:
            mass[k, part_of(w, k) if splits else 0] += own(w)
    for (a, b), times in pairs.items():
        k = splits(c[a]) if splits else 1
        by_part[a, part_of(b, k) if splits else 0][b] += times

    def p(a, b):
        if not c[a]:
            return own(b)
        k = splits(c[a]) if splits else 1
        part = part_of(b, k) if splits else 0
        seen = by_part.get((a, part), Counter())
        total = sum(seen.values())
        of_part = (total + 1) / (c[a] + k)
        low = own(b) / mass[k, part]
        if not total:
            return of_part * low
        return of_part * (max(seen[b] - DISCOUNT, 0) / total + DISCOUNT * len(seen) / total * low)

    for a in [END, *list(c)[:5], "never seen"]:
        assert math.isclose(sum(p(a, w) for w in words), 1, rel_tol=1e-9)
    out = []
    for i, t in rows:
        t = tokens_of(t)
        out.append(
            (i, held_out(i), len(t), sum(c[w] > 0 for w in t), n, sum(math.log10(own(w)) for w in t),
             sum(math.log10(p(a, b)) for a, b in zip([END, *t], t)))
        )
    return out


def close(got, expected):
    got, expected = (sorted(map(tuple, x), key=lambda r: (repr(r[0]), r[2], r[5])) for x in (got, expected))
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    for g, e in zip(got, expected):
        assert math.isclose(g[5], e[5], rel_tol=1e-9)
        # each code is rounded by less than a step, and some are the sum of two
        assert e[6] - 2 * e[2] / STEPS <= g[6] <= e[6] + 1e-6


@pytest.fixture(scope="module")
def rows(corpus):
    return [*[(i, t) for i, t in corpus], corpus[4], (None, "the river and THE river"), (None, "of"), (17, "a stone"), (17, "a stone")]


def frame(spark, rows, parts=3):
    return spark.createDataFrame(
        [(i, t, 1, "x", 2, "y") for i, t in rows], "doc_id long, text string, block int, words string, n int, part string"
    ).repartition(parts)


def test_scores_equal_brute_force(spark, rows):
    close(score(spark, frame(spark, rows)).collect(), brute(rows))


def test_parts_of_texts_and_many_shards(spark, rows):
    got = score(spark, frame(spark, rows), block_bytes=2000, shard_tokens=50).collect()
    close(got, brute(rows))
    whole = score(spark, frame(spark, rows, 1)).collect()
    key = lambda r: (repr(r[0]), r[2], r[6])
    # sums of whole steps do not depend on blocks, shards or order
    assert [(r[0], r[6]) for r in sorted(got, key=key)] == [(r[0], r[6]) for r in sorted(whole, key=key)]


def test_frequent_contexts_are_split(spark):
    """One pair and one word hold much of the corpus; their contexts lie in several parts."""
    import random

    rng = random.Random(3)
    rows = [(i, " ".join(["very common"] * 5 + [prose(rng, 30)] + ["common " + w for w in prose(rng, 20).split()])) for i in range(40)]
    got = score(spark, frame(spark, rows), part_tokens=40).collect()
    # plain scores differ only in how the mass of rare successors is spread
    plain = {r[0]: r[6] for r in brute(rows)}
    for r in got:
        assert abs(r["score"] - plain[r["doc_id"]]) < 0.15 * abs(plain[r["doc_id"]])
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_probabilities_of_split_contexts_sum_to_one():
    """By the formulas of the shards, for a context with words of its own in some parts only."""
    from rollbook.llm.language_model import _scored, _slot

    n_words = 400
    rng = np.random.default_rng(5)
    c = rng.integers(1, 50, n_words)
    c[0] = 3000
    total = int(c.sum())
    mass = np.zeros(SLOTS)
    np.add.at(mass, _slot(np.arange(n_words)), c + 1)
    mass[_slot(np.array([n_words]))] += 1
    counts = Counts(total, n_words, {0: 0}, np.concatenate(([0], np.cumsum(mass))) / (total + n_words + 1), 1, 500)
    n = np.zeros(n_words + 1, dtype=np.int64)
    chosen = rng.choice(n_words, 60, replace=False)
    np.add.at(n, rng.choice(chosen, 3000), 1)
    assert counts.splits(np.array([3000]))[0] == 6
    every = np.arange(n_words + 1)
    packed = _pack(
        np.array([0]), np.array([n_words + 1]), np.array([3000]), np.diff(every, prepend=0), n, np.append(c, 0)
    )
    codes = _scored([packed], counts)[0]
    assert 0.998 < (10.0 ** (-codes / STEPS)).sum() <= 1


def test_nothing_to_score_or_learn(spark, no_docs):
    assert score(spark, no_docs).collect() == []
    only = [(i, "some words here") for i in range(40) if held_out(i)]
    got = score(spark, frame(spark, only)).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got} == {(0, 0, 0.0, 0.0)}
