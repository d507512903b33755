import hashlib
import itertools
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from rollbook.llm.packing import _best_fit, _Sums, pack, plan
from rollbook.llm.sentence_pieces import MODEL, encode_and_decode, load_model
from rollbook.llm.token_counts import TOKENIZER, UnitEncoder, _unit_encoder, token_counts, unit_encoder
from rollbook.llm.words import parts, split_white

os.environ["TOKENIZERS_PARALLELISM"] = "false"


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def encode():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(MODEL))


ODD = [
    "it's 'sue #'s <|endoftext|>x <|ENDOFTEXT|> a<|startoftext|>b", "Σας ΟΔΟΣ İx", "caf\u0065\u0301. …. é!e", "a\u00a0b\x1cc\x85d",
    "don't-stop 12ab3 ***", "\u0301 lone", "ﬁ ½²", "𝔘 👍🏽", "'s", "x'S'll",
]


def test_token_counts(spark, docs, corpus, rows_with, encode):
    expected = [(i, len((t or "").encode()), len(encode(t))) for i, t in corpus]
    assert found(token_counts(docs)) == rows_with(expected)


def test_token_counts_of_odd_texts(spark, no_docs, encode):
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    assert [r[2] for r in sorted(found(token_counts(docs)))] == [len(encode(t)) for t in ODD]
    assert found(token_counts(no_docs)) == []


def test_parts_cut_long_texts():
    texts = pa.array(["ab", "a b c d e f g h i j", None, "", "unbroken-text-without-space"])
    again = {}
    for rows, part in parts(texts, part_bytes=6):
        for row, text in zip(rows.tolist(), part.to_pylist()):
            again[row] = again.get(row, "") + text
    assert [again[i] for i in range(5)] == [t or "" for t in texts.to_pylist()]


def test_split_white_is_ascii_white_space():
    words = split_white(pa.array(["a\x0bb\x0cc \x1cd\u00a0e  ", "", " x"], pa.large_string()))
    assert words.unique.to_pylist() == ["a", "b", "c", "\x1cd\u00a0e", "x"]
    assert words.bounds.tolist() == [0, 4, 4, 5]


def test_plan_uses_every_length_and_fills():
    rng = np.random.default_rng(3)
    for n in (1, 10, 500, 20_000):
        lengths = np.minimum(2048, rng.lognormal(6, 1.2, n).astype(int) + 1)
        counts = {int(a): int(b) for a, b in zip(*np.unique(lengths, return_counts=True))}
        used = Counter()
        for pattern in (patterns := plan(counts)):
            assert sum(pattern.lengths) <= 2048
            for length in pattern.lengths:
                used[length] += pattern.times
        assert used == Counter(counts)
        least = -(-int(lengths.sum()) // 2048)
        big = int((lengths > 1024).sum())
        assert sum(p.times for p in patterns) <= max(least, big) * 1.05 + 1
    assert plan({}) == []
    assert [(len(p.lengths), p.times) for p in plan({2048: 3, 1024: 4, 700: 2, 648: 1})] == [(1, 3), (2, 2), (3, 1)]


def sequences(patterns):
    return sum(p.times for p in patterns)


def test_plan_is_never_worse_than_best_fit():
    rng = np.random.default_rng(8)
    uniform = {i: int(n) for i, n in zip(range(1, 2049), rng.integers(1, 10**6, 2048))}
    lengths = np.minimum(2048, rng.lognormal(6, 1.2, 10**5).astype(int) + 1)
    lognormal = {int(a): int(b) for a, b in zip(*np.unique(lengths, return_counts=True))}
    for counts in (uniform, lognormal, {700: 5, 648: 9, 1024: 3, 100: 50}, {1: 10**9}):
        patterns = plan(dict(counts))
        used = Counter()
        for pattern in patterns:
            for length in pattern.lengths:
                used[length] += pattern.times
        assert used == Counter(counts)
        assert sequences(patterns) <= sequences(_best_fit(dict(counts), 2048))


def test_sums_of_one_two_and_three_lengths():
    left = {5: 1, 4: 1, 3: 1, 2: 1, 1: 1}
    index = _Sums(left, 20)
    assert list(index.singles(4, 5)) == [(4,)] and list(index.singles(4, 3)) == [] == list(index.singles(6, 9))
    assert sorted(index.pairs(6, 4)) == [(3, 3), (4, 2)] and sorted(index.pairs(6, 9)) == [(3, 3), (4, 2), (5, 1)]
    triples = {tuple(sorted(t)) for t in index.triples(7, 5)}
    assert triples == {t for t in itertools.combinations_with_replacement(range(1, 6), 3) if sum(t) == 7}
    del left[3]
    assert (3, 3) not in list(index.pairs(6, 9)) and (4, 2) in list(index.pairs(6, 9))


def test_units_joined_or_one_by_one():
    encode = unit_encoder()
    words = [*ODD[0].split(), "it's", "<|endoftext|>", "naïve,café", "日本", "'s", "x" * 50]
    together = encode(words)
    assert together == [b"".join(_unit_encoder(TOKENIZER, 100)([w])) for w in words]


def test_words_are_cut_once_a_part():
    """Different words of the same units cost no call of the tokenizer and no Python step each."""
    pattern = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+(?=[!-@\[-`{-~])|[^\t-\r ]+")
    rng = random.Random(6)
    words = ["".join(rng.choices("abcZéß,.'3中\u0301-_", k=rng.randint(1, 6))) for _ in range(2000)]
    met = []
    encoder = UnitEncoder(lambda units: [met.append(u) or np.array([len(u)], "<u4").tobytes() for u in units], 10_000)
    ids, lengths = encoder.ids(pa.array(words, pa.large_string()))
    cut = [pattern.findall(w) for w in words]
    assert ids.tolist() == [len(u) for units in cut for u in units] and lengths.tolist() == [len(u) for u in cut]
    assert sorted(met) == sorted({u for units in cut for u in units})
    ids, lengths = encoder.ids(pa.array([], pa.large_string()))
    assert len(ids) == len(lengths) == 0 and encoder([]) == []


def test_pack(spark, docs, corpus, encode):
    got = pack(spark, docs, ranked_rows=10).collect()
    expected = []
    for i, t in [*corpus, corpus[4]]:
        ids = [*encode(t), 0]
        for n, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            expected.append((i, n, start, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())))
    assert sorted(tuple(r)[:5] for r in got) == sorted(expected)
    ends = Counter()
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 2048


def test_pack_nothing(spark, no_docs):
    assert pack(spark, no_docs).count() == 0


def test_sentence_pieces(spark, docs, corpus, rows_with, pieces):
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    expected = []
    for i, t in corpus:
        ids = pieces.encode(t or "")
        expected.append((i, len(ids), digest(",".join(map(str, ids))), digest(pieces.decode(ids))))
    assert found(encode_and_decode(docs)) == rows_with(expected)


def test_sentence_pieces_match_the_library(pieces):
    model, rng = load_model(), random.Random(5)
    signs = "abcdest nr  \n.,'-_▁éüñ日0123<>🎉ing\tthe\u0301"
    texts = [*ODD, "", " ", "  ", "a  b", " a", "a ", "\n", "▁a▁▁b", "<s> <0x0A>", "\x00", "ab" * 300]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randint(1, 60))) for _ in range(400)]
    known = list(model.ids)
    texts += ["".join(rng.choices(known, k=rng.randint(1, 9))).replace("▁", " ") for _ in range(600)]
    for text in texts:
        assert model.encode(text) == pieces.encode(text)
    for _ in range(3000):
        ids = [rng.randrange(32000) if rng.random() < 0.6 else rng.randrange(262) for _ in range(rng.randint(0, 9))]
        assert model.decode(ids) == pieces.decode(ids)


def test_sentence_pieces_of_nothing(spark, no_docs):
    assert found(encode_and_decode(no_docs)) == []
