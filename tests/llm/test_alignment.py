import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from rollbook.llm import alignment
from rollbook.llm.alignment import BYTE_TOKENIZER, PIECE_MODEL, Pair, align, aligned_documents, gallop, units

ODD = [
    "it's 'sue <|endoftext|>x </s><s> <unk> <0x41>", "a  b   c", " lead", "trail ", "trail  ", " ", "\n", "a\n\n b\n c \n", "a  b\x1c c",
    "▁", "a ▁b c", "日本語 の 漢字", "é ́ x", "\x00 \x85 \r\n y", "𝔘 👍🏽 ½²", "x　 y", "́ a", "-- ---  ----",
]


@pytest.fixture(scope="module")
def libraries():
    left = Tokenizer.from_file(public_tokenizers.path(BYTE_TOKENIZER))
    left.encode_special_tokens = True
    return left, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECE_MODEL))


@pytest.fixture(scope="module")
def brute(libraries):
    """Plain Python on whole texts: the rows of ``align`` for (id, text)."""
    left, right = libraries
    letters = {}
    for token, number in left.get_vocab().items():
        letters[number] = token
    plain = {c: b for c, b in alignment._byte_letters().items()}

    def document(text):
        a = left.encode(" " + text, add_special_tokens=False).ids if text else []
        b = right.encode(text) if text else []
        a_bytes = [bytes(plain[c] for c in letters[i]) for i in a]
        b_bytes = [
            bytes([int(right.id_to_piece(i)[3:-1], 16)]) if right.is_byte(i) else right.id_to_piece(i).replace("▁", " ").encode()
            for i in b
        ]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            return [], [], [], []
        spans = []
        for tokens in (a_bytes, b_bytes):
            at, mine = 0, []
            for t in tokens:
                mine.append((at, at + len(t)))
                at += len(t)
            spans.append(mine)
        both = {e for _, e in spans[0]} & {e for _, e in spans[1]}
        groups, start = [], 0
        for end in sorted(both):
            groups.append(tuple([i for i, (s, e) in zip(ids, mine) if start <= s and e <= end] for ids, mine in zip((a, b), spans)))
            start = end
        links = [(a[i], b[j]) for i, (s, e) in enumerate(spans[0]) for j, (u, v) in enumerate(spans[1]) if s < v and u < e]
        return a, b, groups, links

    def rows(corpus):
        found = [(i, *document(t)) for i, t in corpus]
        counts = Counter(link for *_, links in found for link in links)
        top = Counter()
        for (_, y), n in counts.items():
            top[y] = max(top[y], n)
        out = []
        for i, a, b, groups, links in found:
            text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
            best = sum(counts[link] == top[link[1]] for link in links)
            digest = hashlib.sha256(text.encode()).hexdigest() if a else ""
            out.append((i, len(a), len(b), len(groups), len(links), best, sum(counts[x] for x in links), digest))
        return out

    return rows


def small(corpus):
    return [(i, t[:3000] if t else t) for i, t in corpus]


@pytest.mark.parametrize("frequent", [1, 50, 200_000])
def test_alignment_equals_brute_force(spark, corpus, brute, frequent):
    rows = small(corpus) + [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "a null id"), (3, "a null id"), (3, "a null id")]
    docs = spark.createDataFrame(
        [(i, t, 1, "x", 2) for i, t in rows], "doc_id long, text string, n int, pairs string, _row int"
    ).repartition(3)
    got = sorted((tuple(r) for r in align(spark, docs, frequent=frequent).collect()), key=repr)
    assert got == sorted(brute(rows), key=repr)


def test_alignment_of_nothing(spark, no_docs):
    assert align(spark, no_docs).count() == 0


def test_long_texts_in_parts(spark, corpus):
    docs = spark.createDataFrame([(i, t) for i, t in corpus if t and "▁" not in t], "doc_id long, text string")
    whole, cut = aligned_documents(docs), aligned_documents(docs, part_bytes=40)
    key = lambda r: repr(r)
    assert sorted((tuple(r) for r in whole.collect()), key=key) == sorted((tuple(r) for r in cut.collect()), key=key)


def test_units_meet_token_for_token(libraries):
    left, right = libraries
    pair, rng = Pair(BYTE_TOKENIZER, PIECE_MODEL), random.Random(2)
    signs = "abc  \n\n\t.,'’-éü日0123<>🎉\x85\x1c\xa0　\r"
    texts = [t for t in ODD if "▁" not in t] + ["".join(rng.choice(signs) for _ in range(rng.randint(1, 60))) for _ in range(2000)]
    for text in texts:
        words = units(text)
        assert " " + " ".join(words) == " " + text
        a, b = pair.encode(pa.array(words, pa.large_string()))
        assert a.ids.tolist() == left.encode(" " + text, add_special_tokens=False).ids
        assert b.ids.tolist() == right.encode(text)
        assert len(a.counts) == len(b.counts) == len(words)


def test_gallop_finds_what_is_there():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 7, 300, 5000):
        values = np.unique(rng.integers(0, 3 * n + 1, n))
        wanted = np.arange(-2, 3 * n + 3)
        low = np.zeros(len(wanted), dtype=np.int64)
        found = gallop(wanted, values, low, np.full(len(wanted), len(values)))
        expected = [{v: i for i, v in enumerate(values.tolist())}.get(w, -1) for w in wanted.tolist()]
        assert found.tolist() == expected
