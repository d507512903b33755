"""Toxicity scores of texts whose disguised words are restored first.

A disguised word is taken as a clean one sent through a noisy channel that swaps letters
for signs that look alike, repeats letters, and puts gaps between them. The signs a reader
sees make a lattice of the letters that may be meant, and the Viterbi algorithm finds the
path through it that a character language model and the channel together make likeliest.
The language model counts the letter triples of all documents. Single letters in a row are
one lattice, in which each blank may be a gap or the edge of a word. Words that show no
sign of disguise have one path only and stay as they are.

The score is learned from labels: restored words and the beginnings of words are features,
each with the odds at which texts that have it are toxic.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rollbook.llm.words import NOWHERE, Memo, parts, split_white

# The channel: what a sign may stand for, besides itself if it is a letter.
LOOK_ALIKES: dict[str, str] = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "#": "h", "*": "aeiou",
}
# Logarithms of the channel's odds.
_SWAPPED, _REPEATED, _DROPPED = math.log(0.05), math.log(0.1), math.log(0.02)

_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_EDGE = 26  # the letter code of a word's edge
_SIGNS = re.escape("".join(LOOK_ALIKES))
# A word with a look-alike, a letter twice in a row, or a mark between letters.
_DISGUISED = re.compile(rf"[{_SIGNS}]|([a-z])\1|[a-z][^\w\s]+[a-z]|[a-z]_+[a-z]")
_MARK = re.compile(r"[" + re.escape("".join(c for c in LOOK_ALIKES if not c.isalnum())) + "]")
# No word of single letters has this. Of those in a row so many must have a sign of a letter.
_NOT_SINGLE = re.compile(r"[^\W_]{2}")
_LETTER = re.compile(rf"[a-z{_SIGNS}]")
_LEAST_SINGLE = 3
# The same sign more often than twice says no more than twice.
_LONG = re.compile(r"(.)\1{2,}", re.DOTALL)
_ENDS = ".,;:!?\"'()[]{}«»“”…"

# Features: words, and beginnings of these lengths.
_BEGINNINGS = (4, 5, 6)
# The labelled documents that are used at most, about, and the features that are kept.
MOST_LABELLED = 50_000
MOST_FEATURES = 50_000
# A feature is used if so many labelled texts have it, and its odds differ by so many
# standard errors.
_LEAST_TEXTS, _LEAST_ERRORS = 5, 3.0
# So many texts at the base rate are added to those of each feature.
_BASE_TEXTS = 4
PREDICT_FROM = 0.7


class CharacterModel:
    """Log-probabilities of a letter after two others, smoothed by one count."""

    def __init__(self, counts: np.ndarray):
        counts = counts.reshape(27, 27, 27) + 1.0
        self.logs = np.log(counts / counts.sum(axis=2, keepdims=True)).tolist()


def letter_triples(docs: DataFrame) -> np.ndarray:
    """How often each triple of letters and word edges occurs in all texts: 27 ** 3 counts."""
    code = np.full(256, _EDGE, dtype=np.int64)
    for i, letter in enumerate(_LETTERS):
        code[ord(letter)] = code[ord(letter.upper())] = i

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(27**3, dtype=np.int64)
        for batch in batches:
            for _, part in parts(batch.column("text"), NOWHERE):
                # every text starts and ends with an edge; edges in a row make none but themselves
                letters = code[np.frombuffer(" ".join(part.to_pylist()).encode() + b"  ", dtype=np.uint8)]
                letters = np.concatenate(([_EDGE, _EDGE], letters))
                total += np.bincount(letters[:-2] * 729 + letters[1:-1] * 27 + letters[2:], minlength=27**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["triple", "n"])

    found = docs.select("text").mapInArrow(counted, "triple long, n long")
    out = np.zeros(27**3)
    for row in found.groupBy("triple").agg(F.sum("n").alias("n")).collect():
        out[row["triple"]] = row["n"]
    return out


def restore(word: str, model: CharacterModel, marks: bool = True) -> str:
    """The likeliest clean word behind a disguised one (lower case), or the words behind
    single letters with blanks between them.

    Each sign may be read as itself, if it is a letter, as a letter it looks like, as a
    repetition of the letter before it, or, if it is neither letter nor digit, as a gap; a
    digit that is like no letter is one, too. A blank is a gap or the edge of a word.
    Without ``marks``, signs that look like a letter are no gaps.
    """
    logs = model.logs
    # state: the two letters before; value: its best log-probability and the path so far
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(_EDGE, _EDGE): (0.0, None)}
    for sign in _LONG.sub(r"\1\1", word):
        readings: list[tuple[int, float]] = []
        if "a" <= sign <= "z":
            readings.append((ord(sign) - 97, 0.0))
        readings += [(ord(c) - 97, _SWAPPED) for c in LOOK_ALIKES.get(sign, "")]
        blank = sign == " "
        gap = 0.0 if blank else _DROPPED
        after: dict[tuple[int, int], tuple[float, tuple | None]] = {}

        def reach(state: tuple[int, int], value: float, path: tuple | None) -> None:
            if state not in after or after[state][0] < value:
                after[state] = (value, path)

        for (first, second), (value, path) in states.items():
            for letter, odds in readings:
                reach((second, letter), value + odds + logs[first][second][letter], (path, _LETTERS[letter]))
                if letter == second:
                    reach((first, second), value + odds + _REPEATED, path)
            if not readings or (marks and not sign.isalnum()):
                reach((first, second), value + gap, path)
            if blank and second != _EDGE:
                reach((second, _EDGE), value + logs[first][second][_EDGE], (path, " "))
        states = after
    path = max(((v + (logs[a][b][_EDGE] if b != _EDGE else 0.0), p) for (a, b), (v, p) in states.items()), key=lambda x: x[0])[1]
    out = []
    while path is not None:
        path, letter = path
        out.append(letter)
    return "".join(reversed(out))


def readings(word: str, model: CharacterModel) -> list[str]:
    """What a word of a text may say: itself without marks at its ends, and restored. Single
    letters with blanks between them say the words that are restored from them."""
    plain = word.lower()
    if " " in plain:
        return restore(plain, model).split()
    bare = plain.strip(_ENDS + "#*$%&|<>")
    out = [bare] if bare else []
    core = plain.strip(".,;:?\"'")
    if len(core) >= 3 and _DISGUISED.search(core):
        out.append(restore(core, model))
        # a mark may be a letter where a gap is likelier, as in "a$$"
        if _MARK.search(core):
            out.append(restore(core, model, marks=False))
    return out


def word_features(word: str, model: CharacterModel) -> tuple[str, ...]:
    """The features of a word: what it may say, and the beginnings of that."""
    out: dict[str, None] = {}
    for text in readings(word, model):
        if len(text) >= 3:
            out[text] = None
            for n in _BEGINNINGS:
                if len(text) > n:
                    out[text[:n] + "-"] = None
    return tuple(out)


def text_words(texts: pa.Array) -> tuple[list[str], list[list[int]]]:
    """The different words of texts, and the numbers of each text's words; single letters in
    a row, with one blank between them, count besides as one word."""
    words = split_white(texts)
    unique = words.unique.to_pylist()
    numbers = {word: i for i, word in enumerate(unique)}
    bounds = words.bounds
    lists = [np.unique(words.codes[a:b]).tolist() for a, b in zip(bounds[:-1], bounds[1:])]
    lower = [word.lower() for word in unique]
    single = np.array([not _NOT_SINGLE.search(word) for word in lower], dtype=bool)
    letter = np.array([bool(_LETTER.search(word)) for word in lower], dtype=bool)
    for row, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        codes = np.asarray(words.codes[a:b])
        inside = np.concatenate(([0], single[codes].astype(np.int8), [0]))
        turns = np.flatnonzero(np.diff(inside))
        for start, end in zip(turns[::2].tolist(), turns[1::2].tolist()):
            if end - start < _LEAST_SINGLE or letter[codes[start:end]].sum() < _LEAST_SINGLE:
                continue
            joined = " ".join(lower[i] for i in codes[start:end].tolist())
            if joined not in numbers:
                numbers[joined] = len(unique)
                unique.append(joined)
            lists[row].append(numbers[joined])
    return unique, lists


@dataclass
class Model:
    """The letter triples, the log-odds of features, and those of a text without any."""

    triples: np.ndarray
    odds: dict[str, float]
    base: float


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, most_labelled: int = MOST_LABELLED) -> Model:
    """Learns from the labelled documents that are not held out, a sample of about
    ``most_labelled`` of them if there are more, drawn by a hash of the id. The letters of
    all documents are counted. Labels other than 0 and 1 count as none."""
    triples = letter_triples(docs)
    known = labels.filter("toxic IN (0, 1)").filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    size = known.count()
    parts_in = 1_000_000
    wanted = min(parts_in, int(most_labelled * parts_in / max(1, size)))
    drawn = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(parts_in)) < wanted)
    # the draw bounds the ids, so they go to the documents, not the documents to them
    sample = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = CharacterModel(triples)
        known_words = Memo(lambda words: [word_features(w, model) for w in words], 200_000)
        for batch in batches:
            toxic = batch.column("toxic").to_pylist()
            for rows, part in parts(batch.column("text"), NOWHERE, 1_000_000):
                unique, lists = text_words(part)
                features = known_words(unique)
                names, flags = [], []
                for row, numbers in zip(rows.tolist(), lists):
                    own = {f for n in numbers for f in features[n]}
                    names += own
                    flags += [toxic[row]] * len(own)
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(flags, pa.int32())], ["feature", "toxic"])

    total = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("t")).first()
    n, t = total["n"], total["t"]
    rate = (t + 1) / (n + 2)
    counted = (
        sample.select("text", F.col("toxic").cast("int").alias("toxic"))
        .mapInArrow(listed, "feature string, toxic int")
        .groupBy("feature")
        .agg(F.count("*").alias("n"), F.sum("toxic").alias("t"))
        .filter(f"n >= {_LEAST_TEXTS}")
    )
    # the difference from the base rate, in standard errors
    strength = (F.col("t") - F.col("n") * rate) / F.sqrt(F.col("n") * rate * (1 - rate))
    kept = counted.withColumn("strength", strength).filter(f"strength >= {_LEAST_ERRORS} AND t >= {_LEAST_TEXTS}")
    base = math.log(rate / (1 - rate))
    odds = {}
    for r in kept.orderBy(F.desc("strength"), "feature").limit(MOST_FEATURES).collect():
        toxic, clean = r["t"] + _BASE_TEXTS * rate, r["n"] - r["t"] + _BASE_TEXTS * (1 - rate)
        odds[r["feature"]] = math.log(toxic / clean) - base
    return Model(triples, odds, base)


def score_texts(docs: DataFrame, model: Model, predict_from: float = PREDICT_FROM) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    The score is the probability of toxicity by the text's strongest feature: features of
    one text tell of the same words, so their odds are not multiplied. Without any feature,
    as for a null or empty text, it is the rate at which such labelled texts may be toxic
    at most, the base rate. Repeated rows are scored each; a null id is not held out. Other
    columns are not read.
    """
    triples, odds, base = model.triples, model.odds, model.base

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        characters = CharacterModel(triples)

        def strongest(words: list[str]) -> list[float]:
            return [max((odds.get(f, 0.0) for f in word_features(w, characters)), default=0.0) for w in words]

        known_words = Memo(strongest, 400_000)
        for batch in batches:
            for rows, part in parts(batch.column("text"), NOWHERE):
                unique, lists = text_words(part)
                weights = np.array([*known_words(unique), 0.0])
                best = np.array([weights[[*numbers, -1]].max() for numbers in lists])
                score = 1 / (1 + np.exp(-(base + best)))
                ids = batch.column("doc_id").take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([ids, pa.array(score)], ["doc_id", "score"])

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInArrow(scored, f"doc_id {doc_id}, score double")
    return found.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= predict_from).cast("int").alias("predicted"),
    )


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``score_texts`` with a model learned from ``labels``."""
    return score_texts(docs, train(docs, labels))
