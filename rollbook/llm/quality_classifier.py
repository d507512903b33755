"""A quality classifier without labels: heuristics vote, and a hashed scorer learns from them.

Overlapping heuristics each vote junk or good, or not at all. Expectation-maximisation over
the votes of all documents estimates how common junk is and how often each heuristic is
right. It works on the counts of vote patterns, a table that the number of
heuristics bounds. The posterior of a document's pattern is its weak label. A linear model
over hashed features of the text is fitted to the weak labels of a bounded sample and
scores every document.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rollbook.llm.words import NOWHERE, parts, split_white

JUNK, NONE, GOOD = 0, 1, 2
# Value of a text: what is usual for prose, and what is junk.
MEASURES: dict[str, tuple[float, float]] = {
    "symbols": (0.02, 0.25),  # of #*$%&|<> per word
    "upper_case": (0.10, 0.35),  # of A-Z and a-z
    "marks": (0.20, 0.80),  # of !?=_~^+{}[]\ and quotes per word
    "repetition": (0.20, 0.50),  # of words in windows of three that occur again
    "duplicate_lines": (0.35, 0.60),  # of lines with a word
    "digits": (0.15, 0.40),  # of all characters
    "word_length": (7.5, 12.0),  # bytes per word
    "others": (0.25, 0.50),  # of characters neither letters nor white space
}
# In texts with fewer words, or lines, repetition means little and counts as none.
_REPETITION_WORDS, _REPETITION_LINES = 50, 5
# The heuristics. One for each measure votes junk beyond its second value. Three vote good:
# if all measures are usual; if letters, case and symbols are; if words and repetition are.
_USUAL = (
    tuple(MEASURES),
    ("symbols", "upper_case", "marks", "others", "repetition"),
    ("word_length", "repetition", "duplicate_lines", "symbols", "upper_case"),
)
N_HEURISTICS = len(MEASURES) + len(_USUAL)

# Documents on whose weak labels the scorer is fitted, at most about so many.
MOST_FITTED = 20_000
BUCKETS = 1024
KEEP_FROM = 0.3
_STEPS = 200
# Rows of the fitted sample that are in 32 bits at a time.
_BLOCK_ROWS = 2_000

# Kinds of bytes; features are the kinds of three bytes in a row, and how the heuristics'
# values lie. Both are hashed into the same buckets.
_LOWER, _UPPER, _DIGIT, _SPACE, _LINE, _STOP, _MARK, _SYMBOL, _PUNCTUATION, _WIDE, _CONTROL = range(11)


def _kinds() -> np.ndarray:
    kinds = np.full(256, _PUNCTUATION, dtype=np.int64)
    kinds[:32], kinds[127] = _CONTROL, _CONTROL
    kinds[128:] = _WIDE
    for kind, members in (
        (_LOWER, b"abcdefghijklmnopqrstuvwxyz"),
        (_UPPER, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        (_DIGIT, b"0123456789"),
        (_SPACE, b" \t\x0b\x0c\r"),
        (_LINE, b"\n"),
        (_STOP, b".,;:"),
        (_MARK, b"!?=_~^+{}[]\\\"'`"),
        (_SYMBOL, b"#*$%&|<>"),
    ):
        kinds[list(members)] = kind
    return kinds


@dataclass
class Model:
    """What the votes and the fit have taught: the share of junk, how often each heuristic
    is right, and the scorer's weights."""

    junk_share: float
    accuracy: np.ndarray
    weights: np.ndarray
    bias: float


def _hashed(x: np.ndarray) -> np.ndarray:
    x = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(54)).astype(np.int64) % BUCKETS


def measure(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The measures (a row for each text) and the hashed features of texts."""
    words = split_white(texts)
    values = np.zeros((len(texts), len(MEASURES)))
    features = np.zeros((len(texts), BUCKETS), dtype=np.float32)
    kinds = _kinds()
    codes = words.codes.astype(np.uint64)
    mixed = (codes + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(31)
    for row, text in enumerate(texts.to_pylist()):
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        if not len(raw):
            continue
        kind = kinds[raw]
        if len(kind) > 2:
            three = kind[:-2] * 121 + kind[1:-1] * 11 + kind[2:]
            counts = np.bincount(three, minlength=1331)
            used = np.flatnonzero(counts)
            np.add.at(features[row], _hashed(used), (counts[used] / len(three)).astype(np.float32))
        n = np.bincount(kind, minlength=11)
        a, b = words.bounds[row], words.bounds[row + 1]
        n_words = max(1, int(b - a))
        lines = [x for x in text.split("\n") if x.strip()]
        values[row] = (
            n[_SYMBOL] / n_words,
            n[_UPPER] / max(1, n[_LOWER] + n[_UPPER]),
            n[_MARK] / n_words,
            _repeated(mixed[a:b]) / n_words if n_words >= _REPETITION_WORDS else 0,
            (len(lines) - len(set(lines))) / len(lines) if len(lines) >= _REPETITION_LINES else 0,
            n[_DIGIT] / len(raw),
            (len(raw) - n[_SPACE] - n[_LINE]) / n_words,
            1 - (n[_LOWER] + n[_UPPER] + n[_WIDE] + n[_SPACE] + n[_LINE]) / len(raw),
        )
    # how far each measure lies between its two values, in quarters, as one feature each
    low, high = (np.array(x) for x in zip(*MEASURES.values()))
    step = np.clip(np.floor(4 * (values - low) / (high - low)), -1, 4).astype(np.int64) + 1
    at = _hashed(2000 + np.arange(len(MEASURES)) * 8 + step)
    for column in range(len(MEASURES)):
        features[np.arange(len(texts)), at[:, column]] += 1
    return values, features


def _repeated(words: np.ndarray) -> int:
    """Words that lie in a window of three that occurs more than once."""
    if len(words) < 4:
        return 0
    windows = words[:-2] * np.uint64(3) + words[1:-1] * np.uint64(5) + words[2:] * np.uint64(7)
    _, number, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[number] > 1
    covered = np.zeros(len(words), dtype=bool)
    for k in range(3):
        covered[k : len(words) - 2 + k] |= again
    return int(covered.sum())


def votes(values: np.ndarray) -> np.ndarray:
    """What each heuristic says to each text's measures."""
    low, high = (np.array(x) for x in zip(*MEASURES.values()))
    junk = np.where(values > high, JUNK, NONE)
    usual = values <= low
    names = list(MEASURES)
    good = [np.where(usual[:, [names.index(n) for n in group]].all(axis=1), GOOD, NONE) for group in _USUAL]
    return np.column_stack([junk, *good]).astype(np.int64)


def vote_patterns(docs: DataFrame) -> DataFrame:
    """(pattern, n): how many documents voted so, a digit a heuristic; all documents count."""

    def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in parts(batch.column("text"), NOWHERE, 1_000_000):
                cast = votes(measure(part)[0])
                yield pa.RecordBatch.from_arrays([pa.array(["".join(map(str, v)) for v in cast.tolist()])], ["pattern"])

    found = docs.select("text").mapInArrow(voted, "pattern string")
    return found.groupBy("pattern").agg(F.count("*").alias("n"))


def fit_votes(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[float, np.ndarray]:
    """The share of junk, and how often each heuristic is right when it votes.

    Expectation-maximisation, from heuristics that are right four times in five. Before
    any vote both classes are equally likely: rare junk that one heuristic alone finds
    would otherwise count against the heuristic. One that does not vote says nothing about
    the class. Four right votes and a wrong one are added to each heuristic's.
    """
    accuracy = np.full(patterns.shape[1], 0.8)
    voted = patterns != NONE
    for _ in range(rounds):
        junk = posterior(patterns, accuracy)
        right = np.where(patterns == JUNK, junk[:, None], 1 - junk[:, None]) * voted
        accuracy = (counts @ right + 4) / (counts @ voted + 5)
    return float(posterior(patterns, accuracy) @ counts / counts.sum()), accuracy


def posterior(patterns: np.ndarray, accuracy: np.ndarray) -> np.ndarray:
    """The probability of junk for votes."""
    weight = np.log(accuracy / (1 - accuracy))
    logs = ((patterns == JUNK) * weight - (patterns == GOOD) * weight).sum(axis=1)
    return 1 / (1 + np.exp(-np.clip(logs, -50, 50)))


def fit_scorer(features: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights of a logistic model for soft labels, by accelerated gradient steps.

    ``features`` may be in 16 bits: they are widened a block of rows at a time.
    """
    n = len(features)
    blocks = [slice(k, k + _BLOCK_ROWS) for k in range(0, n, _BLOCK_ROWS)]
    squares = sum(np.einsum("ij,ij->j", x, x) for x in (features[b].astype(np.float32) for b in blocks))
    scale = np.sqrt(squares / n) + np.float32(1e-3)
    w = ahead = np.zeros(features.shape[1], dtype=np.float32)
    bias = ahead_bias = np.float32(0)
    rate = np.float32(4.0 / max(1.0, 1 + float((squares / scale**2).sum()) / n))
    for step in range(_STEPS):
        slope, slope_bias = np.zeros_like(w), 0.0
        scaled = ahead / scale
        for b in blocks:
            x = features[b].astype(np.float32)
            error = 1 / (1 + np.exp(-np.clip(x @ scaled + ahead_bias, -30, 30))) - good[b]
            slope += error @ x
            slope_bias += float(error.sum())
        fresh = ahead - rate * (slope / scale / n + np.float32(1e-4) * ahead)
        fresh_bias = ahead_bias - rate * np.float32(slope_bias / n + 1e-4 * ahead_bias)
        pace = np.float32(step / (step + 3))
        ahead, ahead_bias = fresh + pace * (fresh - w), fresh_bias + pace * (fresh_bias - bias)
        w, bias = fresh, fresh_bias
    return (w / scale).astype(np.float32), float(bias)


def train(docs: DataFrame, most_fitted: int = MOST_FITTED, seen: Callable[[int], None] | None = None) -> Model:
    """The model of a corpus. Votes of all documents are counted; the scorer is fitted on a
    sample of about ``most_fitted`` rows at most, each drawn by a hash of its id, its text and
    its place, so that rows which repeat an id, or have none, are drawn like any others. ``seen`` is told how
    many rows the scorer is fitted on."""
    rows = sorted(tuple(r) for r in vote_patterns(docs).collect())  # 2 ** heuristics at most
    if not rows:
        return Model(0.5, np.full(N_HEURISTICS, 0.5), np.zeros(BUCKETS, dtype=np.float32), 0.0)
    patterns = np.array([[int(v) for v in pattern] for pattern, _ in rows])
    counts = np.array([n for _, n in rows], dtype=np.float64)
    share, accuracy = fit_votes(patterns, counts)

    parts_in = 1_000_000
    wanted = min(parts_in, int(most_fitted * parts_in / counts.sum()))
    drawn = F.pmod(F.xxhash64("doc_id", "text", F.monotonically_increasing_id()), F.lit(parts_in)) < wanted
    sample = docs.select("doc_id", "text").withColumn("_drawn", drawn).filter("_drawn")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in parts(batch.column("text"), NOWHERE, 1_000_000):
                values, features = measure(part)
                cast = votes(values)
                voted = (cast != NONE).any(axis=1)  # without a vote there is nothing to learn
                good = 1 - posterior(cast[voted], accuracy)
                packed = [zlib.compress(x.astype("<f2").tobytes(), 1) for x in features[voted]]
                yield pa.RecordBatch.from_arrays([pa.array(good), pa.array(packed, pa.binary())], ["good", "features"])

    found = sample.select("text").mapInArrow(listed, "good double, features binary").collect()
    found.sort(key=lambda r: (r["features"], r["good"]))
    if seen:
        seen(len(found))
    if not found:
        return Model(share, accuracy, np.zeros(BUCKETS, dtype=np.float32), float(np.log((1 - share) / share)))
    good = np.array([r["good"] for r in found], dtype=np.float32)
    features = np.empty((len(found), len(zlib.decompress(found[0]["features"])) // 2), dtype=np.float16)
    for at in reversed(range(len(found))):  # a row is let go once it is copied
        features[at] = np.frombuffer(zlib.decompress(found.pop()["features"]), dtype="<f2")
    weights, bias = fit_scorer(features, good)
    return Model(share, accuracy, weights, bias)


def _score(features: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(features @ weights + bias, -30, 30).astype(np.float64)))


def classify(docs: DataFrame, model: Model | None = None, keep_from: float = KEEP_FROM) -> DataFrame:
    """One row per document: doc_id, score, weak_label, kept.

    ``score`` is the scorer's probability that the document is good, ``weak_label`` the
    posterior of its heuristics' votes; documents with a score of ``keep_from`` or more are
    kept. A null or empty text has no features and scores by the bias alone. Equal texts
    score alike; repeated rows are scored each. Columns other than doc_id and text are not
    read; labels are not used.
    """
    model = model or train(docs)
    accuracy, weights, bias = model.accuracy, model.weights, model.bias

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, part in parts(batch.column("text"), NOWHERE, 1_000_000):
                values, features = measure(part)
                score = _score(features, weights, bias)
                weak = 1 - posterior(votes(values), accuracy)
                ids = batch.column("doc_id").take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([ids, pa.array(score), pa.array(weak)], ["doc_id", "score", "weak_label"])

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_id}, score double, weak_label double"
    found = docs.select("doc_id", "text").mapInArrow(scored, schema)
    return found.withColumn("kept", F.col("score") >= keep_from)


def keep_good(docs: DataFrame, model: Model | None = None, keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of ``docs`` that ``classify`` keeps, all columns as they are; nothing is
    shuffled."""
    model = model or train(docs)
    weights, bias = model.weights, model.bias

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, part in parts(batch.column("text"), NOWHERE, 1_000_000):
                score = _score(measure(part)[1], weights, bias)
                yield batch.take(pa.array(rows[score >= keep_from]))

    return docs.mapInArrow(kept, docs.schema)
