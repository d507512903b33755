"""Documents packed into sequences of a fixed number of tokens, by exact complements.

Packing is planned on the counts of lengths, a table no longer than the capacity, however
many documents there are: a plan fills a sequence from lengths, not from documents. The plan
indexes the sums of one, two and three available lengths, looks up for each length the
combinations that fill the rest of the capacity exactly, takes as many of them as the counts
allow, and places what remains best fit. Exact sequences early on can leave lengths that fit
each other badly, so best fit alone is planned too, and the plan with fewer sequences holds.
Pieces then find their places by their rank among the pieces of their length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, Window

from rollbook.llm.tables import stage
from rollbook.llm.token_counts import MOST_UNITS, TOKENIZER, unit_encoder
from rollbook.llm.words import parts, ranges, split_white

CAPACITY = 2048
END_ID = 0
# Rows of pieces that are ranked together, about.
RANKED_ROWS = 100_000


@dataclass(frozen=True)
class Pattern:
    """``times`` sequences that hold these lengths, in this order."""

    lengths: tuple[int, ...]
    times: int


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that together use every length as often as ``counts`` says."""
    left = {length: n for length, n in counts.items() if n}
    if any(length < 1 or length > capacity for length in left):
        raise ValueError("lengths must lie between 1 and the capacity")
    plain = _best_fit(dict(left), capacity)
    exact = _exact(left, capacity)
    exact += _best_fit(left, capacity)
    return min(exact, plain, key=lambda patterns: sum(p.times for p in patterns))


def _take(left: dict[int, int], lengths: tuple[int, ...], patterns: list[Pattern]) -> None:
    """As many sequences of these lengths as the counts allow."""
    needed = {length: lengths.count(length) for length in lengths}
    times = min(left.get(length, 0) // n for length, n in needed.items())
    if times:
        patterns.append(Pattern(lengths, times))
        for length, n in needed.items():
            left[length] -= times * n
            if not left[length]:
                del left[length]


class _Sums:
    """The sums of one, two and three available lengths, each with its combinations.

    Pairs are filed under their sum, the one with the smallest larger length last. A triple is
    a length and a pair no longer than it, so its sum is found by the pair's. Combinations
    with a length that is used up are dropped as they are met; none ever comes back.
    """

    def __init__(self, left: dict[int, int], capacity: int):
        self._left = left
        self._lengths = sorted(left, reverse=True)
        self._pairs: dict[int, list[tuple[int, int]]] = {}
        for k, a in enumerate(self._lengths):
            for b in self._lengths[k:]:
                if a + b < capacity:
                    self._pairs.setdefault(a + b, []).append((a, b))

    def singles(self, total: int, most: int) -> Iterator[tuple[int, ...]]:
        """The combinations of one length with this sum, none longer than ``most``."""
        if total <= most and total in self._left:
            yield (total,)

    def pairs(self, total: int, most: int) -> Iterator[tuple[int, ...]]:
        filed, left = self._pairs.get(total, []), self._left
        at = len(filed) - 1
        while at >= 0:
            a, b = filed[at]
            if a not in left or b not in left:
                del filed[at]
            elif a > most:
                return
            else:
                yield a, b
            at = min(at, len(filed)) - 1

    def triples(self, total: int, most: int) -> Iterator[tuple[int, ...]]:
        for a in self._lengths:
            if 3 * a < total:
                return
            if a <= most and a in self._left and total - a in self._pairs:
                for b, c in self.pairs(total - a, a):
                    if a not in self._left:
                        break
                    yield a, b, c


def _exact(left: dict[int, int], capacity: int) -> list[Pattern]:
    """Longest lengths first, the gaps beside them are filled exactly: by one other length,
    by two, by three. ``left`` keeps what no combination takes."""
    patterns: list[Pattern] = []
    if capacity in left:
        _take(left, (capacity,), patterns)
    for kind in (_Sums.singles, _Sums.pairs, _Sums.triples):
        index = _Sums(left, capacity)
        for length in sorted(left, reverse=True):
            for others in kind(index, capacity - length, length):
                if length not in left:
                    break
                _take(left, (length, *others), patterns)
    return patterns


def _best_fit(left: dict[int, int], capacity: int) -> list[Pattern]:
    """Longest first into the fullest sequences that have room; alike sequences together."""
    done: list[Pattern] = []
    open_by_gap: dict[int, list[Pattern]] = {}
    gaps: list[int] = []

    def add(gap: int, pattern: Pattern) -> None:
        if not gap:
            done.append(pattern)
            return
        if gap not in open_by_gap:
            open_by_gap[gap] = []
            insort(gaps, gap)
        open_by_gap[gap].append(pattern)

    for length in sorted(left, reverse=True):
        n = left[length]
        while n and (at := bisect_left(gaps, length)) < len(gaps):
            gap = gaps[at]
            found = open_by_gap[gap].pop()
            if not open_by_gap[gap]:
                del open_by_gap[gap], gaps[at]
            each = min(gap // length, max(1, n // found.times))
            times = min(found.times, n // each)
            add(gap - each * length, Pattern(found.lengths + (length,) * each, times))
            if found.times > times:
                add(gap, Pattern(found.lengths, found.times - times))
            n -= each * times
        each = capacity // length
        if n // each:
            add(capacity - each * length, Pattern((length,) * each, n // each))
        if n % each:
            add(capacity - (n % each) * length, Pattern((length,) * (n % each), 1))
    left.clear()
    return done + [p for patterns in open_by_gap.values() for p in patterns]


def pieces(
    docs: DataFrame,
    tokenizer: str = TOKENIZER,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    remembered: int = MOST_UNITS,
) -> DataFrame:
    """The documents' pieces: doc_id, piece, start, length, ids_crc32.

    A document is its token ids and then ``end_id``; one that is longer than ``capacity``
    is cut into pieces of that length, the last of which may be shorter. The checksum is
    over the ids as little-endian unsigned 32-bit numbers.
    """
    end = np.array([end_id], dtype="<u4").tobytes()
    step = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = unit_encoder(tokenizer, remembered)
        for batch in batches:
            ids = batch.column("doc_id")
            open_row, held = -1, bytearray()  # a text that comes in several parts
            for rows, texts in parts(batch.column("text")):
                if open_row >= 0 and rows[0] != open_row:
                    yield _piece_batch(ids, [(open_row, bytes(held))], step, end)
                    open_row, held = -1, bytearray()
                coded = _encoded(texts, encode)
                if len(rows) == 1:
                    open_row = int(rows[0])
                    held += coded[0]
                else:
                    yield _piece_batch(ids, list(zip(rows.tolist(), coded)), step, end)
            if open_row >= 0:
                yield _piece_batch(ids, [(open_row, bytes(held))], step, end)

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_id}, piece int, start long, length long, ids_crc32 long"
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def _encoded(texts: pa.Array, encode) -> list[bytes]:
    """The ids of each text, four bytes each."""
    words = split_white(texts)
    flat, lengths = encode.ids(words.unique)
    starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    each = lengths[words.codes]
    stream = flat[ranges(starts[words.codes], each)]
    ends = np.concatenate(([0], np.cumsum(each)))[words.bounds]
    return [stream[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]


def _piece_batch(ids: pa.Array, coded: list[tuple[int, bytes]], step: int, end: bytes) -> pa.RecordBatch:
    rows, numbers, starts, lengths, sums = [], [], [], [], []
    for row, stream in coded:
        stream += end
        for number, start in enumerate(range(0, len(stream), step)):
            part = stream[start : start + step]
            rows.append(row)
            numbers.append(number)
            starts.append(start // 4)
            lengths.append(len(part) // 4)
            sums.append(zlib.crc32(part))
    return pa.RecordBatch.from_arrays(
        [
            ids.take(pa.array(rows, pa.int64())),
            pa.array(numbers, pa.int32()),
            *(pa.array(x, pa.int64()) for x in (starts, lengths, sums)),
        ],
        ["doc_id", "piece", "start", "length", "ids_crc32"],
    )


def pack(
    spark: SparkSession,
    docs: DataFrame,
    tokenizer: str = TOKENIZER,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    ranked_rows: int = RANKED_ROWS,
    remembered: int = MOST_UNITS,
) -> DataFrame:
    """One row per piece: those of ``pieces``, sequence_id, offset.

    Each sequence holds at most ``capacity`` tokens, its pieces without a gap from offset 0.
    A null or empty text is one piece, the end id alone. Repeated rows are packed each.
    Other columns of ``docs`` are not read; an empty table gives an empty result.
    """
    staged = stage(spark)
    found = staged.table("pieces", pieces(docs, tokenizer, capacity, end_id, remembered))
    # as many parts as a shuffle has, so that a common length is not one task's work
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_parts = max(shuffled, -(-found.count() // ranked_rows))
    deal = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(n_parts)).cast("int")
    dealt = found.withColumn("_deal", deal)

    # How many pieces of each length there are, by part: at most ``capacity`` rows a part.
    sizes = staged.table("sizes", dealt.groupBy("length", "_deal").agg(F.count("*").alias("_n")))
    earlier = Window.partitionBy("length").orderBy("_deal").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("length", "_deal", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))

    # At most ``capacity`` rows.
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    slots = _Slots.of(plan(counts, capacity))

    order = Window.partitionBy("_deal", "length").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        dealt.withColumn("_rank", F.row_number().over(order) - 1)
        # the window's shuffle serves this join; the table grows with the parts, so no broadcast
        .join(before.hint("merge"), ["_deal", "length"])
        .select(*found.columns, (F.col("_before") + F.col("_rank")).alias("_rank"))
    )

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = slots.places(
                np.asarray(batch.column("length")), np.asarray(batch.column("_rank"))
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence), pa.array(offset)],
                [*batch.schema.names[:-1], "sequence_id", "offset"],
            )

    kinds = ", ".join(f"{name} {kind}" for name, kind in found.dtypes)
    return ranked.mapInArrow(placed, f"{kinds}, sequence_id long, offset long")


@dataclass
class _Slots:
    """Where the pieces of each length go: from a rank on, to sequences from a number on."""

    lengths: np.ndarray
    ranks: np.ndarray
    sequences: np.ndarray
    offsets: np.ndarray

    @classmethod
    def of(cls, patterns: list[Pattern]) -> _Slots:
        used: dict[int, int] = {}
        rows = []
        first = 0
        for pattern in patterns:
            offset = 0
            for length in pattern.lengths:
                rank = used.get(length, 0)
                rows.append((length, rank, first, offset))
                used[length] = rank + pattern.times
                offset += length
            first += pattern.times
        rows.sort()
        return cls(*np.array(rows, dtype=np.int64).reshape(-1, 4).T)

    def places(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.zeros(len(lengths), dtype=np.int64)
        for length in np.unique(lengths):
            mine = lengths == length
            low, high = np.searchsorted(self.lengths, [length, length + 1])
            at[mine] = low + np.searchsorted(self.ranks[low:high], ranks[mine], side="right") - 1
        return self.sequences[at] + ranks - self.ranks[at], self.offsets[at]
