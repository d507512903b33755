"""Texts scored by a language model of word pairs, kept as Elias-Fano tries in shards.

A word's probability after another is its discounted count there, and the discounted mass is
spread by the words' own probabilities (interpolated absolute discounting). The model grows
with the corpus, so it is never in one place: pairs are dealt to shards by their first word,
and a shard's trie holds its contexts, pointers to their successors, the successors, and
quantised probabilities. Texts do not travel to the model either. They are cut into blocks; a
block sends each shard the different pairs it holds, once, and gets their codes back.

A context with very many occurrences is split by its successors' slots, numbers that their
ids are hashed to: the part a successor lies in has a probability of its own, and within the
part discounting is as in any other context. So no shard holds all successors of a frequent
word, and probabilities still sum to one. Codes are whole steps of a logarithm, rounded
against the text: sums of them are exact, and what is scored is never more than the model's
probability.
"""

from __future__ import annotations

import math
import mmap
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from rollbook.llm.elias_fano import Trie
from rollbook.llm.tables import stage
from rollbook.llm.words import parts, split_white

# Documents whose checksum leaves this remainder are not learned from.
FOLDS, HELD_OUT = 7, 2
DISCOUNT = 0.75
# Steps of a code for a factor of ten.
STEPS = 2048
# Occurrences from which on a context is split, slots of successors to split it by.
PART_TOKENS, SLOTS = 250_000, 65_536
# Tokens of all documents for each shard, and bytes of text in a block.
SHARD_TOKENS, BLOCK_BYTES = 2_000_000, 16_000_000

# The end of a text is a word that no text holds. It also stands before the first word.
_END = " "


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers from 0 on, in as few bytes as each needs, byte by byte, compressed."""
    out = []
    for array in arrays:
        top = int(array.max(initial=0))
        size = 1 if top < 2**8 else 2 if top < 2**16 else 4 if top < 2**32 else 8
        raw = array.astype(f"<u{size}").view(np.uint8).reshape(len(array), size)
        out.append(struct.pack("<BQ", size, len(array)) + np.ascontiguousarray(raw.T).tobytes())
    return zstandard.ZstdCompressor(level=3).compress(b"".join(out))


def _unpack(packed: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(packed), 0, []
    while at < len(raw):
        size, n = struct.unpack_from("<BQ", raw, at)
        at += 9
        planes = np.frombuffer(raw, dtype=np.uint8, count=size * n, offset=at).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).view(f"<u{size}").ravel().astype(np.int64))
        at += size * n
    return out


def _mixed(numbers: np.ndarray) -> np.ndarray:
    """A hash of each number, as splitmix64 mixes it."""
    x = numbers.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _codes(probabilities: np.ndarray) -> np.ndarray:
    """Steps of -log10, rounded up: the probability of a code is never too large."""
    return np.ceil(-STEPS * np.log10(probabilities) - 1e-9).astype(np.int64)


@dataclass(frozen=True)
class Counts:
    """What all shards need of the vocabulary: training tokens, different ones, the first id
    of each part of the vocabulary, and the running sum of probabilities by slot."""

    tokens: int
    words: int
    offsets: dict[int, int]
    mass: np.ndarray
    shards: int
    part_tokens: int

    @property
    def unknown(self) -> int:
        """The id of all words that training has not seen."""
        return self.words

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 1) / (self.tokens + self.words + 1)

    def splits(self, counts: np.ndarray) -> np.ndarray:
        """Into how many parts a context with this many occurrences is split."""
        return np.clip(-(-counts // self.part_tokens), 1, SLOTS)

    def part(self, successors: np.ndarray, splits: np.ndarray) -> np.ndarray:
        return _slot(successors) * splits // SLOTS

    def part_mass(self, part: np.ndarray, splits: np.ndarray) -> np.ndarray:
        """The probability, by the words' own counts, of the words of a part."""
        edge = lambda k: -(-k * SLOTS // splits)
        return self.mass[edge(part + 1)] - self.mass[edge(part)]


def _slot(ids: np.ndarray) -> np.ndarray:
    return (_mixed(ids) % np.uint64(SLOTS)).astype(np.int64)


_BLOCK = (
    "block long, words array<string>, learned array<long>, codes binary, "
    "row array<long>, doc_id array<{doc_id}>, held_out array<boolean>, n_codes array<long>"
)


def blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Texts as codes of words: one row per block, with its different words, how often each
    occurs in training, and the documents or parts of documents it holds.

    The codes of a document begin with its context, the end of a text or the last word of the
    part before, and its last part ends with the end of a text.
    """

    def tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 33
        n_blocks = n_rows = 0
        for batch in batches:
            held = np.asarray(batch.column("_held"))
            pending: tuple[np.ndarray, pa.Array] | None = None
            open_row, context = -1, _END

            def made(rows: np.ndarray, texts: pa.Array, last: bool) -> pa.RecordBatch:
                nonlocal open_row, context
                words = split_white(pc.ascii_lower(texts))
                first = context if open_row == rows[0] else _END
                unique = pa.concat_arrays([pa.array([_END, first], pa.large_string()), words.unique.cast(pa.large_string())])
                coded = unique.dictionary_encode()  # the context may be among the words
                sizes = np.diff(words.bounds)
                ends = np.ones(len(rows), dtype=np.int64)
                ends[-1] = 1 if last else 0
                n_codes = 1 + sizes + ends
                codes = np.zeros(n_codes.sum(), dtype=np.int64)
                starts = np.cumsum(n_codes) - n_codes
                inner = np.ones(len(codes), dtype=bool)
                inner[starts] = False
                inner[(starts + n_codes - 1)[ends > 0]] = False
                codes[inner] = words.codes + 2
                codes[starts[0]] = 1
                codes = np.asarray(coded.indices, dtype=np.int64)[codes]
                learns = np.repeat(~held[rows], n_codes)
                learns[starts] = False
                if not last:
                    open_row = int(rows[-1])
                    context = coded.dictionary[int(codes[-1])].as_py()
                learned = np.bincount(codes[learns], minlength=len(coded.dictionary))
                return pa.RecordBatch.from_pydict(
                    {
                        "block": pa.array([task + n_blocks], pa.int64()),
                        "words": pa.array([coded.dictionary.to_pylist()], pa.list_(pa.string())),
                        "learned": pa.array([learned], pa.list_(pa.int64())),
                        "codes": pa.array([_pack(codes)], pa.binary()),
                        "row": pa.array([task + n_rows + rows], pa.list_(pa.int64())),
                        "doc_id": pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), batch.column("doc_id").take(pa.array(rows))),
                        "held_out": pa.array([held[rows]], pa.list_(pa.bool_())),
                        "n_codes": pa.array([n_codes], pa.list_(pa.int64())),
                    }
                )

            for rows, texts in parts(batch.column("text"), part_bytes=block_bytes):
                if pending is not None:
                    yield made(*pending, last=pending[0][-1] != rows[0])
                    n_blocks += 1
                pending = rows, texts
            if pending is not None:
                yield made(*pending, last=True)
                n_blocks += 1
            n_rows += batch.num_rows

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT
    return docs.select("doc_id", "text", held.alias("_held")).mapInArrow(tokenised, _BLOCK.format(doc_id=doc_id))


def vocabulary(found: DataFrame) -> DataFrame:
    """Ids and counts of the words of each block, by part of the vocabulary.

    One row per part and block: ``packed`` are the places of words in the block, their numbers
    within the part and their training counts. The row of a part without a block has the
    counts of all its words, by number. Words that training has not seen count 0.
    """
    each = found.select("block", F.posexplode(F.arrays_zip("words", "learned")).alias("place", "_word")).select(
        "block", "place", F.col("_word.words").alias("word"), F.col("_word.learned").alias("n")
    )
    # one shuffle by word, and an order in it by which equal words are neighbours
    sorted_words = each.repartition("word").sortWithinPartitions("word")

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list[list[np.ndarray]] = [[], [], [], []]  # blocks, places, runs of words, counts
        runs, last = 0, None
        for batch in batches:
            words = batch.column("word").cast(pa.large_string())
            new = np.ones(len(words), dtype=bool)
            new[1:] = np.asarray(pc.not_equal(words[1:], words[:-1]))
            new[0] = words[0].as_py() != last if len(words) else True
            if not len(words):
                continue
            last = words[-1].as_py()
            run = runs + np.cumsum(new) - 1
            runs = int(run[-1]) + 1
            for into, values in zip(held, (np.asarray(batch.column("block")), np.asarray(batch.column("place")), run, np.asarray(batch.column("n")))):
                into.append(values.astype(np.int64))
        if not runs:
            return
        block, place, run, n = (np.concatenate(h) for h in held)
        counts = np.bincount(run, weights=n, minlength=runs).astype(np.int64)
        seen = counts > 0
        number = np.cumsum(seen) - 1
        yield _row(part, None, _pack(counts[seen]))
        order = np.lexsort((place, block))
        block, place, run = block[order], place[order], run[order]
        for start, stop in _runs(block):
            mine = run[start:stop]
            yield _row(
                part,
                int(block[start]),
                _pack(np.diff(place[start:stop], prepend=0), np.where(seen[mine], number[mine], 0), counts[mine]),
            )

    def _row(part: int, block: int | None, packed: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"part": pa.array([part], pa.int64()), "block": pa.array([block], pa.int64()), "packed": pa.array([packed], pa.binary())}
        )

    return sorted_words.mapInArrow(numbered, "part long, block long, packed binary")


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Start and stop of each run of equal numbers."""
    if len(values):
        edges = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
        yield from zip(edges[:-1], edges[1:])


def _counted(found: DataFrame, known: DataFrame, shard_tokens: int, part_tokens: int) -> Counts:
    """Totals: one row a part of the vocabulary and one a slot come to the driver."""
    whole = known.filter("block IS NULL").select("part", "packed")

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = _unpack(packed)[0]
                yield pa.RecordBatch.from_pydict(
                    {"part": pa.array([part], pa.int64()), "words": pa.array([len(counts)], pa.int64()), "tokens": pa.array([counts.sum()], pa.int64())}
                )

    sizes = sorted(tuple(r) for r in whole.mapInArrow(summed, "part long, words long, tokens long").collect())
    words, tokens = sum(r[1] for r in sizes), sum(r[2] for r in sizes)
    offsets = dict(zip([r[0] for r in sizes], np.cumsum([0, *[r[1] for r in sizes]]).tolist()))

    def slotted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, dtype=np.int64)
        for batch in batches:
            for part, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = _unpack(packed)[0]
                np.add.at(total, _slot(offsets[part] + np.arange(len(counts))), counts + 1)
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"slot": pa.array(filled, pa.int32()), "s": pa.array(total[filled], pa.int64())})

    mass = np.zeros(SLOTS)
    for r in whole.mapInArrow(slotted, "slot int, s long").groupBy("slot").agg(F.sum("s").alias("s")).collect():
        mass[r["slot"]] = r["s"]
    mass[_slot(np.array([words]))] += 1
    mass = np.concatenate(([0.0], np.cumsum(mass))) / (tokens + words + 1)
    n_all = found.select(F.sum(F.aggregate("n_codes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    return Counts(tokens, words, offsets, mass, max(1, -(-int(n_all) // shard_tokens)), part_tokens)


class _Block:
    """A block with the ids of its words: its tokens, and its different pairs by shard."""

    def __init__(self, left: pa.Table, dictionary: list[tuple[int, bytes]], counts: Counts):
        row = left.to_pylist()[0]
        self.row, self.doc_id, self.held_out = row["row"], row["doc_id"], row["held_out"]
        codes, n_codes = _unpack(row["codes"])[0], np.array(row["n_codes"], dtype=np.int64)
        size = int(codes.max(initial=0)) + 1
        ids, seen = np.full(size, counts.unknown, dtype=np.int64), np.zeros(size, dtype=np.int64)
        for part, packed in dictionary:
            places, numbers, n = _unpack(packed)
            places = np.cumsum(places)
            ids[places] = np.where(n > 0, counts.offsets[part] + numbers, counts.unknown)
            seen[places] = n
        starts = np.cumsum(n_codes) - n_codes
        inner = np.ones(len(codes), dtype=bool)
        inner[starts] = False
        places = np.flatnonzero(inner)
        self.n_tokens = n_codes - 1
        self.token, context = codes[places], codes[places - 1]
        self.seen = seen[self.token]
        self.known = seen[context] > 0
        wide = counts.words + 1
        pairs, first, self.at = np.unique(
            ids[context[self.known]] * wide + ids[self.token[self.known]], return_index=True, return_inverse=True
        )
        learns = np.repeat(~np.array(self.held_out, dtype=bool), self.n_tokens)[self.known]
        self.n = np.bincount(self.at, weights=learns, minlength=len(pairs)).astype(np.int64)
        self.context, self.successor = pairs // wide, pairs % wide
        self.n_context = seen[context[self.known][first]]
        self.n_successor = seen[self.token[self.known][first]]
        part = counts.part(self.successor, counts.splits(self.n_context))
        shard = (_mixed(self.context * SLOTS + part) % np.uint64(counts.shards)).astype(np.int64)
        # pairs by shard, in order within it
        self.order = np.argsort(shard, kind="stable")
        self.shards = [(int(shard[self.order[a]]), a, b) for a, b in _runs(shard[self.order])]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sums over each document's tokens."""
        running = np.concatenate((np.zeros(1, dtype=values.dtype), np.cumsum(values)))
        ends = np.cumsum(self.n_tokens)
        return running[ends] - running[ends - self.n_tokens]


def _sent(block: int, known: _Block) -> Iterator[dict]:
    """The pairs for each shard. Contexts are written once, with their number of successors."""
    for shard, start, stop in known.shards:
        mine = known.order[start:stop]
        context, successor = known.context[mine], known.successor[mine]
        first = np.flatnonzero(np.diff(context, prepend=-1))
        step = np.diff(successor, prepend=0)
        step[first] = successor[first]
        packed = _pack(
            np.diff(context[first], prepend=0), np.diff(np.append(first, len(mine))), known.n_context[mine][first],
            step, known.n[mine], known.n_successor[mine],
        )
        yield {"shard": shard, "block": block, "packed": packed}


def _received(packed: bytes) -> list[np.ndarray]:
    """Contexts, successors, training counts of the pair, of the context and of the successor."""
    steps, sizes, n_context, step, n, n_successor = _unpack(packed)
    first = np.cumsum(sizes) - sizes
    running = np.cumsum(step)
    successor = running - np.repeat(running[first] - step[first], sizes)
    return [np.repeat(np.cumsum(steps), sizes), successor, n, np.repeat(n_context, sizes), n_successor]


def _scored(sent: list[bytes], counts: Counts) -> list[np.ndarray]:
    """The codes of all pairs that a shard was sent: it builds its trie and asks it."""
    received = [_received(packed) for packed in sent]
    context, successor, n, n_context, n_successor = (np.concatenate(c) for c in zip(*received))
    splits = counts.splits(n_context)
    part = counts.part(successor, splits)
    key = context * SLOTS + part
    order = np.lexsort((successor, key))
    key, successor = key[order], successor[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (successor[1:] != successor[:-1])
    starts = np.flatnonzero(new)
    n = np.add.reduceat(n[order], starts)
    key, successor = key[starts], successor[starts]
    picked = order[starts]
    splits, part, own = splits[picked], part[picked], counts.unigram(n_successor[picked])
    n_context, mass = n_context[picked], counts.part_mass(part, splits)

    learned = np.flatnonzero(n)
    first = np.flatnonzero(np.diff(key[learned], prepend=-1))
    heads = learned[first]
    n_part = np.add.reduceat(n[learned], first) if len(first) else first
    kinds = np.diff(np.append(first, len(learned)))
    of_part = (n_part + 1) / (n_context[heads] + splits[heads])
    spread = of_part * DISCOUNT * kinds / np.maximum(n_part, 1) / mass[heads]
    at = np.repeat(np.arange(len(first)), kinds)
    seen = of_part[at] * (n[learned] - DISCOUNT) / n_part[at] + spread[at] * own[learned]
    built = Trie.of(key[heads], first, successor[learned], _codes(seen), _codes(spread)).to_bytes()

    # the levels are one mapping of memory, and are asked in place
    with mmap.mmap(-1, len(built)) as mapped:
        mapped.write(built)
        trie = Trie.read(mapped)
        number = trie.find_contexts(key)
        place = trie.find(number, successor)
        unseen = _codes((1 / (n_context + splits)) / mass)
        penalty = np.where(number >= 0, trie.penalties[np.maximum(number, 0)] if len(heads) else 0, unseen)
        code = penalty + _codes(own)
        found = place >= 0
        code[found] = trie.codes[place[found]]
        del trie
    code = np.maximum(code, 0)
    out = np.empty(len(order), dtype=np.int64)
    out[order] = code[np.cumsum(new) - 1]
    return np.split(out, np.cumsum([len(r[0]) for r in received])[:-1])


def score(
    spark: SparkSession,
    docs: DataFrame,
    block_bytes: int = BLOCK_BYTES,
    shard_tokens: int = SHARD_TOKENS,
    part_tokens: int = PART_TOKENS,
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score.

    The model is learned from the documents that are not held out. ``base_score`` goes by the
    words' own counts, ``score`` is the log10 probability of the text after the model of pairs.
    A null or empty text is its end alone. Repeated rows are learned from and scored each; null
    ids count as an empty id, which is not held out. Other columns of ``docs`` are not read; an
    empty table gives an empty result. Without training documents every word is unknown.
    """
    staged = stage(spark)
    found = staged.table("blocks", blocks(docs, block_bytes))
    known = staged.table("vocabulary", vocabulary(found))
    counts = _counted(found, known, shard_tokens, part_tokens)
    texts = found.drop("words", "learned")
    dictionary = known.filter("block IS NOT NULL").select("block", "part", "packed", F.lit(False).alias("answer"))

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        pairs = [(p, b) for p, b in zip(right["part"].to_pylist(), right["packed"].to_pylist())]
        sent = list(_sent(left["block"][0].as_py(), _Block(left, pairs, counts)))
        return pa.Table.from_pylist(sent, pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("packed", pa.binary())]))

    sent = (
        texts.groupBy("block").cogroup(dictionary.groupBy("block")).applyInArrow(send, "shard long, block long, packed binary")
    )

    def answer(table: pa.Table) -> pa.Table:
        codes = _scored(table["packed"].to_pylist(), counts)
        return pa.table(
            {"block": table["block"], "part": table["shard"], "packed": pa.array([_pack(c) for c in codes], pa.binary())}
        )

    answers = (
        sent.repartition(counts.shards, "shard")
        .groupBy("shard")
        .applyInArrow(answer, "block long, part long, packed binary")
        .withColumn("answer", F.lit(True))
    )
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    kind = found.schema["doc_id"].dataType.elementType

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = list(zip(right["answer"].to_pylist(), right["part"].to_pylist(), right["packed"].to_pylist()))
        block = _Block(left, [(p, b) for is_answer, p, b in rows if not is_answer], counts)
        codes = {p: b for is_answer, p, b in rows if is_answer}
        by_pair = np.zeros(len(block.n), dtype=np.int64)
        for shard, start, stop in block.shards:
            by_pair[block.order[start:stop]] = _unpack(codes[shard])[0]
        own = counts.unigram(block.seen)
        code = _codes(own)
        code[block.known] = by_pair[block.at]
        return pa.table(
            {
                "_row": pa.array(block.row, pa.int64()),
                "doc_id": left["doc_id"].combine_chunks().flatten(),
                "held_out": pa.array(block.held_out, pa.bool_()),
                "n_tokens": pa.array(block.n_tokens, pa.int64()),
                "n_known": pa.array(block.sums((block.seen > 0).astype(np.int64)), pa.int64()),
                "base_score": pa.array(block.sums(np.log10(own))),
                "steps": pa.array(block.sums(code), pa.int64()),
            }
        )

    each = (
        texts.groupBy("block")
        .cogroup(dictionary.unionByName(answers).groupBy("block"))
        .applyInArrow(
            summed,
            f"_row long, doc_id {doc_id}, held_out boolean, n_tokens long, n_known long, base_score double, steps long",
        )
    )
    total = lambda c: F.sum(c).alias(c)
    return (
        each.groupBy("_row", "doc_id", "held_out")
        .agg(*map(total, ("n_tokens", "n_known", "base_score", "steps")))
        .select(
            F.col("doc_id").cast(kind), "held_out", "n_tokens", "n_known", F.lit(counts.tokens).cast("long").alias("train_tokens"),
            "base_score", (F.col("steps") / F.lit(-float(STEPS))).alias("score"),
        )
    )
