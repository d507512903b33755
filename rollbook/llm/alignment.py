"""Two tokenizers aligned on the bytes of the same text, and how often their tokens meet.

Both tokenizers' tokens spell the text, so each has a rising list of byte offsets at which
its tokens end. Offsets in both lists cut the tokens into groups; they are found by galloping:
the shorter list drives, and each of its offsets is sought in the longer one in steps that
double, and then by halving. Within a group the tokens of one side that overlap a token of the
other are a range, and the ranks of its two ends among the other side's offsets are the
range's bounds.

A place before a space that follows a character other than white space is a boundary of tokens
on both sides, whatever stands around it. So a text is cut there, and each different unit of a
batch is encoded and aligned once, all units at the same time: the lists of a batch are single
arrays, and the steps of the search are taken for all offsets of the shorter lists together.
Counts of linked ids are added up over the corpus in Spark and joined to the documents' links:
the most frequent pairs, a bounded number, where the links lie, the others by a shuffle.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from rollbook.llm.tables import stage
from rollbook.llm.words import parts, per_worker, ranges

BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"
SPACE = "▁"

# Pairs with more than 1 in FREQUENT of all links are joined by broadcast: there are fewer
# than FREQUENT of them, whatever the data.
FREQUENT = 200_000
# Bytes of text that are worked on at a time.
PART_BYTES = 3_000_000
# Units of texts that are put together again at a time.
CHUNK_UNITS = 50_000

# Where texts are cut; the last character never stands alone.
_CUT = re.compile(r"(?<=\S)(?= .)", re.DOTALL)
# Words after which a space is no such place: none at all, or one that ends in white space.
_OPEN = "^$|[\\s\\x{1C}-\\x{1F}\\x{85}\\x{A0}\\p{Z}]$"
# Words of letters on which all versions of Unicode agree.
_LATIN = "^[\\x{0}-\\x{24F}]*$"
# What shows that texts meet at such places, token for token.
_PROBES = (
    "A test's word, 12ab  re-read\n\n\n #'s it's.\n naïve \t café!\n<|endoftext|>x y</s> <unk>\n z  ",
    " lead   nb\u00a0 sp\x1c x\x85 y\r\n z\u3000 中文 字\n日本 e\u0301 ﬁ 🎉 ½²  end \n",
)


@dataclass
class Tokens:
    """The tokens of units one after the other: ids, and how many each unit has."""

    ids: np.ndarray
    counts: np.ndarray

    def of(self, chosen: np.ndarray) -> Tokens:
        """The tokens of the units where ``chosen`` is true; the others have none."""
        if chosen.all():
            return self
        return Tokens(self.ids[np.repeat(chosen, self.counts)], np.where(chosen, self.counts, 0))


class Spelling:
    """The bytes of each token of a vocabulary, in one array."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self._starts = np.cumsum(self.lengths) - self.lengths
        self._bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.names = pa.array([str(i) for i in range(len(tokens))])

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return self._bytes[ranges(self._starts[ids], self.lengths[ids])]


class Pair:
    """The two tokenizers; worker processes make one, not the driver."""

    def __init__(self, byte_name: str, piece_name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self._bytes = Tokenizer.from_file(public_tokenizers.path(byte_name))
        self._bytes.encode_special_tokens = True
        self._pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(piece_name))
        spelled = _byte_letters()
        left = [b""] * self._bytes.get_vocab_size()
        for token, number in self._bytes.get_vocab(with_added_tokens=False).items():
            left[number] = bytes(spelled[c] for c in token if c in spelled)
        special = {t.content for t in self._bytes.get_added_tokens_decoder().values()}
        ranks = {left[i]: i for t, i in self._bytes.get_vocab().items() if t not in special}
        # the same vocabulary in a library that encodes long texts faster
        self._quick = tiktoken.Encoding("left", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.left = Spelling(left)
        self.right = Spelling([self._piece(i) for i in range(self._pieces.get_piece_size())])
        self._probe()

    def _piece(self, number: int) -> bytes:
        piece = self._pieces.id_to_piece(number)
        if self._pieces.is_byte(number):
            return bytes([int(piece[1:-1], 16)])
        return piece.replace(SPACE, " ").encode()

    def _probe(self) -> None:
        for probe in _PROBES:
            a = self._bytes.encode(" " + probe, add_special_tokens=False).ids
            a, b = np.array(a), np.array(self._pieces.encode(probe))
            left, right = self.encode(words := pa.array(units(probe), pa.large_string()))
            whole = np.array_equal(left.ids, a) and np.array_equal(right.ids, b)
            if not whole or len(words) < 2:
                raise ValueError("the tokenizers join tokens across words; they cannot be used here")

    def encode(self, words: pa.Array) -> tuple[Tokens, Tokens]:
        """The tokens of both sides for units, each given without the space it begins with.

        The piece model puts a space before any text by itself.
        """
        right = self._pieces.encode(words.to_pylist(), num_threads=1)
        return self._left(words), _flat(right)

    def _left(self, words: pa.Array) -> Tokens:
        """Units of Latin letters are encoded as one text, at whose cuts tokens end."""
        plain = pc.and_(pc.match_substring_regex(words, _LATIN), pc.invert(pc.match_substring_regex(words, _OPEN)))
        rare = pc.invert(plain)
        texts = [" " + w for w in words.filter(rare).to_pylist()]
        others = _flat([e.ids for e in self._bytes.encode_batch_fast(texts, add_special_tokens=False)])
        joined = words.filter(plain)
        if not len(joined):
            return others
        ends = np.cumsum(np.asarray(pc.binary_length(joined)).astype(np.int64) + 1)
        ids = np.array(self._quick.encode_ordinary(_spaced(joined).tobytes().decode()), dtype=np.int64)
        stops = np.searchsorted(np.cumsum(self.left.lengths[ids]), ends) + 1
        counts = np.zeros(len(words), dtype=np.int64)
        places = np.asarray(plain)
        counts[places] = np.diff(stops, prepend=0)
        if not len(others.ids):
            return Tokens(ids, counts)
        counts[~places] = others.counts
        out = np.empty(counts.sum(), dtype=np.int64)
        from_joined = np.repeat(places, counts)
        out[from_joined], out[~from_joined] = ids, others.ids
        return Tokens(out, counts)


def _flat(lists: list[list[int]]) -> Tokens:
    counts = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    return Tokens(np.fromiter((i for ids in lists for i in ids), dtype=np.int64, count=counts.sum()), counts)


def _spaced(words: pa.Array) -> np.ndarray:
    """The bytes of all words, each after a space."""
    empty, space = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
    joined = pc.binary_join_element_wise(empty, words.cast(pa.large_string()), space)
    size = pc.sum(pc.binary_length(joined)).as_py() or 0
    return np.frombuffer(joined.buffers()[2], dtype=np.uint8, count=size) if size else np.zeros(0, dtype=np.uint8)


def _byte_letters() -> dict[str, int]:
    """The letter by which byte-level vocabularies write each byte: printable Latin-1 signs
    stand for themselves, the other bytes in rising order for the letters from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


def units(text: str) -> list[str]:
    """A space and ``text``, cut where both tokenizers end a token; without the spaces that
    the units begin with."""
    return [u[1:] for u in _CUT.split(" " + text)]


def gallop(wanted: np.ndarray, values: np.ndarray, low: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """For each number its place in values[low:stop], which rise, or -1: steps from ``low``
    double until they are past the number, halving then finds it."""
    low, high, step = low.copy(), low.copy(), 1
    last = len(values) - 1
    moving = np.flatnonzero(high < stop)
    while len(moving := moving[values[high[moving]] < wanted[moving]]):
        low[moving] = high[moving] + 1
        high[moving] += step
        step *= 2
        moving = moving[high[moving] < stop[moving]]
    high = np.minimum(high, stop)
    halving = np.flatnonzero(low < high)
    while len(halving):
        middle = (low[halving] + high[halving]) // 2
        less = values[middle] < wanted[halving]
        low[halving] = np.where(less, middle + 1, low[halving])
        high[halving] = np.where(less, high[halving], middle)
        halving = halving[low[halving] < high[halving]]
    found = (low < stop) & (values[np.minimum(low, last)] == wanted) if last >= 0 else np.zeros(len(low), dtype=bool)
    return np.where(found, low, -1)


def common_ends(
    left: np.ndarray, left_counts: np.ndarray, right: np.ndarray, right_counts: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Tokens (i, j) of the two sides that end at the same byte, in order.

    ``left`` and ``right`` are the ends of all tokens, unit after unit; of each unit the side
    with fewer tokens drives.
    """
    left_first, right_first = np.cumsum(left_counts) - left_counts, np.cumsum(right_counts) - right_counts
    drives = left_counts <= right_counts

    out = []
    for side, (mine, counts, first, others, other_counts, other_first) in enumerate(
        (
            (left, left_counts, left_first, right, right_counts, right_first),
            (right, right_counts, right_first, left, left_counts, left_first),
        )
    ):
        chosen = np.flatnonzero(drives if not side else ~drives)
        places = ranges(first[chosen], counts[chosen])
        low = np.repeat(other_first[chosen], counts[chosen])
        stop = low + np.repeat(other_counts[chosen], counts[chosen])
        found = gallop(mine[places], others, low, stop)
        met = (places[found >= 0], found[found >= 0])
        out.append(met if not side else met[::-1])
    i, j = np.concatenate([out[0][0], out[1][0]]), np.concatenate([out[0][1], out[1][1]])
    order = np.argsort(i, kind="stable")
    return i[order], j[order]


@dataclass
class Aligned:
    """What units add to their texts, by unit: tokens of both sides, groups and links in
    ``counts``; the groups as text; the linked ids, one number a link, unit after unit; and
    whether both sides spell the unit, without which it adds nothing."""

    counts: np.ndarray
    texts: pa.Array
    pairs: np.ndarray
    valid: np.ndarray


def align_units(pair: Pair, words: pa.Array) -> Aligned:
    """Aligns units, each given without the space it begins with."""
    left, right = pair.encode(words)
    sizes = np.asarray(pc.binary_length(words)).astype(np.int64) + 1
    valid = np.ones(len(words), dtype=bool)
    for tokens, spelling in ((left, pair.left), (right, pair.right)):
        valid &= _sums(spelling.lengths[tokens.ids], tokens.counts) == sizes
    for tokens, spelling in ((left, pair.left), (right, pair.right)):
        text = _spaced(words if valid.all() else words.filter(pa.array(valid)))
        same = spelling.bytes_of(tokens.of(valid).ids) == text
        if not same.all():
            each = np.where(valid, sizes, 0)
            valid &= _sums(~same, each) == 0
    left, right = left.of(valid), right.of(valid)

    ends, other_ends = np.cumsum(pair.left.lengths[left.ids]), np.cumsum(pair.right.lengths[right.ids])
    i, j = common_ends(ends, left.counts, other_ends, right.counts)
    groups = np.diff(np.searchsorted(i, np.cumsum(left.counts)), prepend=0)

    def joined(values: pa.Array, stops: np.ndarray, sign: str) -> pa.Array:
        offsets = pa.array(np.concatenate(([0], stops)), pa.int32())
        return pc.binary_join(pa.ListArray.from_arrays(offsets, values), sign)

    texts = pc.binary_join_element_wise(
        joined(pair.left.names.take(pa.array(left.ids)), i + 1, ","),
        joined(pair.right.names.take(pa.array(right.ids)), j + 1, ","),
        "|",
    )

    # the tokens of B that end after a token of A begins, up to the first at or after its end
    low = np.searchsorted(other_ends, ends - pair.left.lengths[left.ids], side="right")
    met = np.searchsorted(other_ends, ends) - low + 1
    pairs = np.repeat(left.ids, met) * len(pair.right.lengths) + right.ids[ranges(low, met)]
    return Aligned(
        np.column_stack([left.counts, right.counts, groups, _sums(met, left.counts)]),
        joined(texts, np.cumsum(groups), ";"),
        pairs,
        valid,
    )


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sums of runs of ``values`` of these lengths."""
    running = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    ends = np.cumsum(counts)
    return running[ends] - running[ends - counts]


class _Document:
    """Sums over the parts of one text."""

    def __init__(self):
        self.counts, self.pairs, self.digest = np.zeros(4, np.int64), [], hashlib.sha256()
        self.valid = self.empty = True

    def add(self, counts: np.ndarray, text: str, pairs: np.ndarray, times: np.ndarray, valid: bool) -> None:
        self.counts += counts
        self.valid &= valid
        self.digest.update(((";" if not self.empty else "") + text).encode())
        self.pairs.append((pairs, times))
        self.empty = False

    def row(self) -> tuple[list[int], str, np.ndarray, np.ndarray]:
        if self.empty or not self.valid:
            return [0] * 4, "", np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs, times = self.pairs[0]
        if len(self.pairs) > 1:
            pairs, at = np.unique(np.concatenate([p for p, _ in self.pairs]), return_inverse=True)
            times = np.bincount(at, np.concatenate([t for _, t in self.pairs])).astype(np.int64)
        return self.counts.tolist(), self.digest.hexdigest(), pairs, times


def _align(pair: Pair, texts: pa.Array, first: bool, into: list[_Document]) -> None:
    """Adds texts, or parts of one text, to their documents."""
    if not first:
        texts = pc.utf8_slice_codeunits(texts, 1)  # the space it was cut at
    filled = np.asarray(pc.binary_length(texts)) > 0
    lists = pc.split_pattern(texts, " ")
    bounds = np.asarray(lists.offsets).astype(np.int64)
    flat = lists.flatten()
    last = np.zeros(len(flat), dtype=bool)
    last[bounds[1:] - 1] = True
    # cut at every space only where each is a place to cut; after the last word there is none
    open_word = np.asarray(pc.match_substring_regex(flat, _OPEN)) & ~(last & (np.asarray(pc.binary_length(flat)) > 0))
    simple = filled & (_sums(open_word, np.diff(bounds)) == 0)
    rest = np.flatnonzero(filled & ~simple)
    cut = [units(t) for t in texts.take(pa.array(rest)).to_pylist()]
    counts = np.where(simple, np.diff(bounds), 0)
    words = pa.concat_arrays(
        [flat.filter(pa.array(np.repeat(simple, np.diff(bounds)))), pa.array([w for ws in cut for w in ws], flat.type)]
    )
    rows = np.concatenate([np.flatnonzero(simple), rest])
    counts = np.concatenate([counts[simple], np.array([len(ws) for ws in cut], dtype=np.int64)])
    coded = words.dictionary_encode()
    found = align_units(pair, coded.dictionary)
    codes = np.asarray(coded.indices, dtype=np.int64)

    sums = np.column_stack([_sums(found.counts[codes, k], counts) for k in range(4)]).reshape(-1, 4)
    wrong = _sums(~found.valid[codes], counts)
    starts = np.cumsum(found.counts[:, 3]) - found.counts[:, 3]
    names, keys = found.texts.cast(pa.large_string()), len(pair.left.lengths) * len(pair.right.lengths)
    stops = np.cumsum(counts)
    for low, high in _chunks(counts, CHUNK_UNITS):
        begin = stops[low] - counts[low]
        mine = codes[begin : stops[high - 1]]
        offsets = pa.array(np.concatenate(([0], stops[low:high] - begin)), pa.int32())
        joined = pc.binary_join(pa.ListArray.from_arrays(offsets, names.take(pa.array(mine))), pa.scalar(";", pa.large_string()))
        met = found.pairs[ranges(starts[mine], found.counts[mine, 3])]
        numbered, times = np.unique(np.repeat(np.arange(high - low), sums[low:high, 3]) * keys + met, return_counts=True)
        edges = np.searchsorted(numbered, np.arange(high - low + 1) * keys)
        for k in range(low, high):
            own = slice(edges[k - low], edges[k - low + 1])
            into[rows[k]].add(sums[k], joined[k - low].as_py(), numbered[own] - (k - low) * keys, times[own], not wrong[k])


def _chunks(counts: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` units together, one text at least."""
    low, held = 0, 0
    for high, n in enumerate(counts.tolist()):
        if high > low and held + n > most:
            yield low, high
            low, held = high, 0
        held += n
    if len(counts):
        yield low, len(counts)


def aligned_documents(
    docs: DataFrame, byte_name: str = BYTE_TOKENIZER, piece_name: str = PIECE_MODEL, part_bytes: int = PART_BYTES
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and its
    linked ids: ``pairs`` (A's id times the size of B's vocabulary plus B's id) and ``times``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = per_worker(f"aligner {byte_name} {piece_name}", lambda: Pair(byte_name, piece_name))
        for batch in batches:
            done: list[tuple[int, _Document]] = []
            for rows, texts in parts(batch.column("text"), _CUT, part_bytes):
                again = len(done) == len(rows) == 1 and done[0][0] == rows[0]
                if not again:
                    if done:
                        yield _rows(batch.column("doc_id"), done)
                    done = [(row, _Document()) for row in rows.tolist()]
                _align(pair, texts, not again, [d for _, d in done])
            if done:
                yield _rows(batch.column("doc_id"), done)

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run,
        f"doc_id {doc_id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "pairs array<long>, times array<long>",
    )


def _rows(ids: pa.Array, done: list[tuple[int, _Document]]) -> pa.RecordBatch:
    found = [d.row() for _, d in done]
    offsets = pa.array(np.concatenate(([0], np.cumsum([len(f[2]) for f in found]))), pa.int32())
    return pa.RecordBatch.from_arrays(
        [
            ids.take(pa.array([row for row, _ in done], pa.int64())),
            *(pa.array([f[0][i] for f in found], pa.int64()) for i in range(4)),
            pa.array([f[1] for f in found], pa.string()),
            *(pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([f[i] for f in found]))) for i in (2, 3)),
        ],
        ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
    )


def pair_counts(found: DataFrame, wide: int) -> DataFrame:
    """Of ``aligned_documents``: pair, n (links that hold it), best (none of its B id has more).

    The highest counts, one for each id of B, are broadcast: the vocabulary bounds them.
    """
    each = found.select(F.inline(F.arrays_zip("pairs", "times")).alias("pair", "times"))
    counts = each.groupBy("pair").agg(F.sum("times").alias("n"))
    tops = counts.groupBy((F.col("pair") % wide).alias("_b")).agg(F.max("n").alias("_top"))
    return counts.join(F.broadcast(tops), F.col("pair") % wide == F.col("_b")).select(
        "pair", "n", (F.col("n") == F.col("_top")).alias("best")
    )


def align(
    spark: SparkSession,
    docs: DataFrame,
    byte_name: str = BYTE_TOKENIZER,
    piece_name: str = PIECE_MODEL,
    frequent: int = FREQUENT,
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256.

    Null and empty texts, and texts that a tokenizer does not spell as they are, have no
    tokens: zeros and an empty ``groups_sha256``. Repeated rows are aligned and counted each;
    null ids are kept. Other columns of ``docs`` are not read; an empty table gives an empty
    result.
    """
    import sentencepiece

    wide = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(piece_name)).get_piece_size()
    staged = stage(spark)
    found = staged.table(
        "documents", aligned_documents(docs, byte_name, piece_name).withColumn("_row", F.monotonically_increasing_id())
    )
    known = staged.table("counts", pair_counts(found, wide))

    total = known.agg(F.sum("n").alias("_total"))
    often = known.join(F.broadcast(total), F.expr(f"n * {frequent} > _total")).drop("_total")
    each = found.select("_row", F.inline(F.arrays_zip("pairs", "times")).alias("pair", "times"))
    met = each.join(F.broadcast(often), "pair", "left")
    rare = met.filter("n IS NULL").select("pair", "_row", "times").join(known, "pair")
    sums = None
    for part in (met.filter("n IS NOT NULL"), rare):
        part = part.groupBy("_row").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("n") * F.col("times")).alias("count_sum"),
        )
        sums = part if sums is None else sums.unionByName(part)
    sums = sums.groupBy("_row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return found.join(sums, "_row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256"
    )
