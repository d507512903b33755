"""Token counts of whole texts, encoded in Arrow batches that hand back lengths only.

A batch is worked on in parts of bounded bytes; long texts are cut at white space, which no
token crosses. Within a part each different word is counted once, cut further at a place that no
token crosses either, so that a word with a comma costs a look-up, not an encoding. Units
that a worker has not met before go to the tokenizer in one batch.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from rollbook.llm.words import Memo, parts, per_worker, ranges, split_white

TOKENIZER = "word_bpe_49k.json"

# Units that are encoded as one text.
UNITS_AT_ONCE = 50_000
# How many units a worker remembers, about 200 bytes each.
MOST_UNITS = 800_000

# Where a word may be cut: after a run of Latin letters that it begins with, before ASCII
# punctuation or a digit. The tokenizer's pattern takes letters on their own, and no character
# combines with an ASCII one that follows it. Whatever is written otherwise stays in one piece.
_CUT = r"^([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-@\[-`{-~])"
# What shows that texts meet at white space and at such places, token for token.
_PROBES = (
    "A test's word, 12ab re-read #'s it's. naïve café! <|endoftext|>x y<|startoftext|>,z",
    "it’s é, ß… ﬁ Σας ΟΔΟΣ 中文 字.",
)


def load_tokenizer(name: str = TOKENIZER):
    """The tokenizer, for one thread; worker processes call this, not the driver."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


class UnitEncoder:
    """Encodes words without white space by their units."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], remembered: int):
        self._units = Memo(encode, remembered)

    def ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, unsigned 32-bit, and how many each word has."""
        cut = split_white(pc.replace_substring_regex(words, _CUT, r"\1 \2"))
        known = self._units(cut.unique.to_pylist())
        lengths = np.fromiter(map(len, known), np.int64, len(known)) // 4
        starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
        each = lengths[cut.codes]
        ids = np.frombuffer(b"".join(known), dtype="<u4")[ranges(starts[cut.codes], each)]
        return ids, np.diff(np.concatenate(([0], np.cumsum(each)))[cut.bounds])

    def __call__(self, words: list[str]) -> list[bytes]:
        """The ids of each word as little-endian unsigned 32-bit."""
        ids, lengths = self.ids(pa.array(words, pa.large_string()))
        ends = np.cumsum(lengths)
        return [ids[a:b].tobytes() for a, b in zip(ends - lengths, ends)]


def unit_encoder(name: str = TOKENIZER, remembered: int = MOST_UNITS) -> UnitEncoder:
    """The encoder that serves all tasks of a worker process.

    Once it remembers more than ``remembered`` units, it forgets them before the next part.
    """
    return per_worker(f"encoder {name} {remembered}", lambda: _unit_encoder(name, remembered))


def _unit_encoder(name: str, remembered: int) -> UnitEncoder:
    tokenizer = load_tokenizer(name)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values() if t.special and not (t.lstrip or t.rstrip)]

    def one_by_one(units: list[str]) -> list[bytes]:
        return [
            np.array(e.ids, dtype="<u4").tobytes()
            for e in tokenizer.encode_batch_fast(units, add_special_tokens=False)
        ]

    def encode(units: list[str]) -> list[bytes]:
        """Many units as one text, which takes half the time: a special token between them,
        that none of them holds, keeps them apart."""
        if not special or not all(units) or any(special[0] in unit for unit in units):
            return one_by_one(units)
        out: list[bytes] = []
        for start in range(0, len(units), UNITS_AT_ONCE):
            batch = units[start : start + UNITS_AT_ONCE]
            found = tokenizer.encode_batch_fast([special[0].join(batch)], add_special_tokens=False)[0].ids
            ids = np.array(found, dtype="<u4")
            cuts = 4 * np.flatnonzero(ids == tokenizer.token_to_id(special[0]))
            raw = ids.tobytes()
            pieces = [raw[a:b] for a, b in zip([0, *(cuts + 4).tolist()], [*cuts.tolist(), len(raw)])]
            out += pieces if len(pieces) == len(batch) else one_by_one(batch)
        return out

    units = UnitEncoder(encode, remembered)
    for probe in _PROBES:
        if b"".join(units(probe.split(" "))) != encode([probe])[0]:
            raise ValueError(f"{name} encodes words together; it cannot be used here")
    return units


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens.

    Whole texts are counted, without added special tokens; special strings inside a text
    count as the tokenizer takes them. A null or empty text has no bytes and no tokens.
    Repeated rows are counted each. Other columns of ``docs`` are not read.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = unit_encoder(tokenizer)
        for batch in batches:
            n_bytes = np.zeros(batch.num_rows, dtype=np.int64)
            n_tokens = np.zeros(batch.num_rows, dtype=np.int64)
            for rows, texts in parts(batch.column("text")):
                words = split_white(texts)
                _, lengths = encode.ids(words.unique)
                running = np.concatenate(([0], np.cumsum(lengths[words.codes])))
                np.add.at(n_tokens, rows, np.diff(running[words.bounds]))
                np.add.at(n_bytes, rows, np.asarray(pc.binary_length(texts)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_bytes), pa.array(n_tokens)], ["doc_id", "n_bytes", "n_tokens"]
            )

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(counted, f"doc_id {doc_id}, n_bytes long, n_tokens long")
