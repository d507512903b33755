"""SentencePiece models of the merge type: exact encoding by backtracking, and decoding.

Merging picks, again and again, the best adjacent pair of a text. The same result can be
found from left to right: take the longest piece that fits, by an Aho-Corasick automaton
over all pieces, and accept it next to its neighbour only if merging the two pieces' text
from its characters ends in these two pieces. Where no piece is accepted, step back, note
the position in a bitfield of those that lead nowhere, and try a shorter piece. A sequence
in which all neighbours are accepted is the merged one, and there is only one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from rollbook.llm.words import Memo, parts, per_worker, split_spaces

MODEL = "piece_bpe_32k.model"
# How many a worker remembers, about 400 bytes each.
MOST_WORDS, MOST_UNITS = 200_000, 500_000
# How sentence pieces write a space.
SPACE = "▁"
# A space that starts a unit: pieces may hold several spaces in a row.
_APART = re.compile(f"(?<![ {SPACE}]) ")
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_NEVER = float("-inf")


class PieceModel:
    """The vocabulary of a model file, with what encoding and decoding look up.

    Models that this covers merge pairs (BPE), fall back to bytes, leave texts as they are
    apart from spaces, and put one space in front; others are refused.
    """

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        rules, trainer = proto.normalizer_spec, proto.trainer_spec
        covered = (
            trainer.model_type == trainer.BPE
            and trainer.byte_fallback
            and not trainer.treat_whitespace_as_suffix
            and not rules.precompiled_charsmap
            and rules.add_dummy_prefix
            and rules.escape_whitespaces
            and not rules.remove_extra_whitespaces
            and {p.type for p in proto.pieces} <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}
        )
        if not covered:
            raise ValueError(f"{path}: not a plain merge-type model with byte fallback")
        self.pieces = [p.piece for p in proto.pieces]
        self.kinds = [p.type for p in proto.pieces]
        normal = [i for i, kind in enumerate(self.kinds) if kind == _NORMAL]
        self.ids = {self.pieces[i]: i for i in normal}
        self.scores = {self.pieces[i]: proto.pieces[i].score for i in normal}
        self.bytes = {int(self.pieces[i][3:5], 16): i for i, kind in enumerate(self.kinds) if kind == _BYTE}
        self.others = {i for i, kind in enumerate(self.kinds) if kind != _NORMAL}
        self.spaced = [piece.replace(SPACE, " ") for piece in self.pieces]
        self.digits = [str(i) for i in range(len(self.pieces))]
        self.characters = {c for piece in self.ids for c in piece}
        self._pairs: dict[tuple[str, str], bool] = {}
        # pieces that merging never makes cannot stand in a merged text
        made = [piece for piece in self.ids if len(piece) == 1 or self.merged(piece) == [piece]]
        self.made = set(made)
        self.automaton = ahocorasick.Automaton()
        for piece in made:
            self.automaton.add_word(piece, len(piece))
        self.automaton.make_automaton()
        self.cut = self._cuts()

    def _cuts(self) -> re.Pattern:
        """Units of a text such that no piece reaches over the end of one.

        Letters part from other characters, and everything from a space after it, except
        characters that some piece has next to a letter.
        """
        beside = set()
        for piece in self.ids:
            for a, b in zip(piece, piece[1:]):
                if a.isalpha() != b.isalpha() and SPACE not in (a, b):
                    beside |= {c for c in (a, b) if not c.isalpha()}
        joining = "".join(re.escape(c) for c in sorted(beside))
        # \w also takes numbers such as a superscript two
        numbers = "".join(sorted(c for c in self.characters if re.match(r"[^\W\d_]", c) and not c.isalpha()))
        letter = rf"[^\W\d_{numbers}]"
        letter = rf"(?:{letter}|[{joining}])" if joining else letter
        other = rf"(?:(?!{letter})[^{SPACE}])"
        units = re.compile(rf"{SPACE}*(?:{letter}+|{other}+)|{SPACE}+", re.DOTALL)
        # kept only if it leaves every piece whole
        whole = all(units.fullmatch(p) and units.findall(p) == [p] for p in self.ids)
        return units if whole else re.compile(rf"{SPACE}*[^{SPACE}]+|{SPACE}+", re.DOTALL)

    def merged(self, text: str) -> list[str]:
        """The text's characters merged by score, best first and leftmost among equals."""
        symbols, scores = list(text), self.scores
        found = [scores.get(a + b, _NEVER) for a, b in zip(symbols, symbols[1:])]
        while found and (best := max(found)) > _NEVER:
            i = found.index(best)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            del found[i]
            if i:
                found[i - 1] = scores.get(symbols[i - 1] + symbols[i], _NEVER)
            if i < len(found):
                found[i] = scores.get(symbols[i] + symbols[i + 1], _NEVER)
        return symbols

    def fit(self, left: str, right: str) -> bool:
        """Whether the two pieces stay apart when their text is merged from its characters."""
        known = self._pairs.get((left, right))
        if known is None:
            if len(self._pairs) > 500_000:
                self._pairs.clear()
            known = left + right not in self.made and self.merged(left + right) == [left, right]
            self._pairs[left, right] = known
        return known

    def split(self, text: str) -> list[str]:
        """The merged pieces of a text whose characters all occur in pieces."""
        if text in self.made:
            return [text]
        longest = [0] * len(text)
        for end, length in self.automaton.iter(text):
            longest[end - length + 1] = length  # ends come in order: the last is the longest
        made, fit = self.made, self.fit
        failed = 0  # bit i: no accepted sequence goes on from position i
        found: list[str] = []
        start, length = 0, longest[0]
        while start < len(text):
            before = found[-1] if found else None
            while length:
                piece = text[start : start + length]
                if (
                    piece in made
                    and not failed >> (start + length) & 1
                    and (before is None or fit(before, piece))
                ):
                    break
                length -= 1
            if length:
                found.append(piece)
                start += length
                length = longest[start] if start < len(text) else 0
                continue
            failed |= 1 << start
            if before is None:
                raise ValueError(f"no merged form of {text!r}")
            found.pop()
            length = len(before) - 1
            start -= len(before)
        return found

    def unit_ids(self, unit: str) -> list[int]:
        """The ids of one unit; characters outside all pieces become their bytes."""
        if self.characters.issuperset(unit):
            return self._known_ids(unit)
        out: list[int] = []
        known = ""
        for c in unit:
            if c in self.characters:
                known += c
                continue
            if known:
                out += self._known_ids(known)
                known = ""
            out += [self.bytes[b] for b in c.encode()]
        return out + self._known_ids(known) if known else out

    def _known_ids(self, text: str) -> list[int]:
        ids = self.ids
        pieces = self.split(text)
        try:
            return [ids[piece] for piece in pieces]
        except KeyError:  # a character that only occurs inside longer pieces
            return [i for p in pieces for i in ([ids[p]] if p in ids else [self.bytes[b] for b in p.encode()])]

    def units(self, text: str) -> list[str]:
        return self.cut.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, text: str) -> list[int]:
        return [i for unit in self.units(text) for i in self.unit_ids(unit)]

    def decode(self, ids: list[int]) -> str:
        """The text of any ids: spaces restored, the one in front dropped, bytes joined."""
        if self.others.isdisjoint(ids):
            text = "".join([self.spaced[i] for i in ids])
            return text[1:] if ids and self.pieces[ids[0]].startswith(SPACE) else text
        out, held = [], bytearray()
        first = True
        for i in ids:
            if self.kinds[i] == _BYTE:
                held.append(int(self.pieces[i][3:5], 16))
                continue
            if held:
                out.append(_bytes_text(bytes(held)))
                held.clear()
                first = False
            if self.kinds[i] == _CONTROL:
                continue
            text = " ⁇ " if self.kinds[i] == _UNKNOWN else self.spaced[i]
            out.append(text[1:] if first and self.pieces[i].startswith(SPACE) else text)
            first = False
        if held:
            out.append(_bytes_text(bytes(held)))
        return "".join(out)


def _bytes_text(raw: bytes) -> str:
    """UTF-8, one replacement character for each byte that is part of none."""
    out = []
    while raw:
        try:
            return "".join(out) + raw.decode()
        except UnicodeDecodeError as e:
            out.append(raw[: e.start].decode() + "�")
            raw = raw[e.start + 1 :]
    return "".join(out)


def load_model(name: str = MODEL) -> PieceModel:
    return PieceModel(public_tokenizers.path(name))


def encode_and_decode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    The digests are SHA-256 in lower-case hexadecimal of the decimal ids joined by commas
    and of the decoded text in UTF-8. Whole texts are encoded, in parts that end where no
    piece crosses; without begin and end ids. A null or empty text has no ids. Repeated
    rows are encoded each. Other columns of ``docs`` are not read.
    """

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(f"pieces {model}", lambda: _DigestEncoder(load_model(model)))
        for batch in batches:
            counts, ids, texts = encoder.digests(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts), pa.array(ids), pa.array(texts)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_id}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(coded, schema)


class _DigestEncoder:
    """Encodes batches of texts; words met before cost one look-up."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.units = Memo(self._units, MOST_UNITS)
        self.words = Memo(self._words, MOST_WORDS)

    def _units(self, units: list[str]) -> list[tuple[int, bytes, bytes]]:
        """Of each unit: how many ids, the ids in decimal, its decoded text with all spaces."""
        out = []
        for unit in units:
            ids = self.model.unit_ids(unit)
            decoded = self.model.decode([self.model.ids["a"], *ids])[1:]
            digits = ",".join([self.model.digits[i] for i in ids])
            out.append((len(ids), digits.encode(), decoded.encode()))
        return out

    def _words(self, words: list[str]) -> list[tuple[int, bytes, bytes]]:
        cut = [self.model.cut.findall(SPACE + word) for word in words]
        found = iter(self.units([unit for word in cut for unit in word]))
        return [_joined([next(found) for _ in word]) for word in cut]

    def digests(self, texts: pa.Array) -> tuple[np.ndarray, list[str], list[str]]:
        counts = np.zeros(len(texts), dtype=np.int64)
        ids = [hashlib.sha256() for _ in range(len(texts))]
        decoded = [hashlib.sha256() for _ in range(len(texts))]
        begun = np.zeros(len(texts), dtype=bool)

        def add(row: int, n: int, id_text: bytes, text: bytes) -> None:
            if not n:
                return
            ids[row].update(b"," + id_text if begun[row] else id_text)
            # the space that was put in front of the whole text is dropped
            decoded[row].update(text if begun[row] else text[1:])
            begun[row] = True
            counts[row] += n

        # A part begins with a space, as its first unit does, so it loses it here to get it
        # back as every word does. Spaces in a row form pieces together, and so does a sign
        # for a space in the text: such parts are cut by the model's own pattern.
        odd_pattern = f"^ |  | $|{SPACE}"
        for rows, part in parts(texts, _APART):
            odd = np.asarray(pc.match_substring_regex(part, odd_pattern))
            words = split_spaces(part)
            known = self.words(words.unique.to_pylist())
            codes, bounds = words.codes.tolist(), words.bounds.tolist()
            for i, row in enumerate(rows.tolist()):
                if odd[i]:
                    text = part[i].as_py()
                    later = begun[row] or counts[row]
                    written = text.replace(" ", SPACE)
                    units = self.model.cut.findall(written if later else SPACE + written)
                    add(row, *_joined(self.units(units)))
                elif bounds[i] < bounds[i + 1]:
                    add(row, *_joined([known[c] for c in codes[bounds[i] : bounds[i + 1]]]))
        return counts, [h.hexdigest() for h in ids], [h.hexdigest() for h in decoded]


def _joined(found: list[tuple[int, bytes, bytes]]) -> tuple[int, bytes, bytes]:
    numbers, ids, texts = zip(*found) if found else ((), (), ())
    return sum(numbers), b",".join(ids), b"".join(texts)
