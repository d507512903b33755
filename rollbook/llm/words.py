"""Words of many texts at once, as Arrow dictionaries: each different word is met once.

A batch of texts is cut into parts of bounded bytes, so that memory stays bounded however
many rows an Arrow batch holds and however long its texts are. Long texts are cut only at
a white space character, where the callers' units end anyway.
"""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that are worked on at a time.
PART_BYTES = 4_000_000
_WHITE = re.compile("[ \\t\\n]")
# For ``parts`` of whole texts: it matches no place.
NOWHERE = re.compile("(?!)")


@dataclass
class Words:
    """``unique`` words; ``codes`` of all words in order; text i has codes[bounds[i]:bounds[i+1]]."""

    unique: pa.Array
    codes: np.ndarray
    bounds: np.ndarray


def split_white(texts: pa.Array) -> Words:
    """Runs of characters other than space and U+0009 to U+000D."""
    return _words(pc.ascii_split_whitespace(texts))


def split_spaces(texts: pa.Array) -> Words:
    """What stands between single spaces; empty words are dropped."""
    return _words(pc.split_pattern(texts, " "))


def _words(lists: pa.Array) -> Words:
    values, bounds = lists.flatten(), np.asarray(lists.offsets).astype(np.int64)
    bounds = bounds - bounds[0]
    real = np.asarray(pc.binary_length(values)) > 0
    if not real.all():
        bounds = np.concatenate(([0], np.cumsum(real)))[bounds]
        values = values.filter(pa.array(real))
    coded = values.dictionary_encode()
    return Words(coded.dictionary, np.asarray(coded.indices, dtype=np.int64), bounds)


def parts(texts: pa.Array, at: re.Pattern = _WHITE, part_bytes: int = PART_BYTES) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """(row numbers, texts) of at most about ``part_bytes``; nulls as empty texts.

    Texts longer than that come as several items of the same row number, in order; each
    but the first begins with a match of ``at``. A text without a match stays whole.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    sizes = np.asarray(pc.binary_length(texts))
    rows: list[int] = []
    held = 0
    for row, size in enumerate(sizes.tolist()):
        if size > part_bytes:
            if rows:
                yield np.array(rows), texts.take(pa.array(rows))
                rows, held = [], 0
            for piece in _pieces(texts[row].as_py(), at, part_bytes):
                yield np.array([row]), pa.array([piece], pa.large_string())
            continue
        if held + size > part_bytes or len(rows) >= 20_000:
            yield np.array(rows), texts.take(pa.array(rows))
            rows, held = [], 0
        rows.append(row)
        held += size
    if rows:
        yield np.array(rows), texts.take(pa.array(rows))
    # workers live on from stage to stage: what one needed is not kept from the next
    pa.default_memory_pool().release_unused()


def _pieces(text: str, at: re.Pattern, length: int) -> Iterator[str]:
    start = 0
    while found := at.search(text, start + length):
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


class Memo:
    """Values of words, worked out once per worker process; ``most`` bounds what it holds."""

    def __init__(self, work: Callable[[list[str]], list], most: int = 400_000):
        self._work, self._most, self._known = work, most, {}

    def __call__(self, words: list[str]) -> list:
        if len(self._known) > self._most:
            self._known.clear()
        get = self._known.get
        found = list(map(get, words))
        missing = [i for i, value in enumerate(found) if value is None]
        if missing:
            fresh = list(dict.fromkeys(words[i] for i in missing))
            self._known.update(zip(fresh, self._work(fresh), strict=True))
            for i in missing:
                found[i] = get(words[i])
        return found


def per_worker(key: str, make: Callable[[], Any]) -> Any:
    """What ``make`` returns, made once per Python worker, so that later tasks reuse it.

    It lies in a module of its own: the code of a task is unpickled for every task, and its
    globals with it.
    """
    name = "rollbook_worker_objects"
    kept = vars(sys.modules.setdefault(name, types.ModuleType(name)))
    if key not in kept:
        kept[key] = make()
    return kept[key]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, one range after the other."""
    ends = np.cumsum(lengths)
    out = np.arange(ends[-1] if len(ends) else 0, dtype=np.int64)
    return out + np.repeat(starts - (ends - lengths), lengths)
