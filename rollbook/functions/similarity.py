"""Token-sort similarity: 100 x normalised Indel similarity of two strings.

Indel distance counts insertions and deletions only, so with ``n`` the two lengths
added and ``lcs`` the longest common subsequence it is ``n - 2 * lcs``.
"""

from __future__ import annotations

from fractions import Fraction

# A signed 64-bit word holds the match vector plus one carry bit. Longer strings take several
# words, and the carries of one are what the next one adds.
WORD_BITS = 61


def characters(text: str) -> str:
    return f"regexp_extract_all({text}, '(?s)(.)', 1)"


def character_masks(text: str) -> str:
    """For each word of ``text``, each distinct character to a bit set of the positions it
    occupies there: an array of maps.

    Depends on one string only, so it is computed once per string, not once per pair.
    """
    piece = f"substring({text}, _word * {WORD_BITS} + 1, {WORD_BITS})"
    # from the last character to the first, each moves the bits one place up
    mask = "aggregate(_chars, 0L, (m, d) -> shiftleft(m, 1) + IF(d = c, 1L, 0L))"
    masks = f"map_from_arrays(array_distinct(_chars), transform(array_distinct(_chars), c -> {mask}))"
    # an array of one gives the characters a name, so that they are taken apart once
    masks = f"get(transform(array(reverse({characters(piece)})), _chars -> {masks}), 0)"
    return f"transform(sequence(0, CAST(greatest(length({text}) - 1, 0) div {WORD_BITS} AS INT)), _word -> {masks})"


def lcs_length(left: str, left_masks: str, right: str) -> str:
    """Length of the longest common subsequence.

    One step per character of ``right`` on a bit vector over each word of ``left``.
    """
    full = f"(shiftleft(1L, length({left})) - 1L)"
    steps = f"transform({characters(right)}, c -> coalesce(try_element_at(get({left_masks}, 0), c), 0L))"
    advance = f"((v + (v & m)) | (v - (v & m))) & {full}"
    in_word = f"aggregate({steps}, {full}, (v, m) -> {advance}, v -> bit_count(~v & {full}))"
    return f"CASE WHEN size({left_masks}) = 1 THEN {in_word} WHEN size({left_masks}) > 1 THEN {_lcs_by_words(left, left_masks, right)} END"


def _lcs_by_words(left: str, left_masks: str, right: str) -> str:
    """The same word by word. Each hands on one carry for each character of ``right``, packed
    like the words themselves, so the work grows with the words times the characters."""
    bits = WORD_BITS
    full = f"shiftleft(1L, least(length({left}) - _at * {bits}, {bits})) - 1L"
    words = f"transform({left_masks}, (_masks_of_word, _at) -> struct(_masks_of_word AS masks, {full} AS full))"
    # the characters by as many as there are carries in a word
    last = f"CAST(greatest(length({right}) - 1, 0) div {bits} AS INT)"
    run = characters(f"substring({right}, _number * {bits} + 1, {bits})")
    runs = f"transform(sequence(0, {last}), _number -> {run})"
    # for each character: where it stands in this word, and the carry it meets
    steps = (
        "transform(_run.chars, (c, i) -> struct(coalesce(try_element_at(_word.masks, c), 0L) AS m, "
        "shiftright(_run.carries, i) & 1L AS carry))"
    )
    added = "(_state.v + (_state.v & _met.m) + _met.carry)"
    # carries come in at the top and move down, so that the first ends at the bottom
    step = (
        f"struct(({added} | (_state.v - (_state.v & _met.m))) & _word.full AS v, "
        f"shiftrightunsigned(_state.open + ({added} & {1 << bits}L), 1) AS open)"
    )
    one_run = (
        f"aggregate({steps}, struct(_past.v AS v, 0L AS open), (_state, _met) -> {step}, _state -> struct(_state.v AS v, "
        f"concat(_past.carries, array(shiftrightunsigned(_state.open, {bits} - size(_run.chars)))) AS carries))"
    )
    met = "transform(_runs, (_chars, _number) -> struct(_chars AS chars, get(_sofar.carries, _number) AS carries))"
    word = (
        f"aggregate({met}, struct(_word.full AS v, CAST(array() AS ARRAY<BIGINT>) AS carries), (_past, _run) -> {one_run}, "
        "_past -> struct(_past.carries AS carries, _sofar.found + bit_count(~_past.v & _word.full) AS found))"
    )
    nothing = "struct(array_repeat(0L, size(_runs)) AS carries, 0 AS found)"
    every = f"aggregate({words}, {nothing}, (_sofar, _word) -> {word}, _sofar -> _sofar.found)"
    return f"get(transform(array({runs}), _runs -> {every}), 0)"


def score(total_length: str, lcs: str) -> str:
    """The published form of the score; other algebraically equal forms round differently."""
    distance = f"CAST({total_length} - {lcs} * 2 AS DOUBLE)"
    return f"(1D - {distance} / ({total_length})) * 100D"


class Threshold:
    """Integer tests that follow from ``score >= threshold``; no rounding involved."""

    def __init__(self, threshold: float):
        exact = Fraction(str(threshold))
        if not 0 < exact <= 100:
            raise ValueError("similarity threshold must be above 0 and at most 100")
        self._numerator = exact.numerator
        self._hundred = 100 * exact.denominator

    def reached(self, total_length: str, lcs: str) -> str:
        return f"{lcs} * {2 * self._hundred} >= ({total_length}) * {self._numerator}"

    def budget(self, length: str, other: str) -> str:
        """Largest Indel distance two strings of these lengths may have.

        The distance has the parity of the two lengths added.
        """
        spare = self._hundred - self._numerator
        most = f"(({length} + {other}) * {spare} div {self._hundred})"
        return f"CAST({most} - pmod({most} - ({length} + {other}), 2) AS INT)"

    def longest_within(self, budget: int) -> float:
        """The length up to which two strings of equal length have at most this budget."""
        spare = self._hundred - self._numerator
        return budget * self._hundred / (2 * spare) if spare else float("inf")

    def partner_lengths(self, length: str) -> str:
        """All lengths a partner may have: the length difference alone costs that much."""
        num, top = self._numerator, 2 * self._hundred - self._numerator
        low = f"CAST(({length} * {num} + {top - 1}) div {top} AS INT)"
        high = f"CAST({length} * {top} div {num} AS INT)"
        return f"sequence(greatest({low}, 1), {high})"
