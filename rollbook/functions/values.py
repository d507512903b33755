"""Ids, categories, dates and money."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Mapping

from rollbook.config import DEFAULT_SETTINGS, Settings
from rollbook.functions.text import literal, strip, strip_lower

EARLIEST_DATE = "1970-01-01"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_ISO_DATE = r"^\d{4}-\d{1,2}-\d{1,2}([T ].*)?$"
_ZONE = r":.*(Z|[+-]\d{2}(:?\d{2})?)$"


def _lookup(values: Mapping[str, object], key: str, kind: str = "string") -> str:
    """The entry for ``key`` in a constant map; null where there is none."""
    entries = ", ".join(
        f"{literal(k)}, CAST({literal(v)} AS {kind})" for k, v in values.items()
    )
    return f"try_element_at(map({entries}), {key})"


def id_digits(stripped: str) -> str:
    """The whole part of a number, else the first digit run, without leading zeros.

    Empty for zero, null where there is no digit. Digits are kept exactly, however long
    the id is.
    """
    # ".5" is a number with nothing before the point
    number = f"IF(startswith({stripped}, '.') AND {stripped} RLIKE r'^\\.[0-9]+$', '0', {stripped})"
    return f"trim(LEADING '0' FROM get(regexp_extract_all({number}, '[0-9]+', 0), 0))"


def company_prefix(stripped: str, settings: Settings = DEFAULT_SETTINGS) -> str:
    return _lookup(settings.id_prefixes, stripped)


def padded_key(prefix: str, digits: str) -> str:
    """Prefix, hyphen and at least six digits; longer ids are never cut."""
    return f"concat({prefix}, '-', lpad({digits}, greatest(6, length({digits})), '0'))"


def employee_key(value: str, company: str, settings: Settings = DEFAULT_SETTINGS) -> str:
    """``1042`` / ``1042.0`` / ``ACQ_01042`` of a known company to ``GT-001042`` etc."""
    return padded_key(company_prefix(strip(company), settings), id_digits(strip(value)))


def type_of(lowered: str, settings: Settings = DEFAULT_SETTINGS) -> str:
    return _lookup(settings.employment_types, lowered)


def employment_type(value: str, settings: Settings = DEFAULT_SETTINGS) -> str:
    """Any known spelling to its category; unknown ones are null."""
    return type_of(strip_lower(value), settings)


def as_of_date(as_of: dt.date | None) -> str:
    """The start of the day that counts as today, without a zone."""
    day = "current_date()" if as_of is None else f"DATE'{as_of.isoformat()}'"
    return f"CAST({day} AS TIMESTAMP_NTZ)"


def standard_date(value: str, settings: Settings = DEFAULT_SETTINGS) -> str:
    """Text to a zone-free UTC timestamp; unparsed or out of [1970-01-01, as_of] is null."""
    return date_in_range(parsed_date(strip(value), settings), settings)


def date_in_range(date: str, settings: Settings = DEFAULT_SETTINGS) -> str:
    low, high = f"TIMESTAMP_NTZ'{EARLIEST_DATE}'", as_of_date(settings.as_of)
    return f"CASE WHEN {date} BETWEEN {low} AND {high} THEN {date} END"


def parsed_date(stripped: str, settings: Settings = DEFAULT_SETTINGS) -> str:
    """Text in ISO 8601 or one of the declared layouts to a zone-free UTC timestamp.

    A value with an offset is moved to UTC, one without is taken as it stands, whatever
    the session time zone is.
    """
    text = stripped
    zoned = f"convert_timezone('UTC', CAST(try_cast({text} AS TIMESTAMP) AS TIMESTAMP_NTZ))"
    shape = f"translate({text}, '{_DIGITS + _LETTERS}', '{'9' * len(_DIGITS) + 'a' * len(_LETTERS)}')"
    # one look-up tells which layouts the shape has; equal lists share a number
    lists: dict[tuple[str, ...], int] = {}
    numbers = [(s, lists.setdefault(tuple(ls), len(lists))) for s, ls in shapes(settings.date_layouts).items()]
    table = ", ".join(f"{literal(s)}, {number}" for s, number in numbers)
    cases = " ".join(
        f"WHEN {number} THEN CAST(coalesce({', '.join(f'try_to_timestamp({text}, {literal(p)})' for p in patterns)}) AS TIMESTAMP_NTZ)"
        for patterns, number in lists.items()
    )
    listed = f"CASE try_element_at(map({table}), {shape}) {cases} END" if cases else "CAST(NULL AS TIMESTAMP_NTZ)"
    return (
        f"CASE WHEN {text} RLIKE r'{_ISO_DATE}' THEN CASE WHEN {text} RLIKE r'{_ZONE}' "
        f"THEN {zoned} ELSE try_cast({text} AS TIMESTAMP_NTZ) END ELSE {listed} END"
    )


_DIGITS = "0123456789"
_LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
# The lengths of what a run of pattern letters stands for; other runs are as long as written.
_LENGTHS = {"d": (1, 2), "M": (1, 2), "H": (1, 2), "MMM": (3,), "MMMM": range(4, 10)}


def shapes(layouts: Iterable[str]) -> dict[str, list[str]]:
    """Each shape that a text of one of the layouts can have, to the layouts it may follow.

    In a shape every digit is a 9 and every letter an a; signs and blanks are themselves.
    """
    found: dict[str, list[str]] = {}
    for layout in layouts:
        options = [""]
        for run in re.findall(r"([A-Za-z])(\1*)|([^A-Za-z])", layout):
            letters = run[0] + run[1]
            if not letters:
                options = [o + run[2] for o in options]
                continue
            sign = "a" if len(letters) > 2 and run[0] == "M" else "9"
            options = [o + sign * n for o in options for n in _LENGTHS.get(letters, (len(letters),))]
        for shape in options:
            found.setdefault(shape, []).append(layout)
    return found


def bare_amount(value: str) -> str:
    """An amount without currency signs, thousands commas and outer white space."""
    return strip(without_signs(value))


def without_signs(value: str) -> str:
    return f"translate({value}, '$,€£', '')"


def salary_amount(value: str) -> str:
    """``$85,000`` to 85000.0; blank or unparsable is null."""
    # the pattern keeps out what only the cast would accept, such as "85000d"
    return f"try_cast(regexp_substr({bare_amount(value)}, r'{_NUMBER}') AS DOUBLE)"


def salary_factor(currency: str, frequency: str, settings: Settings = DEFAULT_SETTINGS) -> str:
    """Rate x periods per year for stripped texts; null where either is unknown."""
    key = f"concat(upper({currency}), '|', lower({frequency}))"
    return _lookup(settings.usd_factors(), key, "DECIMAL(10, 4)")


def annual_usd(bare: str, factor: str) -> str:
    """Bare amount x factor to two places.

    The arithmetic is decimal, so that the cents do not depend on the engine.
    """
    return f"CAST(round(try_cast({bare} AS DECIMAL(24, 6)) * {factor}, 2) AS DOUBLE)"


def salary_usd_annual(
    value: str, currency: str, frequency: str, settings: Settings = DEFAULT_SETTINGS
) -> str:
    """Raw amount, currency and frequency to annual USD; any unknown part gives null."""
    factor = salary_factor(strip(currency), strip(frequency), settings)
    return annual_usd(bare_amount(value), factor)


def day_gap(left: str, right: str) -> str:
    """Whole days between two timestamps: the signed difference floored, then absolute."""
    borrowed = f"CAST({_time_of_day(left)} < {_time_of_day(right)} AS INT)"
    return f"abs(datediff(CAST({left} AS DATE), CAST({right} AS DATE)) - {borrowed})"


def _time_of_day(value: str) -> str:
    return f"({value} - CAST(CAST({value} AS DATE) AS TIMESTAMP_NTZ))"


def day_number(value: str) -> str:
    return f"unix_date(CAST({value} AS DATE))"
