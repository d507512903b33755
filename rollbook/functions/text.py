"""Text normalisation; nothing here leaves the JVM."""

from __future__ import annotations

# The code points that count as white space when a value is stripped.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_SPACES = "".join(f"\\u{ord(c):04x}" for c in WHITE_SPACE)
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"
_CASE_RUNS = f"([{_CASED}]+|[^{_CASED}]+)"


def literal(value: object) -> str:
    """A quoted SQL string."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def strip(value: str) -> str:
    """Drop leading and trailing Unicode white space (``trim`` drops blanks only)."""
    return f"btrim({value}, '{_SPACES}')"


def strip_column(column: str) -> str:
    """``strip`` for a plain column, faster where there is nothing to drop.

    Text that begins and ends with a visible ASCII character is left alone; the ends are
    compared, which is cheaper than a search in the set of white space.
    """
    first = f"{column} >= '!' AND {column} < '\\u007f'"
    last = f"substr({column}, -1) BETWEEN '!' AND '~'"
    return f"CASE WHEN {first} AND {last} THEN {column} ELSE {strip(column)} END"


def strip_lower(value: str) -> str:
    return f"lower({strip(value)})"


def compatibility_form(value: str) -> str:
    """Unicode NFKC.

    ASCII text is its own NFKC form. Anything else goes through the ICU library that
    Spark itself ships, so no Python worker is needed.
    """
    icu = f"reflect('com.ibm.icu.text.Normalizer', 'compose', {value}, true)"
    return rf"CASE WHEN {value} RLIKE r'\P{{ASCII}}' THEN {icu} ELSE {value} END"


def title_case(value: str) -> str:
    """Upper-case the first letter of each run of letters, lower-case the others.

    ``initcap`` alone starts words only after blanks (``O'brien``, ``Jean-luc``), so
    it is applied to each run; plain words need no split.
    """
    runs = f"regexp_extract_all({value}, r'{_CASE_RUNS}', 1)"
    each = f"array_join(transform({runs}, run -> initcap(run)), '')"
    return f"CASE WHEN {value} RLIKE '^[A-Za-z ]*$' THEN initcap({value}) ELSE {each} END"


def tidy(value: str) -> str:
    """NFKC and stripped."""
    return strip(compatibility_form(value))


def title_or_null(tidied: str) -> str:
    return f"CASE WHEN {tidied} <> '' THEN {title_case(tidied)} END"


def person_name(value: str) -> str:
    """NFKC, stripped, title case; blank becomes null."""
    return title_or_null(tidy(value))


def full_name(first: str, last: str) -> str:
    """The parts that are present, joined by one blank; null when both are missing."""
    return f"nullif(concat_ws(' ', {first}, {last}), '')"


def sorted_tokens(value: str) -> str:
    """Words in code-point order joined by one blank: the form in which names are compared."""
    words = f"filter(split({value}, '[{_SPACES}]+'), word -> word <> '')"
    return f"array_join(array_sort({words}), ' ')"
