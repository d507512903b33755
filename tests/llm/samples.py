"""Texts for the tests of the text operators."""

import re

WORDS = "the of and rain stone river light over under green house walk slow idiot né früh día".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that operators also use as names of their own.
CLASHING = "kept int, n int, label string, pos long, lines string, _hot int, set_id string"


def words_of(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def prose(rng, n):
    out = []
    for i in range(n):
        word = rng.choice(WORDS) + rng.choice(["", "", "er", "ing", "s", "en"])
        out.append(word + rng.choice(["", "", "", ",", ".", ".\n"]))
    return " ".join(out)
