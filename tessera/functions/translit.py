"""Transliteration to ASCII, for rows that hold a non-Latin character.

With the ``unidecode`` package installed its tables are used. Without it, a
character is taken in turn by: the name of a Hangul syllable or a kana, which
spells it; its compatibility decomposition; the small tables below for Cyrillic, Greek and the Indic scripts, which share one order
of letters; the Latin part of its Unicode name. What none of these knows is
left out. That is an approximation, and scripts without an alphabet stay poor.
"""

from __future__ import annotations

import logging
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_CYRILLIC = "a b v g d e zh z i i k l m n o p r s t u f kh ts ch sh shch ' y ' e iu ia".split()
_GREEK = "a b g d e z e th i k l m n x o p r s s t u ph kh ps o".split()
#: Letters from the block's 5th place on: vowels, then consonants by place of articulation.
_INDIC = "a aa i ii u uu r l e e e ai o o o au k kh g gh ng c ch j jh ny tt tth dd ddh nn t th d dh n n p ph b bh m y r r l ll l v sh ss s h".split()
_INDIC_SIGNS = "aa i ii u uu r rr e e e ai o o o au".split()


@lru_cache(maxsize=65536)
def ascii_of(c: str) -> str:
    code = ord(c)
    if code < 128:
        return c
    if c.lower() != c and len(c.lower()) == 1:
        return ascii_of(c.lower()).capitalize()
    name = unicodedata.name(c, "")
    if name.startswith(("HANGUL SYLLABLE ", "HIRAGANA LETTER ", "KATAKANA LETTER ")):
        # Their names spell them; a decomposition would lose the vowel or the voicing.
        return name.split(" ")[-1].lower()
    plain = "".join(x for x in unicodedata.normalize("NFKD", c) if ord(x) < 128)
    if plain:
        return plain
    base = unicodedata.normalize("NFD", c)[0]
    if base != c:
        return ascii_of(base)
    if unicodedata.category(c) == "Mn" and not 0x900 <= code < 0xD80:
        return ""
    if 0x430 <= code < 0x450:
        return _CYRILLIC[code - 0x430]
    if 0x3B1 <= code < 0x3CA:
        return _GREEK[code - 0x3B1]
    if 0x900 <= code < 0xD80:
        place = code % 0x80
        if 5 <= place < 5 + len(_INDIC):
            return _INDIC[place - 5]
        if 0x3E <= place < 0x3E + len(_INDIC_SIGNS):
            return _INDIC_SIGNS[place - 0x3E]
        if 0x66 <= place < 0x70:
            return str(place - 0x66)
        return "n" if place in (1, 2) else "h" if place == 3 else ""
    if c.isspace():
        return " "
    if unicodedata.category(c) == "Sc":
        return name.split(" ")[0][:3]
    for word in (" LETTER ", " SYLLABLE "):
        if word in name:
            part = name.split(word)[1].split(" ")[-1].lower()
            return part if word == " SYLLABLE " or len(part) < 3 else part[0]
    return ""


def ascii_text(text: str) -> str:
    try:
        from unidecode import unidecode
    except ImportError:
        return "".join(map(ascii_of, text))
    try:
        return unidecode(text)
    except Exception as e:  # the row keeps its text
        logging.getLogger(__name__).warning("not transliterated: %s", e)
        return text


@F.arrow_udf(StringType())
def transliterate(texts: pa.Array) -> pa.Array:
    """Null stays null, so rows that need nothing cost nothing."""
    return pa.array([None if t is None else ascii_text(t) for t in texts.to_pylist()], pa.string())
