"""Normalisation of names, addresses and countries as Column expressions.

The steps, in this order: null to blank; transliteration of rows with a
character outside Latin, and its stutters collapsed; accents stripped and case
folded; dotted acronyms joined; ampersands spelled out; abbreviations
expanded; letters parted from digits and all else than words turned into
single spaces; the stripped raw value where nothing is left.

All but transliteration are built-in expressions. After that step a text only
holds U+0000-024F, U+2000-206F and white space, so stripping accents and
folding case is a finite character map, generated here from ``unicodedata``.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.translit import transliterate

# Abbreviations and their full forms.
GENERAL = {
    "inc": "incorporated", "corp": "corporation", "co": "company",
    "llc": "limited liability company", "ltd": "limited",
    "llp": "limited liability partnership", "pvt": "private",
    "pc": "professional corporation", "sarl": "sarl", "sasu": "sasu", "sas": "sas",
}
ADDRESS = {
    "st": "street", "rd": "road", "ave": "avenue", "blvd": "boulevard",
    "apt": "apartment", "ste": "suite", "dr": "drive", "ln": "lane",
    "hwy": "highway", "nr": "near", "soc": "society",
    "socty": "society", "ind": "industrial", "coop": "cooperative",
}

# Python's notions of white space and word characters, in Java's dialect; what is Latin.
_BLANK = r"[\s\x1c-\x1f]"
_WORD = r"\p{IsAlphabetic}\p{Nd}_²³¹¼½¾"
NON_LATIN = r"(?U)[^\u0000-ɏ -⁯\s]"
#: Stand around an abbreviation that was found; a text's own count as blanks.
_MARKS = "\x02\x03"


def _fold_tables() -> tuple[dict[str, str], str, str]:
    """Characters that fold to several, and the two sides of a one-to-one map."""
    many, src, dst = {}, [], []
    for code in [*range(0x250), *range(0x2000, 0x2070)]:
        c = chr(code)
        folded = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn").casefold()
        if folded == c:
            continue
        if len(folded) == 1:
            src.append(c)
            dst.append(folded)
        else:
            many[c] = folded
    return many, "".join(src), "".join(dst)


_MANY, _FROM, _TO = _fold_tables()


def blank_if_null(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, rf"(?U)^{_BLANK}+|{_BLANK}+$", "")


def is_ascii(c: Column) -> Column:
    """Whether every character is ASCII, where the Unicode classes of the patterns below are the short ones."""
    return F.octet_length(c) == F.char_length(c)


def is_non_latin(c: Column) -> Column:
    c = blank_if_null(c)
    return ~is_ascii(c) & c.rlike(NON_LATIN)


def collapse_repeats(c: Column) -> Column:
    return F.regexp_replace(c, r"(.)\1{2,}", "$1$1")


def _either(c: Column, test: Callable[[Column], Column], yes: Callable[[Column], Column], no: Callable[[Column], Column] = lambda x: x) -> Column:
    """``yes`` or ``no`` of a text by a test of it; ``c`` is evaluated once."""
    return F.get(F.transform(F.array(c), lambda x: F.when(test(x), yes(x)).otherwise(no(x))), F.lit(0))


def _where(c: Column, pattern: str, change: Callable[[Column], Column]) -> Column:
    """``change`` of the texts that hold a pattern; one pass over the others."""
    return _either(c, lambda x: x.rlike(pattern), change)


def _fold(c: Column) -> Column:
    def mapped(x: Column) -> Column:
        for one, folded in _MANY.items():
            x = F.replace(x, F.lit(one), F.lit(folded))
        return F.translate(x, _FROM, _TO)

    return _either(c, is_ascii, F.lower, mapped)


def fold(c: Column) -> Column:
    """Accents stripped, case folded, white space stripped at both ends."""
    return strip(_fold(c))


def join_acronyms(c: Column, flags: str = "(?U)") -> Column:
    """``p.v.t.`` to ``pvt``: two or more single letters with dots, before a letter or digit.

    A dot goes if such a run goes on after it, or ends with it. The guard is a
    plain search, and leaves most texts out.
    """
    goes_on = r"(?<=\b[A-Za-z])\.(?=[A-Za-z]\.\w)"
    ends = r"(?<=\b[A-Za-z]\.[A-Za-z])\.(?=\w)"
    return _where(c, r"[A-Za-z]\.[A-Za-z]\.", lambda x: F.regexp_replace(x, f"{flags}{goes_on}|{ends}", ""))


def spell_ampersand(c: Column) -> Column:
    return _either(c, lambda x: F.contains(x, F.lit("&")), lambda x: F.regexp_replace(x, rf"(?U){_BLANK}*&{_BLANK}*", " and "))


def expand(c: Column, words: dict[str, str], flags: str = "(?U)") -> Column:
    """Whole-word abbreviations, plural or not, with the dot that follows if a word goes on after it.

    One pass marks them, and plain replacements put the full forms in. Where
    no abbreviation can begin, a look at one character ends the attempt.
    """
    c = _either(c, lambda x: F.contains(x, F.lit(_MARKS[0])) | F.contains(x, F.lit(_MARKS[1])), lambda x: F.translate(x, _MARKS, "  "))
    ahead = f"(?=[{''.join(sorted({w[0] for w in words}))}])" if words else ""
    c = F.regexp_replace(c, rf"{flags}\b{ahead}({'|'.join(words)})(s?)(?:\.\b|\b)", f"{_MARKS[0]}$1{_MARKS[1]}$2")

    def put(x: Column) -> Column:
        for key, value in words.items():
            x = F.replace(x, F.lit(f"{_MARKS[0]}{key}{_MARKS[1]}"), F.lit(value))
        return x

    return _either(c, lambda x: F.contains(x, F.lit(_MARKS[0])), put)


def clean(c: Column, gap: str = rf"(?U)[^{_WORD}]+") -> Column:
    """Letters parted from digits; words joined by single spaces."""
    c = _where(c, r"\d(?:[a-zA-Z]|(?<=[a-zA-Z]\d))", lambda x: F.regexp_replace(x, r"(?<=\d)(?=[a-zA-Z])|(?<=[a-zA-Z])(?=\d)", " "))
    return F.trim(F.regexp_replace(c, gap, " "))


def normalize(c: Column, words: dict[str, str], latin_only: bool = False) -> Column:
    """The whole chain. ``latin_only`` leaves out transliteration, and with it the only Python UDF."""
    raw = blank_if_null(c)
    text = raw
    if not latin_only:
        other = is_non_latin(raw)
        text = F.when(other, collapse_repeats(transliterate(F.when(other, raw)))).otherwise(raw)

    # Latin texts are ASCII once folded, save a few; blanks at the ends go with the last step
    def of_ascii(x: Column) -> Column:
        return clean(expand(spell_ampersand(join_acronyms(x, "")), words, ""), r"\W+")

    out = _either(_fold(text), is_ascii, of_ascii, lambda x: clean(expand(spell_ampersand(join_acronyms(x)), words)))
    return F.get(F.transform(F.array(out), lambda x: F.when(x == "", strip(raw)).otherwise(x)), F.lit(0))


def normalize_country(c: Column) -> Column:
    """Stripped and case-folded; accents stay."""
    return F.replace(F.lower(strip(blank_if_null(c))), F.lit("ß"), F.lit("ss"))
