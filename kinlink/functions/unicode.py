"""Normal forms, scripts and Indic transliteration: what Spark has no built-in for, as Arrow batches."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, functions as F

#: The nine Indic scripts and their Unicode blocks, which share one layout.
INDIC = {"Devanagari": 0x900, "Bengali": 0x980, "Gurmukhi": 0xA00, "Gujarati": 0xA80, "Oriya": 0xB00, "Tamil": 0xB80, "Telugu": 0xC00, "Kannada": 0xC80, "Malayalam": 0xD00}
#: Letters rewritten first (Tamil nnna, Malayalam chillus and length mark, Oriya wa).
REWRITTEN = {"ன": "ந", "ൺ": "ണ്", "ൻ": "ന്", "ർ": "ര്", "ൽ": "ല്", "ൾ": "ള്", "ൿ": "ക്", "ൗ": "ൌ", "ୱ": "ବ"}
#: Latin forms by place in a block. Vowels stand alone at 05 to 14 and as signs at 3E to 4C.
VOWELS = dict(zip(range(0x05, 0x15), "a a i i u u r l ea e e ai oa o o au".split(), strict=True))
SIGNS = dict(zip(range(0x3E, 0x4D), "a i i u u r r ea e e ai oa o o au".split(), strict=True))
CONSONANTS = dict(zip(range(0x15, 0x3A), "k kh g gh ng ch ch j jh n t th d dh n t th d dh n n p ph b bh m y r r l l l v sh sh s h".split(), strict=True)) | dict(zip(range(0x58, 0x60), "k kh g j d dh ph y".split(), strict=True))
MARKS = {0x01: "m", 0x02: "m", 0x03: "h", 0x70: "m", 0x71: "", 0x4E: "t", 0x50: "om", 0x64: ".", 0x65: "."}
VIRAMA, NUKTA = 0x4D, 0x3C
#: Tamil writes each stop series with one letter, which comes out as the series' last sound.
TAMIL_STOPS = {0x15: "gh", 0x1A: "jh", 0x1F: "dh", 0x24: "dh", 0x2A: "bh"}


def normal_form(text: str | None) -> str:
    return unicodedata.normalize("NFKC", text or "").lower()


@lru_cache(maxsize=65536)
def _script_of(ch: str) -> str | None:
    if unicodedata.category(ch)[0] not in "LM":
        return None
    word = unicodedata.name(ch, "").split(" ")[0].capitalize()
    return {"Cjk": "CJK"}.get(word, word) or None


def script_of(text: str | None) -> tuple[str, bool]:
    """The most frequent script but Latin (first seen wins ties) and true; ('Latin', False) where all letters are Latin."""
    counts: dict[str, int] = {}
    for ch in () if not text or text.isascii() else text:
        s = _script_of(ch)
        if s and s != "Latin":
            counts[s] = counts.get(s, 0) + 1
    return (max(counts, key=counts.get), True) if counts else ("Latin", False)


def _latin(text: str, script: str) -> str:
    base, out, open_ = INDIC[script], [], False  # open_: a consonant whose inherent vowel is still due
    for ch in re.sub("|".join(REWRITTEN), lambda m: REWRITTEN[m[0]], text):
        place = ord(ch) - base
        if place == NUKTA or ch in "‌‍﻿":
            continue
        if open_ and place not in SIGNS and place != VIRAMA:
            out.append("a")
        open_ = False
        if place in CONSONANTS:
            out.append(TAMIL_STOPS.get(place, CONSONANTS[place]) if script == "Tamil" else CONSONANTS[place])
            open_ = True
        elif place in SIGNS or place in VOWELS:
            out.append(SIGNS.get(place) or VOWELS[place])
        elif 0x66 <= place <= 0x6F:
            out.append(str(place - 0x66))
        elif place != VIRAMA:
            out.append(MARKS.get(place, ch) if 0 <= place < 0x80 else ch)
    return "".join(out) + "a" * open_


def transliterate(name: str, script: str, cross: bool) -> tuple[str, bool, bool]:
    """(Latin form, handled, degenerate); other scripts pass through unhandled."""
    if not cross or script not in INDIC:
        return name, False, False
    try:
        out = " ".join(normal_form(_latin(name, script)).split())
    except (TypeError, ValueError):
        return name, False, True
    return (name, True, True) if not out else (out, True, not out.isascii())


def _beyond_ascii(c: Column) -> Column:
    return F.coalesce(c.rlike("[^\\x00-\\x7F]"), F.lit(False))


def nfkc_lower(c: Column) -> Column:
    """Normal form and lower case; null as empty. ASCII texts, which are in normal form, are lowered by the engine: Python gets nulls for them."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(normal_form, na_action="ignore")

    far = _beyond_ascii(c)
    return F.when(far, run(F.when(far, c))).otherwise(F.lower(F.coalesce(c, F.lit(""))))


def detect_script(c: Column) -> Column:
    """(script, is_cross_script); ASCII texts are Latin without Python."""

    @F.pandas_udf("script string, is_cross_script boolean")
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([script_of(x) for x in s], columns=["script", "is_cross_script"])

    far = _beyond_ascii(c)
    latin = F.struct(F.lit("Latin").alias("script"), F.lit(False).alias("is_cross_script"))
    return F.when(far, run(F.when(far, c))).otherwise(latin)


def transliterated(name: Column, script: Column, cross: Column) -> Column:
    """(name, handled, degenerate); rows that aren't cross-script pass without Python. What can't be read stays native, unhandled and degenerate."""

    @F.pandas_udf("name string, handled boolean, degenerate boolean")
    def run(n: pd.Series, s: pd.Series, x: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([transliterate(a, b, bool(c)) for a, b, c in zip(n, s, x, strict=True)], columns=["name", "handled", "degenerate"])

    some = F.coalesce(cross & script.isin(*INDIC), F.lit(False))
    passed = F.struct(name.alias("name"), F.lit(False).alias("handled"), F.lit(False).alias("degenerate"))
    only = lambda c: F.when(some, c)
    return F.when(some, run(only(name), only(script), only(cross))).otherwise(passed)
