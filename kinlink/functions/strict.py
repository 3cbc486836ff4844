"""The strict cleaning variant: ASCII only, symbols as words, abbreviations written out, sentinels for empty outcomes."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F

from kinlink.functions.text import squeezed
from kinlink.functions.unicode import INDIC, script_of, transliterate

#: Abbreviations written out, in names and in addresses.
NAME_WORDS = {"corp": "corporation", "inc": "incorporated", "ltd": "limited", "pvt": "private", "co": "company", "intl": "international"}
ADDRESS_WORDS = {"st": "street", "rd": "road", "ave": "avenue", "blvd": "boulevard", "ln": "lane", "dr": "drive", "apt": "apartment", "fl": "floor"}
#: Country names that are one.
COUNTRIES = {"usa": "us", "united states": "us", "in": "india", "fr": "france"}


def has_indic(c: Column) -> Column:
    """Whether a text holds a character of the Devanagari block, the narrow test for cross-script rows."""
    return F.coalesce(c.rlike("[\\u0900-\\u097F]"), F.lit(False))


def nfkd_ascii(c: Column) -> Column:
    """The ASCII characters of a text's compatibility decomposition; ASCII texts don't go to Python."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode(), na_action="ignore")

    far = F.coalesce(c.rlike("[^\\x00-\\x7F]"), F.lit(False))
    return F.when(far, run(F.when(far, c))).otherwise(F.coalesce(c, F.lit("")))


def latin_tokens(c: Column) -> Column:
    """A text with its Indic words transliterated one by one and all others kept."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: re.sub(r"\S+", lambda m: transliterate(m[0], *script_of(m[0]))[0] if script_of(m[0])[0] in INDIC else m[0], t), na_action="ignore")

    far = F.coalesce(c.rlike("[^\\x00-\\x7F]"), F.lit(False))
    return F.when(far, run(F.when(far, c))).otherwise(F.coalesce(c, F.lit("")))


def expanded(c: Column, words: dict[str, str]) -> Column:
    """A lower-case text with abbreviations, as whole words, written out."""
    table = F.create_map(*(F.lit(x) for pair in words.items() for x in pair))
    return F.array_join(F.transform(F.split(c, " "), lambda w: F.coalesce(table[w], w)), " ")


def strict(c: Column, words: dict[str, str]) -> Column:
    """ASCII letters and digits in lower case, one space between words: dots go, @ and & become words, all else is a space; abbreviations are written out."""
    t = F.lower(nfkd_ascii(latin_tokens(c)))
    t = F.replace(F.replace(F.replace(t, F.lit("."), F.lit("")), F.lit("@"), F.lit(" at ")), F.lit("&"), F.lit(" and "))
    return expanded(squeezed(F.regexp_replace(t, "[^a-z0-9]+", " ")), words)


def or_sentinel(c: Column, entity_id: Column, sentinel: str) -> Column:
    """c, or where it is empty the sentinel and the entity's id, so that no two missing values are alike."""
    return F.when(F.coalesce(c, F.lit("")) == "", F.concat_ws(" ", F.lit(sentinel), entity_id)).otherwise(c)


def country_name(c: Column) -> Column:
    """A country's name in lower case, other names of one being one."""
    t = F.lower(F.trim(c))
    return F.coalesce(F.create_map(*(F.lit(x) for pair in COUNTRIES.items() for x in pair))[t], t)
