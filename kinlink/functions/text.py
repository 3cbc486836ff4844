"""Cleaning of names and addresses, and character trigrams, as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Unicode word characters, blanks, and the edges between words, for Java's ASCII-only shorthands.
W, S = r"[\p{L}\p{N}_]", r"[\s\p{Z}\x1C-\x1F\x85]"
EDGE = rf"(?:(?<={W})(?!{W})|(?<!{W})(?={W}))"
#: Literals that stand for a missing address, and for missing fields on loading.
ABSENT = ("", "null", "<null>", "n/a", "<n/a>", "none", "nan", "undefined")
FAKE_NULLS = ("n/a", "na", "null", "none", "-")


def squeezed(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, S + "+", " "), "^ | $", "")


def clean_name(raw: Column, normal: Column | None = None) -> Column:
    """The cleaned name, never empty; normal is a column of raw in normal form and lower case (lower(raw) suits ASCII)."""
    t = F.coalesce(normal if normal is not None else F.lower(raw), F.lit(""))
    # What links, domains, brackets and leading marks look like.
    t = F.regexp_replace(t, rf"{S}*\|{S}*(?:https?://)?(?:www\.)?[^\s\p{{Z}}]+", " ")
    t = F.regexp_replace(t, r"https?://(?:www\.)?", "")
    t = F.regexp_replace(t, rf"(?<!{W})www\.", "")
    t = F.regexp_replace(t, rf"\.(?:com|org|net|in|co|io)(?!{W})", "")
    t = F.regexp_replace(t, r"[\[\](){}<>]", " ")
    t = F.regexp_replace(t, rf"^(?:(?!{W})[\s\S])+", "")
    words = F.filter(F.split(squeezed(t), " "), lambda x: x != "")
    t = F.array_join(F.filter(words, lambda x, i: (i == 0) | (x != F.get(words, i - 1))), " ")
    kept = squeezed(F.coalesce(raw, F.lit("")))
    return F.when(F.coalesce(raw, F.lit("")) == "", "").when(t != "", t).when(kept != "", kept).otherwise("unknown")


def has_address(raw: Column) -> Column:
    return F.coalesce(~F.lower(squeezed(raw)).isin(*ABSENT), F.lit(False))


def clean_address(raw: Column, normal: Column | None = None) -> Column:
    """The cleaned address; empty where has_address is false."""
    t = normal if normal is not None else F.lower(raw)
    # What missing fields, number signs and runs of commas look like.
    t = F.regexp_replace(t, rf"{EDGE}(?:null|n/a|none|nan){EDGE}|<null>|<n/a>", "")
    t = F.regexp_replace(t, rf"#+{S}*", "")
    t = F.regexp_replace(t, rf"{S}*,{S}*", ", ")
    t = F.regexp_replace(t, rf"(?:,{S}*)+,", ",")
    t = F.regexp_replace(t, "^[, ]+|[, ]+$", "")
    return F.when(has_address(raw), squeezed(t)).otherwise("")


def ngrams(text: Column, n: int = 3, sentinels: tuple[str, ...] = ("nullname", "nulladdr")) -> Column:
    """Character n-grams with repeats; a shorter text is its own token; empty, null and sentinel texts have none."""
    t = F.coalesce(text, F.lit(""))
    grams = F.transform(F.sequence(F.lit(1), F.length(t) - (n - 1)), lambda i: F.substring(t, i, F.lit(n)))
    none = F.array().cast("array<string>")
    return F.when((t == "") | F.lower(F.trim(t)).isin(*sentinels), none).when(F.length(t) < n, F.array(t)).otherwise(grams)


def trigrams(text: Column) -> Column:
    return ngrams(text)


def tokens(text: Column) -> Column:
    """Distinct white-space tokens."""
    return F.array_distinct(F.filter(F.split(squeezed(F.coalesce(text, F.lit(""))), " "), lambda x: x != ""))


def numbers(text: Column) -> Column:
    """Distinct digit runs."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(\p{Nd}+)"), F.lit(1)))


def without_fake_nulls(c: Column) -> Column:
    return F.when(c.isNull() | F.lower(F.trim(c)).isin(*FAKE_NULLS), "").otherwise(c)
