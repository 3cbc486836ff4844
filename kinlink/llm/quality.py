"""Quality rules: length and repetition counts, and Jensen-Shannon distance of each document's histograms to its language's."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from kinlink.llm.store import cut, tidy
from kinlink.llm.text import coded, flat_bytes, rows_of, slices, split_words, texts_of, windows_coded

#: Frequent function words by language, whose shares make the common-word histogram.
COMMON_WORDS = {
    "en": "the of and to in is that it was for on as with be at by this from or an".split(),
    "de": "der die und das ist in zu den von mit sich auf für im dem nicht ein eine als auch".split(),
    "fr": "le la les de des et un une est que dans pour qui sur pas au par plus ne du".split(),
    "es": "el la los de que y en un una es por con para se del las al lo como más".split(),
}
WORD_BINS = {w: i for i, w in enumerate(dict.fromkeys(w for words in COMMON_WORDS.values() for w in words))}
#: The languages that list a common word, as one bin for each set of languages; the last bin holds all other words.
LANGUAGE_BINS = {s: i for i, s in enumerate(dict.fromkeys(tuple(x for x in COMMON_WORDS if w in COMMON_WORDS[x]) for w in WORD_BINS))}
LANGUAGES_OF = np.array([LANGUAGE_BINS[tuple(x for x in COMMON_WORDS if w in COMMON_WORDS[x])] for w in WORD_BINS] + [len(LANGUAGE_BINS)], np.int64)
#: Character classes: lower, upper, digit, space, sentence marks, symbols, controls, beyond ASCII.
N_CLASSES = 8
CLASS_OF = np.full(256, 7, np.int64)
CLASS_OF[:128] = 5
CLASS_OF[:32], CLASS_OF[127] = 6, 6
for _class, _chars in ((0, b"abcdefghijklmnopqrstuvwxyz"), (1, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (2, b"0123456789"), (3, b" \t\n\v\f\r"), (4, b".,;:!?'\"()-")):
    CLASS_OF[list(_chars)] = _class

#: References of at most so many languages (under 1 KB each) are sent to every task; more are joined by key.
BROADCAST_LANGUAGES = 10_000

FEATURES = "lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_chars long, classes array<int>, common array<int>, languages array<int>"


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[at[1:]] - total[at[:-1]]


def _features(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts, n = texts_of(batch), batch.num_rows
    words, at = split_words(texts)
    row, (codes, distinct) = rows_of(at), coded(words)
    lines = pc.split_pattern(texts, "\n")
    line_row, flat = np.repeat(np.arange(n), pc.list_value_length(lines).to_numpy()), lines.flatten()
    real = pc.match_substring_regex(flat, "[^ \\t-\\r]").to_numpy(zero_copy_only=False)
    line_codes, kinds = coded(flat)
    line_row, line_codes = line_row[real], line_codes[real]
    once = np.unique(line_row * (len(kinds) + 1) + line_codes) // (len(kinds) + 1)
    dup_lines = np.bincount(line_row, minlength=n) - np.bincount(once, minlength=n)
    size = 8
    covered = np.zeros(len(codes) + 1, np.int64)
    windows = windows_coded(codes, size)
    inside = np.flatnonzero(row[: len(windows)] == row[size - 1 :][: len(windows)])
    if len(inside):
        key = row[inside] * (int(windows.max()) + 1) + windows[inside]
        _, back, count = np.unique(key, return_inverse=True, return_counts=True)
        hits = inside[count[back] > 1]
        covered += np.bincount(hits, minlength=len(covered)) - np.bincount(hits + size, minlength=len(covered))
    repeat = np.cumsum(covered)[:-1] > 0
    data, ends = flat_bytes(texts)
    lead = (data & 0xC0) != 0x80
    classes = np.bincount((rows_of(ends) * N_CLASSES + CLASS_OF[data])[lead], minlength=n * N_CLASSES).reshape(n, N_CLASSES)
    bins = len(WORD_BINS)
    bin_of = np.array([WORD_BINS.get(w.lower().strip(".,;:!?'\"()"), bins) for w in distinct.to_pylist()], np.int64)
    common = np.bincount(row * (bins + 1) + (bin_of[codes] if len(codes) else codes), minlength=n * (bins + 1)).reshape(n, bins + 1)
    languages = common @ (LANGUAGES_OF[:, None] == np.arange(len(LANGUAGE_BINS) + 1))
    ints = lambda a: pa.ListArray.from_arrays(pa.array(np.arange(0, a.size + 1, a.shape[1], dtype=np.int32)), pa.array(a.ravel().astype(np.int32)))
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    columns = [batch.column("doc_id"), batch.column("lang"), *(pa.array(np.asarray(x, np.int64)) for x in (np.diff(at), _sums(lengths, at), pc.count_substring_regex(texts, "[#*$%&|<>]").to_numpy(zero_copy_only=False), dup_lines, _sums(repeat, at), classes.sum(1))), ints(classes), ints(common), ints(languages)]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", *(x.split()[0] for x in FEATURES.split(", "))])


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Counts and histograms of every whole text; null text: none of anything. Ids are of any type, which they keep."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield _features(batch)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, {FEATURES}")


def _shares(counts: Column) -> Column:
    """Counts as shares of their sum, which is made once: in an enclosing lambda, as one inside the inner lambda runs for every bin."""
    total = F.array(F.aggregate(counts, F.lit(0.0), lambda s, y: s + y))
    return F.transform(total, lambda s: F.transform(counts, lambda x: F.try_divide(x, s)))[0]


def _divergence(p: str, q: str) -> Column:
    """Jensen-Shannon distance (square root of the base-2 divergence) of a count array and an array of shares; 0 where either is empty."""
    half = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    terms = F.zip_with(_shares(F.col(p)), F.col(q), lambda a, b: (half(a, (a + b) / 2) + half(b, (a + b) / 2)) / 2)
    return F.sqrt(F.greatest(F.lit(0.0), F.coalesce(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x), F.lit(0.0))))


@tidy
def quality(docs: DataFrame, max_class_distance: float = 0.18, max_word_distance: float = 0.6, max_language_distance: float = 0.25, min_chars: int = 200, min_words: int = 50, min_reference_docs: int = 30, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per input row: counts, base_failed, the three distances, kept.

    A language's reference for words is the sum, over all documents that pass the base rules and the length guards, of
    their histograms, and for character classes the median of each class's share in them, which junk among them does not
    move. A null language, or one with fewer than min_reference_docs such documents, has no reference: its documents are
    judged by the base rules only. Documents under min_chars (min_words) are not judged by the class (word and language)
    distance. Single words are too rare in short texts to tell a wrong language by; what languages the common words are
    of tells it, and tells texts without common words. Null or empty texts have
    no words and fail the base rules. Repeated rows repeat; a null id stays null; other columns are not read.
    """
    f = cut(features(docs, id_col, text_col, lang_col).withColumn("base_failed", F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words")))
    bins = {"classes": N_CLASSES, "common": len(WORD_BINS) + 1, "languages": len(LANGUAGE_BINS) + 1}
    sums = [F.array(*(F.sum(F.col(c)[i].cast("long")).cast("double") for i in range(n))).alias(f"{c}_ref") for c, n in bins.items() if c != "classes"]
    # shares in ten-thousandths: at most so many values are held for a median
    sums.append(F.array(*(F.percentile(F.round(F.col("classes")[i] * 10_000 / F.col("n_chars")).cast("int"), 0.5) for i in range(N_CLASSES))).alias("classes_ref"))
    sound = f.where(~F.col("base_failed") & (F.col("n_chars") >= min_chars) & (F.col("n_words") >= min_words))
    by_lang = sound.where("lang is not null").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), *sums).where(F.col("n") >= min_reference_docs)
    by_lang = cut(by_lang.select("lang", *(_shares(F.col(f"{c}_ref")).alias(f"{c}_ref") for c in bins)))
    # a language may hold most documents, so they are not dealt by it; where references are too many to send, both sides
    # are plain tables, and the engine splits the hot language
    small = by_lang.count() <= BROADCAST_LANGUAGES
    by_lang = by_lang.hint("broadcast" if small else "merge")
    joined = f.join(by_lang, "lang", "left")  # no reference: no distance
    joined = joined.withColumn("class_distance", F.when((F.col("n_chars") >= min_chars) & F.col("classes_ref").isNotNull(), _divergence("classes", "classes_ref")))
    joined = joined.withColumn("word_distance", F.when((F.col("n_words") >= min_words) & F.col("common_ref").isNotNull(), _divergence("common", "common_ref")))
    joined = joined.withColumn("language_distance", F.when((F.col("n_words") >= min_words) & F.col("languages_ref").isNotNull(), _divergence("languages", "languages_ref")))
    good = (F.coalesce("class_distance", F.lit(0.0)) <= max_class_distance) & (F.coalesce("word_distance", F.lit(0.0)) <= max_word_distance) & (F.coalesce("language_distance", F.lit(0.0)) <= max_language_distance)
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance", "language_distance", (~F.col("base_failed") & good).alias("kept"))
