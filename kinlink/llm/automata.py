"""Substring dedup by repeated-phrase automata: words covered by a window of words that occurs again anywhere.

Shards confirm the passages that recur; each batch compiles those that it has into automata and reads all its documents
through them, and what they hit is what goes.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from kinlink.llm.repeats import Batch, Kind, shared
from kinlink.llm.text import coded, gather, rows_of, split_words, windows_coded

#: Words of the phrases compiled into one automaton; a batch with more compiles several.
AUTOMATON_WORDS = 1 << 17
#: A word is so many letters long in an automaton as its number has digits to this base, so that no state has more edges.
BASE = 32


def _runs(mask: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of true in mask that stays in one row."""
    at = np.flatnonzero(mask)
    new = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(row[at]) != 0)])[: len(at)]
    head = np.flatnonzero(new)
    return at[head], at[np.concatenate([head[1:], [len(at)]])[: len(head)] - 1]


def confirm_passages(weights: np.ndarray, lengths: np.ndarray, text: bytes, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, start, end) of the passages in some segments: runs of windows that occur twice or more, weights counted, compared word by word.

    Segments with fewer words than a window have none.
    """
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    texts = pa.Array.from_buffers(pa.string(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(text)])
    words, at = split_words(texts)
    codes, _ = coded(words)
    row = rows_of(at)
    window = windows_coded(codes, size)
    ok = np.arange(len(window)) + size <= np.repeat(at[1:], np.diff(at))[: len(window)]
    counts = np.bincount(window[ok], weights=weights[row[: len(window)][ok]]) if ok.any() else np.zeros(1)
    first, last = _runs(ok & (counts[np.minimum(window, len(counts) - 1)] > 1), row)
    return row[first], first - at[row[first]], last + size - at[row[first]]


def phrases_of(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Where the phrases start that make up passages (start, end): one after the other, and the last `size` words."""
    number = -((starts - ends) // size)
    inner = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
    return np.minimum(np.repeat(starts, number) + inner * size, np.repeat(ends - size, number))


def occurrences(codes: np.ndarray, at: np.ndarray, phrases: np.ndarray, size: int, automaton_words: int) -> np.ndarray:
    """Mask of the words that any occurrence of a phrase covers; phrases are `size` words each and start at the given places.

    All documents (codes, with offsets at) are read through automata of about automaton_words words. Phrases are equally
    long, so a place ends one at most, and what is found never outgrows the documents. Each digit of a word's number has
    letters of its own, so that no match begins inside a word.
    """
    digits = 1
    while BASE**digits <= int(codes.max(initial=0)):
        digits += 1
    letters = np.stack([codes // BASE**k % BASE + 256 + k * BASE for k in range(digits)], 1).astype("<u4")
    read = lambda a, b: letters[a:b].tobytes().decode("utf-32-le")
    texts = [(a, read(a, b)) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True) if b - a >= size]
    hits = np.zeros(len(codes) + 1, np.int64)
    distinct = list(dict.fromkeys(read(a, a + size) for a in phrases.tolist()))
    shard = max(1, automaton_words // size)
    for k in range(0, len(distinct), shard):
        machine = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for phrase in distinct[k : k + shard]:
            machine.add_word(phrase)
        machine.make_automaton()
        for a, text in texts:
            end = np.fromiter((e for e, _ in machine.iter(text)), np.int64) // digits + 1 + a
            hits[end - size] += 1
            hits[end] -= 1
    return np.cumsum(hits)[:-1] > 0


def _phrases(docs: DataFrame, size: int, gram: int, id_col: str, text_col: str, digests: bool) -> DataFrame:
    def finish(b: Batch, buckets: int) -> list[pa.Array]:
        words, at = split_words(pa.array(b.texts, pa.string()))
        gone, n_words = np.zeros(len(words), bool), np.diff(at)
        rows = np.array(b.used, np.int64)
        starts, ends = b.passages(buckets)
        if len(starts):
            codes, inside = gather(coded(words)[0], at, rows)
            mask = occurrences(codes, inside, phrases_of(starts, ends, size), size, AUTOMATON_WORDS)
            gone[gather(np.arange(len(words)), at, rows)[0]] = mask
        for n, copy in enumerate(b.copy):
            if copy and n_words[n] >= size:  # every window of a text with copies recurs
                gone[at[n] : at[n + 1]] = True
        before = np.concatenate([[0], np.cumsum(gone)])
        kept = pa.ListArray.from_arrays(pa.array((at - before[at]).astype(np.int32)), words.filter(pa.array(~gone)))
        left = pc.binary_join(kept, " ")
        if digests:
            left = pa.array([hashlib.sha256(t.encode()).hexdigest() for t in left.to_pylist()], pa.string())
        return [pa.array(b.ids, pa.int64()), pa.array(n_words), pa.array(before[at[1:]] - before[at[:-1]]), left]

    def locate(ids, weights, lengths, text):
        return confirm_passages(weights, lengths, text, size)

    last = "kept_sha256" if digests else "text"
    return shared(docs, Kind("words", size, gram, False), locate, finish, f"doc_id long, n_words long, n_removed long, {last} string", id_col, text_col)


def remove_phrases(docs: DataFrame, size: int = 35, gram: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and the remaining words, joined by one space, of every row of docs.

    Removed is each word covered by a window of `size` words that also starts anywhere else, same document included, as
    the input stands. A null text has no words; rows with a null id count like others; repeated rows are documents like
    any, so they recur; an empty table gives no rows; other columns are not read.
    """
    return _phrases(docs, size, gram, id_col, text_col, False)


def remove_phrases_digests(docs: DataFrame, size: int = 35, gram: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """remove_phrases() with kept_sha256 in place of the text."""
    return _phrases(docs, size, gram, id_col, text_col, True)
