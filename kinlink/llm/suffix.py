"""Suffix-array dedup: bytes covered by a long string that starts in an earlier document too."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kinlink.llm.repeats import Batch, Kind, shared

#: Bytes sorted in one suffix array; a routed group with more is several shards, merged by binary search.
ARRAY_BYTES = 1 << 20
#: Bytes before the end of a removed run in which what is to be kept is looked for.
LOOK_BACK = 256
#: Bytes of common prefixes compared for all suffixes in step, before the few longer ones are compared one by one.
STEPS = 256
_MOST = np.iinfo(np.int64).max


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Suffixes in order, each read up to the zero byte that ends its segment; equal ones by place.

    Larsson and Sadakane's refinement: groups equal in h bytes are sorted by the rank h further on, h doubling; groups of
    one, and groups whose end lies within h, are done. Keys carry the place in their low bits, so plain sorts do.
    """
    n = len(data)
    bits = max(1, n.bit_length())
    place, low = np.arange(n, dtype=np.int64), (1 << bits) - 1
    first = min(5, (63 - bits) // 8)
    zeros = np.flatnonzero(data == 0)
    left = zeros[np.searchsorted(zeros, place)] - place  # bytes before the end
    key, alive = np.zeros(n, np.int64), np.ones(n, bool)
    for j in range(first):
        byte = np.zeros(n, np.int64)
        byte[: max(n - j, 0)] = data[j:]
        alive &= byte != 0
        key = (key << 8) | np.where(alive, byte, 0)
    key = np.sort((key << bits) | place)
    order, key = key & low, key >> bits
    new = np.concatenate([[True], key[1:] != key[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, place, 0))
    h, open_ = first, place
    while True:
        alone = new[open_] & np.concatenate([new, [True]])[open_ + 1]
        open_ = open_[~alone & (left[order[open_]] >= h)]
        if not len(open_):
            return order
        held = order[open_]
        group, then = rank[held], rank[held + h]
        if 3 * bits <= 63:
            packed = np.sort((((group << bits) | then) << bits) | held)
            held, packed = packed & low, packed >> bits
        else:
            packed = (group << bits) | then
            by = np.argsort(packed, kind="stable")
            held, packed = held[by], packed[by]
        order[open_] = held
        fresh = np.concatenate([[True], packed[1:] != packed[:-1]])
        new[open_] = fresh
        rank[held] = np.maximum.accumulate(np.where(fresh, open_, 0))
        h *= 2


def common_prefixes(data: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes each suffix shares with the one before it in order, after Kasai: in text order the length falls by one at most.

    It falls by exactly one wherever the byte before both suffixes is the same, so only the others are compared.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    at = np.arange(n)
    chained = (at > 0) & (before > 0)
    chained[1:] &= data[:-1] == data[np.maximum(before[1:], 1) - 1]
    chained[1:] &= data[:-1] != 0
    shared_ = np.zeros(n, np.int64)
    left = np.flatnonzero(~chained & (before >= 0))
    x, y = left, before[left]
    for _ in range(STEPS):
        here = data[x]
        ok = (here == data[y]) & (here != 0)
        left, x, y = left[ok], x[ok] + 1, y[ok] + 1
        shared_[left] += 1
    for i, p, q in zip(left.tolist(), x.tolist(), y.tolist(), strict=True):  # what is longer goes on by stretches
        shared_[i] += _common(data, p, q)
    head = np.maximum.accumulate(np.where(chained, 0, at))
    return np.maximum(shared_[head] - (at - head), 0)[order]


def _common(data: np.ndarray, p: int, q: int) -> int:
    """Bytes that the suffixes at p and q share, up to a zero byte; compared in stretches of doubling length."""
    done, step = 0, 64
    while True:
        most = min(step, len(data) - max(p, q) - done)
        a, b = data[p + done : p + done + most], data[q + done : q + done + most]
        stop = np.flatnonzero((a != b) | (a == 0))
        if len(stop) or not most:
            return done + int(stop[0] if len(stop) else 0)
        done, step = done + most, 2 * step


def _shard(data: np.ndarray, docs: np.ndarray, valid: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys, least, where, key of where): the sorted distinct strings that start at valid places, each one's least document, and the places."""
    order = suffix_array(data)
    new = common_prefixes(data, order) < size
    new[0] = True
    group = np.cumsum(new) - 1
    real = valid[order]
    where, group = order[real], group[real]
    fresh = np.concatenate([[True], group[1:] != group[:-1]])[: len(group)]
    heads = np.flatnonzero(fresh)
    least = np.minimum.reduceat(docs[where], heads) if len(heads) else np.zeros(0, np.int64)
    strings = np.lib.stride_tricks.sliding_window_view(data, size)[where[heads]] if len(heads) else np.zeros((0, size), np.uint8)
    return np.ascontiguousarray(strings).view(f"S{size}").ravel(), least, where, np.cumsum(fresh) - 1


def locate_repeats(docs: np.ndarray, lengths: np.ndarray, text: bytes, size: int, array_bytes: int = ARRAY_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, start, end) of the byte ranges covered by strings of `size` bytes that start in a document with a smaller id.

    Segments shorter than that hold none, and segments of one id don't count against each other.
    """
    raw, ends = np.frombuffer(text, np.uint8) + np.uint8(1), np.cumsum(lengths)
    starts = ends - lengths
    # shards of whole segments
    edges = np.flatnonzero(np.concatenate([[True], np.diff(ends // array_bytes) != 0, [True]]))
    shards, keys, least = [], np.zeros(0, f"S{size}"), np.zeros(0, np.int64)
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        long = lengths[a:b]
        data = np.zeros(int(long.sum()) + (b - a), np.uint8)  # a zero byte ends each segment; text bytes are shifted up by one
        place = np.arange(ends[b - 1] - starts[a]) + np.repeat(np.arange(b - a), long)
        data[place] = raw[starts[a] : ends[b - 1]]
        owner = np.repeat(np.arange(b - a), long + 1)
        first = np.cumsum(long + 1) - (long + 1)
        valid = np.arange(len(data)) - first[owner] + size <= long[owner]
        own, low, where, which = _shard(data, docs[a:b][owner], valid, size)
        at = np.searchsorted(keys, own)
        known = at < len(keys)
        known[known] = keys[at[known]] == own[known]
        least[at[known]] = np.minimum(least[at[known]], low[known])
        keys, least = np.insert(keys, at[~known], own[~known]), np.insert(least, at[~known], low[~known])
        shards.append((a, owner, first, own, where, which))
    out = []
    for a, owner, first, own, where, which in shards:
        low = least[np.searchsorted(keys, own)][which] if len(own) else np.zeros(0, np.int64)
        hit = np.sort(where[low < docs[a + owner[where]]])
        seg, offset = owner[hit] + a, hit - first[owner[hit]]
        new = np.concatenate([[True], (seg[1:] != seg[:-1]) | (offset[1:] != offset[:-1] + 1)])[: len(hit)]
        heads = np.flatnonzero(new)
        tails = np.concatenate([heads[1:], [len(hit)]])[: len(heads)] - 1
        out.append((seg[heads], offset[heads], offset[tails] + size))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _given_back(gone: np.ndarray, raw: bytes, pattern: re.Pattern) -> np.ndarray:
    """gone without what the pattern finds at the end of a removed run that text follows."""
    edges = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
    for a, b in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True):
        if b < len(raw) and (found := pattern.search(raw, max(a, b - LOOK_BACK), b)):
            gone[found.start() : b] = False
    return gone


def _suffix(docs: DataFrame, size: int, gram: int, id_col: str, text_col: str, digests: bool, keep: str | None = None, carried: str | None = None) -> DataFrame:
    kept_back = re.compile(keep.encode()) if keep else None

    def finish(b: Batch, buckets: int) -> list[pa.Array]:
        mask, place = b.covered(buckets), {n: i for i, n in enumerate(b.used)}
        columns = [], [], [], [], []
        for n, t in enumerate(b.texts):
            raw = t.encode()
            data = np.frombuffer(raw, np.uint8)
            if b.copy[n] == b"c":  # every string of a copy starts in the document it copies
                gone = np.full(len(data), len(data) >= size)
            elif n in place:
                gone = mask[b.units.at[place[n]] : b.units.at[place[n] + 1]]
            else:
                gone = np.zeros(len(data), bool)
            if kept_back:
                gone = _given_back(gone, raw, kept_back)
            kept = data[~gone].tobytes()
            spans = int(gone[:1].sum() + (np.diff(gone.astype(np.int8)) == 1).sum())
            last = hashlib.sha256(kept).hexdigest() if digests else kept.decode("utf-8", "ignore")
            for column, x in zip(columns, (b.ids[n], len(data), int(gone.sum()), spans, last), strict=True):
                column.append(x)
        return [pa.array(c, pa.int64()) for c in columns[:4]] + [pa.array(columns[4], pa.string())]

    def locate(ids, weights, lengths, text):
        return locate_repeats(ids, lengths, text, size)

    last = "kept_sha256" if digests else "text"
    return shared(docs, Kind("bytes", size, gram, True), locate, finish, f"doc_id long, n_bytes long, n_removed long, n_spans long, {last} string", id_col, text_col, carried)


def remove_repeats(docs: DataFrame, size: int = 50, gram: int = 18, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the remaining text of every row of docs; a character cut in two goes whole.

    Removed is each byte covered by a string of `size` bytes that also starts in a document with a smaller doc_id, as
    the input stands. A null text is empty; a row with a null id keeps its text and takes nothing from others; repeated
    rows repeat, and rows of one id don't count against each other; an empty table gives no rows.
    """
    return _suffix(docs, size, gram, id_col, text_col, False)


def remove_repeats_digests(docs: DataFrame, size: int = 50, gram: int = 18, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """remove_repeats() with kept_sha256, the digest of the remaining bytes, in place of the text."""
    return _suffix(docs, size, gram, id_col, text_col, True)


def without_repeats(docs: DataFrame, size: int = 50, gram: int = 18, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars", keep: str | None = None) -> DataFrame:
    """docs, all rows and columns kept whatever their names, with each text as remove_repeats() leaves it; length_col, where docs has it, gets the new length.

    keep: a pattern for what stays at the end of a removed run where text follows it, so that it isn't cut in two. Nulls,
    empty tables and repeated rows are as in remove_repeats(); a null text stays null.
    """
    of = lambda c: "`" + c.replace("`", "``") + "`"
    text, rest = F.col(of(text_col)), [c for c in docs.columns if c != text_col]
    # a document's other columns go with its text, which is dealt out once and never joined again
    rows = docs.select(F.col(of(id_col)).cast("long").alias("doc_id"), text.cast("string").alias("text"), F.struct(F.struct(*(F.col(of(c)) for c in rest)).alias("rest"), text.isNull().alias("none")).alias("row_"))
    made = _suffix(rows, size, gram, "doc_id", "text", False, keep, "row_")
    swap = {text_col: F.when(~F.col("row_.none"), F.col("text"))}
    if length_col in rest:
        swap[length_col] = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema[length_col].dataType)).otherwise(F.col(f"row_.rest.{of(length_col)}"))
    return made.select(*((swap[c] if c in swap else F.col(f"row_.rest.{of(c)}")).alias(c) for c in docs.columns))
