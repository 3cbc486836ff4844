"""Byte-level BPE on ragged numpy arrays: token counts by rank-synchronous merging, encoding by forced boundaries."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers.pre_tokenizers import ByteLevel

from kinlink.llm.text import flat_bytes, gather, slices, texts_of

#: Fixed value: the pre-token pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NONE = np.int64(1 << 40)


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files: itself where printable, else the next from U+0100."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


#: A character of each class that pre-tokens are cut by, none of which the pattern names by itself.
STANDS_FOR = {"letter": "x", "number": "0", "white": "\t", "other": "!"}


@lru_cache(maxsize=1)
def class_differences() -> dict[int, str]:
    """Code points that the library's Unicode tables class otherwise than the pattern's here, and a character of the class that it gives them."""
    library = ByteLevel(add_prefix_space=False, use_regex=True)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and c not in (0x20, 0x27)]
    every = "".join(points)
    whole = lambda text: len(library.pre_tokenize_str(text)) == 1
    here = regex.compile(r"(?P<letter>\p{L}+)|(?P<number>\p{N}+)|(?P<white>\s+)|(?P<other>[^\s\p{L}\p{N}]+)")
    mine = [""] * len(points)
    for m in here.finditer(every):
        mine[m.start() : m.end()] = [m.lastgroup] * (m.end() - m.start())
    out = {}
    for _, (a, b) in library.pre_tokenize_str(every):  # a run of one class
        c = every[a]
        theirs = "letter" if whole("a" + c) else "number" if whole("1" + c) else "other" if whole("!" + c) else "white"
        out |= {ord(every[i]): STANDS_FOR[theirs] for i in range(a, b) if mine[i] != theirs}
    return out


class PreTokens:
    """The cutting of texts into pre-tokens as the library does it, whatever Unicode version either has."""

    def __init__(self, differences: dict[int, str]):
        self.pattern, self.differences = regex.compile(PATTERN), differences
        self.some = frozenset(map(chr, differences))

    def cut(self, text: str) -> list[str]:
        if text.isascii() or self.some.isdisjoint(text):
            return self.pattern.findall(text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(text.translate(self.differences))]


class Vocabulary:
    """Arrays of one byte-level BPE file (tokenizers' .json): bounded by the vocabulary, so it travels with the job."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or before.get("type") != "ByteLevel" or spec["normalizer"]:
            raise ValueError(f"{path} is not a byte-level BPE vocabulary")
        told = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback") if model.get(k)]
        told += [k for k in ("lstrip", "rstrip", "single_word") if any(t.get(k) for t in spec["added_tokens"])]
        if told or before.get("add_prefix_space") or not before.get("use_regex", True):
            raise ValueError(f"{path} asks for what is not done here: {', '.join(told) or 'another cutting of pre-tokens'}")
        self.differences = class_differences()
        symbols, ids = byte_symbols(), spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*ids.values(), *self.special.values()]) + 1
        plain = {i: bytes(symbols[c] for c in token) for token, i in ids.items()}
        plain |= {i: content.encode() for content, i in self.special.items()}
        pieces = [plain.get(i, b"") for i in range(size)]
        self.token_bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.token_starts = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
        self.byte_ids = np.zeros(256, np.int64)
        for c, b in symbols.items():
            self.byte_ids[b] = ids[c]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([(ids[a] << 20) | ids[b] for a, b in merges], np.int64)
        # open addressing over pair keys; a slot holds a key and its rank
        self.bits = max(8, int(len(keys) * 8).bit_length())
        self.slot_keys, self.slot_ranks, self.probes = np.full((1 << self.bits) + 64, -1, np.int64), np.full((1 << self.bits) + 64, NONE), 0
        for rank, (key, slot) in enumerate(zip(keys.tolist(), self._slots(keys).tolist(), strict=True)):
            start = slot
            while self.slot_keys[slot] >= 0:
                slot += 1
            self.slot_keys[slot], self.slot_ranks[slot], self.probes = key, rank, max(self.probes, slot - start)
        self.merged = np.array([ids[a + b] for a, b in merges], np.int64)  # by rank
        #: inside[a, b]: some token holds byte a just before byte b. Where it is false, no merge can cross.
        self.inside = np.zeros((256, 256), bool)
        within = np.ones(len(self.token_bytes), bool)
        within[self.token_starts[1:][self.token_starts[1:] > 0] - 1] = False
        at = np.flatnonzero(within[:-1])
        self.inside[self.token_bytes[at], self.token_bytes[at + 1]] = True

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge rank of each pair, NONE where no merge has it."""
        key = (left << 20) | right
        slot = self._slots(key)
        there = self.slot_keys[slot]
        out = np.where(there == key, self.slot_ranks[slot], NONE)
        left_over = np.flatnonzero((there != key) & (there >= 0))
        for _ in range(self.probes):
            slot[left_over] += 1
            there = self.slot_keys[slot[left_over]]
            found = there == key[left_over]
            out[left_over[found]] = self.slot_ranks[slot[left_over[found]]]
            left_over = left_over[~found & (there >= 0)]
        return out


def merge(v: Vocabulary, symbols: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge every sequence of a ragged array to its end: in each round, each sequence's lowest-ranked pair everywhere in it.

    A pair that a merge makes always ranks after it, so a round's occurrences, taken from the left, are what one-by-one
    merging takes too. Finished sequences leave the working arrays.
    """
    n = len(offsets) - 1
    ends, done = np.diff(offsets).copy(), []
    which = np.flatnonzero(ends > 0)
    now, at = symbols, offsets[np.concatenate([which, [n]])] if len(which) else np.zeros(1, np.int64)
    while len(which):
        lengths = np.diff(at)
        ranks = np.full(len(now), NONE)
        last = np.zeros(len(now), bool)
        last[at[1:] - 1] = True
        pair = np.flatnonzero(~last)
        ranks[pair] = v.pair_ranks(now[pair], now[pair + 1])
        least = np.minimum.reduceat(ranks, at[:-1])
        over = least == NONE
        if over.any():
            keep = np.repeat(~over, lengths)
            done.append((which[over], now[~keep], lengths[over]))
            now, ranks, which, least, lengths = now[keep], ranks[keep], which[~over], least[~over], lengths[~over]
            at = np.concatenate([[0], np.cumsum(lengths)])
            if not len(which):
                break
        hit = np.flatnonzero(ranks == np.repeat(least, lengths))
        first = np.concatenate([[True], np.diff(hit) != 1])
        run = np.maximum.accumulate(np.where(first, np.arange(len(hit)), 0))
        hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
        now[hit] = v.merged[ranks[hit]]
        gone = np.zeros(len(now), bool)
        gone[hit + 1] = True
        now = now[~gone]
        at = np.concatenate([[0], np.cumsum(lengths - np.add.reduceat(gone, at[:-1], dtype=np.int64))])
    for rows, _, lengths in done:
        ends[rows] = lengths
    out_at = np.concatenate([[0], np.cumsum(ends)])
    out = np.zeros(out_at[-1], np.int64)
    for rows, values, lengths in done:
        inner = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out[np.repeat(out_at[rows], lengths) + inner] = values
    return out, out_at


def pre_tokens(v: Vocabulary, texts: list[str], cutter: PreTokens) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct pre-tokens, each text's codes of them in turn, and the texts' offsets. Special strings are pre-tokens of their own."""
    split = regex.compile("(" + "|".join(map(regex.escape, sorted(v.special, key=len, reverse=True))) + ")") if v.special else None
    found, counts = [], np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        before = len(found)
        if split is None or not any(s in t for s in v.special):
            found += cutter.cut(t)
        else:
            for part in split.split(t):
                found += [part] if part in v.special else cutter.cut(part)
        counts[i] = len(found) - before
    d = pa.array(found, pa.string()).dictionary_encode()
    return d.dictionary, d.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.concatenate([[0], np.cumsum(counts)])


def _encode_distinct(v: Vocabulary, distinct: pa.Array, forced: bool) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each distinct pre-token. forced: cut it first wherever no token can hold the two bytes."""
    data, at = flat_bytes(distinct)
    special = [(int(i), v.special[distinct[i].as_py()]) for i in np.flatnonzero(pc.is_in(distinct, pa.array(list(v.special), pa.string())).to_numpy(zero_copy_only=False))]
    symbols = v.byte_ids[data]
    cuts = at
    if forced and len(data):
        edge = np.zeros(len(data) + 1, bool)
        edge[at] = True
        edge[1:-1] |= ~v.inside[data[:-1], data[1:]]
        cuts = np.flatnonzero(edge)
    out, out_at = merge(v, symbols, cuts)
    out_at = out_at[np.searchsorted(cuts, at)] if forced and len(data) else out_at
    if special:
        lists = [out[a:b] for a, b in zip(out_at[:-1], out_at[1:], strict=True)]
        for i, token in special:
            lists[i] = np.array([token])
        out, out_at = np.concatenate(lists), np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    return out, out_at


def _sources(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of docs.

    One output row per input row, repeated rows included. A null text counts as empty (0 tokens); a null id stays null;
    other columns of docs are not read. Texts are whole, special strings count as their one token.
    """
    v = Vocabulary(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = PreTokens(v.differences)
        for batch in slices(batches, 16 << 20):
            texts = texts_of(batch)
            distinct, codes, at = pre_tokens(v, texts.to_pylist(), cutter)
            _, ends = _encode_distinct(v, distinct, forced=False)
            total = np.concatenate([[0], np.cumsum(np.diff(ends)[codes])])
            n = total[at[1:]] - total[at[:-1]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(flat_bytes(texts)[1])), pa.array(n), pa.array(n > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return _sources(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int), decoded (the ids' text) for each row of docs, by forced-boundary splitting.

    A null text is encoded as empty (no ids, empty text); a null id stays null; repeated rows repeat; other columns are not read.
    """
    return _encoded(docs, vocabulary, id_col, text_col, False)


def encode_digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode()'s results as digests, made where they arise."""
    return _encoded(docs, vocabulary, id_col, text_col, True)


def _encoded(docs: DataFrame, vocabulary: str, id_col: str, text_col: str, digests: bool) -> DataFrame:
    v = Vocabulary(vocabulary)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "doc_id long, ids array<int>, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = PreTokens(v.differences)
        for batch in slices(batches, 8 << 20):
            distinct, codes, at = pre_tokens(v, texts_of(batch).to_pylist(), cutter)
            ids, rows = gather(*_encode_distinct(v, distinct, forced=True), codes)
            rows = rows[at]
            back, ends = gather(v.token_bytes, v.token_starts, ids)
            ends, ids = ends[rows], ids.astype("<u4")
            spans, texts = list(zip(rows[:-1], rows[1:], strict=True)), list(zip(ends[:-1], ends[1:], strict=True))
            if digests:
                made = [pa.array(np.diff(rows)), pa.array([hashlib.sha256(ids[a:b]).hexdigest() for a, b in spans], pa.string()), pa.array([hashlib.sha256(back[a:b].tobytes().decode("utf-8", "replace").encode()).hexdigest() for a, b in texts], pa.string())]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            else:
                made = [pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)), pa.array(ids.astype(np.int32))), pa.array([back[a:b].tobytes().decode("utf-8", "replace") for a, b in texts], pa.string())]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], names=["doc_id", "ids", "decoded"])

    return _sources(docs, id_col, text_col).mapInArrow(run, schema)
