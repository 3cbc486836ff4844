"""Finding what documents share: anchors route every recurring stretch to one shard, and the shards' findings come back.

A window is a fixed number of units (bytes or words). The least hash of the short grams in a window is its anchor: equal
windows have equal anchors, and neighbouring windows mostly share theirs, so a stretch of windows with one anchor (a
segment) is what is dealt out. Only segments whose anchor occurs again can hold a recurring window, and all windows
equal to one of theirs are in the same shard. Hashes only route; what a shard finds, it finds on the units themselves.

Documents are dealt once into batches of a few MB. Each batch sends its anchors to buckets (five bytes each, grouped into
one row per batch and bucket), is told which of them recur, sends the segments of these to shards, and gets back the
ranges found there. Segments that several batches have are looked at once. Copies of a text take no part beyond one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kinlink.llm.store import cut
from kinlink.llm.text import CHUNK, binaries, flat, flat_bytes, inverses, mixed, powers, spaced, split_words, word_hashes

#: Bytes of text in a batch, and in what a bucket or a shard is meant to look after.
BATCH, BUCKET, SHARD = 4 << 20, 32 << 20, 2 << 20
NOTHING = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
MAIL = "batch long, kind int, key long, payload binary"
FOUND, RANGES, COPY = 0, 1, 2
#: The end of a range that takes in all of its segment.
ALL = (1 << 32) - 1


@dataclass(frozen=True)
class Kind:
    """What is compared: units 'bytes' or 'words', units in a window, units in a gram, whether ids order the documents."""

    unit: str
    window: int
    gram: int
    ordered: bool


class Units:
    """The units of some texts as 64-bit values, with the rows' offsets; cut(a, b) is the text of units a to b, words joined by one space."""

    def __init__(self, unit: str, texts: pa.Array):
        if unit == "bytes":
            self.values, self.at = flat_bytes(texts)
            text = self.values.tobytes()
            self.cut = lambda a, b: text[a:b]
        else:
            words, self.at = split_words(texts)
            text, starts = spaced(words)
            self.values, text, starts = word_hashes(text, starts), text.tobytes(), starts.tolist()
            self.cut = lambda a, b: text[starts[a] : starts[b] - 1]


def segments(units: Units, kind: Kind) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, first window, last window, anchor) of all segments, windows being named by the unit they start at; and the anchor at each place that is one."""
    block = units.at[:-1] // CHUNK
    edges = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [len(block)]])
    parts = [NOTHING]
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if b > a and (found := _segments(units.values[units.at[a] : units.at[b]], units.at[a : b + 1] - units.at[a], kind)):
            parts.append((found[0] + a, found[1] + units.at[a], found[2] + units.at[a], *found[3:]))
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def _segments(values: np.ndarray, at: np.ndarray, kind: Kind) -> tuple | None:
    n = len(values)
    if n < kind.window:
        return None
    # a gram's hash is the difference of two running sums, brought to the power its first unit would have at place 0
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(n), out=sums[1:])
    gram = mixed((sums[kind.gram :] - sums[: n - kind.gram + 1]) * inverses(n - kind.gram + 1))
    span = kind.window - kind.gram + 1
    least = _extreme(gram, span, np.minimum)
    # a gram is an anchor if it is the least of a window that holds it
    most = _extreme(np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)]), span, np.maximum)
    ok = np.ones(n, bool)
    for k in range(1, kind.window):  # windows may not leave their row
        place = at[1:] - k
        ok[place[place >= at[:-1]]] = False
    new = np.ones(len(least), bool)
    new[1:] = least[1:] != least[:-1]
    new[at[:-1][at[:-1] < len(new)]] = True
    new, end = np.flatnonzero(new & ok[: len(least)]), np.flatnonzero(np.concatenate([new[1:], [True]]) | ~ok[: len(least)])
    if not len(new):
        return None
    # a segment ends where the next begins, or before the first window that leaves the row
    stop = end[np.searchsorted(end, new)]
    last = np.where(ok[stop], stop, stop - 1)
    row = np.searchsorted(at, new, "right") - 1
    return row, new, last, least[new], gram[most == gram]


def _extreme(x: np.ndarray, span: int, of: Callable) -> np.ndarray:
    wide = 1
    while wide < span:
        step = min(wide, span - wide)
        x, wide = of(x[:-step], x[step:]), wide + step
    return x


class Batch:
    """One batch's documents in a fixed order, without those that only repeat another's text."""

    def __init__(self, table: pa.Table, mail: pa.Table, kind: Kind):
        ids, texts = table.column("doc_id").to_pylist(), table.column("text").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i] or ""))
        self.order = order
        self.kind, self.ids, self.texts = kind, [ids[i] for i in order], [texts[i] or "" for i in order]
        self.letters = list(zip(*(mail.column(c).to_pylist() for c in ("kind", "key", "payload")), strict=True))
        least = {p[:32]: int(p[32:]) if len(p) > 32 else None for k, _, p in self.letters if k == COPY}
        #: b"" (the text occurs once), b"r" (it stands for its copies) or b"c" (it is a copy)
        self.copy = [b""] * len(order)
        if least:
            for n, (i, t) in enumerate(zip(self.ids, self.texts, strict=True)):
                digest = hashlib.sha256(t.encode()).digest()
                if digest in least and not (kind.ordered and i is None):
                    self.copy[n] = b"r" if i == least[digest] else b"c"
        self.used = [n for n, (i, c) in enumerate(zip(self.ids, self.copy, strict=True)) if c != b"c" and not (kind.ordered and i is None)]
        self.units = Units(kind.unit, pa.array([self.texts[n] for n in self.used], pa.string()))
        self.row, self.first, self.last, self.anchor, self.places = segments(self.units, kind)

    def anchors(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchors and whether each occurs at several places here, be it in one segment, by bucket; and their buckets."""
        value, (there, count) = np.unique(self.anchor), np.unique(self.places, return_counts=True)
        several, bucket = count[np.searchsorted(there, value)] > 1, value % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        return value[order], several[order], bucket[order]

    def recurring(self, buckets: int) -> tuple[np.ndarray, list[int], list[int]]:
        """Indexes of the segments whose anchor recurs, the number of each one's text, and each text's first segment."""
        value = np.unique(self.anchor)
        order = np.argsort(value % np.uint64(buckets), kind="stable")
        found = np.zeros(len(value), bool)
        told = b"".join(p for _, p in sorted((key, p) for k, key, p in self.letters if k == FOUND))
        found[order] = np.frombuffer(told, bool)
        wanted = np.flatnonzero(found[np.searchsorted(value, self.anchor)]) if len(value) else np.zeros(0, np.int64)
        numbers, firsts, seen, cut_ = [], [], {}, self.units.cut
        for s, a, b in zip(wanted.tolist(), self.first[wanted].tolist(), (self.last[wanted] + self.kind.window).tolist(), strict=True):
            n = seen.setdefault(cut_(a, b), len(firsts))
            if n == len(firsts):
                firsts.append(s)
            numbers.append(n)
        self.rendered = list(seen)
        return wanted, numbers, firsts

    def covered(self, buckets: int) -> np.ndarray:
        """The mask over all units that the ranges found in shards make."""
        wanted, numbers, firsts = self.recurring(buckets)
        cover = np.zeros(len(self.units.values) + 1, np.int64)
        if len(wanted):
            number, lead = np.array(numbers), self.row[np.array(firsts)]
            ids = np.array([self.ids[n] or 0 for n in self.used], np.int64)
            # a lower id has the same segment in this very batch
            later = ids[self.row[wanted]] > ids[lead[number]] if self.kind.ordered else np.zeros(len(wanted), bool)
            low, high = self.first, self.last + self.kind.window
            np.add.at(cover, low[wanted[later]], 1)
            np.add.at(cover, high[wanted[later]], -1)
            segment, start, end = self.ranges()
            rest, number = wanted[~later], number[~later]
            a, b = np.searchsorted(segment, number), np.searchsorted(segment, number, "right")
            pick = np.repeat(a - np.concatenate([[0], np.cumsum(b - a)[:-1]]), b - a) + np.arange((b - a).sum())
            base, top = np.repeat(low[rest], b - a), np.repeat(high[rest], b - a)
            np.add.at(cover, base + start[pick], 1)
            np.add.at(cover, np.minimum(base + end[pick], top), -1)
        return np.cumsum(cover)[:-1] > 0

    def passages(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """(first unit, end) of each range that came back, at the first segment here that has its text."""
        _, _, firsts = self.recurring(buckets)
        segment, start, end = self.ranges()
        at = self.first[np.array(firsts, np.int64)[segment]]
        return at + start, at + end

    def ranges(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of the text, start, end) of all ranges that came back, by number."""
        found = np.frombuffer(b"".join(p for k, _, p in self.letters if k == RANGES), "<u4").reshape(-1, 3).astype(np.int64)
        found = found[np.argsort(found[:, 0], kind="stable")]
        return found[:, 0], found[:, 1], found[:, 2]


def _copies(docs: DataFrame, batch) -> DataFrame:
    """Mail to each batch that has a text which occurs several times: its digest and the least id."""
    marked = docs.select("doc_id", batch.alias("batch"), F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest"))
    # written, so that the join below is of plain tables, whose hot keys are split
    several = cut(marked.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "least"))
    homes = marked.select("batch", "digest").distinct()
    payload = F.concat("digest", F.encode(F.coalesce(F.col("least").cast("string"), F.lit("")), "utf-8"))
    return homes.join(several, "digest").select("batch", F.lit(COPY).alias("kind"), F.lit(0).cast("long").alias("key"), payload.alias("payload"))


def shared(docs: DataFrame, kind: Kind, locate: Callable, finish: Callable, schema: str, id_col: str = "doc_id", text_col: str = "text", carried: str | None = None) -> DataFrame:
    """Run the exchange that the module describes.

    locate(docs, weights, lengths, text): for the distinct segments of one shard, (segment, start, end) arrays of ranges
    of units; docs are least ids, weights the number of documents' places that have the segment.
    finish(batch, buckets): Arrow columns for schema, from what came back to a batch, a row for each of its documents.
    carried: a column of docs that goes with each document to its batch and stands in its row of the result, so that
    nothing need be joined to it again.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *([F.col(carried)] if carried else []))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches, buckets, shards = (total // size + 1 for size in (BATCH, BUCKET, SHARD))
    batch = F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches))
    dealt = docs.withColumn("batch", batch)
    copies = _copies(docs, batch)
    result = T.StructType([*T.StructType.fromDDL(schema), *([docs.schema[carried]] if carried else [])])
    arrow = to_arrow_schema(result)
    home = lambda table: table.column("batch")[0].as_py() if len(table) else 0

    def send_anchors(table: pa.Table, mail: pa.Table) -> pa.Table:
        value, several, bucket = Batch(table, mail, kind).anchors(buckets)
        edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else np.zeros(1, np.int64)
        # 39 bits of the anchor, and one that tells if it occurs at several places
        short = ((value >> np.uint64(24)) & ~np.uint64(1)) | several.astype(np.uint64)
        short = np.ascontiguousarray(short.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5])
        return pa.table([pa.array(bucket[edges[:-1]].astype(np.int64)), pa.array(np.full(len(edges) - 1, home(table), np.int64)), binaries(short, 5 * edges)], names=["bucket", "batch", "anchors"])

    def answer(table: pa.Table) -> pa.Table:
        short, count = flat(table.column("anchors"), "u1")
        wide = np.zeros((len(short) // 5, 8), np.uint8)
        wide[:, :5] = short.reshape(-1, 5)
        value = wide.view("<u8").ravel()
        _, back, times = np.unique(value >> np.uint64(1), return_inverse=True, return_counts=True)
        many = times > 1
        many[back[(value & np.uint64(1)) > 0]] = True
        edges = np.concatenate([[0], np.cumsum(count // 5)])
        return pa.table([table.column("batch"), pa.array(np.full(len(count), FOUND, np.int32)), table.column("bucket"), binaries(many[back].view(np.uint8), edges)], names=["batch", "kind", "key", "payload"])

    def send_segments(table: pa.Table, mail: pa.Table) -> pa.Table:
        b = Batch(table, mail, kind)
        wanted, numbers, firsts = b.recurring(buckets)
        lead = np.array(firsts, np.int64)
        ids = np.array([b.ids[n] or 0 for n in b.used], np.int64)
        twice = np.array([1 + (b.copy[n] == b"r") for n in b.used], np.float64)
        weight = np.bincount(np.array(numbers, np.int64), twice[b.row[wanted]], len(lead)).astype("<u4")
        shard = b.anchor[lead] % np.uint64(shards)
        order = np.argsort(shard, kind="stable")
        shard = shard[order]
        edges = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if len(order) else np.zeros(1, np.int64)
        texts = [b.rendered[i] for i in order.tolist()]
        length = np.array([len(t) for t in texts], "<u4")
        ends = np.concatenate([[0], np.cumsum(length, dtype=np.int64)])
        parts = [(order.astype("<u4"), 4 * edges), (ids[b.row[lead[order]]].astype("<i8"), 8 * edges), (weight[order], 4 * edges), (length, 4 * edges), (b"".join(texts), ends[edges])]
        keys = [pa.array(shard[edges[:-1]].astype(np.int64)), pa.array(np.full(len(edges) - 1, home(table), np.int64))]
        return pa.table([*keys, *(binaries(data, at) for data, at in parts)], names=["shard", "batch", "seg", "doc", "weight", "length", "text"])

    def look(table: pa.Table) -> pa.Table:
        seg, count = flat(table.column("seg"), "<u4")
        doc, weight, length = (flat(table.column(c), t)[0] for c, t in (("doc", "<i8"), ("weight", "<u4"), ("length", "<u4")))
        text = np.concatenate([flat_bytes(c)[0] for c in table.column("text").chunks])
        ends = np.concatenate([[0], np.cumsum(length, dtype=np.int64)])
        # a segment that several batches have is looked at once
        coded_ = pa.Array.from_buffers(pa.large_binary(), len(seg), [None, pa.py_buffer(ends), pa.py_buffer(text)]).dictionary_encode()
        code, distinct = coded_.indices.to_numpy(zero_copy_only=False), coded_.dictionary
        least = np.full(len(distinct), np.iinfo(np.int64).max)
        np.minimum.at(least, code, doc)
        lengths = pc.binary_length(distinct).to_numpy(zero_copy_only=False).astype(np.int64)
        found = locate(least, np.bincount(code, weight, len(distinct)).astype(np.int64), lengths, b"".join(distinct.to_pylist()))
        by = np.argsort(found[0], kind="stable")
        which, start, end = (x[by] for x in found)
        # every window of a segment that a lower id has too is covered
        whole = doc > least[code] if kind.ordered else np.zeros(len(seg), bool)
        rest = np.flatnonzero(~whole)
        a, b = np.searchsorted(which, code[rest]), np.searchsorted(which, code[rest], "right")
        pick = np.repeat(a - np.concatenate([[0], np.cumsum(b - a)[:-1]]), b - a) + np.arange((b - a).sum())
        owner = np.concatenate([np.flatnonzero(whole), np.repeat(rest, b - a)])
        none = np.zeros(whole.sum(), np.int64)
        triples = np.stack([seg[owner], np.concatenate([none, start[pick]]), np.concatenate([none + ALL, end[pick]])], 1).astype("<u4")
        home_ = np.repeat(np.arange(len(count)), count)[owner]
        order = np.argsort(home_, kind="stable")
        edges = np.searchsorted(home_[order], np.arange(len(count) + 1))
        out = pa.table([table.column("batch"), pa.array(np.full(len(count), RANGES, np.int32)), table.column("shard"), binaries(np.ascontiguousarray(triples[order]), 12 * edges)], names=["batch", "kind", "key", "payload"])
        return out.filter(pa.array(np.diff(edges) > 0))

    def gather(table: pa.Table, mail: pa.Table) -> pa.Table:
        if not len(table):
            return arrow.empty_table()
        b = Batch(table, mail, kind)
        columns = finish(b, buckets) + ([table.column(carried).take(pa.array(b.order)).cast(arrow.field(carried).type)] if carried else [])
        return pa.table(columns, schema=arrow)

    both = lambda mail, f, out: dealt.groupBy("batch").cogroup(mail.groupBy("batch")).applyInArrow(f, out)
    replies = both(copies, send_anchors, "bucket long, batch long, anchors binary").groupBy("bucket").applyInArrow(answer, MAIL)
    replies = copies.unionByName(replies)
    sent = both(replies, send_segments, "shard long, batch long, seg binary, doc binary, weight binary, length binary, text binary")
    marks = sent.groupBy("shard").applyInArrow(look, MAIL)
    return both(replies.unionByName(marks), gather, result)
