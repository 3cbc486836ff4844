"""Conflict-constrained best-fit packing of documents into bins of fixed capacity."""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from kinlink.llm.similar import GROUP, similar_groups
from kinlink.llm.store import cut


def best_fit(items: list[tuple[int, object, object]], capacity: int) -> list[tuple[int, int]]:
    """(bin, slot) for each item (length, source, cluster), in the order given.

    Bins stand in order of what room they have left. An item's search starts at the tightest that holds it and goes on to
    the next until one has neither its source nor its cluster; if none is left, a bin is opened. None conflicts with nothing.
    """
    order: list[tuple[int, int]] = []  # (room, bin)
    sources: list[int] = []
    clusters: list[int] = []
    counts: list[int] = []
    numbers: tuple[dict, dict] = ({}, {})
    out = []
    for length, source, cluster in items:
        s = 0 if source is None else 1 << numbers[0].setdefault(source, len(numbers[0]))
        c = 0 if cluster is None else 1 << numbers[1].setdefault(cluster, len(numbers[1]))
        for at in range(bisect_left(order, (length, -1)), len(order)):
            b = order[at][1]
            if not (sources[b] & s or clusters[b] & c):
                room = order.pop(at)[0]
                break
        else:
            b, room = len(counts), capacity
            sources.append(0)
            clusters.append(0)
            counts.append(0)
        sources[b] |= s
        clusters[b] |= c
        insort(order, (room - length, b))
        out.append((b, counts[b]))
        counts[b] += 1
    return out


def text_cluster(text: Column) -> Column:
    """Documents with the same words, case and white space aside, are of one cluster."""
    return F.xxhash64(F.lower(F.trim(F.regexp_replace(text, "[ \\t-\\r]+", " "))))


def pack(docs: DataFrame, capacity: int = 8192, group_rows: int = 2048, with_text: bool = False, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cluster: Column | None = None, length: Column | None = None) -> DataFrame:
    """(bin_id, slot, doc_id, piece, start, length, source, cluster, fill[, text]): where each piece of each document lies, and the used share of its bin.

    Lengths are code points unless given (as tokens, say; then texts can't be cut along). A document over capacity is cut
    into pieces of it, so whole texts are packed. Documents are dealt by hash of id, length, cluster and place in the
    input into groups of about group_rows, each packed by itself, longest first (ties by id, then text), so that groups
    stay bounded, also where all rows are equal, and a hot source is spread. No bin has two documents of one source or of
    one cluster (the same words, unless cluster is given). A null text is one empty piece; a null source or cluster
    conflicts with nothing; a null id stays null; repeated rows are documents of one cluster; an empty table gives no
    rows. Other columns are not read.
    """
    if length is not None and with_text:
        raise ValueError("texts are cut by code points only")
    text = F.col(text_col).cast("string")
    size = F.length(text) if length is None else length
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(size, F.lit(0)).cast("long").alias("n"), F.col(source_col).cast("string").alias("source"), (text_cluster(text) if cluster is None else cluster).cast("long").alias("cluster"), *([text.alias("text")] if with_text else []))
    rows = cut(rows)  # a row's place is the same whenever this table is read
    groups = max(1, -(-rows.count() // group_rows))
    rows = rows.withColumn("group", F.pmod(F.xxhash64("doc_id", "n", "cluster", F.monotonically_increasing_id()), F.lit(groups)))
    schema = "bin_id long, slot int, doc_id long, piece int, start long, length long, source string, cluster long, fill double" + ", text string" * with_text

    def run(table: pa.Table) -> pa.Table:
        columns = [table.column(c).to_pylist() for c in ("doc_id", "n", "source", "cluster")]
        texts = table.column("text").to_pylist() if with_text else [None] * table.num_rows
        pieces = []
        for d, n, s, c, t in zip(*columns, texts, strict=True):
            for k in range(max(1, -(-n // capacity))):
                length = min(capacity, n - k * capacity)
                pieces.append((d, k, k * capacity, length, s, c, t[k * capacity : k * capacity + length] if t is not None else None))
        pieces.sort(key=lambda p: (-p[3], p[0] is None, p[0] or 0, p[1], p[4] or "", p[5] or 0, p[6] or ""))
        placed = best_fit([(p[3], p[4], p[5]) for p in pieces], capacity)
        home = table.column("group")[0].as_py() << 32
        used: dict[int, int] = {}
        for (b, _), p in zip(placed, pieces, strict=True):
            used[b] = used.get(b, 0) + p[3]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.float64()] + [pa.string()] * with_text
        made = [(home + b, slot, *p[:6], used[b] / capacity, *p[6:]) for (b, slot), p in zip(placed, pieces, strict=True)]
        return pa.table([pa.array([m[i] for m in made], t) for i, t in enumerate(types)], names=[x.split()[0] for x in schema.split(", ")])

    return rows.groupBy("group").applyInArrow(run, schema)


def pack_apart(docs: DataFrame, capacity: int = 8192, with_text: bool = False, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """pack() with near copies (Jaccard >= 0.8 over five-word shingles, case aside) as clusters, so that none shares a bin with another.

    Null and wordless texts are one cluster. Otherwise as pack().
    """
    text = F.col(text_col).cast("string")
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.length(text).alias("n_points"), text.alias("text"))
    grouped = similar_groups(slim, keep=["doc_id", "source", "n_points", *["text"] * with_text])
    return pack(grouped, capacity, with_text=with_text, cluster=F.col(GROUP), length=None if with_text else F.col("n_points"))
