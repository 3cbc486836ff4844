"""SimHash near-dedup: fingerprints of word shingles, and tiled exact comparison of them."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from kinlink.llm.graph import components
from kinlink.llm.store import cut, tidy
from kinlink.llm.text import slices, split_words, texts_of

#: A fingerprint's cell is the population counts of its four 16-bit quarters.
QUARTERS, LEVELS = 4, 17
#: Each byte's bits, the lowest first, as the bytes of a number.
LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view("<u8").ravel()


def majority(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The fingerprint of each row of hashes, whose offsets are at: a bit is set if it is in over half of them; 0 without any."""
    out = np.zeros((len(at) - 1, 8), np.uint8)
    some = np.flatnonzero(np.diff(at))
    if not len(some):
        return out.view(np.uint64).ravel()
    size = np.diff(at)[some]
    pieces = -(-size // 255)  # whose counts fit a byte
    home = np.cumsum(pieces) - pieces
    begin = np.repeat(at[:-1][some], pieces) + 255 * (np.arange(pieces.sum()) - np.repeat(home, pieces))
    by_byte = hashes[: at[-1]].view(np.uint8).reshape(-1, 8)
    for k in range(8):  # eight counts, one a bit, in the bytes of one number
        counts = np.add.reduceat(LANES[by_byte[:, k]], begin).view(np.uint8).reshape(-1, 8)
        ones = np.add.reduceat(counts, home, axis=0, dtype=np.int32)
        out[some, k] = np.packbits(2 * ones > size[:, None], axis=1, bitorder="little").ravel()
    return out.view(np.uint64).ravel()


def _fingerprints(texts: pa.Array, size: int) -> np.ndarray:
    """64-bit fingerprints: bit set if set in over half of the XXH64 (seed 42) of the shingles; 0 without words."""
    words, at = split_words(pc.ascii_lower(texts))
    n, counts = len(texts), np.diff(at)
    number = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    starts = np.concatenate([[0], np.cumsum(number)])
    first = np.repeat(at[:-1], number) + np.arange(starts[-1]) - np.repeat(starts[:-1], number)
    short = np.repeat(counts < size, number)
    rows = np.repeat(np.arange(n), number)
    joined = pc.binary_join_element_wise(*(words.take(pa.array(first[~short] + k)) for k in range(size)), " ")
    hashes = np.empty(starts[-1], np.uint64)
    digest = xxhash.xxh64_intdigest
    hashes[~short] = np.fromiter((digest(s, 42) for s in joined.to_pylist()), np.uint64, int((~short).sum()))
    for i in np.flatnonzero(short):
        r = rows[i]
        hashes[i] = digest(" ".join(words[int(at[r]) : int(at[r + 1])].to_pylist()), 42)
    return majority(hashes, starts)


def fingerprints(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) of every whole text; null and wordless texts have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4 << 20):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_fingerprints(texts_of(batch), size).view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def _forest(left: np.ndarray, right: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Edges enough to join what (left, right) join among n nodes: never more than n - 1."""
    parent, out = list(range(n)), []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        if (x := root(a)) != (y := root(b)):
            parent[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def links(distinct: DataFrame, radius: int = 2, tile: int = 2048) -> DataFrame:
    """(a, b) joining all distinct fingerprints (column fp) within radius bits, as a forest for each pair of tiles.

    Fingerprints within the radius have quarter counts that differ by no more in sum, so only tiles of such cells meet:
    the rest of the tile pairs are skipped. Every surviving pair of tiles is compared in full.
    """
    fp, quarters = F.col("fp"), []
    for k in range(QUARTERS):
        quarters.append(F.bit_count(F.shiftrightunsigned(fp, 16 * k).bitwiseAND(F.lit(0xFFFF))).cast("int"))
    cell = sum((q * LEVELS**k for k, q in enumerate(quarters)), F.lit(0))
    cells = distinct.select("fp", cell.cast("int").alias("cell"))
    sizes = cells.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    # at most 17^4 rows, whatever the input
    tiles = cells.join(F.broadcast(sizes), "cell").withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
    tiles = tiles.groupBy("cell", "tile").agg(F.collect_list("fp").alias("fps"))
    steps = [s for s in itertools.product(range(-radius, radius + 1), repeat=QUARTERS) if sum(map(abs, s)) <= radius]
    offsets = [sum(x * LEVELS**k for k, x in enumerate(s)) for s in steps if s >= (0,) * QUARTERS]  # each pair of cells once
    # a step beyond 0..16 leads to a cell of other counts: pairs there are compared for nothing, never lost
    left = tiles.select(F.col("cell").alias("from_cell"), F.col("tile").alias("from_tile"), F.col("fps").alias("left"), F.explode(F.array(*map(F.lit, offsets))).alias("step"))
    pairs = left.join(tiles, (F.col("from_cell") + F.col("step")) == F.col("cell")).where("step <> 0 or from_tile <= tile")
    pairs = pairs.select("left", F.col("fps").alias("right"), ((F.col("step") == 0) & (F.col("from_tile") == F.col("tile"))).alias("same"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found_a, found_b = [], []
            sides = [(c.flatten().to_numpy(), c.offsets.to_numpy() - c.offsets[0].as_py()) for c in (batch.column("left"), batch.column("right"))]
            same = batch.column("same").to_numpy(zero_copy_only=False)
            for i in range(batch.num_rows):
                a, b = (v[at[i] : at[i + 1]] for v, at in sides)
                near = np.bitwise_count(np.bitwise_xor.outer(a, b).view(np.uint64)) <= radius
                if same[i]:
                    near = np.triu(near, 1)
                p, q = np.nonzero(near)
                if len(p) > len(a):
                    joined = _forest(p, q if same[i] else q + len(a), len(a) + (0 if same[i] else len(b)))
                    p = np.array([x for x, _ in joined], np.int64)
                    q = np.array([y for _, y in joined], np.int64) - (0 if same[i] else len(a))
                found_a.append(a[p])
                found_b.append(b[q])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x or [np.zeros(0, np.int64)]), pa.int64()) for x in (found_a, found_b)], names=["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


@tidy
def near_groups(docs: DataFrame, size: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest id reachable by links of at most radius bits).

    One row per input row. Equal texts share one node, so copies are never paired; wordless and null texts share the
    fingerprint 0 and link like any other. A row with a null id belongs to its group but never names it (a group of
    null ids only has a null component_id). Empty table: no rows. Other columns are not read.
    """
    fps = cut(fingerprints(docs, size, id_col, text_col))
    nodes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    groups = components(links(nodes.select("fp"), radius)).withColumnsRenamed({"node": "fp", "component": "root"})
    rooted = cut(nodes.join(groups, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    # written, so that the engine splits a hot fingerprint in the join of all rows
    known = cut(rooted.select("fp", "root").join(named, "root").select("fp", "component_id"))
    return fps.join(known, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
