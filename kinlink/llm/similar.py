"""Near copies by SimHash fingerprints of word shingles, verified by Jaccard; what fingerprints miss is found by a prefix filter, a bound by sketches and whole sets."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from kinlink.llm.graph import components
from kinlink.llm.simhash import majority
from kinlink.llm.store import batches_of, cut, drop, tidy
from kinlink.llm.text import ODD, binaries, flat, rows_of, slices, spaced, split_words, texts_of, word_hashes

#: Shingles that HEAVY of about SAMPLE documents share come last in the order of shingles. This steers only the time taken.
SAMPLE, HEAVY = 8000, 16
#: Shingles of a document are counted in so many bins; the counts bound how many shingles two documents share.
BINS = 256
#: Bins that are compared first, and nodes of a token compared at a time.
COARSE, TILE = 64, 512
#: Bits that fingerprints of near copies may differ by; at a Jaccard of 0.8 some 10 of 64 do, 3 more or less.
RADIUS = 20
#: Orders of fingerprints, each led by another quarter of their bits.
TURNS = 4
#: Sets of more shingles have a second sketch, of a bin for each FINE of them or fewer.
LONG, FINE = 1024, 4
#: Shingles of documents, about a fifth of which are tokens, that a bucket is meant to look after.
BUCKET = 1 << 22
#: Tokens that are put in order of buckets at a time.
PACKED = 1 << 20
#: Shingles of a cluster's nodes that are held as one tile.
HELD = 1 << 22
#: Bytes of text whose shingles are made at a time, and rows that executors send to Python at a time: memory follows both.
SLICE, ROWS = 1 << 20, 2048
#: Bits of a filter for each of its values, the power of two that it has at most, and places that each value has in it.
FILTER, WIDEST, PLACES = 16, 27, 4
GROUP = "near_group"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _ordered(row: np.ndarray, load: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The order by (row, load, hash): by one key that holds the hash's upper bits, and by all of it should they not tell some apart."""
    kinds, load = np.unique(load, return_inverse=True)
    bits = int(row[-1] if len(row) else 0).bit_length() + (len(kinds) - 1).bit_length()
    if bits > 31:
        return np.lexsort((hashes, load, row))
    key = (row.astype(np.uint64) * np.uint64(1 << (len(kinds) - 1).bit_length()) + load.astype(np.uint64)) << np.uint64(64 - bits) if bits else np.zeros(len(row), np.uint64)
    key |= hashes >> np.uint64(bits)
    order = np.argsort(key)
    sorted_, upper = hashes[order], key[order]
    mixed_up = (upper[1:] == upper[:-1]) & (sorted_[1:] != sorted_[:-1])
    return np.lexsort((hashes, load, row)) if mixed_up.any() else order


def _shingles(texts: pa.Array, size: int, heavy: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of every text (64-bit hashes; the whole text where it has fewer words), in the order of (weight, hash), and offsets."""
    words, at = split_words(pc.ascii_lower(texts))
    of, counts = word_hashes(*spaced(words)), np.diff(at)
    number = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    row = np.repeat(np.arange(len(texts)), number)
    begin = np.cumsum(number) - number
    first = at[:-1][row] + np.arange(len(row)) - begin[row]
    of = np.concatenate([of, np.zeros(size, np.uint64)])
    sums = of[: len(words)].copy()
    for k in range(1, size):  # of all places, also those where a shingle would leave its row
        sums = sums * np.uint64(ODD) + of[k : k + len(words)]
    hashes = _mixed(sums[first])
    for i in np.flatnonzero((counts > 0) & (counts < size)).tolist():  # a short text is one shingle
        code = int(counts[i])
        for h in of[at[i] : at[i + 1]].tolist():
            code = (code * ODD + h) % (1 << 64)
        hashes[begin[i]] = _mixed(np.array([code], np.uint64))[0]
    place = np.minimum(np.searchsorted(heavy, hashes), max(len(heavy) - 1, 0))
    load = np.where(heavy[place] == hashes, weight[place], 0) if len(heavy) else np.zeros(len(hashes), np.int64)
    order = _ordered(row, load, hashes)
    row, hashes = row[order], hashes[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    return hashes[fresh], np.concatenate([[0], np.cumsum(np.bincount(row[fresh], minlength=len(texts)))])


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))


def _fine(hashes: np.ndarray, at: np.ndarray) -> pa.Array:
    """The second sketch of each long row, empty for others: counts in so many bins, a power of two, that few shingles share one."""
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        bits = (-(-(b - a) // FINE) - 1).bit_length()
        bins = np.bincount((hashes[a:b] >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits) if b - a > LONG else ()
        out.append(np.minimum(bins, 255).astype(np.uint8).tobytes())
    return pa.array(out, pa.binary())


def _nodes(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One hash of each row's set of shingles."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(hashes ^ np.uint64(0x9E3779B97F4A7C15)), dtype=np.uint64)])
    return _mixed((total[at[1:]] - total[at[:-1]]) ^ np.diff(at).astype(np.uint64)).view(np.int64)


def _places(values: np.ndarray, bits: int) -> np.ndarray:
    """The places of each value among so many bits, a row for each of PLACES hashes."""
    return np.stack([_mixed(values.view(np.uint64) + np.uint64((k + 1) * ODD % (1 << 64))) >> np.uint64(64 - bits) for k in range(PLACES)])


def _matching(values: DataFrame) -> Callable[[np.ndarray], np.ndarray]:
    """A function that tells of longs which ones may be in the only column of values: all that are, and of others one in 400 or so.

    Its bits are set by executors. A table of few of whose rows are asked for is filtered by it where it lies and need not
    be dealt out to be joined. Beyond 8 million values it lets more through, which costs time alone.
    """
    bits = min(WIDEST, max(16, (FILTER * values.count()).bit_length()))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.unique(_places(batch.column(0).to_numpy(), bits)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(place >> 16), pa.array((place & 0xFFFF).astype(np.int32))], names=["part", "place"])

    def set_(table: pa.Table) -> pa.Table:
        mask = np.zeros(1 << 16, bool)
        mask[table.column("place").to_numpy()] = True
        return pa.table([table.column("part").slice(0, 1), pa.array([np.packbits(mask).tobytes()], pa.binary())], names=["part", "bits"])

    made = np.zeros((1 << (bits - 16), 1 << 13), np.uint8)
    for r in values.mapInArrow(spread, "part long, place int").groupBy("part").applyInArrow(set_, "part long, bits binary").collect():
        made[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    made = made.ravel()

    def matching(x: np.ndarray) -> np.ndarray:
        place = _places(x, bits)
        return (made[place >> np.uint64(3)] >> (7 - (place & np.uint64(7))).astype(np.uint8) & 1).all(0)

    return matching


def _asked(rows: DataFrame, column: str, matching: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Rows whose column may be in the table that matching is made of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(found := np.flatnonzero(matching(batch.column(column).to_numpy()))):
                yield batch.take(pa.array(found))

    return rows.mapInArrow(run, rows.schema)


def _packed(batch: pa.RecordBatch, buckets: int) -> pa.RecordBatch:
    """The tokens of a batch's distinct nodes, one row a bucket: five bytes of the token, and its node, size and fingerprint, as binaries."""
    node, n, prefix = batch.column("node").to_numpy(), batch.column("n").to_numpy(), batch.column("prefix")
    fp = batch.column("fp").to_numpy()
    at = prefix.offsets.to_numpy().astype(np.int64)
    token = prefix.flatten().to_numpy().view(np.uint64)
    _, once = np.unique(node, return_index=True)
    some = np.zeros(len(node), bool)
    some[once] = True
    row = np.repeat(np.arange(len(node)), np.diff(at))
    keep = some[row]
    token, row = token[keep], row[keep]
    bucket = (token % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket, token, row = bucket[order], token[order], row[order]
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else np.zeros(1, np.int64)
    short = np.ascontiguousarray((token >> np.uint64(24)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5])
    made = [pa.array(bucket[edges[:-1]], pa.int64()), binaries(short, 5 * edges), binaries(node[row], 8 * edges), binaries(n[row].astype(np.int32), 4 * edges), binaries(fp[row], 8 * edges)]
    return pa.RecordBatch.from_arrays(made, names=["bucket", "token", "node", "n", "fp"])


def _met(table: pa.Table, threshold: float) -> pa.Table:
    """A bucket's tokens that several nodes have, (token, node, n), without nodes whose sizes rule out all others of the token; and, with a null token, (node, other): neighbours at a token, whose sizes allow the threshold.

    Nodes of a token stand side by side by their fingerprints, turned so that each quarter leads once, and neighbours
    within RADIUS bits are paired: pairs are as many as tokens, however many nodes have one. Tokens that five bytes don't
    tell apart are one, which gives candidates for nothing, but loses none.
    """
    short, node, n, fp = (flat(table.column(c), t)[0] for c, t in (("token", "u1"), ("node", "<i8"), ("n", "<i4"), ("fp", "<u8")))
    wide = np.zeros((len(node), 8), np.uint8)
    wide[:, :5] = short.reshape(-1, 5)
    home = table.column("bucket")[0].as_py() if len(table) else 0
    token = wide.view("<i8").ravel() | np.int64((home << 40) & ((1 << 63) - 1))
    order = np.lexsort((node, token))
    token, node, n, fp = token[order], node[order], n[order], fp[order]
    fresh = np.ones(len(token), bool)
    fresh[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
    token, node, n, fp = token[fresh], node[fresh], n[fresh], fp[fresh]
    same = token[1:] == token[:-1]
    met = (np.concatenate([same, [False]]) | np.concatenate([[False], same]))[: len(token)]
    token, node, n, fp = token[met], node[met], n[met], fp[met]
    pairs = [np.zeros((0, 2), np.int64)]
    for k in range(TURNS):
        turned = (fp << np.uint64(16 * k)) | (fp >> np.uint64(64 - 16 * k)) if k else fp
        order = np.lexsort((n, turned, token))
        t, x, size, bits = token[order], node[order], n[order], turned[order]
        at = np.flatnonzero((t[1:] == t[:-1]) & (np.bitwise_count(bits[1:] ^ bits[:-1]) <= RADIUS))
        at = at[_fit(size[at], size[at + 1], threshold)]
        pairs.append(np.stack([x[at], x[at + 1]], 1))
    pairs = np.unique(np.sort(np.concatenate(pairs), axis=1), axis=0)
    order = np.lexsort((n, token))
    token, node, n = token[order], node[order], n[order]
    close = (token[1:] == token[:-1]) & _fit(n[1:], n[:-1], threshold)
    some = (np.concatenate([close, [False]]) | np.concatenate([[False], close]))[: len(token)]
    token, node, n = token[some], node[some], n[some]
    m, k = len(token), len(pairs)
    columns = [pa.concat_arrays([pa.array(token), pa.nulls(k, pa.int64())]), pa.array(np.concatenate([node, pairs[:, 0]])), pa.concat_arrays([pa.array(n, pa.int32()), pa.nulls(k, pa.int32())]), pa.concat_arrays([pa.nulls(m, pa.int64()), pa.array(pairs[:, 1])])]
    return pa.table(columns, names=["token", "node", "n", "other"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches sorted by token, cut anew so that no token is in two of them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        token = batch.column("token").to_numpy()
        if not len(token):
            continue
        since = int(np.searchsorted(token, token[-1]))
        if since or (held and held[-1].column("token")[-1].as_py() != token[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, since)])
            held = []
        held.append(batch.slice(since))
    if held:
        yield pa.Table.from_batches(held)


class _Forest:
    """Trees of nodes that grow together edge by edge."""

    def __init__(self) -> None:
        self.above: dict[int, int] = {}

    def top(self, x: int) -> int:
        above = self.above
        while (up := above.get(x, x)) != x:
            above[x] = x = above.get(up, up)
        return x

    def tops(self, nodes: np.ndarray) -> np.ndarray:
        return np.fromiter(map(self.top, nodes.tolist()), np.int64, len(nodes))

    def grow(self, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        """The edges of these that join two trees."""
        out = []
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            p, q = self.top(x), self.top(y)
            if p != q:
                self.above[max(p, q)] = min(p, q)
                out.append((x, y))
        return out


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _others(rows: DataFrame, threshold: float) -> DataFrame:
    """(a, b): a forest that spans the pairs of nodes of different components with a token in common whose sizes and sketches leave the threshold possible.

    A token's nodes are compared where they lie, those of its largest component only with the others. Edges of a task are
    fewer than its nodes, however many pairs there are: who is to be compared by whole sets is in one tree.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = _Forest()
        for table in _runs(batches):
            token, node, n, component = (table.column(c).to_numpy() for c in ("token", "node", "n", "component"))
            sketch = flat(table.column("sketch"), "u1")[0].reshape(-1, BINS)
            order = np.lexsort((n, component, token))
            token, node, n, component, sketch = token[order], node[order], n[order].astype(np.int64), component[order], sketch[order]
            coarse = sketch.reshape(len(sketch), COARSE, -1).sum(2, dtype=np.int16)
            edges = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1], [True]]))
            found = []
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                kinds, first, count = np.unique(component[a:b], return_index=True, return_counts=True)
                if len(kinds) < 2:
                    continue
                top = int(count.argmax())
                rest = np.concatenate([np.arange(a, a + first[top]), np.arange(a + first[top] + count[top], b)])
                for i in range(0, len(rest), TILE):
                    left = rest[i : i + TILE]
                    for j in range(a, b, TILE):
                        right = np.arange(j, min(b, j + TILE))
                        x, y = np.nonzero((component[left][:, None] != component[right]) & _fit(n[left][:, None], n[right], threshold) & (forest.tops(node[left])[:, None] != forest.tops(node[right])))
                        x, y = left[x], right[y]
                        for counts in (coarse, sketch):
                            ok = _possible(_apart(counts, x, y), n[x], n[y], threshold)
                            x, y = x[ok], y[ok]
                        found += forest.grow(node[x], node[y])
            yield _edges(found)

    return rows.repartition("token").sortWithinPartitions("token").mapInArrow(run, "a long, b long")


def _joined(members: DataFrame, threshold: float) -> DataFrame:
    """(a, b): a forest that spans the links between nodes of one cluster and different components, by whole sets; members are (cluster, node, component, hashes).

    A cluster is dealt into tiles by its shingles, and each pair of tiles is a task, so that a large one is spread and held in parts.
    """
    sizes = members.groupBy("cluster").agg(F.ceil(F.sum(F.size("hashes")) / HELD).cast("int").alias("tiles"))
    dealt = members.join(sizes, "cluster").withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    met = dealt.withColumn("x", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).withColumn("low", F.least("tile", "x")).withColumn("high", F.greatest("tile", "x"))

    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("node").to_numpy(), kind="stable")
        node, component, tile = (table.column(c).to_numpy()[order] for c in ("node", "component", "tile"))
        lists = table.column("hashes").combine_chunks()
        at, flat_ = lists.offsets.to_numpy(), lists.values.to_numpy()
        sets = [np.sort(flat_[at[i] : at[i + 1]].view(np.uint64)) for i in order.tolist()]
        n = np.array([len(x) for x in sets], np.int64)
        bits = max(8, (int(np.median(n)) // FINE).bit_length())  # few shingles share a bin, also of long sets
        fine = np.stack([np.minimum(np.bincount((x >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 255) for x in sets]).astype(np.uint8)
        levels = [fine.reshape(len(fine), k, -1).sum(2, dtype=np.int16) for k in (COARSE, BINS)] + ([fine] if bits > 8 else [])
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        sides, forest, found = (np.flatnonzero(tile == low), np.flatnonzero(tile == high)), _Forest(), []
        for i in range(0, len(sides[0]), TILE):
            left = sides[0][i : i + TILE]
            for j in range(i if low == high else 0, len(sides[1]), TILE):
                right = sides[1][j : j + TILE]
                x, y = np.nonzero((component[left][:, None] != component[right]) & (left[:, None] < right if low == high else True) & _fit(n[left][:, None], n[right], threshold))
                x, y = left[x], right[y]
                for counts in levels:
                    ok = _possible(_apart(counts, x, y), n[x], n[y], threshold)
                    x, y = x[ok], y[ok]
                for p, q in zip(x.tolist(), y.tolist(), strict=True):
                    if forest.top(int(component[p])) != forest.top(int(component[q])):
                        shared = len(np.intersect1d(sets[p], sets[q], assume_unique=True))
                        if shared >= threshold * (n[p] + n[q] - shared) - 1e-9:
                            forest.grow(component[p : p + 1], component[q : q + 1])
                            found.append((int(node[p]), int(node[q])))
        return pa.Table.from_batches([_edges(found)])

    return met.groupBy("cluster", "low", "high").applyInArrow(run, "a long, b long")


def _fit(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Whether sets of these sizes can have the Jaccard."""
    return np.minimum(x, y) >= threshold * np.maximum(x, y) - 1e-9


def _apart(sketch: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The sum of what the bins of the sketches of rows x and y differ by: sets differ at least by that. So many pairs at a time that memory stays in bounds."""
    out = np.zeros(len(x), np.int64)
    for a in range(0, len(x), 8192):
        b = a + 8192
        out[a:b] = np.abs(sketch[x[a:b]].astype(np.int16) - sketch[y[a:b]].astype(np.int16)).sum(1, dtype=np.int64)
    return out


def _possible(differ: np.ndarray, n: np.ndarray, m: np.ndarray, threshold: float) -> np.ndarray:
    """Whether sets of n and m that differ by so much or more can have the Jaccard."""
    return differ * (1 + threshold) <= (1 - threshold) * (n.astype(np.int64) + m) + 1e-6


def _bounded(pairs: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose sketches leave the threshold possible."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = np.concatenate([np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS) for c in ("sketch_a", "sketch_b")])
            place, n, m = np.arange(batch.num_rows), batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
            ok = _possible(_apart(both, place, place + batch.num_rows), n, m, threshold)
            for i in np.flatnonzero(ok & (np.minimum(n, m) > LONG)).tolist():
                x, y = (np.frombuffer(batch.column(c)[i].as_py(), np.uint8).astype(np.int64) for c in ("fine_a", "fine_b"))
                k = min(len(x), len(y))
                ok[i] = _possible(np.abs(x.reshape(k, -1).sum(1) - y.reshape(k, -1).sum(1)).sum(), n[i], m[i], threshold)
            ok = pa.array(ok)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(ok) for c in ("a", "b")], names=["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose whole sets (columns left, right) have the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            sides = [(c.flatten().to_numpy(), c.offsets.to_numpy() - c.offsets[0].as_py()) for c in (batch.column("left"), batch.column("right"))]
            for i in range(batch.num_rows):
                a, b = (v[at[i] : at[i + 1]] for v, at in sides)
                shared = len(np.intersect1d(a, b, assume_unique=True))
                ok[i] = shared >= threshold * (len(a) + len(b) - shared) - 1e-9
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(ok)) for c in ("a", "b")], names=["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


@tidy
@batches_of(ROWS)
def similar_groups(docs: DataFrame, size: int = 5, threshold: float = 0.8, keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """Columns `keep` of docs (all unless given), whatever their names, and group, for each row: documents joined by pairs whose shingles of `size` words have Jaccard >= threshold.

    Words are ASCII-lowered; a text of fewer words is one shingle; null texts and texts without words are one group;
    repeated rows share one; an empty table gives no rows. No pair is missed: sets that similar share one of their first
    n - ceil(threshold n) + 1 shingles in any one order of all shingles. Of sets that share one, those next to each other by
    SimHash fingerprint and within RADIUS bits are held against each other first, and then all that are not of one component yet, where
    counts in bins cannot rule them out: a forest of such pairs tells clusters, and each cluster's whole sets of 64-bit hashes are
    compared in one place. Tokens are dealt in buckets, as arrays.
    """
    text = F.col(text_col).cast("string")
    kept = docs.select(F.struct(*(keep or docs.columns)).alias("row"), text.alias("text"), F.xxhash64(text).alias("mark"))
    texts = kept.select("text", "mark")
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    count = docs.count()

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE):
            yield pa.RecordBatch.from_arrays([pa.array(_shingles(texts_of(batch), size, *none)[0].view(np.int64))], names=["token"])

    sample = texts.where(F.pmod(F.hash("mark"), F.lit(max(1, count // SAMPLE))) == 0)
    common = sample.mapInArrow(tokens, "token long").groupBy("token").count().where(F.col("count") >= HEAVY).collect()
    heavy, weight = np.array([r["token"] for r in common], np.int64).view(np.uint64), np.array([r["count"] for r in common], np.int64)
    by_hash = np.argsort(heavy)
    heavy, weight = heavy[by_hash], weight[by_hash]
    names = ["row", "mark", "node", "n", "fp", "sketch", "fine", "prefix"]

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE):
            hashes, at = _shingles(texts_of(batch), size, heavy, weight)
            n, row = np.diff(at), rows_of(at)
            prefix = np.where(n > 0, n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1, 0)
            early = np.arange(len(hashes)) - at[:-1][row] < prefix[row]
            bins = np.bincount(row * BINS + (hashes >> np.uint64(56)).astype(np.int64), minlength=len(n) * BINS)
            sketch = binaries(np.minimum(bins, 255).astype(np.uint8), BINS * np.arange(len(n) + 1))
            columns = [batch.column("row"), batch.column("mark"), pa.array(_nodes(hashes, at)), pa.array(n.astype(np.int32)), pa.array(majority(hashes, at).view(np.int64)), sketch, _fine(hashes, at), _lists(hashes[early], np.concatenate([[0], np.cumsum(prefix)]))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE):
            hashes, at = _shingles(texts_of(batch), size, *none)
            yield pa.RecordBatch.from_arrays([pa.array(_nodes(hashes, at)), _lists(hashes, at)], names=["node", "hashes"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = np.cumsum(pc.list_value_length(batch.column("prefix")).to_numpy(zero_copy_only=False)) // PACKED
            edges = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [batch.num_rows]]) if batch.num_rows else [0]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                yield _packed(batch.slice(int(a), int(b - a)), buckets)

    schema = T.StructType([kept.schema["row"], kept.schema["mark"], *T.StructType.fromDDL("node long, n int, fp long, sketch binary, fine binary, prefix array<long>")])
    rows = cut(kept.mapInArrow(sets, schema))
    buckets = (rows.agg(F.sum("n")).first()[0] or 0) // BUCKET + 1
    packed = rows.select("node", "n", "fp", "prefix").mapInArrow(deal, "bucket long, token binary, node binary, n binary, fp binary")
    dealt = cut(packed.groupBy("bucket").applyInArrow(lambda t: _met(t, threshold), "token long, node long, n int, other long"))
    nodes = rows.select("node", "n", "sketch", "fine", "mark")

    def sets_for(marks: DataFrame) -> DataFrame:
        """(node, hashes) of each distinct text that has one of these marks, and of a few others; no other text leaves its place."""
        return _asked(texts, "mark", _matching(marks)).dropDuplicates(["mark", "text"]).mapInArrow(whole, "node long, hashes array<long>")

    def verified(pairs: DataFrame) -> DataFrame:
        asked = cut(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
        # sizes and sketches of what is asked for, one row a node
        sides = cut(_asked(nodes, "node", _matching(asked)).join(asked, "node", "left_semi").dropDuplicates(["node"]))
        side = lambda x: sides.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}"), F.col("fine").alias(f"fine_{x}"))
        likely = cut(_bounded(pairs.join(side("a"), "a").join(side("b"), "b"), threshold))
        wanted = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
        marks = cut(sides.join(wanted, "node", "left_semi").select("mark").distinct())
        sets_of = cut(sets_for(marks))
        side = lambda x, name: sets_of.select(F.col("node").alias(x), F.col("hashes").alias(name))
        out = cut(_verified(likely.join(side("a", "left"), "a").join(side("b", "right"), "b"), threshold))
        for table in (asked, sides, likely, marks, sets_of):
            drop(table)
        return out

    first = dealt.where("token is null").select(F.col("node").alias("a"), F.col("other").alias("b")).distinct()
    links = verified(first)
    # what fingerprints put elsewhere: all that has a token in common and is not of one component yet
    known = components(links).withColumnRenamed("node", "member")
    placed = cut(dealt.where("token is not null").join(known, F.col("node") == F.col("member"), "left").select("token", "node", "n", F.coalesce("component", "node").alias("component")))
    # of tokens that the same nodes have, told by two hashes of them all and their number, one stands for the others
    of_all = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"all{k}") for k in range(2)]
    several = placed.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("many"), *of_all).where("low < high")
    several = several.groupBy("all0", "all1", "many").agg(F.min("token").alias("token")).select("token")
    open_ = placed.join(several, "token", "left_semi")
    sketched = nodes.select("node", "sketch").join(open_.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"])
    more = cut(_others(open_.join(sketched, "node"), threshold))
    # who may be alike is in one cluster, and its sets are compared where they come together, each sent once (a large cluster's once a tile)
    near = components(more).withColumnRenamed("component", "cluster")
    asked = cut(near.join(known, F.col("node") == F.col("member"), "left").select("cluster", "node", F.coalesce("component", "node").alias("component")))
    marks = cut(nodes.join(asked, "node", "left_semi").groupBy("node").agg(F.min("mark").alias("mark")).select("mark").distinct())
    members = cut(asked.join(sets_for(marks), "node"))
    drop(placed)
    links = links.union(cut(_joined(members, threshold)))
    # written, so that the engine splits a hot set in the join of all rows
    groups = cut(components(links).withColumnRenamed("node", "member"))
    placed = rows.select("row", "node").join(groups, F.col("node") == F.col("member"), "left")
    return placed.select("row.*", F.coalesce("component", "node").alias(GROUP))
