"""Embedding near-dedup: small-world graphs per shard, audited searches, exact cosine, components."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kinlink.llm.graph import components
from kinlink.llm.store import cut, tidy

_ROWS = 256
#: Bytes of the shards that ask one shard in one task.
ASKING = 64 << 20
#: The beam that searches begin with; one that is to be wider than a WIDE-th of the shard's rows is made as wide as the shard, as reading all rows costs less.
EF, WIDE = 32, 16
#: A beam as wide as a shard of at most so many rows is still walked.
WALKED = 64
#: Of the nearest rows that are no links, the share that audits ask walks to find.
NEAREST = 0.9


def _select(candidates: np.ndarray, sims: np.ndarray, unit: np.ndarray, m: int) -> np.ndarray:
    """For each row, up to m candidates (best first) none of which is closer to a chosen one than to the row; -1 pads."""
    order = np.argsort(-sims, axis=1, kind="stable")
    candidates, sims = np.take_along_axis(candidates, order, 1), np.take_along_axis(sims, order, 1)
    vectors = unit[np.maximum(candidates, 0)]
    gram = vectors @ vectors.transpose(0, 2, 1)
    chosen = np.zeros(candidates.shape, bool)
    for t in range(candidates.shape[1]):
        crowded = (chosen & (gram[:, t] > sims[:, t : t + 1])).any(1)
        chosen[:, t] = ~crowded & (candidates[:, t] >= 0) & (chosen.sum(1) < m)
    # places left go to the closest that were passed over
    rank = np.where(candidates < 0, 2, np.where(chosen, 0, 1))
    pick = np.argsort(rank, axis=1, kind="stable")[:, :m]
    out = np.take_along_axis(candidates, pick, 1)
    return np.pad(out, ((0, 0), (0, m - out.shape[1])), constant_values=-1)


class Graph:
    """A hierarchical navigable small-world graph over unit vectors; rows are inserted in batches, queries walk in step."""

    def __init__(self, unit: np.ndarray, m: int = 12, ef: int = 48):
        self.unit, self.m, self.walks = unit.astype(np.float32), m, 0
        n = len(unit)
        seed = (np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)
        level = np.floor(-np.log((seed.astype(float) + 1) / 2**53) / math.log(m)).astype(int)
        self.layers, self.members = [], []
        for height in range(max(0, int(level.max(initial=0))) + 1):
            members = np.flatnonzero(level >= height)
            if height and len(members) < 2 * m:
                break
            self.members.append(members)
        #: neighbours by layer, over all rows (-1 where none)
        self.layers = [np.full((n, 2 * m if height == 0 else m), -1, np.int32) for height in range(len(self.members))]
        for height in reversed(range(len(self.members))):
            self._build(height, ef)
        self.apart = self._unreached()

    def _build(self, height: int, ef: int) -> None:
        links, members = self.layers[height], self.members[height]
        # those that stand above come first: searches enter there
        above = self.members[height + 1] if height + 1 < len(self.members) else members[:1]
        order = np.concatenate([above, members[~np.isin(members, above)]])
        done = min(len(order), max(64, len(above)))
        self._link(height, order[:done], np.broadcast_to(order[:done], (done, done)), own=True)
        while done < len(order):
            batch = order[done : done + min(done, _ROWS)]
            found, _ = self._walk(self.unit[batch], height, ef, self._enter(self.unit[batch], height))
            both = np.concatenate([found, np.broadcast_to(batch, (len(batch), len(batch)))], 1)
            self._link(height, batch, both, own=True)
            done += len(batch)
        self.layers[height] = links

    def _link(self, height: int, rows: np.ndarray, candidates: np.ndarray, own: bool) -> None:
        links = self.layers[height]
        keep = 4 * self.m
        for a in range(0, len(rows), _ROWS):
            mine, options = rows[a : a + _ROWS], candidates[a : a + _ROWS]
            sims = self._sims(self.unit[mine], options)
            sims[(options < 0) | (options == mine[:, None])] = -np.inf
            best = np.argsort(-sims, axis=1, kind="stable")[:, :keep]
            near, sims = np.take_along_axis(options, best, 1), np.take_along_axis(sims, best, 1)
            near = np.where(np.isfinite(sims), near, -1)
            links[mine] = _select(near, sims, self.unit, links.shape[1])
        source, target = np.repeat(rows, links.shape[1]), links[rows].ravel()
        source, target = source[target >= 0], target[target >= 0]
        # links back, the closest first where a row gets many
        sims = np.einsum("ed,ed->e", self.unit[source], self.unit[target])
        order = np.lexsort((-sims, target))
        source, target = source[order], target[order]
        heads = np.flatnonzero(np.concatenate([[True], np.diff(target) != 0])[: len(target)])
        place = np.arange(len(target)) - np.repeat(heads, np.diff(np.concatenate([heads, [len(target)]])))
        width = links.shape[1]
        source, target, place = source[place < width], target[place < width], place[place < width]
        row_of = np.cumsum(np.concatenate([[True], np.diff(target) != 0])[: len(target)]) - 1
        owners = target[np.concatenate([[True], np.diff(target) != 0])[: len(target)]]
        come = np.full((len(owners), width), -1, np.int64)
        come[row_of, place] = source
        for a in range(0, len(owners), _ROWS):
            own_rows = owners[a : a + _ROWS]
            old = links[own_rows].astype(np.int64)
            new = come[a : a + _ROWS]
            new[(new[:, :, None] == old[:, None, :]).any(2)] = -1
            options = np.concatenate([old, new], 1)
            full = (options >= 0).sum(1) > width
            packed = np.take_along_axis(options, np.argsort(options < 0, axis=1, kind="stable"), 1)[:, :width]
            if full.any():
                sims = self._sims(self.unit[own_rows[full]], options[full])
                sims[options[full] < 0] = -np.inf
                packed[full] = _select(options[full], sims, self.unit, width)
            links[own_rows] = packed

    def _unreached(self) -> np.ndarray:
        """Rows that no path of the lowest layer reaches from where searches enter it, or that few links lead to and walks for themselves miss; queries are held against them one by one."""
        links, n = self.layers[0], len(self.unit)
        seen = np.zeros(n + 1, bool)
        front = self.members[1] if len(self.members) > 1 else self.members[0][:1]
        while len(front):
            seen[front] = True
            come = np.unique(links[front])
            front = come[(come >= 0) & ~seen[come]]
        rare = np.flatnonzero(np.bincount(links[links >= 0], minlength=n) <= self.m) if n > EF else np.zeros(0, np.int64)
        for a in range(0, len(rare), _ROWS):
            part = rare[a : a + _ROWS]
            ids, _ = self._walk(self.unit[part], 0, EF, self._enter(self.unit[part], 0))
            seen[part[~(ids == part[:, None]).any(1)]] = False
        return np.flatnonzero(~seen[:n])

    def _sims(self, queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return (self.unit[np.maximum(rows, 0)] @ queries[:, :, None])[:, :, 0]

    def _enter(self, queries: np.ndarray, height: int) -> np.ndarray:
        at = np.zeros((len(queries), 1), np.int64) + (self.members[-1][0] if len(self.members) else 0)
        for above in reversed(range(height + 1, len(self.members))):
            at, sims = self._walk(queries, above, 8, at)
            at = np.where(np.isfinite(sims), at, -1)
        return at

    def _walk(self, queries: np.ndarray, height: int, ef: int, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ef best rows that a beam of that width reaches from entry, best first, for all queries in step."""
        links, q, n = self.layers[height], len(queries), len(self.unit)
        side = np.arange(q)[:, None]
        seen = np.zeros((q, n + 1), bool)  # place n stands for padding
        seen[:, n] = True
        ids, sims, walked = np.full((q, ef), -1, np.int64), np.full((q, ef), -np.inf, np.float32), np.zeros((q, ef), bool)
        come = entry
        while True:
            come = np.where(come < 0, n, come)
            come.sort(axis=1)
            fresh = ~seen[side, come]
            fresh[:, 1:] &= come[:, 1:] != come[:, :-1]
            seen[side, come] = True
            new = np.where(fresh, self._sims(queries, np.minimum(come, n - 1)), -np.inf)
            ids, sims, walked = np.concatenate([ids, come], 1), np.concatenate([sims, new], 1), np.concatenate([walked, ~fresh], 1)
            best = np.argpartition(-sims, ef - 1, axis=1)[:, :ef] if sims.shape[1] > ef else np.broadcast_to(np.arange(sims.shape[1]), sims.shape)
            ids, sims, walked = (np.take_along_axis(x, best, 1) for x in (ids, sims, walked))
            open_ = np.where(walked | ~np.isfinite(sims), -np.inf, sims)
            turn = np.argsort(-open_, axis=1)[:, :4]
            live = np.isfinite(np.take_along_axis(open_, turn, 1))
            if not live.any():
                order = np.argsort(-sims, axis=1, kind="stable")
                sims = np.take_along_axis(sims, order, 1)
                return np.where(np.isfinite(sims), np.take_along_axis(ids, order, 1), -1), sims
            walked[side, turn] = True
            come = np.where(live[:, :, None], links[np.minimum(np.maximum(ids[side, turn], 0), n - 1)], -1).reshape(q, -1).astype(np.int64)

    def near(self, queries: np.ndarray, threshold: float, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) at threshold or more among the rows that the walks reach; a beam full of links is widened for its query.

        A beam as wide as the shard holds every row of it, and is read without a walk.
        """
        out_q, out_r, todo, n = [], [], np.arange(len(queries)), len(self.unit)
        for a in range(0, len(queries) if len(self.apart) else 0, _ROWS):
            x, y = np.nonzero(queries[a : a + _ROWS] @ self.unit[self.apart].T >= threshold)
            out_q.append(a + x)
            out_r.append(self.apart[y])
        ef = min(ef, n)
        while len(todo):
            again = []
            for a in range(0, len(todo), _ROWS):
                part = todo[a : a + _ROWS]
                ids, sims = self.beam(queries[part], ef)
                full = (sims[:, -1] >= threshold) & (ef < n)
                x, y = np.nonzero((sims >= threshold) & ~full[:, None])
                out_q.append(part[x])
                out_r.append(ids[x, y])
                again.append(part[full])
            todo, ef = np.concatenate(again), _wider(ef, n)
        q, r = np.concatenate([np.zeros(0, np.int64), *out_q]), np.concatenate([np.zeros(0, np.int64), *out_r])
        key = np.unique(q * n + r)  # a row apart may be met on a walk too
        return key // n, key % n

    def beam(self, queries: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and similarities that a beam of width ef ends with, at least the last place being the worst of them."""
        n = len(self.unit)
        if ef >= n > WALKED:
            return np.broadcast_to(np.arange(n), (len(queries), n)), queries @ self.unit.T
        self.walks += len(queries)
        return self._walk(queries, 0, ef, self._enter(queries, 0))


def _wider(ef: int, n: int) -> int:
    return 4 * ef if 4 * ef * WIDE <= n else n


@dataclass(frozen=True)
class Audit:
    """How one search was audited: the beam's width, what sampled queries have in a full scan, and how much of it walks found."""

    ef: int
    true: int
    found: int


def audited(graph: Graph, queries: np.ndarray, threshold: float, ef: int = EF, audit_every: int = 16, audit_least: int = 512, recall: float = 1.0, own: bool = False) -> tuple[np.ndarray, np.ndarray, Audit]:
    """near() with the beam widened until, of what sampled queries have in a full scan, the share `recall` is found.

    Sampled are every audit_every-th query, and at least audit_least in all. What one has is its links and, so that a sample
    without links audits too, its nearest row; itself doesn't count (own: queries are the graph's rows). The sample alone
    is searched until a beam will do, then all queries are.
    """
    n = len(graph.unit)
    step = max(1, min(audit_every, len(queries) // audit_least))
    sample = np.arange(0, len(queries), step)
    true, nearest = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a in range(0, len(sample), _ROWS):
        part = sample[a : a + _ROWS]
        sims = queries[part] @ graph.unit.T
        if own:
            sims[np.arange(len(part)), part] = -np.inf
        x, y = np.nonzero(sims >= threshold)
        true.append(part[x] * n + y)
        best = sims.argmax(1)
        alone = (sims[np.arange(len(part)), best] < threshold) & (n > own)
        nearest.append(part[alone] * n + best[alone])
    true, nearest = np.concatenate(true), np.concatenate(nearest)
    asked = queries[sample]
    while True:
        q, r = graph.near(asked, threshold, ef)
        hits = np.isin(true, sample[q] * n + r)
        found = int(hits.sum())
        for a in range(0, len(nearest), _ROWS):
            part = nearest[a : a + _ROWS]
            ids, _ = graph.beam(queries[part // n], min(ef, n))
            found += int(((ids == (part % n)[:, None]).any(1) | np.isin(part % n, graph.apart)).sum())
        total = len(true) + len(nearest)
        links = hits.all() if recall >= 1 else True
        if ef >= n or (links and found >= min(recall, NEAREST) * total):
            return *graph.near(queries, threshold, ef), Audit(min(ef, n), total, found)
        ef = _wider(ef, n)


FOUND = "key long, links long, other long, shard int, asking int, ef int, audited long, found long"


def _nodes(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows, nodes): vec_id, label and sound vector (else null) of each row; and each distinct vector of a label with a key of its own."""
    x = F.col(vector_col).cast("array<double>")
    sound = F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.when(sound & F.col(label_col).isNotNull() & F.col(id_col).isNotNull(), F.transform(x, lambda v: v + F.lit(0.0))).alias("vec"))
    nodes = rows.where("vec is not null").groupBy("label", "vec").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("size"))
    return rows, cut(nodes.withColumn("dim", F.size("vec")).withColumn("key", F.monotonically_increasing_id()))


def _searched(nodes: DataFrame, threshold: float, shard_rows: int) -> DataFrame:
    """FOUND rows: each node's weighted number of links, edges of spanning forests, and the audits, of every pair of shards."""
    counts = nodes.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("shards"))
    total = counts.agg(F.sum("shards")).first()[0] or 1
    dealt = nodes.join(counts, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("key"), F.col("shards")).cast("int"))
    # as many tasks as shards: their work grows with the square of their rows, which sizes in bytes don't tell
    dealt = dealt.select("label", "dim", "shards", "shard", "key", "size", "vec").repartition(2 * total, "label", "dim", "shard")

    def index(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("key").to_numpy(), kind="stable")
        key, size = table.column("key").to_numpy()[order], table.column("size").to_numpy()[order]
        vec = table.column("vec").combine_chunks().flatten().to_numpy().reshape(len(order), -1)[order]
        big = np.abs(vec).max(1, keepdims=True)
        unit = vec / big
        unit /= np.sqrt((unit * unit).sum(1, keepdims=True))
        graph = Graph(unit)
        packed = [np.concatenate([layer.ravel() for layer in graph.layers]).tobytes(), np.array([len(graph.layers)] + [x for mm in graph.members for x in (len(mm), *mm)], np.int32).tobytes()]
        first = table.slice(0, 1)
        made = [key.astype(np.int64).tobytes(), size.astype(np.int64).tobytes(), unit.tobytes(), *packed]
        names = ["label", "dim", "shards", "shard"]
        return pa.table([*(first.column(c) for c in names), *(pa.array([b], pa.binary()) for b in made)], names=[*names, "key", "size", "unit", "links", "members"])

    label_type = nodes.schema["label"].dataType.simpleString()
    indexes = cut(dealt.groupBy("label", "dim", "shards", "shard").applyInArrow(index, f"label {label_type}, dim int, shards int, shard int, key binary, size binary, unit binary, links binary, members binary"))
    # of two shards one asks the other: shard a is asked by all from a on, some of them in each task
    turn_of = lambda c: F.floor(c / F.greatest(F.lit(1), F.floor(F.lit(ASKING // (8 * shard_rows)) / F.col("dim")))).cast("int")
    asked = indexes.withColumn("turn", F.explode(F.sequence(turn_of(F.col("shard")), turn_of(F.col("shards") - 1))))
    asking = indexes.select("label", "dim", F.explode(F.sequence(F.lit(0), "shard")).alias("shard"), F.col("shard").alias("asking"), "key", "size", "unit").withColumn("turn", turn_of(F.col("asking")))
    deal = lambda side: side.repartition(2 * total, "label", "dim", "shard", "turn")

    def search(asked: pa.Table, asking: pa.Table) -> pa.Table:
        a = asked.to_pylist()[0]
        graph, out = _graph(np.frombuffer(a["unit"], np.float64).reshape(-1, a["dim"]), a), []
        for b in asking.select(["asking", "key", "size", "unit"]).to_pylist():
            out.append(_pair(graph, a, b, threshold))
        return pa.Table.from_batches(out)

    keys = ("label", "dim", "shard", "turn")
    return cut(deal(asked).groupBy(*keys).cogroup(deal(asking).groupBy(*keys)).applyInArrow(search, FOUND))


@tidy
def near_vectors(vectors: DataFrame, threshold: float = 0.93, shard_rows: int = 8192, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of vectors; links join equal labels at cosine >= threshold.

    Equal vectors of a label are one node with their number, so copies are never paired. Each label's nodes are dealt
    into shards of about shard_rows; each shard has a graph; every node queries every shard of its label (of two shards,
    one asks the other); what searches find is verified in double precision, and counts and a spanning forest, not
    pairs, leave a pair of shards. A null label, a null, zero or empty vector, one with null or non-finite components,
    and a row with a null id link with nothing: n_links 0, component_id its own id, kept true (null id: null and
    false). Vectors of different lengths never link. Repeated rows, and rows of one id, are vectors of their own. An empty
    table gives no rows. Other columns are not read.
    """
    rows, nodes = _nodes(vectors, id_col, vector_col, label_col)
    found = _searched(nodes, threshold, shard_rows)
    linked = found.where("links is not null").groupBy("key").agg(F.sum("links").alias("links"))
    groups = components(found.where("other is not null").select(F.col("key").alias("a"), F.col("other").alias("b"))).withColumnRenamed("node", "key")
    placed = nodes.join(linked, "key", "left").join(groups, "key", "left").select("label", "vec", "node", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links"), F.coalesce("component", "key").alias("component"))
    least = placed.groupBy("component").agg(F.min("node").alias("least"))
    # written, so that hot keys are split in the join of all rows below
    known = cut(placed.join(least, "component").select("label", "vec", F.col("links").alias("n_links"), F.col("least").alias("component_id")))
    out = rows.where("vec is not null").join(known, ["label", "vec"]).select("vec_id", "n_links", "component_id")
    rest = rows.where("vec is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


@tidy
def recall_audits(vectors: DataFrame, threshold: float = 0.93, shard_rows: int = 8192, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(shard, asking, ef, audited, found) for each search of near_vectors(): the beam it ended with, and how much of what a full scan has for the sampled queries its walks found."""
    _, nodes = _nodes(vectors, id_col, vector_col, label_col)
    return _searched(nodes, threshold, shard_rows).where("ef is not null").select("shard", "asking", "ef", "audited", "found")


def _pair(graph: Graph, a: dict, b: dict, threshold: float) -> pa.RecordBatch:
    """Links between two shards (or within one), as each node's weighted number and a spanning forest; and the search's audit."""
    read = lambda s: (np.frombuffer(s["key"], np.int64), np.frombuffer(s["size"], np.int64), np.frombuffer(s["unit"], np.float64).reshape(-1, a["dim"]))
    (node_a, size_a, unit_a), (node_b, size_b, unit_b) = read(a), read(b)
    same = a["shard"] == b["asking"]
    slack = 1e-5  # searches run in single precision; what they find is verified in double
    q, r, audit = audited(graph, unit_b.astype(np.float32), threshold - slack, own=same)
    if same:
        q, r = np.minimum(q, r), np.maximum(q, r)
        key = np.unique(q * len(node_a) + r)
        q, r = key // max(len(node_a), 1), key % max(len(node_a), 1)
        q, r = q[q != r], r[q != r]
    ok = np.zeros(len(q), bool)
    for i in range(0, len(q), 65536):
        s = slice(i, i + 65536)
        ok[s] = np.einsum("ed,ed->e", unit_b[q[s]], unit_a[r[s]]) >= threshold
    q, r = q[ok], r[ok]
    count_b, count_a = np.bincount(q, size_a[r], len(node_b)), np.bincount(r, size_b[q], len(node_a))
    nodes, counts = (node_a, count_a + count_b) if same else (np.concatenate([node_a, node_b]), np.concatenate([count_a, count_b]))
    parent, edges = list(range(len(nodes))), []
    for x, y in zip((q if same else q + len(node_a)).tolist(), r.tolist(), strict=True):
        tops = []
        for z in (x, y):
            while parent[z] != z:
                parent[z] = parent[parent[z]]
                z = parent[z]
            tops.append(z)
        if tops[0] != tops[1]:
            parent[max(tops)] = min(tops)
            edges.append((x, y))
    edge = np.array(edges, np.int64).reshape(-1, 2)
    some = np.flatnonzero(counts)
    n, e = len(some), len(edge)
    blank = lambda k, t=pa.int64(): pa.nulls(k, t)
    told = [pa.concat_arrays([blank(n + e, t), pa.array([v], t)]) for v, t in ((a["shard"], pa.int32()), (b["asking"], pa.int32()), (audit.ef, pa.int32()), (audit.true, pa.int64()), (audit.found, pa.int64()))]
    return pa.RecordBatch.from_arrays([
        pa.concat_arrays([pa.array(np.concatenate([nodes[some], nodes[edge[:, 0]]]), pa.int64()), blank(1)]),
        pa.concat_arrays([pa.array(counts[some].astype(np.int64)), blank(e + 1)]),
        pa.concat_arrays([blank(n), pa.array(nodes[edge[:, 1]], pa.int64()), blank(1)]),
        *told,
    ], names=[c.split()[0] for c in FOUND.split(", ")])


def _graph(unit: np.ndarray, stored: dict) -> Graph:
    """The graph that index() stored."""
    graph = Graph.__new__(Graph)
    graph.unit, graph.m, graph.walks = unit.astype(np.float32), 12, 0
    told, flat = np.frombuffer(stored["members"], np.int32), np.frombuffer(stored["links"], np.int32)
    graph.members, graph.layers, at, used = [], [], 1, 0
    for height in range(int(told[0])):
        size = int(told[at])
        graph.members.append(told[at + 1 : at + 1 + size].astype(np.int64))
        at += 1 + size
        width = 2 * graph.m if height == 0 else graph.m
        graph.layers.append(flat[used : used + width * len(unit)].reshape(len(unit), width))
        used += width * len(unit)
    graph.apart = graph._unreached()
    return graph
