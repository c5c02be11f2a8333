"""Near-duplicate vectors by layered small-world graphs, one per shard."""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from gablework.llm.common import components, partitions
from gablework.session import stage

#: Cosine of a link; vectors of a shard; links of a node above and on the ground layer.
COSINE, SHARD, LINKS, GROUND = 0.98, 4096, 12, 24
#: Beam when building, first beam when searching, nodes opened per step.
BUILD_BEAM, BEAM, OPENED = 40, 48, 4
#: Vectors inserted together; queries searched together; queries with a full beam followed together.
INSERTED, SEARCHED, SPREAD = 256, 1024, 64
#: A node is to be linked from one of so many of its nearest links.
RETURNED = 8
#: Vector components gathered at once when pairs are verified: tens of thousands of pairs.
VERIFIED = 1 << 21
#: How much less similar than a link a node may be on the way from link to link.
SLACK = 0.02
#: Queries of an audit, and the shares of true neighbours that must be found.
AUDITED, NEIGHBOURS, NEAREST_RECALL, LINK_RECALL = 64, 10, 0.9, 1.0
#: Vectors whose links are also counted by comparing them with all others: one id in so many.
AUDIT_EVERY = 100


class LayeredGraph:
    """A hierarchical navigable small-world graph over unit vectors, built and searched in batches."""

    def __init__(self, unit: np.ndarray, seed: int):
        self.unit = unit
        n = len(unit)
        heights = np.floor(-np.log(np.random.default_rng(seed).random(n) + 1e-12) / np.log(LINKS)).astype(int)
        self.height = np.minimum(heights, 6)
        # The top node is inserted first; every layer is entered through it.
        order = np.argsort(-self.height, kind="stable")[:1]
        self.top = int(order[0]) if n else 0
        self.layers = [np.full((n, GROUND if i == 0 else LINKS), -1, dtype=np.int32) for i in range(self.height.max(initial=0) + 1)]
        queue = np.concatenate([order, np.setdiff1d(np.arange(n), order)])
        done = 0
        while done < n:
            step = min(INSERTED, max(32, done))
            self._insert(queue[done : done + step], bool(done))
            done += step
        self._connect()

    def _reach(self, start: int, further: np.ndarray) -> np.ndarray:
        """The nodes that ground links, and one further link per node, lead to from a node."""
        reached = np.zeros(len(self.unit) + 1, dtype=bool)  # the last place takes the ids -1
        frontier = np.array([start])
        while len(frontier):
            reached[frontier] = True
            around = np.append(self.layers[0][frontier].ravel(), further[frontier])
            frontier = np.unique(around[(around >= 0) & ~reached[around]])
        return reached[:-1]

    def _connect(self) -> None:
        """One more ground link per node: to a node that its nearest ones don't link to, or that the top doesn't reach.

        Links to a node may all have been replaced by nearer ones.  It is then linked
        from the nearest of its own links, or of the reached nodes, without a further link yet.
        """
        ground, n = self.layers[0], len(self.unit)
        further = np.full(n, -1, dtype=np.int32)
        near = np.where(ground >= 0, np.einsum("ij,ikj->ik", self.unit, self.unit[np.maximum(ground, 0)]), -np.inf)
        nearest = np.take_along_axis(ground, np.argsort(-near, axis=1, kind="stable")[:, :RETURNED], 1)
        returned = (ground[np.maximum(nearest, 0)] == np.arange(n)[:, None, None]).any(axis=(1, 2))
        for lost in np.flatnonzero(~returned):
            free = nearest[lost][(nearest[lost] >= 0) & (further[nearest[lost]] < 0)]
            further[free[:1]] = lost
        reached = self._reach(self.top, further) if n else np.zeros(0, dtype=bool)
        while not reached.all():
            lost = int(np.argmin(reached))
            near = np.where(reached & (further < 0), self.unit @ self.unit[lost], -np.inf)
            further[np.argmax(near)] = lost
            reached |= self._reach(lost, further)
        self.layers[0] = np.hstack([ground, further[:, None]])

    def _insert(self, nodes: np.ndarray, some: bool) -> None:
        queries = self.unit[nodes]
        near = queries @ queries.T
        entry = np.full((len(nodes), 1), self.top, dtype=np.int32)
        for level in range(len(self.layers) - 1, -1, -1):
            member = self.height[nodes] >= level
            found = sims = None
            if some:
                found, sims = self.search_layer(level, queries, entry, BUILD_BEAM if member.any() else 1)
                entry = found[:, : 4 if level else 1]
            if not member.any():
                continue
            own = np.flatnonzero(member)
            peers = np.where(member[None, :] & (nodes[None, :] != nodes[own][:, None]), near[own], -np.inf)
            take = min(BUILD_BEAM, peers.shape[1])
            best = np.argpartition(-peers, take - 1, axis=1)[:, :take]
            ids = np.where(np.isfinite(np.take_along_axis(peers, best, 1)), nodes[best], -1).astype(np.int32)
            scores = np.take_along_axis(peers, best, 1)
            if some:
                ids, scores = np.hstack([ids, found[own]]), np.hstack([scores, sims[own]])
            width = self.layers[level].shape[1]
            self.layers[level][nodes[own]] = self._choose(ids, scores, width)
            self._link_back(level, nodes[own])

    def _choose(self, ids: np.ndarray, scores: np.ndarray, width: int) -> np.ndarray:
        """Up to ``width`` candidates: those nearer to the node than to one chosen before, then the nearest others."""
        scores = np.where(ids < 0, -np.inf, scores)
        order = np.argsort(-scores, axis=1, kind="stable")[:, : 2 * width + BUILD_BEAM]
        ids, scores = np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)
        again = np.zeros(ids.shape, dtype=bool)
        by_id = np.argsort(ids, axis=1, kind="stable")
        sorted_ids = np.take_along_axis(ids, by_id, 1)
        np.put_along_axis(again, by_id[:, 1:], sorted_ids[:, 1:] == sorted_ids[:, :-1], 1)
        valid = (ids >= 0) & ~again
        vectors = self.unit[np.maximum(ids, 0)]
        between = vectors @ vectors.transpose(0, 2, 1)
        chosen = np.zeros(ids.shape, dtype=bool)
        closest = np.full(ids.shape, -np.inf)
        for i in range(ids.shape[1]):
            take = valid[:, i] & (scores[:, i] > closest[:, i]) & (chosen.sum(axis=1) < width)
            chosen[:, i] = take
            closest = np.where(take[:, None], np.maximum(closest, between[:, i, :]), closest)
        rank = np.where(chosen, 0, np.where(valid, 1, 2)) * ids.shape[1] + np.arange(ids.shape[1])
        kept = np.argsort(rank, axis=1, kind="stable")[:, :width]
        out = np.where(np.take_along_axis(chosen | valid, kept, 1), np.take_along_axis(ids, kept, 1), -1)
        if out.shape[1] < width:
            out = np.pad(out, ((0, 0), (0, width - out.shape[1])), constant_values=-1)
        return out

    def _link_back(self, level: int, nodes: np.ndarray) -> None:
        table = self.layers[level]
        width = table.shape[1]
        target = table[nodes].ravel()
        source = np.repeat(nodes, width)[target >= 0]
        target = target[target >= 0]
        if not len(target):
            return
        sims = np.einsum("ij,ij->i", self.unit[source], self.unit[target])
        order = np.lexsort((-sims, target))
        target, source, sims = target[order], source[order], sims[order]
        unique, start, counts = np.unique(target, return_index=True, return_counts=True)
        place = np.arange(len(target)) - np.repeat(start, counts)
        most = min(int(counts.max()), width)
        fresh = np.full((len(unique), most), -1, dtype=np.int32)
        score = np.full((len(unique), most), -np.inf)
        keep = place < most
        row = np.repeat(np.arange(len(unique)), counts)
        fresh[row[keep], place[keep]] = source[keep]
        score[row[keep], place[keep]] = sims[keep]
        old = table[unique]
        old_score = np.einsum("ij,ikj->ik", self.unit[unique], self.unit[np.maximum(old, 0)])
        table[unique] = self._choose(np.hstack([old, fresh]), np.hstack([old_score, score]), width)

    def search_layer(self, level: int, queries: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The best ``beam`` nodes found for each query, best first: ids (-1: none) and cosines."""
        table, n, q = self.layers[level], len(self.unit), len(queries)
        beam = min(beam, n)
        ids = np.full((q, beam), -1, dtype=np.int32)
        sims = np.full((q, beam), -np.inf, dtype=np.float32)
        seen = np.zeros((q, n + 1), dtype=bool)  # the last column takes the ids -1
        width = min(entry.shape[1], beam)
        ids[:, :width] = entry[:, :width]
        start = np.einsum("ij,ikj->ik", queries, self.unit[np.maximum(ids[:, :width], 0)])
        sims[:, :width] = np.where(ids[:, :width] >= 0, start, -np.inf)
        seen[np.arange(q)[:, None], ids[:, :width]] = True
        seen[:, n] = True
        opened = ids < 0
        active = np.arange(q)
        while len(active):
            closed = opened[active]
            nxt = np.argsort(closed, axis=1, kind="stable")[:, :OPENED]
            usable = ~np.take_along_axis(closed, nxt, 1)
            np.put_along_axis(closed, nxt, True, 1)
            nodes = np.where(usable, np.take_along_axis(ids[active], nxt, 1), -1)
            around = np.where(nodes[:, :, None] >= 0, table[np.maximum(nodes, 0)], -1).reshape(len(active), -1)
            around = np.sort(around, axis=1)
            fresh = ~seen[active[:, None], around]
            fresh[:, 1:] &= around[:, 1:] != around[:, :-1]
            seen[active[:, None], around] = True
            at, column = np.nonzero(fresh)
            score = np.full(around.shape, -np.inf, dtype=np.float32)
            score[at, column] = np.einsum("ij,ij->i", queries[active[at]], self.unit[around[at, column]])
            all_ids = np.hstack([ids[active], np.where(fresh, around, -1)])
            all_sims = np.hstack([sims[active], score])
            all_open = np.hstack([closed, ~fresh])
            order = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
            ids[active] = np.take_along_axis(all_ids, order, 1)
            sims[active] = np.take_along_axis(all_sims, order, 1)
            opened[active] = np.take_along_axis(all_open, order, 1) | (ids[active] < 0)
            active = active[~opened[active].all(axis=1)]
        return ids, sims

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        entry = np.full((len(queries), 1), self.top, dtype=np.int32)
        for level in range(len(self.layers) - 1, 0, -1):
            entry, _ = self.search_layer(level, queries, entry, 4)
        # With the top among the entries, a beam as wide as the graph finds every node.
        entry = np.where(entry == self.top, -1, entry)
        entry = np.hstack([np.full((len(queries), 1), self.top, dtype=np.int32), entry])
        return self.search_layer(0, queries, entry, beam)

    def spread(self, queries: np.ndarray, ids: np.ndarray, sims: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """All (query, node) of a cosine of ``least`` or more that ground links lead to from the given
        finds, by way of nodes at most :data:`SLACK` farther."""
        table, n = self.layers[0], len(self.unit)
        seen = np.zeros((len(queries), n + 1), dtype=bool)  # the last column takes the ids -1
        seen[np.arange(len(queries))[:, None], ids] = True
        seen[:, n] = True
        row, column = np.nonzero(sims >= least - SLACK)
        node, score = ids[row, column], sims[row, column]
        out = []
        while len(row):
            good = score >= least
            out.append(np.stack([row[good], node[good]]))
            around, row = table[node].ravel(), np.repeat(row, table.shape[1])
            fresh = ~seen[row, around]
            row, node = np.divmod(np.unique(row[fresh] * n + around[fresh]), n)
            seen[row, node] = True
            score = _cosines(queries, row, self.unit, node)
            near = score >= least - SLACK
            row, node, score = row[near], node[near], score[near]
        return tuple(np.concatenate(out, axis=1)) if out else (np.zeros(0, int), np.zeros(0, int))


def _cosines(left: np.ndarray, i: np.ndarray, right: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Products of rows ``i`` of one table and ``j`` of another, some at a time."""
    out = np.empty(len(i), dtype=left.dtype)
    step = max(1, VERIFIED // max(1, left.shape[1]))
    for k in range(0, len(i), step):
        part = slice(k, k + step)
        out[part] = np.einsum("ij,ij->i", left[i[part]], right[j[part]])
    return out


def _within(graph: LayeredGraph, queries: np.ndarray, least: float, beam: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All (query, node) found with a cosine of ``least`` or more, some queries at a time; from a beam full of such, the links are followed further."""
    n = len(graph.unit)
    step = max(1, min(SEARCHED, (1 << 22) // max(beam, 1)))
    for i in range(0, len(queries), step):
        ids, sims = graph.search(queries[i : i + step], beam)
        full = (sims[:, -1] >= least) & (ids.shape[1] < n)
        row, column = np.nonzero((sims >= least) & ~full[:, None])
        yield i + row, ids[row, column]
        crowded = np.flatnonzero(full)
        for j in range(0, len(crowded), SPREAD):
            part = crowded[j : j + SPREAD]
            row, node = graph.spread(queries[i + part], ids[part], sims[part], least)
            yield i + part[row], node


def linked_parts(graph: LayeredGraph, queries: np.ndarray, cosine: float) -> tuple[Iterator[tuple[np.ndarray, np.ndarray]], float]:
    """Candidate pairs, some queries at a time, from beams widened until an audit against all vectors of the shard passes; its recall."""
    n, margin = len(graph.unit), 1e-4
    audit = np.unique(np.linspace(0, len(queries) - 1, min(AUDITED, len(queries))).astype(int))
    exact = queries[audit] @ graph.unit.T
    k = min(NEIGHBOURS, n)
    kth = -np.partition(-exact, k - 1, axis=1)[:, k - 1]
    beam = BEAM
    while True:
        ids, sims = graph.search(queries[audit], beam)
        nearest = (sims >= kth[:, None] - 1e-5).sum() / max(1, (exact >= kth[:, None] - 1e-5).sum())
        found = sum(len(row) for row, _ in _within(graph, queries[audit], cosine - margin, beam))
        true = (exact >= cosine - margin).sum()
        recall = found / true if true else 1.0
        if (nearest >= NEAREST_RECALL and recall >= LINK_RECALL) or beam >= n:
            break
        beam *= 2
    return _within(graph, queries, cosine - margin, beam), recall


def linked_pairs(graph: LayeredGraph, queries: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray, float]:
    """All pairs of :func:`linked_parts` at once, and the recall of its audit."""
    parts, recall = linked_parts(graph, queries, cosine)
    row, node = (np.concatenate(x) for x in zip((np.zeros(0, int), np.zeros(0, int)), *parts))
    return row, node, recall


def _either_way(parts: Iterable[tuple[np.ndarray, np.ndarray]], n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs within one shard once each, lesser first: a link may be found from one end or both.  One byte per pair of rows."""
    met = np.zeros((n, n), dtype=bool)
    for q, x in parts:
        met[np.minimum(q, x), np.maximum(q, x)] = True
    np.fill_diagonal(met, False)
    step = max(1, (1 << 16) // max(n, 1))
    for i in range(0, n, step):
        q, x = np.nonzero(met[i : i + step])
        yield i + q, x


class _Links:
    """Link counts of the pairs of two shards, and a forest that connects what they connect; the pairs themselves are dropped."""

    def __init__(self, q_times: np.ndarray, times: np.ndarray, same: bool):
        self.q_times, self.times, self.shift = q_times, times, 0 if same else len(q_times)
        # Within one shard both ends are counted in the same places.
        self.count = np.zeros(len(times) + self.shift, dtype=np.int64)
        self.root = np.arange(len(self.count))
        self.forest: list[tuple[int, int]] = []

    def add(self, q: np.ndarray, x: np.ndarray) -> None:
        np.add.at(self.count, q, self.times[x])
        np.add.at(self.count, x + self.shift, self.q_times[q])
        apart = self.root[q] != self.root[x + self.shift]
        ends = _forest(self.root[q[apart]], self.root[x[apart] + self.shift])
        for a, b in ends:
            self.forest.append((a, b))
            while self.root[a] != a:
                a = self.root[a]
            while self.root[b] != b:
                b = self.root[b]
            self.root[max(a, b)] = min(a, b)
        while ends and (self.root[self.root] != self.root).any():
            self.root = self.root[self.root]


def _true_links(left: np.ndarray, left_norm: np.ndarray, right: np.ndarray, right_norm: np.ndarray, cosine: float) -> int:
    """Pairs of the rows of two tables with a cosine of ``cosine`` or more, by comparing all, some rows at a time."""
    total = 0
    for i in range(0, len(left), 256):
        part = slice(i, i + 256)
        total += int((left[part] @ right.T / (left_norm[part, None] * right_norm[None, :]) >= cosine).sum())
    return total


def _usable(vector: Column, label: Column) -> Column:
    infinite = float("inf")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    return F.coalesce(label.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what all the given edges connect; at most one less than the nodes."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = list(range(len(nodes)))
    kept = []
    for x, y in zip(flat[: len(a)].tolist(), flat[len(a) :].tolist()):
        while root[x] != x:
            root[x] = x = root[root[x]]
        while root[y] != y:
            root[y] = y = root[root[y]]
        if x != y:
            root[max(x, y)] = min(x, y)
            kept.append((x, y))
    return [(int(nodes[x]), int(nodes[y])) for x, y in kept]


def classes(vectors: DataFrame, cosine: float = COSINE, shard: int = SHARD) -> DataFrame:
    """(vec_id, n_links, component_id, kept, audit_recall) of every row of ``vectors`` (vec_id, embedding, label).

    Equal vectors of a label are one node that counts as often as it occurs.  A
    label's nodes are dealt to shards of about ``shard`` vectors by hash; each
    shard's graph is written once.  Every shard is searched for the vectors of all
    shards of its label: each pair of shards once, in a task of its own.  Found
    pairs are verified in double precision, some at a time, and dropped.  A pair of
    shards keeps and returns link counts and a forest that connects what its links connect, so its
    memory does not grow with the links and its result is no longer than its rows.

    ``audit_recall`` is one value for the whole run: of the links that vectors whose node is divisible by
    :data:`AUDIT_EVERY` have to others, by comparing them with all of their label, the share that the graphs
    found; null if they have none.

    A vector that is null, empty, zero, or holds null or non-finite components, and
    one without label, links with nothing.  Vectors of other lengths do not link.
    Rows with one vec_id count as one vector for components.  A null vec_id is
    named by a hash of its vector, and is not kept.  Other columns are ignored; an
    empty table gives an empty result.
    """
    spark = vectors.sparkSession
    vector = F.col("embedding")
    rows = stage(
        vectors.select(
            "vec_id",
            "label",
            F.size("embedding").alias("dim"),
            F.xxhash64("embedding").alias("h1"),
            F.xxhash64(F.lit(7), "embedding").alias("h2"),
            F.coalesce(F.col("vec_id").cast("long"), F.xxhash64("embedding")).alias("own"),
            _usable(vector, F.col("label")).alias("usable"),
            F.transform(vector, lambda x: x.cast("double")).alias("vector"),
        ),
        "vectors",
    )
    key = ["label", "dim", "h1", "h2"]
    merged = rows.where("usable").groupBy(*key).agg(F.min("own").alias("node"), F.count(F.lit(1)).alias("times"), F.first("vector").alias("vector"))
    nodes = stage(merged, "nodes")
    counts = stage(
        nodes.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / shard).cast("int").alias("shards")), "shard-counts"
    )
    dealt = nodes.join(counts, ["label", "dim"]).select(
        "label", "dim", "shards", F.pmod(F.xxhash64("h1", "h2"), F.col("shards")).cast("int").alias("shard"), "node", "times", "vector"
    )

    def build(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("node")
        raw = np.stack(part["vector"].to_numpy())
        unit = (raw / np.linalg.norm(raw, axis=1, keepdims=True)).astype(np.float32)
        first = part.iloc[0]
        graph = LayeredGraph(unit, int(first["shard"]) + 1)
        return pd.DataFrame(
            {
                "label": [first["label"]],
                "dim": [first["dim"]],
                "shards": [first["shards"]],
                "shard": [first["shard"]],
                "node": [part["node"].to_numpy(dtype="<i8").tobytes()],
                "times": [part["times"].to_numpy(dtype="<i8").tobytes()],
                "raw": [raw.astype("<f8").tobytes()],
                "graph": [pickle.dumps((graph.top, graph.layers))],
            }
        )

    label = vectors.schema["label"].dataType.simpleString()
    graphs = stage(
        dealt.groupBy("label", "dim", "shard").applyInPandas(
            build, f"label {label}, dim int, shards int, shard int, node binary, times binary, raw binary, graph binary"
        ),
        "graphs",
    )

    searched = graphs.select("label", "dim", "shard", F.explode(F.sequence("shard", F.col("shards") - 1)).alias("other"), "node", "times", "raw", "graph")
    queries = graphs.select("label", "dim", F.col("shard").alias("other"), F.col("node").alias("q_node"), F.col("times").alias("q_times"), F.col("raw").alias("q_raw"))
    n_pairs = int(counts.agg(F.coalesce(F.sum(F.col("shards") * (F.col("shards") + 1) / 2), F.lit(0))).first()[0])
    # One pair of shards is seconds of work: more tasks than pairs spread them.
    tasks = max(partitions(spark), min(4 * n_pairs, 100_000))
    pairs = searched.join(queries, ["label", "dim", "other"]).repartition(tasks, "label", "dim", "shard", "other")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                node, times = np.frombuffer(row.node, "<i8"), np.frombuffer(row.times, "<i8")
                q_node, q_times = np.frombuffer(row.q_node, "<i8"), np.frombuffer(row.q_times, "<i8")
                raw, q_raw = np.frombuffer(row.raw, "<f8").reshape(-1, row.dim), np.frombuffer(row.q_raw, "<f8").reshape(-1, row.dim)
                graph = LayeredGraph.__new__(LayeredGraph)
                graph.top, graph.layers = pickle.loads(row.graph)
                norm, q_norm = np.linalg.norm(raw, axis=1), np.linalg.norm(q_raw, axis=1)
                graph.unit = (raw / norm[:, None]).astype(np.float32)
                same = row.shard == row.other
                parts, _ = linked_parts(graph, (q_raw / q_norm[:, None]).astype(np.float32), cosine)
                links = _Links(q_times, times, same)
                q_asked, asked, hits = q_node % AUDIT_EVERY == 0, node % AUDIT_EVERY == 0, 0
                true = _true_links(q_raw[q_asked], q_norm[q_asked], raw, norm, cosine)
                # Within one shard a vector also meets itself, which is no link.
                true += -int(asked.sum()) if same else _true_links(raw[asked], norm[asked], q_raw, q_norm, cosine)
                for q, x in _either_way(parts, len(node)) if same else parts:
                    for k in range(0, len(q), 1 << 16):
                        qk, xk = q[k : k + (1 << 16)], x[k : k + (1 << 16)]
                        sure = _cosines(q_raw, qk, raw, xk) / (q_norm[qk] * norm[xk]) >= cosine
                        links.add(qk[sure], xk[sure])
                        hits += int(q_asked[qk[sure]].sum() + asked[xk[sure]].sum())
                ends = node if same else np.concatenate([q_node, node])
                found = pd.DataFrame({"a": ends, "n": links.count}).query("n > 0")
                found = found.groupby("a", as_index=False)["n"].sum()
                edges = pd.DataFrame(ends[np.array(links.forest, dtype=int).reshape(-1, 2)], columns=["a", "b"], dtype="int64")
                audit = pd.DataFrame({"hits": [hits], "true": [true]})
                yield pd.concat([found, edges, audit]).reindex(columns=["a", "b", "n", "hits", "true"]).astype("Int64")

    found = stage(pairs.mapInPandas(search, "a bigint, b bigint, n bigint, hits bigint, true bigint"), "links")
    recall = found.agg(F.try_divide(F.sum("hits"), F.sum("true")).alias("recall")).select("recall").scalar()
    named = components(found.where("b IS NOT NULL").select("a", "b"))
    linked = found.where("n IS NOT NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    summary = stage(
        nodes.drop("vector").join(linked, "node", "left").join(named, "node", "left").select(
            *key, (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id")
        ),
        "summary",
    )
    lone = rows.where("NOT usable").select("vec_id", "own", F.lit(0).cast("long").alias("n_links"), F.col("own").alias("component_id"))
    good = rows.where("usable").select("vec_id", "own", *key).join(summary, key).select("vec_id", "own", "n_links", "component_id")
    out = good.unionByName(lone)
    return out.select(
        "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id").cast("long") == F.col("component_id"), F.lit(False)).alias("kept"), recall.alias("audit_recall")
    )
