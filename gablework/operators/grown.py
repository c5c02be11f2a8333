"""Forests of many settings side by side, from one table of binned rows.

The trees are dealt out in small groups.  A task takes the table (``WHOLE_ROWS`` rows at
most) with the bags of its group only, grows the group's trees level by level for every
fold and setting, and says what they predict for the rows held out.  Trees that
differ in their depth only are one tree looked at level by level, so they are grown once.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from gablework.functions.columns import ratio

# Executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a table that a task may take: some 200 bytes each with one tree.
WHOLE_ROWS = 4_000_000
#: Trees of a group, less on tables of more than 200,000 rows.
TREES = 5
#: Nodes whose sums are held at a time.
NODES = 16384

#: Features looked at per split, as Spark counts them.
LOOKED_AT = {
    "all": lambda n: n,
    "sqrt": lambda n: math.ceil(math.sqrt(n)),
    "log2": lambda n: max(1, math.ceil(math.log2(n))),
    "onethird": lambda n: max(1, math.ceil(n / 3)),
}


def best_splits(bins, sizes, nominal, node, rows, w, y, tw, ty, allowed, least):
    """(feature, cut, mask): the best split of each node; the feature is -1 where none gains.

    Bins up to ``cut`` go left, and of a nominal feature those in ``mask``: its bins are ordered by their mean.
    ``node`` numbers the nodes of the entries from 0, rising; every node has entries.
    """
    k = len(tw)
    best, feature, cut = np.full(k, -np.inf), np.full(k, -1), np.zeros(k, np.int64)
    mask = np.zeros((k, max([0, *(sizes[f] for f in nominal)])), bool)
    for f, size in enumerate(sizes):
        nodes, at, mine = np.arange(k), node, slice(None)
        if allowed is not None:
            nodes = np.flatnonzero(allowed[:, f])
            mine = np.flatnonzero(allowed[node, f])
            at = (np.cumsum(allowed[:, f]) - 1)[node[mine]]
        if size < 2 or not len(nodes):
            continue
        key = at * size + bins[f][rows[mine]]
        held = np.bincount(key, w[mine], len(nodes) * size)
        # Bins that hold something, node by node.
        place = np.flatnonzero(held)
        held, said, owner = held[place], np.bincount(key, y[mine], len(nodes) * size)[place], place // size
        if f in nominal:
            order = np.lexsort((said / held, owner))
            place, held, said = place[order], held[order], said[order]
        starts = np.searchsorted(owner, np.arange(len(nodes)))
        lw, ly = np.cumsum(held), np.cumsum(said)
        lw, ly = lw - (lw[starts] - held[starts])[owner], ly - (ly[starts] - said[starts])[owner]
        rw, ry = tw[nodes][owner] - lw, ty[nodes][owner] - ly
        score = np.full(len(place), -np.inf)
        fits = np.flatnonzero((lw > least - 0.5) & (rw > least - 0.5))
        score[fits] = ly[fits] ** 2 / lw[fits] + ry[fits] ** 2 / rw[fits]
        found = np.maximum.reduceat(score, starts)
        hits = np.flatnonzero(score == found[owner])
        first = hits[np.searchsorted(owner[hits], np.arange(len(nodes)))]
        better = found > best[nodes]
        won = nodes[better]
        best[won], feature[won], cut[won] = found[better], f, place[first[better]] % size
        if f in nominal:
            left = (np.arange(len(place)) <= first[owner]) & better[owner]
            mask[won] = False
            mask[nodes[owner[left]], place[left] % size] = True
    # What rounding alone could gain is no gain.
    feature[~(best - ty * ty / tw > 1e-11 * best)] = -1
    return feature, cut, mask


def grow(bins, sizes, nominal, rows, tree, w, y, trees, fallback, held, depths, least, look, rng):
    """What ``trees`` trees say in sum of each ``held`` row, for each of the rising ``depths``: (depths, held).

    ``rows``, ``tree``, ``w`` and ``y`` are the bags, ordered by tree: row numbers, with weight and sum of the target.
    """
    h_rows, h_at, h_slot = np.tile(held, trees), np.repeat(np.arange(trees), len(held)), np.arange(trees * len(held))
    said, out, at, k, level = np.zeros(trees * len(held)), [], tree, trees, 0
    unordered = np.isin(np.arange(len(sizes)), list(nominal))
    while len(out) < len(depths):
        if k:
            tw, ty = np.bincount(at, w, k), np.bincount(at, y, k)
            said[h_slot] = np.where(tw > 0, ty / np.where(tw > 0, tw, 1), fallback)[h_at]
        if level == depths[len(out)] or not k:
            out.append(said.reshape(trees, -1).sum(axis=0))
            continue
        # Nodes that could split at all, numbered anew.
        wide = (tw > 2 * max(least, 1) - 0.5) & (np.bincount(at, minlength=k) > 1)
        number, k = np.cumsum(wide) - 1, int(wide.sum())
        keep = np.flatnonzero(wide[at])
        at, rows, w, y, tw, ty = number[at[keep]], rows[keep], w[keep], y[keep], tw[wide], ty[wide]
        keep = np.flatnonzero(wide[h_at])
        h_at, h_rows, h_slot = number[h_at[keep]], h_rows[keep], h_slot[keep]
        allowed = None
        if look < len(sizes):
            drawn = rng.random((k, len(sizes)))
            allowed = drawn <= np.partition(drawn, look - 1, axis=1)[:, look - 1 : look]
        new, next_at, next_h = 0, np.full(len(at), -1), np.full(len(h_at), -1)
        for low in range(0, k, NODES):
            part = slice(low, min(low + NODES, k))
            mine, theirs = (slice(*np.searchsorted(x, [part.start, part.stop])) for x in (at, h_at))
            feature, cut, mask = best_splits(
                bins, sizes, nominal, at[mine] - low, rows[mine], w[mine], y[mine], tw[part], ty[part],
                None if allowed is None else allowed[part], least,
            )
            child = np.where(feature >= 0, new + 2 * (np.cumsum(feature >= 0) - 1), -1)
            for span, places, whose, to in ((mine, at, rows, next_at), (theirs, h_at, h_rows, next_h)):
                node = places[span] - low
                on = np.flatnonzero(child[node] >= 0)
                node = node[on]
                value = bins[feature[node], whose[span][on]]
                right = value > cut[node]
                odd = np.flatnonzero(unordered[feature[node]])
                right[odd] = ~mask[node[odd], value[odd]]
                to[span.start + on] = child[node] + right
            new += 2 * int((feature >= 0).sum())
        k, level = new, level + 1
        order = np.argsort(next_at, kind="stable")[np.count_nonzero(next_at < 0) :]
        at, rows, w, y = next_at[order], rows[order], w[order], y[order]
        order = np.argsort(next_h, kind="stable")[np.count_nonzero(next_h < 0) :]
        h_at, h_rows, h_slot = next_h[order], h_rows[order], h_slot[order]
    return np.array(out)


def groups_of(sizes: Sequence[int], most: int) -> list[tuple[int, int]]:
    """Trees first to last of each group; no group crosses a wanted number of trees."""
    ends = sorted(set(sizes))
    return [(a, min(a + most, end)) for start, end in zip([0, *ends[:-1]], ends) for a in range(start, end, most)]


def errors(table: DataFrame, candidates: Sequence[tuple[int, int, int, str]], folds: Sequence[int], seed: int, rows: int) -> DataFrame:
    """(fold, slot, n, mse_<size>...): squared errors of forests over the rows of each held-out fold.

    ``candidates`` are (trees, depth, least rows of a leaf, features looked at); ``slot`` is the
    place of the last three among :func:`slots`.  ``table`` is one of :func:`binned.binned` with a column ``row``.
    """
    described = table.schema["bins"].metadata["ml_attr"]
    nominal = {a["idx"] for a in described["attrs"].get("nominal", [])}
    features = described["num_attrs"]
    places, sizes = slots(candidates), sorted({c[0] for c in candidates})
    fits = sorted({(least, look) for _, least, look in places})
    groups = groups_of(sizes, max(1, min(TREES, 1_000_000 // max(rows, 1))))
    width = max(b - a for a, b in groups)
    folds = list(folds)

    def task(part: pa.Table) -> pa.Table:
        first, last = groups[part["part"][0].as_py()]
        count = last - first
        column = lambda name: part[name].to_numpy()
        bins = np.stack([column(f"b{f}").astype(np.int32) for f in range(features)])
        bin_counts = [int(b.max()) + 1 for b in bins]
        fold, n, total = column("fold"), column("n"), column("sum")
        # About the mean, so that sums of squares keep their digits.
        mean = total.sum() / n.sum()
        bags = [(column(f"w{t}"), column(f"s{t}")) for t in range(count)]
        rows_out, votes = [], []
        for out in folds:
            fit, held = fold != out, np.flatnonzero(fold == out)
            if not len(held) or not fit.any():
                continue
            own = [np.flatnonzero(fit & (w > 0)) for w, _ in bags]
            row = np.concatenate(own)
            tree = np.repeat(np.arange(count), [len(o) for o in own])
            w = np.concatenate([w[o] for (w, _), o in zip(bags, own)])
            y = np.concatenate([s[o] for (_, s), o in zip(bags, own)]) - w * mean
            fallback = total[fit].sum() / n[fit].sum() - mean
            found = np.zeros((len(places), len(held)))
            for least, look in fits:
                depths = sorted(d for d, l, k in places if (l, k) == (least, look))
                rng = np.random.default_rng([seed, first, out, least, list(LOOKED_AT).index(look)])
                said = grow(bins, bin_counts, nominal, row, tree, w, y, count, fallback, held, depths, least, LOOKED_AT[look](features), rng)
                for depth, values in zip(depths, said):
                    found[places.index((depth, least, look))] = values + count * mean
            rows_out.append(column("row")[held])
            votes.append(found.T)
        held_rows = np.concatenate([np.zeros(0, np.int64), *rows_out])
        flat = np.concatenate([np.zeros((0, len(places))), *votes]).ravel()
        offsets = np.arange(len(held_rows) + 1, dtype=np.int32) * len(places)
        return pa.table(
            {
                "row": pa.array(held_rows, pa.int64()),
                "upto": pa.array(np.full(len(held_rows), last), pa.int32()),
                "votes": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
            }
        )

    firsts = F.array(*[F.lit(a) for a, _ in groups])
    dealt = table.select(
        "row", "fold", F.col("n").cast("double").alias("n"), "sum", "w", "s", vector_to_array("bins").alias("_bins"), F.explode(F.sequence(F.lit(0), F.lit(len(groups) - 1))).alias("part")
    ).withColumn("_at", F.get(firsts, F.col("part")))
    dealt = dealt.select(
        "part", "row", "fold", "n", "sum",
        *[F.col("_bins")[f].alias(f"b{f}") for f in range(features)],
        # Past the last tree of all, a short group has nulls that no one reads.
        *[F.get(c, F.col("_at") + t).alias(f"{c}{t}") for c in "ws" for t in range(width)],
    )
    # As many partitions as groups, so that adaptive execution does not put them into one.
    said = dealt.repartition(len(groups), "part").groupBy("part").applyInArrow(task, "row bigint, upto int, votes array<double>")
    each = said.select("row", "upto", F.posexplode("votes").alias("slot", "vote"))
    sums = each.groupBy("row", "slot").agg(*[(F.sum(F.when(F.col("upto") <= size, F.col("vote"))) / size).alias(f"p_{size}") for size in sizes])
    known = sums.join(table.select("row", "fold", "n", "sum", "squares"), "row")
    lost = {size: F.col("n") * F.col(f"p_{size}") ** 2 - 2 * F.col(f"p_{size}") * F.col("sum") + F.col("squares") for size in sizes}
    return known.groupBy("fold", "slot").agg(
        F.sum("n").alias("n"), *[ratio(F.sum(lost[size]), F.sum("n").cast("double")).alias(f"mse_{size}") for size in sizes]
    )


def slots(candidates: Sequence[tuple[int, int, int, str]]) -> list[tuple[int, int, str]]:
    """Settings but for the number of trees, each once."""
    return sorted({c[1:] for c in candidates})
