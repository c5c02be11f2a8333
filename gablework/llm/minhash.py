"""Near duplicates by consistent weighted sampling over weighted word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from gablework.llm.common import components, staged_small, text_or_empty
from gablework.session import stage

#: Words of a shingle, similarity of a link, and the sampling: bands of rows.
SHINGLE, SIMILARITY, BANDS, ROWS = 5, 0.8, 10, 3
#: Cells of the table of document counts: a fixed size, whatever the corpus.
CELLS = 1 << 18
#: A shingle in at most one of so many documents has full weight.
RARE = 32
#: Room for rounding where a sum of weights is held against a limit; pairs are verified after it.
SLACK = 1e-6
#: Members of a bucket in one part of it.
SPREAD = 64

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _step(times: int) -> np.uint64:
    """A multiple of the golden step, modulo 2**64."""
    return np.uint64(int(_GOLD) * times % 2**64)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


#: An odd base of the bytes' polynomial and its inverse, modulo 2**64.
_BASE = 0x9E3779B185EBCA87
_INVERSE = pow(_BASE, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Shingler:
    """Distinct shingles of texts, from the bytes of many texts at once."""

    #: Bytes of texts taken together.
    CHUNK = 1 << 20

    def __init__(self):
        self.up = self.down = np.ones(0, dtype=np.uint64)

    def _word_hashes(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of each run of bytes that are no white space."""
        n = len(data)
        if n > len(self.up):
            self.up, self.down = _powers(_BASE, n), _powers(_INVERSE, n)
        inside = np.zeros(n + 2, dtype=np.int8)
        inside[1:-1] = ~((data == 32) | ((data >= 9) & (data <= 13)))
        edge = np.diff(inside)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:n], dtype=np.uint64, out=sums[1:])
        return start, _mix((sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64))

    def __call__(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """For parts of the rows: first row, rows, and (row in the part, hash, times) by row and hash.

        Words are compared in lower case.  A row of fewer words than a shingle has
        one shingle of all its words; a row without words has none.
        """
        low = pc.utf8_lower(texts.cast(pa.large_string()))
        offsets = np.frombuffer(low.buffers()[1], dtype=np.int64)[low.offset : low.offset + len(low) + 1]
        content = low.buffers()[2]
        whole = np.frombuffer(content, dtype=np.uint8) if content is not None else np.zeros(0, dtype=np.uint8)
        i = 0
        while i < len(low):
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + self.CHUNK, side="right")) - 1)
            j = min(j, i + 60_000, len(low))
            yield i, j - i, *self._part(whole, offsets[i : j + 1])
            i = j

    def _part(self, whole: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        # A blank between texts, so that no word runs on into the next one.
        sizes = np.diff(offsets)
        data = np.full(int(sizes.sum()) + len(sizes), 32, dtype=np.uint8)
        first_byte = np.concatenate([[0], np.cumsum(sizes + 1)])
        data[np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)), sizes)] = whole[offsets[0] : offsets[-1]]
        start, words = self._word_hashes(data)
        bounds = np.searchsorted(start, first_byte)
        n_words = np.diff(bounds)
        counts = np.where(n_words >= SHINGLE, n_words - SHINGLE + 1, np.minimum(n_words, 1))
        row = np.repeat(np.arange(len(sizes), dtype=np.uint16), counts)
        first = np.repeat(bounds[:-1], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        last = np.repeat(bounds[1:], counts) - 1
        code = np.zeros(len(first), dtype=np.uint64)
        for i in range(SHINGLE):
            at = first + i
            code = np.where(at <= last, _mix(code * _GOLD + words[np.minimum(at, last)]), code)
        order = np.lexsort((code, row))
        row, code = row[order], code[order]
        new = np.ones(len(row), dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (code[1:] != code[:-1])
        at = np.flatnonzero(new)
        return row[at].astype(np.int64), code[at], np.diff(np.append(at, len(row)))


def _cell(code: np.ndarray) -> np.ndarray:
    return (code >> np.uint64(64 - (CELLS.bit_length() - 1))).astype(np.int64)


class Weights:
    """tf-idf weights; idf is 1 up to one document in RARE and falls with the logarithm beyond."""

    def __init__(self, cells: np.ndarray, counts: np.ndarray, documents: int):
        self.idf = np.ones(CELLS)
        self.idf[cells] = np.minimum(1.0, np.log1p(documents / np.maximum(counts, 1)) / np.log1p(RARE))

    def __call__(self, code: np.ndarray, times: np.ndarray) -> np.ndarray:
        return times * self.idf[_cell(code)]


def corpus_weights(docs: DataFrame, text: str = "text") -> Weights:
    """Document counts of all shingles, in a table of fixed size.

    Each cell counts the documents' distinct shingles that fall into it; tasks add
    up their own before the shuffle.  Only cells with more than one in RARE
    documents are fetched: at most RARE times the shingles of a mean document,
    and never more than CELLS.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, dtype=np.int64)
        documents, shingler = 0, Shingler()
        for batch in batches:
            for _, _, _, code, _ in shingler(batch.column(0)):
                counts += np.bincount(_cell(code), minlength=CELLS)
            documents += batch.num_rows
        cells = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(cells, -1), pa.int64()), pa.array(np.append(counts[cells], documents), pa.int64())],
            names=["cell", "n"],
        )

    rows = docs.select(text_or_empty(text).alias("text")).mapInArrow(task, "cell bigint, n bigint")
    counted = stage(rows.groupBy("cell").agg(F.sum("n").alias("n")), "shingle-counts")
    total = counted.where("cell = -1").first()
    documents = total["n"] if total else 0
    frequent = counted.where((F.col("cell") >= 0) & (F.col("n") * RARE > documents)).toPandas()
    return Weights(frequent["cell"].to_numpy(dtype=np.int64), frequent["n"].to_numpy(dtype=np.int64), documents)


def _uniforms(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers within (0, 1) from the upper and lower half."""
    scale = np.float32(2.0**-24)
    top, low = (x >> np.uint64(40)).astype(np.float32), ((x >> np.uint64(8)) & np.uint64(0xFFFFFF)).astype(np.float32)
    half = np.float32(0.5)
    return np.minimum((top + half) * scale, np.float32(1 - 2**-24)), np.minimum((low + half) * scale, np.float32(1 - 2**-24))


class _Side:
    """The elements of some rows with one of their weights."""

    def __init__(self, row: np.ndarray, weight: np.ndarray, part: slice | np.ndarray):
        self.part, self.row, self.log_weight = part, row[part], np.log(weight[part]).astype(np.float32)
        self.present, self.start = np.unique(self.row, return_index=True)
        self.counts = np.diff(np.append(self.start, len(self.row)))

    def least(self, r: np.ndarray, log_c: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and t of the element taken of each row."""
        r, log_c, b = r[self.part], log_c[self.part], b[self.part]
        t = np.floor(self.log_weight / r + b)
        a = log_c - r * (t - b) - r
        hit = np.flatnonzero(a == np.repeat(np.minimum.reduceat(a, self.start), self.counts))
        _, at = np.unique(self.row[hit], return_index=True)
        return hit[at], t[hit[at]]


def samples(row: np.ndarray, code: np.ndarray, weight: np.ndarray, plain: np.ndarray, rows: int, size: int) -> np.ndarray:
    """(rows, 2 * size) consistent weighted samples of rows that each have some element, by ``weight`` and then by ``plain``.

    Per element and sample r and c are Gamma(2, 1) and b is uniform, all drawn from the
    element's hash; t = floor(ln w / r + b), and the element with the least
    ln c - r (t - b) - r is taken, with its t.  Both weights see the same draws, so
    a row whose weights are all equal has the same samples by both.
    """
    present, start = np.unique(row, return_index=True)
    out = np.zeros((rows, 2 * size), dtype=np.uint64)
    if not len(present):
        return out
    differs = np.logical_or.reduceat(weight != plain, start)
    sides = [_Side(row, weight, slice(None)), _Side(row, plain, np.repeat(differs, np.diff(np.append(start, len(row)))))]
    for j in range(size):
        seed = _mix(code + _step(2 * j + 1))
        u1, u2 = _uniforms(seed)
        second = _mix(seed + _GOLD)
        u3, u4 = _uniforms(second)
        b, _ = _uniforms(_mix(second + _GOLD))
        r = -np.log(u1 * u2)
        log_c = np.log(-np.log(u3 * u4))
        for side, place in zip(sides, (j, size + j)):
            out[:, place] = out[:, j]
            if len(side.row):
                at, t = side.least(r, log_c, b)
                out[side.present, place] = _mix(code[side.part][at] ^ _mix(t.astype(np.int64).view(np.uint64) + _GOLD))
    return out


def signatures(docs: DataFrame, weights: Weights, text: str = "text") -> DataFrame:
    """(doc_id, h1, h2, bands): the text's identity and one key per band; no keys without words.

    The first BANDS keys are drawn by tf-idf, the others by plain tf weights: a link by
    tf alone may be far less similar by tf-idf where its shingles are in many documents.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            bands = []
            for _, rows, row, code, times in shingler(batch.column(3)):
                drawn = samples(row, code, weights(code, times), times.astype(float), rows, BANDS * ROWS)
                keys = np.zeros((rows, 2 * BANDS), dtype=np.uint64)
                for i in range(2 * BANDS * ROWS):
                    keys[:, i // ROWS] = _mix(keys[:, i // ROWS] * _GOLD + drawn[:, i])
                has = np.bincount(row, minlength=rows) > 0
                bands += [k.tolist() if h else [] for k, h in zip(keys.view(np.int64), has)]
            found = pa.array(bands, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], found], names=["doc_id", "h1", "h2", "bands"])

    body = text_or_empty(text)
    rows = docs.select("doc_id", F.xxhash64(body).alias("h1"), F.xxhash64(F.lit(7), body).alias("h2"), body.alias("text"))
    return rows.mapInArrow(task, f"doc_id {kind}, h1 bigint, h2 bigint, bands array<bigint>")


def _occurrences(texts: pa.Array, weights: Weights) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, idf) of every shingle occurrence, numbered within its row.

    Two rows share the lesser of their counts of a shingle, so the weighted
    similarity of the rows is that of these sets.
    """
    out = []
    for first, _, row, code, times in Shingler()(texts):
        number = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        each = np.repeat(code, times)
        idf = weights.idf[_cell(each)]
        out.append((np.repeat(row + first, times), np.where(number > 0, _mix(each + number.astype(np.uint64) * _GOLD), each), idf))
    if not out:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), np.zeros(0)
    return tuple(np.concatenate([o[i] for o in out]) for i in range(3))


def _similar(shared: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Whether the similarity reaches the limit by tf-idf or by plain tf weights, which stand last."""
    score = np.divide(shared, total - shared, out=np.zeros_like(shared), where=total > shared)
    return (score >= SIMILARITY - 1e-9).any(axis=-1)


def weighted_jaccard(left: pa.Array, right: pa.Array, weights: Weights) -> tuple[np.ndarray, np.ndarray]:
    """Row by row the shared and the summed weights, by tf-idf and by tf."""
    n = len(left)
    sides = [_occurrences(x, weights) for x in (left, right)]
    row, code, idf = (np.concatenate([s[i] for s in sides]) for i in range(3))
    order = np.lexsort((code, row))
    row, code, idf = row[order], code[order], idf[order]
    same = np.flatnonzero((row[1:] == row[:-1]) & (code[1:] == code[:-1]))
    shared = [np.bincount(row[same], weights=w[same], minlength=n) for w in (idf, np.ones(len(idf)))]
    total = [np.bincount(row, weights=w, minlength=n) for w in (idf, np.ones(len(idf)))]
    return np.stack(shared, axis=-1), np.stack(total, axis=-1)


def verified(pairs: DataFrame, texts: DataFrame, weights: Weights) -> DataFrame:
    """Pairs (a, b) whose texts are similar enough; ``texts`` is (node, text)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = _similar(*weighted_jaccard(batch.column(2), batch.column(3), weights))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2]], names=["a", "b"]).filter(pa.array(good))

    one = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    two = one.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return two.select("a", "b", "text_a", "text_b").mapInArrow(task, "a bigint, b bigint")


def _occurrence_counts(texts: DataFrame, weights: Weights) -> np.ndarray:
    """How often the shingle occurrences of each cell come in ``texts``: a table of fixed size."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, dtype=np.int64)
        for batch in batches:
            counts += np.bincount(_cell(_occurrences(batch.column(0), weights)[1]), minlength=CELLS)
        cells = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(counts[cells])], names=["cell", "n"])

    counted = texts.select("text").mapInArrow(task, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(CELLS, dtype=np.int64)
    out[counted["cell"].to_numpy(dtype=np.int64)] = counted["n"].to_numpy(dtype=np.int64)
    return out


def _prefixes(texts: DataFrame, weights: Weights) -> DataFrame:
    """(key, node, component, total, rest, short): the rarest shingle occurrences of each text, by both weights.

    Occurrences stand in one order for all texts, rarest first.  ``rest`` is the weight
    from an occurrence on.  Where it is the first that two texts share, they share
    at most the lesser ``rest``; an occurrence is left out where that can't reach the
    limit, and is not ``short`` where it can't with a text at least as heavy.
    """
    common = _occurrence_counts(texts, weights)
    brief = 2 * SIMILARITY / (1 + SIMILARITY)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, code, idf = _occurrences(batch.column(2), weights)
            if not len(row):
                continue
            order = np.lexsort((code, common[_cell(code)], row))
            row, code, idf = row[order], code[order], idf[order]
            first = np.flatnonzero(np.diff(row, prepend=-1))
            times = np.diff(np.append(first, len(row)))
            for measure, weight in enumerate((idf, np.ones(len(idf)))):
                before = np.cumsum(weight) - weight
                total = np.repeat(np.add.reduceat(weight, first), times)
                rest = total - (before - np.repeat(before[first], times))
                taken = np.flatnonzero(rest >= (SIMILARITY - SLACK) * total)
                at = pa.array(row[taken])
                short = rest[taken] >= (brief - SLACK) * total[taken]
                key = _mix(code[taken] + _step(measure + 1)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), batch.column(0).take(at), batch.column(1).take(at), *map(pa.array, (total[taken], rest[taken], short))],
                    names=["key", "node", "component", "total", "rest", "short"],
                )

    kinds = "key bigint, node bigint, component bigint, total double, rest double, short boolean"
    return texts.select("node", "component", "text").mapInArrow(task, kinds)


def candidates(texts: DataFrame, weights: Weights) -> DataFrame:
    """Pairs (a, b) of ``texts`` (node, component, text): all similar ones of different components, and few others.

    Similar texts share an occurrence among the rarest fifth or so of each, and among the
    rarest ninth of the lighter one, so a join on those finds them all.  A key whose
    texts are in one component is dropped; elsewhere the texts outside a key's largest
    component are joined with all others, so that a large group of copies that is
    connected already is never joined with itself.
    """
    found = stage(_prefixes(texts, weights), "prefixes")
    parts = found.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    parts = parts.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("major"), F.count(F.lit(1)).alias("parts"))
    shared = stage(found.join(parts.where("parts > 1").drop("parts").hint("merge"), "key"), "prefixes")
    sides = [shared.where("component <> major"), shared]
    names = ["node", "component", "total", "rest", "short"]
    one, two = (side.select("key", *[F.col(n).alias(f"{n}_{i}") for n in names]) for i, side in enumerate(sides))
    lighter = F.struct("total_0", "node_0") < F.struct("total_1", "node_1")
    close = (
        (F.col("component_0") != F.col("component_1"))
        & F.when(lighter, F.col("short_0")).otherwise(F.col("short_1"))
        & (F.least("total_0", "total_1") >= (SIMILARITY - SLACK) * F.greatest("total_0", "total_1"))
        & (F.least("rest_0", "rest_1") >= (SIMILARITY / (1 + SIMILARITY) - SLACK) * (F.col("total_0") + F.col("total_1")))
    )
    joined = one.join(two.hint("merge"), "key").where(close)
    return joined.select(F.greatest("node_0", "node_1").alias("a"), F.least("node_0", "node_1").alias("b")).distinct()


def _key_counts(members: DataFrame) -> DataFrame:
    """(bucket, i, key, n): how many members in a batch of (bucket, bands) have a key in place i; add up the batches' rows."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
            key = batch.column(1).flatten().to_numpy()
            if not len(key):
                continue
            bucket = np.repeat(batch.column(0).to_numpy(), sizes)
            place = np.arange(len(key)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            order = np.lexsort((key, place, bucket))
            bucket, place, key = bucket[order], place[order], key[order]
            new = np.ones(len(key), dtype=bool)
            new[1:] = (bucket[1:] != bucket[:-1]) | (place[1:] != place[:-1]) | (key[1:] != key[:-1])
            at = np.flatnonzero(new)
            columns = [bucket[at], place[at].astype(np.int32), key[at], np.diff(np.append(at, len(key)))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["bucket", "i", "key", "n"])

    return members.select("bucket", "bands").mapInArrow(task, "bucket bigint, i int, key bigint, n bigint")


def _typical(members: DataFrame, bands: DataFrame) -> DataFrame:
    """Pairs (a, b) of each bucket's most typical member and those of its members that are not connected to it.

    ``members``: bucket, node, component, size.  The keys that are most common in a group of near copies
    are those of the text they were made from; the member with most of the bucket's
    most common keys is compared with the others.  A large bucket's members are spread
    over parts of about SPREAD rows, and its most common keys go to each part.
    """

    def parts(size: str) -> Column:
        return F.ceil(F.col(size) / SPREAD)

    # Written part by part, so that a task counts equal keys of a part where it reads them.
    parted = members.join(bands, "node").withColumn("part", F.pmod(F.xxhash64("node"), parts("size")))
    keyed = stage(parted.repartition("bucket", "part"), "members")
    counts = _key_counts(keyed).groupBy("bucket", "i", "key").agg(F.sum("n").alias("n"))
    modes = counts.groupBy("bucket", "i").agg(F.max_by("key", F.struct("n", "key")).alias("key"), F.sum("n").alias("size"))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("i", "key"))), lambda x: x["key"])
    modes = modes.groupBy("bucket").agg(listed.alias("modes"), F.max("size").alias("size"))
    modes = modes.select("bucket", F.explode(F.sequence(F.lit(0).cast("bigint"), parts("size") - 1)).alias("part"), "modes")
    agree = F.zip_with("bands", "modes", lambda x, y: (x == y).cast("int"))
    scored = keyed.join(stage(modes, "modes"), ["bucket", "part"]).withColumn("agree", F.aggregate(agree, F.lit(0), lambda x, y: x + y))
    centre = F.max_by(F.struct("node", "component"), F.struct("agree", -F.col("node")))
    centres = stage(scored.groupBy("bucket").agg(centre.alias("centre")), "centres")
    apart = members.join(centres, "bucket").where("component <> centre.component")
    return apart.select(F.greatest("node", "centre.node").alias("a"), F.least("node", "centre.node").alias("b")).distinct()


def _open(members: DataFrame, found: DataFrame) -> DataFrame:
    """(bucket, node, component, size): the members of buckets that hold several components, and how many they are."""
    named = members.select("bucket", "node").join(found, "node", "left")
    named = stage(named.select("bucket", "node", F.coalesce("component", "node").alias("component")), "spokes")
    mixed = named.groupBy("bucket").agg(
        F.min("component").alias("least"), F.max("component").alias("most"), F.count(F.lit(1)).alias("size")
    )
    return stage(named.join(stage(mixed.where("least < most").select("bucket", "size"), "open"), "bucket"), "open")


def links(members: DataFrame, bands: DataFrame, texts: DataFrame, weights: Weights, given: DataFrame) -> DataFrame:
    """Connected components (node, component) over all similar pairs that share a bucket, and the links given.

    ``members`` is (bucket, band, node), ``bands`` (node, bands).  Each bucket's
    members are compared with its smallest node, then, where they are in several
    components, with its most typical member.  All texts of buckets that still hold several
    components are joined by their rarest shingles, see :func:`candidates`, whatever
    bucket they share.  So no pair in a bucket is left out, and no bucket is compared all with all.
    """
    centres = stage(members.groupBy("bucket").agg(F.min("node").alias("centre")), "centres")
    spokes = stage(members.join(centres, "bucket").where("node <> centre"), "spokes")
    star = spokes.select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
    edges = stage(verified(stage(star, "pairs"), texts, weights).unionByName(given), "links")
    found = components(edges)
    rows = _open(spokes, found)
    if rows.isEmpty():
        return found
    more = stage(verified(stage(_typical(rows, bands), "pairs"), texts, weights), "links")
    if not more.isEmpty():
        edges = edges.unionByName(more)
        found = components(edges)
        rows = _open(rows, found)
    left = stage(rows.select("node", "component").distinct().join(texts, "node"), "open")
    if left.isEmpty():
        return found
    more = stage(verified(stage(candidates(left, weights), "pairs"), texts, weights), "links")
    return found if more.isEmpty() else components(edges.unionByName(more))


def _hash_name(h1: Column) -> Column:
    """A name from a text's hash, above all doc_ids, so that a class with a doc_id is never named by it."""
    return h1.bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))


def _own_name() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), _hash_name(F.col("h1")))


def _nodes(signed: DataFrame) -> DataFrame:
    """(h1, h2, name, node, bands): a node per distinct text.

    ``name`` is the smallest doc_id that has the text and is its node; of several texts with
    one such doc_id the others have a node from their hash.
    """
    texts = stage(
        signed.groupBy("h1", "h2").agg(F.min(_own_name()).alias("name"), F.first("bands").alias("bands")),
        "nodes",
    )
    crowded = texts.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("h1", "h2")).alias("first"))
    crowded = stage(crowded.where("n > 1").drop("n"), "crowded")
    if crowded.isEmpty():
        return texts.withColumn("node", F.col("name"))
    found = texts.join(crowded.hint("merge"), "name", "left")
    own = F.col("first").isNull() | (F.col("first") == F.struct("h1", "h2"))
    return stage(found.withColumn("node", F.when(own, F.col("name")).otherwise(_hash_name(F.col("h1")))).drop("first"), "nodes")


def _same_document(signed: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links (a, b) between the texts of one doc_id."""
    several = signed.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min(F.struct("h1", "h2")).alias("least"), F.max(F.struct("h1", "h2")).alias("most")
    )
    several = stage(several.where("least <> most").select("doc_id"), "several")
    if several.isEmpty():
        return signed.sparkSession.createDataFrame([], "a bigint, b bigint")
    named = signed.join(several.hint("merge"), "doc_id").join(nodes.select("h1", "h2", "node").hint("merge"), ["h1", "h2"])
    pairs = stage(named.select("doc_id", "node").distinct(), "several")
    least = pairs.groupBy("doc_id").agg(F.min("node").alias("b"))
    return pairs.join(least, "doc_id").where("node <> b").select(F.col("node").alias("a"), "b").distinct()


def _classified(docs: DataFrame, text: str) -> DataFrame:
    """(doc_id, h1, h2, node, class_id) of every row; a node is a distinct text."""
    weights = corpus_weights(docs, text)
    signed = stage(signatures(docs, weights, text), "signatures")
    nodes = _nodes(signed)
    # Bands by tf-idf and by tf share their buckets: a text whose weights are all 1 is in each once.
    band_and_bucket = F.transform("bands", lambda key, i: F.struct((i % BANDS).alias("band"), F.xxhash64(i % BANDS, key).alias("bucket")))
    keyed = nodes.select("node", F.inline(F.array_distinct(band_and_bucket)))
    shared = stage(keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket"), "buckets")
    members = stage(keyed.join(shared, "bucket").distinct(), "members")
    wanted = stage(members.select("node").distinct().join(nodes, "node"), "wanted")
    body = text_or_empty(text)
    rows = docs.select("doc_id", body.alias("text"), F.xxhash64(body).alias("h1"), F.xxhash64(F.lit(7), body).alias("h2"))
    # Of all rows with a text, those of the doc_id that names it give it: copies stay where they are.
    # The texts wanted grow with the corpus: never a broadcast, also where they are few.
    ids = wanted.select("name", "node", "h1", "h2").hint("merge")
    named_rows = rows.withColumn("name", _own_name()).join(ids, ["name", "h1", "h2"])
    texts = staged_small(named_rows.groupBy("node").agg(F.max("text").alias("text")), "texts")
    found = links(members, wanted.select("node", "bands"), texts, weights, _same_document(signed, nodes))
    named = stage(nodes.join(found, "node", "left").select("h1", "h2", "node", F.coalesce("component", "node").alias("class_id")), "classes")
    return signed.drop("bands").join(named, ["h1", "h2"])


def classes(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, class_id, kept): documents whose texts are linked, named by the smallest doc_id.

    Words are runs of non-white characters in lower case.  Equal texts are one
    node from the start, so a group of copies costs one comparison.  Texts
    without words, null ones included, are linked with equal texts only.  Texts of
    one to four words are one shingle.  Rows that share a doc_id are one
    document: their texts are linked whatever they say.  A null doc_id is linked
    like others; a class of none but nulls has a hash as its name.  Texts of any
    length are compared whole.  Other columns are ignored; no rows give no rows.
    """
    return _classified(docs, text).select("doc_id", "class_id", _stays().alias("kept"))


def _stays() -> Column:
    """Whether a row is the one its class keeps."""
    return (F.col("node") == F.col("class_id")) & (_own_name() == F.col("node"))


def keep_one(docs: DataFrame, text: str = "text") -> DataFrame:
    """The document of each class with the smallest doc_id; all columns as they were.

    Rows that repeat both doc_id and text are kept once; see :func:`classes` for the rest.
    """
    body = text_or_empty(text)
    keys = {"__id": F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "__h1": F.xxhash64(body), "__h2": F.xxhash64(F.lit(7), body)}
    rows = stage(_classified(docs, text), "classes").where(_stays())
    kept = stage(
        rows.groupBy(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")).alias("__id"), F.col("h1").alias("__h1"), F.col("h2").alias("__h2"))
        .agg(F.count(F.lit(1)).alias("__times")),
        "kept",
    )
    out = docs.withColumns(keys).join(kept, list(keys))
    if not kept.where("__times > 1").isEmpty():
        once = out.where("__times > 1").dropDuplicates(list(keys))
        out = out.where("__times = 1").unionByName(once)
    return out.select(*docs.columns)
