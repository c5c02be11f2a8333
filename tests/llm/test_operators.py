"""The operators against brute force, on small tables with every awkward row."""

import hashlib
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gablework.llm import chat, factors, graphs, line_dedup, minhash, packing, pieces, quality_rules, ranked_bytes, tokens, toxicity
from gablework.llm.common import components, prepared, vocabulary
from gablework.session import stage

WORDS, PIECES = vocabulary("word_bpe_49k.json"), vocabulary("piece_bpe_32k.model")
# Extra columns bear names that the operators use themselves.
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n long, node string, bucket int, score double, kept string"


def word(i):
    return "".join(chr(97 + (i * 7 + k * k) % 26) for k in range(3 + i % 6)) + str(i)


def prose(first, n, width=12):
    words = [word(i) for i in range(first, first + n)]
    return "\n".join(" ".join(words[i : i + width]) + "." for i in range(0, n, width))


BASE = prose(0, 200)
NEAR = BASE.replace(word(77), "changed")
TEXTS = [
    (1, BASE),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (5, BASE),
    (5, BASE),
    (6, NEAR),
    (7, prose(1000, 30000)),
    (8, "It's ok, isn't it?! Ünïcödé İstanbul ΣΑΣ é <|endoftext|> \x01 a_, b ½ 12,345.  two  spaces ▁mark x"),
    (None, prose(60000, 120)),
    (None, None),
    (9, "one two three"),
    (10, "same same same " * 40),
    (11, prose(50000, 36) + "\n" + prose(0, 60)),
]


@pytest.fixture(scope="module")
def docs(spark):
    prepared(spark)
    rows = [(i, t, "en", "s", len(t or ""), 1, "x", 2, 0.5, "y") for i, t in TEXTS]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


def texts():
    return [(i, t or "") for i, t in TEXTS]


def test_rules_equal_brute_force(docs, nothing):
    want = Counter()
    for i, t in texts():
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        ls = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        triples = Counter(zip(ws, ws[1:], ws[2:]))
        covered = {k + j for k in range(len(ws) - 2) if triples[tuple(ws[k : k + 3])] > 1 for j in range(3)}
        failed = len(ws) < 50 or 100 * len(covered) > 50 * len(ws)
        want[i, len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(ls) - len(set(ls)), len(covered), failed] += 1
    got = quality_rules.report(docs).collect()
    assert Counter(tuple(r)[:-1] for r in got) == want
    assert not any(r["base_failed"] and r["kept"] for r in got)
    assert quality_rules.report(nothing).count() == 0
    plain = docs.withColumn("text", F.concat("text", F.lit(" the of and to is in" * 8)))
    kept = quality_rules.keep_good(plain)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {1, 5, 6, 11, None}


def test_token_files_round_trip(docs, nothing):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORDS)
    want = Counter()
    for i, text in texts():
        ids = np.array(t.encode(text, add_special_tokens=False).ids + [2], dtype="<u4")
        want[i, len(ids), zlib.crc32(ids.tobytes())] += 1
    got = ranked_bytes.report(docs, WORDS).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    got.sort(key=lambda r: r["start"])
    assert [r["start"] for r in got] == [sum(r["n_tokens"] for r in got[:k]) for k in range(len(got))]
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert ids == sorted(ids)
    assert ranked_bytes.report(nothing, WORDS).count() == 0


def test_ranks_come_from_counts_made_while_encoding(spark):
    """The counts of the groups of texts are those of all ids, and are all that the ranks read."""
    prepared(spark)
    texts = [None, "", "a b a", "the house, the cat. The end", "ünï 😀 the"] * 40
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    encoded = tokens.encode(docs, WORDS, 2, counts=True).persist()
    ids, often = np.unique(np.frombuffer(b"".join(r["ids"] for r in encoded.collect()), dtype="<u4"), return_counts=True)
    ranks = ranked_bytes.frequency_ranks(encoded.select("counts"))
    assert ranks.tolist() == ids[np.lexsort((ids, -often))].tolist()
    encoded.unpersist()


def test_coded_numbers_of_every_width():
    numbers = np.array([0, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 5], dtype="<u4")
    some = [numbers.tobytes(), b"", numbers[:5].tobytes()]
    same = np.arange(2**24 + 1, dtype=np.uint32)
    control, data = ranked_bytes.pack(some, same)
    assert ranked_bytes.unpack(control, data, [8, 0, 5], same) == some


def test_packing_covers_every_id_once(docs, nothing):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORDS)
    ids = {}
    for i, text in texts():
        ids.setdefault(i, []).append(np.array(t.encode(text, add_special_tokens=False).ids + [1], dtype="<u4"))
    rows = packing.report(docs, WORDS).collect()
    assert sum(r["length"] for r in rows) == sum(len(x) for xs in ids.values() for x in xs)
    for r in rows:
        parts = [x[r["start"] : r["start"] + r["length"]] for x in ids[r["doc_id"]] if len(x) == r["doc_tokens"]]
        assert r["ids_crc32"] in [zlib.crc32(p.tobytes()) for p in parts]
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    lengths = []
    for spans in sequences.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))]
        lengths.append(sum(n for _, n in spans))
    assert max(lengths) <= 2048 and sum(n & (n - 1) != 0 for n in lengths) <= 1
    assert sorted(sequences) == list(range(len(sequences)))
    assert packing.report(nothing, WORDS).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_windows_of_whole_documents(seed):
    """Blocks replayed document by document: nothing overlaps, overflows or is left out, and no filler that fits is left."""
    rng = np.random.default_rng(seed)
    tiers = (64, 32, 16, 8)
    counts = rng.integers(0, 2 ** rng.integers(1, 9), 64) * (rng.random(64) < rng.random())
    counts[0] = 0
    filled = packing.fill_windows(counts, tiers)
    windows, ranks = {}, Counter()
    for length, rank, tier, first, n, copies, at in filled.blocks:
        assert rank == ranks[length]
        ranks[length] += n * copies
        for w in range(first, first + n):
            windows.setdefault((tier, w), []).extend((at + k * length, length) for k in range(copies))
    assert [ranks[n] for n in range(64)] == counts.tolist()
    for (tier, _), spans in windows.items():
        spans.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and spans[0][0] == 0
        longest = max(n for _, n in spans)
        assert tier == min(t for t in tiers if t >= longest) and sum(n for _, n in spans) <= tier
    stretches = {(t, w): at for t, first, n, at in filled.stretches for w in range(first, first + n)}
    assert stretches == {k: sum(n for _, n in spans) for k, spans in windows.items()}
    assert filled.gap() == sum(t - at for (t, _), at in stretches.items())


@pytest.mark.parametrize("seed", range(12))
def test_as_few_documents_are_cut_as_fill_the_gaps(seed):
    rng = np.random.default_rng(seed)
    tiers = (64, 32, 16, 8)
    cells = rng.integers(0, 2 ** rng.integers(1, 12), (64, 4)) * (rng.random((64, 4)) < 0.7)
    cells[0] = 0
    if seed == 0:
        cells[1:] = 0
    loose, filled = packing.choose_loose(cells, tiers)
    tokens_of = (np.where(loose, cells, 0).sum(axis=1) * np.arange(64)).sum()
    assert filled.gap() <= tokens_of
    assert sum(n * c for _, _, _, _, n, c, _ in filled.blocks) + np.where(loose, cells, 0).sum() == cells.sum()


def test_packing_keeps_most_documents_whole(spark):
    """Hot lengths and copies too: pieces are gapless, one window is padded, and few documents are cut."""
    prepared(spark)
    rows = [(i, " ".join(["the"] * (1 + i * i % 1900))) for i in range(400)] + [(7, " ".join(["the"] * 1299))] * 300 + [(None, "")] * 100
    pieces_of = packing.report(spark.createDataFrame(rows, "doc_id long, text string"), WORDS).collect()
    assert sum(r["length"] for r in pieces_of) == sum(len(t.split()) + 1 for _, t in rows)
    sizes = Counter()
    for r in pieces_of:
        sizes[r["sequence_id"], r["tier"]] += r["length"]
    assert sum(n != tier for (_, tier), n in sizes.items()) <= 1 and len({s for s, _ in sizes}) == len(sizes)
    assert sum(r["length"] == r["doc_tokens"] for r in pieces_of) > 0.6 * len(rows)


def test_packing_of_equal_lengths_needs_no_room(spark):
    prepared(spark)
    rows = spark.createDataFrame([(i, " ".join(["the"] * 1999)) for i in range(40)], "doc_id long, text string")
    pieces_of = packing.report(rows, WORDS).collect()
    assert sum(r["length"] for r in pieces_of) == 40 * 2000


def test_pieces_equal_the_library(docs, nothing):
    from sentencepiece import SentencePieceProcessor

    p = SentencePieceProcessor(model_file=PIECES)
    want = Counter()
    for i, t in texts():
        ids = p.encode(t)
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(p.decode(ids).encode()).hexdigest()] += 1
    assert Counter(map(tuple, pieces.report(docs, PIECES).collect())) == want
    assert pieces.report(nothing, PIECES).count() == 0


def test_line_windows(docs, nothing):
    rows = line_dedup.drop_repeated(docs)
    got = {r["doc_id"]: r for r in rows.collect() if r["doc_id"] is not None}
    assert rows.columns == [*docs.columns, "__n_lines", "__n_removed"] and rows.count() == len(TEXTS)
    assert got[1]["text"] == BASE and got[5]["text"] == "" and got[2]["text"] is None
    assert got[11]["text"] == prose(50000, 36) and got[11]["n_chars"] == len(prose(50000, 36))
    assert got[10]["__n_removed"] == 0 and got[7]["__n_removed"] == 0
    assert line_dedup.report(nothing).count() == 0


def test_minhash_finds_copies_and_leaves_others(docs, nothing):
    named = {(r["doc_id"]): r["class_id"] for r in minhash.classes(docs).collect() if r["doc_id"] is not None}
    assert named[1] == named[5] == named[6] == 1
    assert {i for i, c in named.items() if c != i} == {5, 6, 3, 4} - {4}
    kept = minhash.keep_one(docs).collect()
    assert Counter(r["doc_id"] for r in kept) == {1: 1, 2: 1, 4: 1, 7: 1, 8: 1, 9: 1, 10: 1, 11: 1, None: 1}
    assert minhash.classes(nothing).count() == 0 and minhash.keep_one(nothing).count() == 0


def test_minhash_documents_with_several_texts(spark):
    """Texts are the nodes; a doc_id with several of them links them all."""
    prepared(spark)
    a, b, c = prose(70000, 120), prose(80000, 120), prose(90000, 120)
    near = {t: t.replace(t.split()[50], "changed") for t in (a, b, c)}
    rows = [(1, a), (1, b), (2, near[a]), (3, near[b]), (4, c), (None, near[c]), (5, a), (5, prose(95000, 60)), (6, prose(95000, 60))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.classes(docs).collect()
    assert {(r["doc_id"], r["class_id"]) for r in got} == {(1, 1), (2, 1), (3, 1), (4, 4), (None, 4), (5, 1), (6, 1)}
    kept = sorted((r["doc_id"], r["text"]) for r in minhash.keep_one(docs).collect())
    assert [i for i, _ in kept] == [1, 4] and kept[0][1] in (a, b)
    # The case with two texts under one id, and nothing else in common.
    small = spark.createDataFrame([(1, a), (1, b), (2, near[a]), (3, near[b])], "doc_id long, text string")
    assert {r["class_id"] for r in minhash.classes(small).collect()} == {1}
    assert minhash.keep_one(small).count() == 1


def test_minhash_group_with_many_texts(spark):
    """Copies of one text with other single words each, in one group, and texts that share a passage only."""
    prepared(spark)
    shared = " ".join(word(i) for i in range(60))
    rows = [(i, BASE.replace(word(40 + i), f"other{i}")) for i in range(60)]
    rows += [(100 + i, shared + " " + " ".join(word(9000 + 200 * i + k) for k in range(150))) for i in range(60)]
    named = {r["doc_id"]: r["class_id"] for r in minhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(named[i] == 0 for i in range(60)) and all(named[100 + i] == 100 + i for i in range(60))


def test_minhash_large_groups_linked_to_one_text_only(spark):
    """Copies of a base with words replaced or inserted, a third and half of all rows; each is linked to the base only."""
    prepared(spark)
    base = [word(i) for i in range(304)]
    for group, others in ((300, 600), (300, 300)):
        rng = np.random.default_rng(group + others)
        texts = [base]
        for i in range(group):
            inserts, copy = i % 2 == 1, list(base)
            # Single words far apart: each replaced one changes five shingles of 300, each inserted one parts four.
            for k in sorted(rng.choice(50, 7 if inserts else 6, replace=False), reverse=True):
                copy[6 * k + 3 : 6 * k + 3 + (not inserts)] = [f"other{i}x{k}"]
            texts.append(copy)
        texts += [[f"single{i}x{k}" for k in range(60)] for i in range(others)]
        sets = [{tuple(t[k : k + 5]) for k in range(len(t) - 4)} for t in texts]
        near = {i for i in range(1, len(texts)) if len(sets[i] & sets[0]) >= 0.8 * len(sets[i] | sets[0])}
        assert len(near) == group and max(len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i in range(1, 40) for j in range(1, i)) < 0.8
        rows = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
        found = {r["doc_id"] for r in minhash.classes(rows).collect() if r["class_id"] != r["doc_id"]}
        # One pair in 1300 of a similarity of exactly 0.8 shares no band.
        assert found <= near and len(near - found) <= 2


def _pairs(spark, texts, weights):
    """The candidates of the join on rare shingles, and those of them that are similar."""
    rows = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "node long, component long, text string")
    pairs = stage(minhash.candidates(rows, weights))
    good = minhash.verified(pairs, rows, weights)
    return pairs, {(r["a"], r["b"]) for r in good.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_rare_shingles_find_all_similar_pairs(spark, seed):
    """Texts of graded likeness, sizes and repeats, weights that fall with frequency: as all pairs, also at exactly 0.8."""
    prepared(spark)
    rng = np.random.default_rng(seed)
    bases = [[word(int(i)) for i in rng.integers(0, 400, n)] for n in (3, 30, 90, 300)]
    texts = ["x y", "x y", " ".join(["same"] * 50), " ".join(["same"] * 44)]
    texts += [" ".join(f"tie{i}" for i in range(94)), " ".join(f"tie{i}" for i in range(76))]  # 90 and 72 shingles: 0.8
    for i in range(120):
        copy = list(bases[i % 4])
        for k in rng.choice(len(copy), rng.integers(0, 1 + len(copy) // 20), replace=False):
            copy[k] = f"other{i}x{k}"
        texts.append(" ".join(copy[: len(copy) - int(rng.integers(0, 1 + len(copy) // 6))]))
    cells = np.arange(0, minhash.CELLS, 2)
    weights = minhash.Weights(cells, rng.integers(1, 200, len(cells)), 200)
    a, b = np.tril_indices(len(texts), -1)
    side = [pa.array([texts[i] for i in x], pa.large_string()) for x in (a, b)]
    good = minhash._similar(*minhash.weighted_jaccard(*side, weights))
    expected = set(zip(a[good].tolist(), b[good].tolist()))
    _, found = _pairs(spark, texts, weights)
    assert found == expected and (5, 4) in found and (1, 0) in found and len(found) < len(a)


def test_unlike_texts_of_one_bucket_cost_no_pairs(spark):
    """20,000 texts that share half their words lie in one bucket; a few of them are near copies."""
    prepared(spark)
    shared = " ".join(word(i) for i in range(20))
    texts = [shared + " " + " ".join(f"own{i}x{k}" for k in range(20)) for i in range(20_000)]
    texts += [t + " end" for t in texts[:50]]
    weights = minhash.Weights(np.zeros(0, int), np.zeros(0, int), 1)
    pairs, found = _pairs(spark, texts, weights)
    assert found == {(20_000 + i, i) for i in range(50)} and pairs.count() <= 100
    ids = spark.range(len(texts)).withColumnRenamed("id", "node")
    members = stage(ids.selectExpr("7L AS bucket", "0 AS band", "node"))
    bands = stage(ids.selectExpr("node", "transform(sequence(1, 20), i -> xxhash64(node, i)) AS bands"))
    bodies = stage(spark.createDataFrame(list(enumerate(texts)), "node long, text string"))
    named = minhash.links(members, bands, bodies, weights, spark.createDataFrame([], "a long, b long"))
    assert {(r["node"], r["component"]) for r in named.collect()} == {(20_000 + i, i) for i in range(50)}


def test_keys_of_a_bucket_are_counted_before_they_become_rows(spark):
    """Members with the same keys make one row per key and batch, not one each; an empty list counts nothing."""
    rows = [(1, [5, 6])] * 300 + [(1, [5, 7])] * 100 + [(2, [6, 5]), (3, [])]
    members = spark.createDataFrame(rows, "bucket long, bands array<long>").repartition(2, "bucket")
    found = minhash._key_counts(members)
    assert found.count() <= 6
    added = found.groupBy("bucket", "i", "key").sum("n").collect()
    assert {tuple(r) for r in added} == {(1, 0, 5, 400), (1, 1, 6, 300), (1, 1, 7, 100), (2, 0, 6, 1), (2, 1, 5, 1)}


def test_typical_member_is_the_text_copied(spark):
    """Copies that are linked to their base only, which is not the smallest node of their bucket."""
    prepared(spark)
    rng = np.random.default_rng(4)
    base = [word(i) for i in range(304)]
    texts = {500: " ".join(base)}
    for i in range(400):
        copy = list(base)
        for k in rng.choice(50, 6, replace=False):
            copy[6 * k + 3] = f"other{i}x{k}"
        texts[i] = " ".join(copy)
    rows = stage(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    weights = minhash.Weights(np.zeros(0, int), np.zeros(0, int), 1)
    bands = stage(minhash.signatures(rows, weights).selectExpr("doc_id AS node", "bands"))
    members = stage(bands.selectExpr("7L AS bucket", "node", "node AS component", "401L AS size"))
    assert {tuple(r) for r in minhash._typical(members, bands).collect()} == {(500, i) for i in range(400)}


def test_components_of_chains(spark):
    pairs = [(i, i + 1) for i in range(1, 40)] + [(100, 50), (50, 70)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(2, 41)} | {70: 50, 100: 50}


def test_graphs_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(60, 16))
    rows = [centre[i % 60] + rng.normal(scale=0.03, size=16) * (1 + i % 4) for i in range(400)]
    table = [(i, [float(x) for x in v], i % 2) for i, v in enumerate(rows)]
    table += [(400, table[0][1], 0), (401, table[0][1], 0), (402, table[0][1], None), (403, None, 0), (404, [0.0] * 16, 0)]
    table += [(405, [float("nan")] * 16, 0), (406, [1.0] * 8, 0), (407, [], 0), (408, [None] * 16, 0)]
    frame = spark.createDataFrame([(*r, "z") for r in table], "vec_id long, embedding array<float>, label int, node string")
    got = {r["vec_id"]: r for r in graphs.classes(frame, shard=64).collect()}
    links = {r[0]: set() for r in table}
    sound = [r for r in table if r[0] <= 401]
    unit = np.array([np.float32(r[1]).astype(float) for r in sound])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.98
    for i, a in enumerate(sound):
        links[a[0]] = {b[0] for j, b in enumerate(sound) if i != j and a[2] == b[2] and close[i, j]}
    assert sum(got[i]["n_links"] for i in got) == sum(map(len, links.values())) and len(got) == len(table)
    for i, others in links.items():
        assert got[i]["n_links"] == len(others) and got[i]["component_id"] <= min({i, *others})
        assert all(got[j]["component_id"] == got[i]["component_id"] for j in others)
        assert got[i]["kept"] == (got[i]["component_id"] == i)
    assert {r["audit_recall"] for r in got.values()} == {1.0}
    assert graphs.classes(frame.limit(0)).count() == 0


def test_graph_finds_all_links_of_a_large_group():
    """Nearly half the vectors are near copies, so that beams are full of links and outer copies lose their links."""
    rng = np.random.default_rng(3)
    raw = rng.normal(size=(1500, 64))
    raw[::2][:700] = raw[0] + rng.normal(scale=0.08, size=(700, 64)) * rng.choice([1, 2], size=(700, 1))
    unit = (raw / np.linalg.norm(raw, axis=1, keepdims=True)).astype(np.float32)
    graph = graphs.LayeredGraph(unit, 1)
    row, node, recall = graphs.linked_pairs(graph, unit, 0.98)
    close = unit @ unit.T >= 0.98 - 1e-4
    assert recall == 1 and set(zip(row.tolist(), node.tolist())) >= set(zip(*np.nonzero(close)))
    assert len(row) <= (unit @ unit.T >= 0.98 - 2e-4).sum()


def test_links_of_near_copies_need_little_memory():
    """Shards full of near copies: pairs come and go in parts, and counts and forest are those of all pairs."""
    import tracemalloc

    rng = np.random.default_rng(5)
    raw = rng.normal(size=64) + rng.normal(scale=0.05, size=(1200, 64))
    unit = (raw / np.linalg.norm(raw, axis=1, keepdims=True)).astype(np.float32)
    one, two = unit[:600], unit[600:]
    graph, times = graphs.LayeredGraph(one, 1), rng.integers(1, 4, 600)
    for queries, same in ((one, True), (two, False)):
        close = queries @ one.T >= 0.98 - 1e-4
        links = graphs._Links(times, times, same)
        tracemalloc.start()
        parts, _ = graphs.linked_parts(graph, queries, 0.98)
        most = 0
        for q, x in graphs._either_way(parts, 600) if same else parts:
            most = max(most, len(q))
            links.add(q, x)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert close.sum() > 300_000 and most <= 1 << 16
        if same:
            np.fill_diagonal(close, False)
            assert (links.count == close @ times).all() and len(links.forest) == 599
        else:
            assert (links.count == np.concatenate([close @ times, times @ close])).all() and len(links.forest) == 1199
        assert len(set(links.root.tolist())) == 1 and peak < 60e6


def test_chat_keeps_maximal_conversations(spark):
    prepared(spark)
    turns = [("user", "hi"), ("assistant", "hello"), ("user", None), ("assistant", "")]
    rows = [(c, t, *turns[t]) for c, n in ((1, 2), (2, 4), (3, 4), (4, 1)) for t in range(n)]
    rows += [(5, 0, "user", "other"), (None, 0, "user", "hi"), (None, None, None, "first"), (6, 0, "user", "hello"), (6, 1, "assistant", "hi")]
    rows += [(7, t, "user", f"t{t}") for t in range(600)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, pos int")
    got = sorted(((r["conv_id"] or 0, r["part"], r["n_turns"], r["text"]) for r in chat.render(frame).collect()))
    assert [g[:3] for g in got] == [(0, 0, 2), (2, 0, 4), (5, 0, 1), (6, 0, 2), (7, 0, 600), (7, 1, 600), (7, 2, 600)]
    assert got[1][3] == "<|user|>\nhi<|end|><|assistant|>\nhello<|end|><|user|>\n<|end|><|assistant|>\n<|end|>".replace("<|end|>", "<|end|>\n")
    assert "".join(g[3] for g in got[4:]) == "".join(f"<|user|>\nt{t}<|end|>\n" for t in range(600))
    assert chat.render(frame.limit(0)).count() == 0


def test_grammar_scores_clauses():
    scorer = toxicity.Scorer({"=moron": 5.0, "idio": 4.0})
    clause = lambda t: scorer.grammar.clause(*zip(*[scorer._class_of(w) if w not in scorer.fixed else scorer.fixed[w] for w in t.split()]))
    assert clause("a moron here") == 5.0 and clause("you moron") == 6.25 and clause("never a moron") == 2.5
    assert clause("who said a moron") == 3.0 and clause("kill you") == 4.0 * 1.25 and clause("kill it") == 0
    assert not any(scorer.features("")[:6]) and scorer.features("idiots! fine.")[3] > 0


def test_lexicon_counts_contexts_not_copies(spark):
    """Copies of a toxic text don't make its chance words insults, nor does an insult its short beginning."""
    rows = [(i, 1, f"{prose(40 * i, 20)} {word(40 * i + 3)} vermin {prose(40 * i + 20, 10)}") for i in range(30)]
    rows += [(100 + i, 1, "some plinth of a vermin") for i in range(30)]
    rows += [(200 + i, 0, f"{prose(40 * i, 30)} verse {word(i)}") for i in range(60)]
    sample = spark.createDataFrame(rows, "doc_id long, __label int, text string")
    found = toxicity._lexicon(toxicity._stem_counts(sample), (0, 1))
    assert {"=vermin", "verm", "vermi"} <= set(found) and not {"=plinth", "plin", "ver", "=verse"} & set(found)
    assert toxicity._lexicon(toxicity._stem_counts(sample.limit(0)), (0, 1)) == {}


def test_negation_and_speech_act_on_threats_too():
    scorer = toxicity.Scorer({})
    clause = lambda t: scorer.grammar.clause(*zip(*[scorer.fixed.get(w, (toxicity.OTHER, 0.0)) for w in t.split()]))
    for form in "kill kills killed killing stabbed murdered shooting tue tuent frappait tötet tötete mataré golpeó".split():
        assert clause(f"{form} you") == clause(f"you {form}") == 5.0
    assert clause("not kill you") == 2.5 and clause("said kill you") == 3.0 and clause("said not kill you") == 1.5
    assert clause("kill you and not kill you") == 5.0


def _plainly(symbols, weights):
    """What the grammar's rules say of a clause, read off the whole clause."""
    t, total, paired = toxicity, 0.0, False
    for i, symbol in enumerate(symbols):
        since = next((k for k in range(1, i + 1) if symbols[i - k] == t.NEGATION), None)
        factor = t.NEGATED if since is not None and since <= t.SCOPE and symbol != t.NEGATION else 1.0
        if symbol == t.INSULT and i and symbols[i - 1] == t.INSULT:
            factor *= 1.2
        before = set(symbols[:i])
        completes = not paired and ((symbol == t.TARGET and t.THREAT in before) or (symbol == t.THREAT and t.TARGET in before))
        paired |= completes
        total += (weights[i] + (t.THREATENED if completes else 0.0)) * factor
    return total * (t.REPORTED if t.REPORT in symbols else 1.0) * (t.TARGETED if t.TARGET in symbols else 1.0)


def test_composed_table_equals_the_rules_on_all_short_clauses():
    grammar = toxicity.Scorer({}).grammar
    for n in range(1, 6):
        for symbols in product(range(toxicity.BOUNDARY), repeat=n):
            weights = [1.0 + i if s == toxicity.INSULT else 0.0 for i, s in enumerate(symbols)]
            assert grammar.clause(symbols, weights) == pytest.approx(_plainly(symbols, weights)), symbols


def test_no_telling_stem_stays_on_the_cluster(spark, tmp_path):
    """The lexicon of all counts in memory equals the one of the stems that were fetched."""
    rows = [(i, int(i < 90), f"{prose(40 * i, 25)} you {'vermin' if i % 2 else 'moronic'} {word(i)}") for i in range(180)]
    sample = spark.createDataFrame(rows, "doc_id long, __label int, text string")
    fetched = toxicity._stem_counts(sample)
    least, toxicity.LEAST_ODDS = toxicity.LEAST_ODDS, -1e9
    try:
        every = toxicity._stem_counts(sample)
    finally:
        toxicity.LEAST_ODDS = least
    assert len(every) > len(fetched)
    for halves in ((0,), (1,), (0, 1)):
        assert toxicity._lexicon(every, halves) == toxicity._lexicon(fetched, halves)


@pytest.mark.parametrize(("module", "label", "column"), [(toxicity, "toxic", "report_scores"), (factors, "quality", "report")])
def test_held_out_accuracy(spark, module, label, column):
    prepared(spark)
    path = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{path}/labels.parquet")
    found = getattr(module, column)(spark.read.parquet(f"{path}/documents.parquet"), labels)
    rows = found.join(labels, "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r[label] for r in rows) / len(rows)
    assert right >= 0.93 and all(0 <= r["score"] <= 1 for r in rows)


@pytest.mark.parametrize(("module", "label", "column"), [(toxicity, "toxic", "report_scores"), (factors, "quality", "report")])
def test_scores_of_awkward_rows(docs, nothing, spark, module, label, column):
    rows = [(1, 1), (7, 0), (6, 0), (11, 1), (2, 1), (3, 0), (8, None), (None, 1), (1, 1)]
    labels = spark.createDataFrame(rows, f"doc_id long, {label} int")
    for some in (labels, labels.limit(0)):
        got = getattr(module, column)(docs, some).collect()
        assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in TEXTS)
        assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in got)
    assert getattr(module, column)(nothing, labels).count() == 0


def test_pipeline(spark, sf_dir):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "toxicity", "line_dedup", "near_dedup", "packing"]
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    spans = {}
    for r in rows:
        spans.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["doc_tokens"]))
    assert spans
    for parts in spans.values():
        parts.sort()
        assert [s for s, _, _ in parts] == [sum(n for _, n, _ in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n, _ in parts) == parts[0][2]
    failed = {r["doc_id"] for r in quality_rules.report(spark.read.parquet(f"{sf_dir}/documents.parquet")).where("NOT kept").collect()}
    assert not failed & set(spans)
