import random

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.conftest import SF

from sluice.llm import simhash
from sluice.llm.queries import op4_simhash


def plain_fingerprint(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum((sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) << b for b in range(64)) if hashes else 0


def classes(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {i: root(i) for i in ids}


@settings(max_examples=50, deadline=None)
@given(st.text(alphabet="aAb éİ\t\n", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=20), st.integers(0, 12))
def test_trees(keys, radius):
    keys += [k ^ (1 << (k % 64)) for k in keys]
    tree, leaf = simhash.BKTree(), simhash.LeafTree(np.array(keys, np.uint64))
    for k in keys:
        tree.add(k)
    for k in keys[:5]:
        want = sorted(i for i, x in enumerate(keys) if (x ^ k).bit_count() <= radius)
        # equal keys lie below each other at distance 0
        assert sorted(tree.within(k, radius)) == want
        assert sorted(np.concatenate(leaf.within(np.uint64(k), radius)).tolist()) == want


def test_leaf_tree_splits():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 2**63, 3000).astype(np.uint64)
    keys[1000:] = keys[:2000] ^ (np.uint64(1) << rng.integers(0, 64, 2000).astype(np.uint64))
    tree = simhash.LeafTree(keys)
    assert tree.children
    for k in keys[::500]:
        assert sorted(np.concatenate(tree.within(k, 5)).tolist()) == np.flatnonzero(np.bitwise_count(keys ^ k) <= 5).tolist()


def test_forests_of_small_and_large_shards(monkeypatch):
    rng = random.Random(3)
    keys = sorted({k ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for k in (rng.getrandbits(64) for _ in range(40)) for _ in range(5)})
    want = classes(range(len(keys)), [(a, b) for a in range(len(keys)) for b in range(a) if (keys[a] ^ keys[b]).bit_count() <= 3])
    for leaf in (512, 10):
        monkeypatch.setattr(simhash, "LEAF", leaf)
        assert dict(simhash.forest(keys)) == {keys[i]: keys[r] for i, r in want.items() if i != r}


def test_any_blocks_find_all_pairs():
    rng = random.Random(1)
    for blocks in (4, 5, 6):
        masks = simhash.shard_masks(blocks)
        for _ in range(300):
            a = rng.getrandbits(64)
            b = a
            for bit in rng.sample(range(64), 3):
                b ^= 1 << bit
            assert any((a & m & (2**64 - 1)) == (b & m & (2**64 - 1)) for m in masks)


def test_components(spark):
    rng = random.Random(2)
    edges = {tuple(sorted(rng.sample(range(120), 2), reverse=True)) for _ in range(70)} | {(i + 1, i) for i in range(200, 240)}
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(sorted(edges), "a long, b long")).collect()}
    want = classes({i for e in edges for i in e}, edges)
    assert got == {i: r for i, r in want.items() if i != r}


def test_query_matches_brute_force(spark, documents):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op4_simhash(spark, SF).collect()}
    fps = {i: plain_fingerprint(t) for i, t in documents}
    ids = sorted(fps)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[:n] if (fps[a] ^ fps[b]).bit_count() <= 3]
    want = classes(ids, links)
    assert got == {i: (f"{fps[i]:016x}", want[i]) for i in ids}


def test_odd_rows(spark, odd):
    out = simhash.near_duplicates(odd).collect()
    assert len(out) == odd.count()
    assert {r.component_id for r in out if r.fp == 0} == {0}  # null, empty and blank texts
    assert len({r.component_id for r in out if r.doc_id in (10, 11)}) == 1
    assert simhash.near_duplicates(odd.where("false")).count() == 0


def test_one_of_each(spark, odd):
    words = [f"w{i}" for i in range(300)]
    near = words[:150] + ["changed"] + words[151:]
    far = words[:100] + [f"v{i}" for i in range(200)]
    rows = [(7, " ".join(words)), (3, " ".join(near)), (9, " ".join(words).upper()), (4, " ".join(far)), (5, "short"), (6, "short"), (8, None), (1, "")]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id for r in kept.collect()} == {3, 4, 5, 1}
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(None) == 2 and ids.count(3) == 2 and len(set(ids)) == len(ids) - 2 and 0 in ids and 1 not in ids and 10 in ids and 11 not in ids
    assert simhash.one_of_each(odd.where("false")).count() == 0


def test_one_of_each_finds_near_copies(spark, documents):
    """Against all pairs by exact Jaccard similarity: no group keeps two alike, and nobody goes without being alike to another."""
    sets = {}
    for i, t in documents:
        w = t.lower().split()
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))}
    kept = {r.doc_id for r in simhash.one_of_each(spark.createDataFrame(documents, "doc_id long, text string")).collect()}
    alike = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    ids = sorted(sets)
    for n, a in enumerate(ids):
        near = [b for b in ids[:n] + ids[n + 1 :] if len(sets[a] & sets[b]) and alike(a, b) >= 0.76]
        if a not in kept:
            assert near
        assert not [b for b in near if b in kept and a in kept and alike(a, b) >= 0.84]


def test_one_of_each_with_a_repeated_line(spark):
    """Repeats change a text's fingerprint, not its set of shingles: similarity 0.95 and more."""
    rng = random.Random(4)
    rows = []
    for n in range(20):
        words, line = ([f"{w}{n}x{i}" for i in range(k)] for w, k in (("w", 300), ("l", 10)))
        rows += [(2 * n, " ".join(words + line)), (2 * n + 1, " ".join(words + line * rng.choice([20, 40, 100])))]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id for r in kept.collect()} == set(range(0, 40, 2))


def test_parities_never_part_alike_sets():
    rng = np.random.default_rng(5)
    for n in (1, 5, 300, 5000):
        a = np.unique(rng.integers(0, 2**32, n).astype("<u4"))
        b = np.union1d(a[n // 10 :], rng.integers(0, 2**32, n // 10).astype("<u4"))
        x, y = simhash.parities([a, b])
        assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


def test_one_of_each_at_the_threshold(spark):
    """Texts of 900 shingles: similarity 800 / 1000 is enough, 799 / 1001 is not."""
    rows = [(1000 * c + 2 * n + k, " ".join(f"{n}x{c}x{i if i < 904 - c else -i * k or i}" for i in range(904))) for c in (100, 101) for n in range(20) for k in (0, 1)]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id for r in kept.collect()} == {100_000 + 2 * n for n in range(20)} | {101_000 + n for n in range(40)}


def test_one_of_each_tells_rows_of_one_id_apart(spark):
    a, b, c = ("the first text of this id " * 3, "another and quite unrelated text " * 3, "a third one that is like none " * 3)
    rows = [(1, a, "x"), (1, b, "y"), (2, c, "z"), (1, a, "w"), (3, b.upper(), "v"), (1, a.replace(" ", "  "), "x")]
    kept = sorted((r.doc_id, " ".join(r.text.split()), r.o) for r in simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, o string")).collect())
    assert [k[:2] for k in kept] == sorted([(1, a.strip()), (1, b.strip()), (2, c.strip())])
    for _ in range(2):
        again = simhash.one_of_each(spark.createDataFrame(rows[::-1], "doc_id long, text string, o string")).collect()
        assert sorted((r.doc_id, " ".join(r.text.split()), r.o) for r in again) == kept


def test_one_of_each_in_parts(spark):
    """A large group of near copies and texts with one passage that are no copies, in shards of any size: the same rows stay as by all pairs."""
    rng = random.Random(6)
    base, passage = [f"b{i}" for i in range(120)], [f"p{i}" for i in range(60)]
    rows = []
    for i in range(150):
        words = base.copy()
        for at in rng.sample(range(120), rng.choice([1, 1, 2, 3])):
            words[at] = f"x{i}y{at}"
        rows.append((rng.randrange(10**6), " ".join(words)))
    for i in range(60):
        rows.append((10**6 + i, " ".join(passage + [f"u{i // 2}v{j}" for j in range(40 + i % 2 * 4)])))
    sets = {i: {tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for i, t in rows}
    links = [(a, b) for a in sets for b in sets if b < a and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    want = {i for i, r in classes(sorted(sets), links).items() if i == r}
    assert 10 < len(want) < 100
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for most in (4, 10_000):
        assert {r.doc_id for r in simhash.one_of_each(docs, most=most).collect()} == want


def test_one_of_each_with_maps(spark):
    rows = [(1, "a text", {"k": 1}), (1, "a text", {"k": 1}), (2, "A TEXT", {"k": 2})]
    assert [(r.doc_id, r.m) for r in simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, m map<string,int>")).collect()] == [(1, {"k": 1})]


def test_minhashes_against_a_loop():
    for n in (1, 255, 256, 257, 1000):
        hashes = np.random.default_rng(n).integers(0, 2**64, n, np.uint64).tolist()
        products = [[h * m % 2**64 for h in hashes] for m in simhash.MULTIPLIERS.tolist()]
        assert simhash.minhashes(np.array(hashes, np.uint64)).tolist() == [min(p ^ p >> 32 for p in row) for row in products]


def test_texts_that_share_half_their_words_seldom_meet():
    """300 texts with 40 words in common and 40 of their own; of any band a thirtieth of them may meet."""
    common = " ".join(f"c{i}" for i in range(40))
    keys = [simhash.shingled(f"{common} {' '.join(f'{n}x{i}' for i in range(40))}".encode(), 5)[0] for n in range(300)]
    largest = [max(np.unique([k[band] for k in keys], return_counts=True)[1]) for band in range(simhash.BANDS)]
    assert np.mean(largest) < 300 / 12


def test_near_copies_meet_by_fingerprints_first(spark, monkeypatch):
    """BK-trees link the fingerprints of the same shingles as in near_duplicates, and the classes bring copies together before any band does."""
    rng, made = np.random.default_rng(21), []
    base = [" ".join(f"w{x}" for x in rng.integers(0, 5000, 400)) for _ in range(6)]
    rows = [(10 * i + k, t + " tail" * k) for i, t in enumerate(base) for k in range(3)] + [(90, ""), (91, None), (92, "two words")]
    linked = simhash.fingerprint_classes
    monkeypatch.setattr(simhash, "fingerprint_classes", lambda *a: made.append(linked(*a)) or made[-1])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in simhash.one_of_each(docs).collect()} == {*range(0, 60, 10), 90, 92}
    assert len(made) == 1
    fps = simhash.fingerprints(docs, shingle=5).withColumnRenamed("doc_id", "node")
    got, want = {}, {}
    for r in linked(fps).collect():
        got.setdefault(r.key, set()).add(r.node)
    for r in simhash.near_duplicates(docs, shingle=5).collect():
        want.setdefault(r.component_id, set()).add(r.doc_id)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values())) and max(map(len, got.values())) == 3
    for i in range(len(base)):
        assert simhash.shingled(rows[3 * i][1].encode(), 5)[2] == simhash.fingerprint(rows[3 * i][1].encode(), 5)
    assert simhash.shingled(b"", 5)[2] == 0


def test_only_texts_that_share_a_band_get_sets(spark, monkeypatch):
    """Sets of shingles are as large as the texts: none is written of a text that nothing is near to."""
    rng, tables, write = np.random.default_rng(8), {}, simhash.saved

    def saved(df, name):
        out = write(df, name)
        tables.setdefault(name, []).append((out.columns, out.count()))
        return out

    monkeypatch.setattr(simhash, "saved", saved)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 10**6, 60)) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100, texts[7] + " tail"), (101, texts[9].upper())]
    kept = {r.doc_id for r in simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == set(range(40))
    assert [(name, n) for name, found in tables.items() for columns, n in found if "set" in columns] == [("sets", 2)]


def test_texts_that_share_many_bands_are_compared_once(spark, monkeypatch):
    """Three texts of which none is a copy, alike at 0.7: they share bands again and again, and meet in one cell of all three and one of each pair at most."""
    words, met, within = [f"w{i}" for i in range(404)], [], simhash.alike_within
    rows = [(n, " ".join(words[:334] + [f"{n}x{i}" for i in range(70)])) for n in range(3)]
    a, b = (simhash.shingled(t.encode(), 5)[0] for _, t in rows[:2])
    assert sum(x == y for x, y in zip(a, b, strict=True)) > 5

    def alike_within(cells, similarity):
        met.append(cells.select("cell", "node").collect())
        return within(cells, similarity)

    monkeypatch.setattr(simhash, "alike_within", alike_within)
    assert {r.doc_id for r in simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {0, 1, 2}
    assert len(met) == 2 and len(met[1]) == len({(r.cell, r.node) for r in met[1]})
    assert 2 <= len(met[1]) <= 3 + 3 * 2


def test_bands_have_room_in_a_key():
    assert simhash.BANDS < 64  # the last six bits of a key; the classes of fingerprints come after the bands
