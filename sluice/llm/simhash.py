"""SimHash near-duplicates: word-shingle fingerprints, linked by sharded BK-trees.

A 64-bit fingerprint has a bit set where over half of the XXH64 values of the
text's shingles have it. Two fingerprints within ``radius`` bits agree wholly on
at least ``blocks - radius`` of ``blocks`` bit blocks, so a shard for each choice
of so many blocks and each of their values holds every pair there is to find; one
pair may meet in several shards. Each shard builds a BK-tree (children keyed by
their Hamming distance to the parent) and follows only the edges within the
radius. Trees over all fingerprints can't be broadcast within a proven size, so a
shard's tree is built in the task that gets the shard's queries.

A shard reports a spanning forest of its links, never all pairs. Linked texts then
get one component by alternating large-star and small-star rounds over tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import discard, release, saved

BITS, RADIUS, SHINGLE, SEED, LEAF = 64, 3, 3, 42, 512


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned fingerprint of a text's UTF-8 bytes; 0 if it has no words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], seed) for a, b in zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)]
    return majority(np.array(hashes, np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    octets = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    counts = sum(np.unpackbits(octets[i : i + 65536], axis=1).sum(0, dtype=np.int64) for i in range(0, len(octets), 65536))
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """id_col and fp (the fingerprint as a signed long). Null texts are empty; other columns are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            fps = np.fromiter((fingerprint(t or b"", shingle, seed) for t in batch.column(1).cast(pa.binary()).to_pylist()), np.uint64, batch.num_rows)
            yield pa.record_batch([batch.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, fp long").withColumnRenamed("id", id_col)


def shard_masks(blocks: int, radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """A signed mask for each choice of blocks that a pair within the radius may wholly agree on."""
    edges = [round(i * bits / blocks) for i in range(blocks + 1)]
    block = [((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in range(blocks)]
    masks = (sum(c) for c in combinations(block, blocks - radius))
    return [m - (1 << bits) if m >> (bits - 1) else m for m in masks]


class BKTree:
    """Children are keyed by their Hamming distance to the parent."""

    def __init__(self) -> None:
        self.keys: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, key: int) -> None:
        self.keys.append(key)
        self.children.append({})
        if len(self.keys) == 1:
            return
        at, new = 0, len(self.keys) - 1
        while True:
            d = (self.keys[at] ^ key).bit_count()
            down = self.children[at].setdefault(d, new)
            if down == new:
                return
            at = down

    def within(self, key: int, radius: int) -> list[int]:
        found, todo = [], [0] if self.keys else []
        keys, children = self.keys, self.children
        while todo:
            at = todo.pop()
            d = (keys[at] ^ key).bit_count()
            if d <= radius:
                found.append(at)
            low, high = d - radius, d + radius
            todo += [down for edge, down in children[at].items() if low <= edge <= high]
        return found


class LeafTree:
    """A BK-tree over an array of fingerprints; up to LEAF of them stay together in a leaf, which is compared at once."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray | None = None) -> None:
        self.rows = np.arange(len(keys)) if rows is None else rows
        self.keys, self.children = keys, {}
        if len(keys) > LEAF:
            apart = np.bitwise_count(keys ^ keys[0])
            if apart.any():
                self.children = {int(d): LeafTree(keys[apart == d], self.rows[apart == d]) for d in np.unique(apart)}

    def within(self, key: np.uint64, radius: int) -> list[np.ndarray]:
        if not self.children:
            return [self.rows[np.bitwise_count(self.keys ^ key) <= radius]]
        d = int(np.bitwise_count(self.keys[0] ^ key))
        return [x for edge, child in self.children.items() if d - radius <= edge <= d + radius for x in child.within(key, radius)]


def forest(keys: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """(key, least key of its component) for the keys of a shard that are linked to a lesser one. Keys ascend."""
    parent = list(range(len(keys)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    def join(i: int, j: int) -> None:
        a, b = root(i), root(j)
        parent[max(a, b)] = min(a, b)

    if len(keys) > LEAF:
        large, rows = LeafTree(np.array(keys, np.uint64)), np.array(keys, np.uint64)
        for i in range(len(keys)):
            for j in np.concatenate(large.within(rows[i], radius)).tolist():
                if j < i:
                    join(i, j)
    else:
        tree = BKTree()
        for i, key in enumerate(keys):
            for j in tree.within(key, radius):
                join(i, j)
            tree.add(key)
    return [(key, keys[r]) for i, key in enumerate(keys) if (r := root(i)) != i]


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges a, b (b < a) that connect just the fingerprints which chains of distances up to radius connect.

    nodes: distinct fingerprints in a column fp. The number of blocks follows their
    number, so that shards stay small; any number finds the same links.
    """
    n = nodes.count()
    blocks = radius + (1 if n < 1 << 22 else 2 if n < 1 << 30 else 3)
    masks = shard_masks(blocks, radius)
    shards = nodes.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("band", "value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def grown(rows: np.ndarray) -> pa.RecordBatch | None:
            """Links of the whole shards in rows (band, value, fp), sorted."""
            starts = np.flatnonzero(np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(1)])
            ends = np.r_[starts[1:], len(rows)]
            many = ends - starts > 1
            found = [e for a, b in zip(starts[many].tolist(), ends[many].tolist(), strict=True) for e in forest(rows[a:b, 2].view(np.uint64).tolist(), radius)]
            if found:
                pairs = np.array(found, np.uint64).view(np.int64)
                return pa.record_batch([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])
            return None

        held = np.empty((0, 3), np.int64)
        for batch in batches:
            rows = np.concatenate([held, np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], 1)])
            if not len(rows):
                continue
            cut = len(rows) - 1
            while cut and (rows[cut - 1, :2] == rows[-1, :2]).all():
                cut -= 1
            held = rows[cut:]
            if cut and (out := grown(rows[:cut])) is not None:
                yield out
        if len(held) > 1 and (out := grown(held)) is not None:
            yield out

    dealt = shards.select("band", "value", "fp").repartition("band", "value").sortWithinPartitions("band", "value", "fp")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node that it is connected with) for each node of the edges a, b; a table is written each round.

    Large-star hands each node's greater neighbours to its least one, small-star its
    lesser ones; when nothing changes all edges point to roots. Rows are only
    aggregated to minima and joined, so a node with very many edges is split by the
    adaptive skew join.
    """
    edges = saved(edges.select("a", "b"), "stars")
    before = None
    while True:  # a round's table goes once the next one is written
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        low = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = low.groupBy("a").agg(F.min("b").alias("m"))
        small = low.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
        old, edges = edges, saved(small.union(least).distinct(), "stars")
        discard(old)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """id_col, fp (signed long), component_id: the least id among all documents that chains of links reach.

    Null and empty texts have the fingerprint 0 and link like any other. Rows that
    repeat come back as often as they went in; a null id takes part, but is a
    component_id only where nothing else is in reach. An empty table gives no rows.
    """
    fps = saved(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    nodes = fps.groupBy("fp").agg(F.min(id_col).alias("first_id"))
    roots = components(links(nodes.select("fp"), radius))
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of = rooted.join(least, "root").select("fp", "component_id")
    return fps.join(of, "fp").select(id_col, "fp", "component_id")


BANDS, ROWS, PARITY = 62, 5, 1024
MULTIPLIERS = np.array([pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 64) | 1 for i in range(BANDS * ROWS)], np.uint64)


def minhashes(hashes: np.ndarray) -> np.ndarray:
    """The least product of the hashes with each multiplier; 256 hashes at a time, which stay in the cache."""
    out = np.full(len(MULTIPLIERS), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 256):
        products = np.multiply.outer(MULTIPLIERS, hashes[i : i + 256])
        products ^= products >> np.uint64(32)
        np.minimum(out, products.min(1), out=out)
    return out


def shingle_hashes(text: bytes, shingle: int, seed: int = SEED) -> np.ndarray:
    """The hashes of a text's shingles, repeats included; fewer words are one shingle, and so are none."""
    words = text.lower().split()
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1]) if words else np.zeros(1, np.int64)
    lasts = ends[shingle - 1 :] if len(words) >= shingle else np.array([len(joined)])
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), lasts.tolist(), strict=True)], np.uint64)


def shingled(text: bytes, shingle: int, seed: int = SEED) -> tuple[list[int], np.ndarray, int]:
    """Band keys, the shingles' hashes and the fingerprint of a text's words."""
    hashes = shingle_hashes(text, shingle, seed)
    bands = [xxhash.xxh64_intdigest(row.tobytes(), i) for i, row in enumerate(minhashes(hashes).reshape(BANDS, ROWS))]
    return bands, hashes, majority(hashes) if text.split() else 0


def shingle_set(text: bytes, shingle: int, seed: int = SEED) -> bytes:
    """All distinct shingle hashes of a text, 32 bits each, ascending."""
    return np.unique((shingle_hashes(text, shingle, seed) >> np.uint64(32)).astype("<u4")).tobytes()


def alike(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """A row of PARITY bits for each set: whether an odd number of its elements falls on the bit."""
    out = np.zeros((len(sets), PARITY // 64), np.uint64)
    for row, x in zip(out, sets, strict=True):
        row[:] = np.packbits(np.bincount(x % PARITY, minlength=PARITY).astype(np.uint8) & 1).view(np.uint64)
    return out


def forest_of(held: list[bytes], root: np.ndarray, part: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """(i, r) of sets of hashes whose chains of similarities lead to a set r before them. Sets of one root are linked already; in a cell of two parts only sets of different parts are compared."""
    sets = [np.frombuffer(x, "<u4") for x in held]
    bits, size = parities(sets), np.array([len(x) for x in sets])
    known, across = np.unique(root, return_index=True, return_inverse=True), part.min() != part.max()
    start = label = known[1][known[2]]
    label = start.copy()
    for i in range(1, len(sets)):
        # a set of n elements and one of m that are alike differ in (1 - similarity) / (1 + similarity) of n + m at most
        most = (1 - similarity) / (1 + similarity) * (size[:i] + size[i]) + 1e-6
        could = np.flatnonzero((np.abs(size[:i] - size[i]) <= most) & (label[:i] != label[i]) & ((part[:i] != part[i]) | (not across)))
        could = could[np.bitwise_count(bits[could] ^ bits[i]).sum(1) <= most[could]]
        while len(could):
            j, could = could[0], could[1:]
            if alike(sets[i], sets[j]) >= similarity:
                a, b = label[i], label[j]
                label[label == max(a, b)] = min(a, b)
                could = could[label[could] != label[i]]
    return [(i, r) for i, (r, s) in enumerate(zip(label.tolist(), start.tolist(), strict=True)) if r != s]


def alike_within(cells: DataFrame, similarity: float) -> DataFrame:
    """Edges a, b of nodes that are linked within a cell; cells has cell, node, root (a hash), part, set."""
    node = cells.schema["node"].dataType.simpleString()

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def grown(held: pa.Table) -> pa.RecordBatch:
            cell, root, part = (held.column(c).to_numpy() for c in ("cell", "root", "part"))
            at, sets = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]), held.column("set").to_pylist()
            out: list[tuple[int, int]] = []
            for a, b in zip(at.tolist(), [*at[1:].tolist(), len(cell)], strict=True):
                out += [(a + i, a + j) for i, j in forest_of(sets[a:b], root[a:b], part[a:b], similarity)]
            nodes = held.column("node").combine_chunks()
            return pa.record_batch([nodes.take(pa.array([x[k] for x in out], pa.int64())) for k in (0, 1)], names=["a", "b"])

        held = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            if not held.num_rows:
                continue
            cell = held.column("cell").to_numpy()
            cut = int(np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])[-1])
            if cut:
                yield grown(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield grown(held)

    dealt = cells.select("cell", "node", "root", "part", "set").repartition("cell").sortWithinPartitions("cell", "node")
    return dealt.mapInArrow(link, f"a {node}, b {node}").where("a != b").distinct()


FIRST_BANDS, CELL = 4, 512


def fingerprint_classes(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """node and key, the root of the fingerprints that chains of links reach; rows has node, fp."""
    roots = components(links(rows.select("fp").distinct(), radius)).withColumnRenamed("node", "__fp")
    return rows.join(roots, F.col("fp") == F.col("__fp"), "left").select("node", F.coalesce("root", "fp").alias("key"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, most: int = CELL) -> DataFrame:
    """docs without near copies: of texts that chains of similarities link, the row with the least id stays.

    Texts are alike if the sets of their shingles, as hashes of 32 bits, have the given
    Jaccard similarity or more. Fingerprints of the shingles that BK-trees link, as in near_duplicates, bring texts together
    first. Three bits don't reach all texts that are alike at 0.8, so MinHash bands find the rest: texts that share the five MinHash values of one of 62 bands
    meet in a shard (at 0.8 all but 2 pairs in 10^11, at 0.3 one in seven, by calculation). There only pairs
    that cannot be alike go untested: where parity bits differ, the sets differ in an
    element for each bit at least. Copies of one word sequence count once. Null texts
    are empty, and empty texts are copies of each other. Rows with a null id all stay.
    Rows are told apart by id and text: of rows that share an id but are no copies each
    one stays; of copies with one id that with the text of least MD5, and of rows with one id and text that
    with the least hash of all columns but maps. An empty table gives no rows.

    Shards are searched twice. In the classes of fingerprints and the first four bands, shards of more than ``most`` rows are
    parted and the first row takes part in each part, which links most copies. Then shards of all bands whose rows
    are not all linked yet are compared in full, pairs of parts apart where they have more than ``most`` rows.
    Shards with the same rows are one cell. Sets of shingles are made only of texts that share a shard, and texts go by
    their place, a number, until the last join with docs.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    key = F.unhex(F.md5(F.coalesce(text_col, F.lit(""))))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            whole = [hashlib.md5(b" ".join(t.lower().split())).digest() for t in texts]
            bands, _, fps = zip(*(shingled(t, shingle) for t in texts), strict=True) if texts else ([], [], [])
            signed, fps = np.array(bands, np.uint64).reshape(-1, BANDS).view(np.int64), np.array(fps, np.uint64).view(np.int64)
            yield pa.record_batch([batch.column(0), pa.array(whole, pa.binary()), pa.array(fps), pa.array(signed.tolist(), pa.list_(pa.int64()))], names=["node", "whole", "fp", "bands"])

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            sets = [shingle_set(t or b"", shingle) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(sets, pa.binary())], names=["node", "set"])

    named = docs.where(F.col(id_col).isNotNull()).select(F.struct(F.col(id_col).alias("id"), key.alias("key")).alias("__node"), F.col(text_col).alias("__text"))
    rows = saved(named.mapInArrow(sketch, f"node struct<id:{kind},key:binary>, whole binary, fp long, bands array<long>"), "sketches")
    repeats = saved(rows.groupBy("node").count().where("count > 1").select("node"), "repeats")
    repeated = not repeats.isEmpty()
    first = rows.groupBy("whole").agg(F.min(F.struct("node", "fp", "bands")).alias("first"))
    first = saved(first.select(F.monotonically_increasing_id().alias("place"), "first.*"), "firsts")
    discard(rows)
    classes = fingerprint_classes(first.select(F.col("place").alias("node"), "fp")).select("node", F.lit(BANDS).alias("band"), F.xxhash64("key").alias("key"))
    keys = first.select(F.col("place").alias("node"), F.posexplode("bands").alias("band", "key")).unionByName(classes)
    keys = keys.select("node", F.col("key").bitwiseAND(F.lit(-64)).bitwiseOR(F.col("band")).alias("key"))  # the last six bits are the band
    of_key = Window.partitionBy("key")
    shared = {"n": F.count("*"), "least": F.min("node"), "members": F.bit_xor(F.xxhash64("node"))}
    keys = keys.select("node", "key", *(f.over(of_key).alias(c) for c, f in shared.items())).where("n > 1")
    keys = saved(keys.withColumn("parts", F.ceil(F.col("n") / most).cast("int")), "bands")
    places = saved(first.select("place", F.col("node").alias("__node")), "places")
    discard(first)
    near = keys.select(F.col("node").alias("place")).distinct().join(places, "place")
    sets = saved(named.join(near, "__node").select("place", "__text").mapInArrow(collect, "node long, set binary"), "sets")
    if repeated:
        old, sets = sets, saved(sets.dropDuplicates(["node"]), "sets")
        discard(old)
    band = F.col("key").bitwiseAND(F.lit(63))
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    all_parts = F.sequence(F.lit(0), F.col("parts") - 1)
    cell = F.xxhash64("n", "least", "members", "in").alias("cell")

    own = F.when(F.col("node") == F.col("least"), all_parts).otherwise(F.array(part))
    cells = keys.where((band < FIRST_BANDS) | (band == BANDS)).select("node", *shared, F.explode(own).alias("in")).select("node", cell).distinct()
    cells = cells.select("node", "cell", F.col("node").alias("root"), F.lit(0).alias("part"))
    found = saved(alike_within(cells.join(sets, "node"), similarity), "alike")

    roots = saved(components(found), "roots")
    rooted = keys.where(band < BANDS).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = rooted.withColumns({"low": F.min("root").over(of_key), "high": F.max("root").over(of_key)}).where("low != high")
    pair = F.explode(F.transform(all_parts, lambda k: F.struct(F.least(k, F.col("part")).alias("low"), F.greatest(k, F.col("part")).alias("high"))))
    cells = open_.withColumn("part", part).select("node", "root", "part", *shared, pair.alias("in")).select("node", "root", "part", cell).distinct()
    more = saved(alike_within(cells.join(sets, "node"), similarity), "alike")

    linked = components(found.union(more)).withColumnRenamed("node", "place")
    least = places.join(linked, "place", "left").groupBy(F.coalesce("root", "place").alias("root")).agg(F.min("__node").alias("node"))
    stay = saved(least.select("node"), "stay")
    discard(places, keys, sets, found, more, roots)
    kept = docs.withColumn("__node", F.struct(F.col(id_col).alias("id"), key.alias("key"))).join(stay.select(F.col("node").alias("__stay")), F.col("__node") == F.col("__stay")).drop("__stay")
    if repeated:
        order = F.xxhash64(*(F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()))
        many = kept.join(repeats.select(F.col("node").alias("__node")), "__node", "left_semi").withColumn("__n", F.row_number().over(Window.partitionBy("__node").orderBy(order))).where("__n = 1").drop("__n")
        kept = kept.join(repeats.select(F.col("node").alias("__node")), "__node", "left_anti").unionByName(many)
    return kept.drop("__node").select(docs.columns).unionByName(docs.where(F.col(id_col).isNull()))
