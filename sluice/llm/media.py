"""Cropped and edited copies of images by local descriptors.

Corners are found at several scales; each gets its orientation from the centroid of
its patch and 128 bits from brightness tests turned by it. A corner alone says little: the corners of
any two boxes look alike. So corners are joined with their nearest ones to pairs, and two Hamming tables, each keyed by
one half of both descriptors, bring together equal pairs and those whose differing bits leave a half of both
untouched. Each such meeting votes for the turn, scale and shift that would make one image of the other; enough
votes for one of them link the images.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import discard, release, saved
from sluice.llm.mixing import small
from sluice.llm.simhash import components

#: A fourth of an octave apart.
SCALES = tuple(2 ** (-i / 4) for i in range(5))
REACH, TURNS = 7, 32
#: So many votes link images, and so many for a corner of the image with fewer corners.
VOTES, SHARE = 2, 0.08
_rng = np.random.default_rng(7)
#: 128 pairs of points within REACH of the corner, turned to each of TURNS orientations.
_points = np.clip(_rng.normal(0, REACH / 2.2, (128, 2, 2)), -REACH + 2, REACH - 2)
_turns = np.arange(TURNS) * 2 * np.pi / TURNS
PATTERN = np.rint(np.einsum("tij,pqj->tpqi", np.array([[[np.cos(a), -np.sin(a)], [np.sin(a), np.cos(a)]] for a in _turns]), _points) + 1e-9).astype(np.int64)
_dy, _dx = np.mgrid[-REACH : REACH + 1, -REACH : REACH + 1]
DISC = (_dx**2 + _dy**2 <= REACH**2).astype(float)


def pgm(gray: np.ndarray) -> bytes:
    return b"P5 %d %d 255\n" % gray.shape[::-1] + gray.astype(np.uint8).tobytes()


def gray_of(data: bytes | None) -> np.ndarray | None:
    """Brightness rows of a binary PGM file; None for anything else."""
    found = re.match(rb"P5\s+(\d+)\s+(\d+)\s+255\s", data or b"")
    if not found:
        return None
    w, h = int(found[1]), int(found[2])
    body = data[found.end() :]
    return np.frombuffer(body, np.uint8).reshape(h, w).astype(float) if w and h and len(body) == w * h else None


def blurred(x: np.ndarray) -> np.ndarray:
    """Binomial smoothing, 5 by 5."""
    h, w = x.shape
    p = x[np.clip(np.arange(-2, h + 2), 0, h - 1)]
    p = (p[:h] + p[4:] + 4 * (p[1 : h + 1] + p[3 : h + 3]) + 6 * p[2 : h + 2]) / 16
    p = p[:, np.clip(np.arange(-2, w + 2), 0, w - 1)]
    return (p[:, :w] + p[:, 4:] + 4 * (p[:, 1 : w + 1] + p[:, 3 : w + 3]) + 6 * p[:, 2 : w + 2]) / 16


def highest(x: np.ndarray) -> np.ndarray:
    """The greatest of the 5 by 5 around each inner element."""
    h, w = x.shape[0] - 4, x.shape[1] - 4
    rows = np.maximum.reduce([x[i : i + h] for i in range(5)])
    return np.maximum.reduce([rows[:, i : i + w] for i in range(5)])


def resized(x: np.ndarray, scale: float) -> np.ndarray:
    if scale == 1.0:
        return x
    h, w = max(1, round(x.shape[0] * scale)), max(1, round(x.shape[1] * scale))
    y, c = np.clip(np.arange(h) / scale, 0, x.shape[0] - 1), np.clip(np.arange(w) / scale, 0, x.shape[1] - 1)
    y0, x0 = np.minimum(y.astype(int), x.shape[0] - 2 if x.shape[0] > 1 else 0), np.minimum(c.astype(int), x.shape[1] - 2 if x.shape[1] > 1 else 0)
    fy, fx = (y - y0)[:, None], c - x0
    y1, x1 = np.minimum(y0 + 1, x.shape[0] - 1), np.minimum(x0 + 1, x.shape[1] - 1)
    return (x[np.ix_(y0, x0)] * (1 - fx) + x[np.ix_(y0, x1)] * fx) * (1 - fy) + (x[np.ix_(y1, x0)] * (1 - fx) + x[np.ix_(y1, x1)] * fx) * fy


def descriptors(gray: np.ndarray) -> list[tuple[float, float, int, float, int, int]]:
    """x, y (in the whole image), turn, scale and two 64-bit halves of each corner above the response threshold."""
    out = []
    for scale in SCALES:
        x = resized(blurred(gray) if scale < 1 else gray, scale)
        if min(x.shape) < 2 * REACH + 3:
            continue
        smooth = blurred(x)
        gy, gx = np.gradient(smooth)
        a, b, c = blurred(gx * gx), blurred(gy * gy), blurred(gx * gy)
        response = a * b - c * c - 0.05 * (a + b) ** 2
        m = REACH
        inner = response[m:-m, m:-m]
        around = highest(response[m - 2 : response.shape[0] - m + 2, m - 2 : response.shape[1] - m + 2])
        ys, xs = np.nonzero((inner == around) & (inner > 1.0))
        if not len(ys):
            continue
        ys, xs = ys + m, xs + m
        patches = smooth[ys[:, None, None] + _dy, xs[:, None, None] + _dx] * DISC
        angle = np.arctan2((patches * _dy).sum((1, 2)), (patches * _dx).sum((1, 2)))
        turn = np.rint(angle / (2 * np.pi / TURNS)).astype(int) % TURNS
        at = PATTERN[turn]
        values = smooth[ys[:, None, None] + at[..., 1], xs[:, None, None] + at[..., 0]]
        halves = np.packbits(values[..., 0] < values[..., 1], axis=1).view(">u8").astype(np.uint64).view(np.int64)
        out += zip((xs / scale).tolist(), (ys / scale).tolist(), turn.tolist(), [scale] * len(xs), halves[:, 0].tolist(), halves[:, 1].tolist(), strict=True)
    return out


NEIGHBOURS, REACHED = 2, 255


def doublets(found: list[tuple[float, float, int, float, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and places of an image's corner pairs: each corner with its nearest ones of the same scale (ties too), in each Hamming table.

    A key has the table's number, what both descriptors have in the table's half, the lesser first, and their distance (half octaves). A
    place has the first corner's x and y (half pixels of the whole image), the offset of the second (half pixels of its scale), the
    first one's turn and its scale's number.
    """
    if len(found) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    x, y, turn, scale, d0, d1 = (np.array(c) for c in zip(*found, strict=True))
    pairs = []
    for s in np.unique(scale):
        here = np.flatnonzero(scale == s)
        px, py, k = x[here] * s, y[here] * s, min(NEIGHBOURS, len(here) - 1)
        for at in range(0, len(here) if k else 0, 512):
            far = (px[at : at + 512, None] - px) ** 2 + (py[at : at + 512, None] - py) ** 2
            far[np.arange(len(far)), np.arange(at, at + len(far))] = np.inf
            i, j = np.nonzero(far <= np.minimum(np.partition(far, k - 1, axis=1)[:, k - 1 : k] + 1e-6, REACHED**2))
            i, j = here[i + at], here[j]
            pairs.append(np.stack([np.minimum(i, j), np.maximum(i, j)], 1))
    i, j = np.unique(np.concatenate(pairs), axis=0).T if pairs else np.zeros((2, 0), np.int64)
    level = np.array([SCALES.index(s) for s in scale.tolist()])
    keys, places = [], []
    for table, half in enumerate((d0, d1)):
        swap = half[i] > half[j]
        first, second = np.where(swap, j, i), np.where(swap, i, j)
        same = half[i] == half[j]  # either may come first
        first, second = np.r_[first, second[same]], np.r_[second, first[same]]
        u, v = half[first].view(np.uint64), half[second].view(np.uint64)
        key = (u ^ (u >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(table)
        span = np.rint(2 * np.log2(np.maximum(1, np.hypot(x[second] - x[first], y[second] - y[first]) * scale[first]))).astype(np.uint64)
        key = (key ^ (key >> np.uint64(32)) ^ v ^ (span << np.uint64(56))) * np.uint64(0x94D049BB133111EB)
        keys.append(((key ^ (key >> np.uint64(31)))).view(np.int64))
        off = [np.rint(2 * (c[second] - c[first]) * scale[first]).astype(np.int64) + 512 for c in (x, y)]
        spot = [np.rint(2 * c[first]).astype(np.int64) & 0xFFFF for c in (x, y)]
        places.append(spot[0] << 44 | spot[1] << 28 | off[0] << 18 | off[1] << 8 | turn[first] << 3 | level[first])
    return np.concatenate(keys), np.concatenate(places)


def described(images: DataFrame, id_col: str, data_col: str) -> DataFrame:
    """id, whole (MD5 of the file), n_corners, keys and places of the corner pairs of all images."""
    kind = images.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some, out = batch.slice(at, 256), []
                for data in some.column(1).to_pylist():
                    gray = gray_of(data)
                    found = descriptors(gray) if gray is not None else []
                    out.append((hashlib.md5(data or b"").hexdigest(), len(found), *doublets(found)))
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())), strict=True)]
                yield pa.record_batch([some.column(0), *columns], names=["id", "whole", "n_corners", "keys", "places"])

    return images.select(id_col, data_col).mapInArrow(run, f"id {kind}, whole string, n_corners long, keys array<long>, places array<long>")


def unpacked(place: np.ndarray) -> tuple[np.ndarray, ...]:
    """x, y of the first corner, offset of the second (both in pixels of the whole image), turn and scale."""
    scale = np.array(SCALES)[place & 7]
    x, y = (place >> 44 & 0xFFFF) / 2, (place >> 28 & 0xFFFF) / 2
    return x, y, ((place >> 18 & 1023) - 512) / 2 / scale, ((place >> 8 & 1023) - 512) / 2 / scale, place >> 3 & 31, scale


def moves(p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Turn, scale and shift (quarter pixels) that make the first corner of p that of q, one row each; and whether the second corners agree."""
    x, y, dx, dy, turn, scale = unpacked(p)
    x2, y2, dx2, dy2, turn2, scale2 = unpacked(q)
    turn, ratio = (turn2 - turn) % TURNS, scale / scale2
    c, s = ratio * np.cos(turn * 2 * np.pi / TURNS), ratio * np.sin(turn * 2 * np.pi / TURNS)
    off = np.hypot(c * dx - s * dy - dx2, s * dx + c * dy - dy2)
    rows = np.stack([turn, np.rint(4 * np.log2(ratio)).astype(np.int64), np.rint(4 * (x2 - c * x + s * y)).astype(np.int64), np.rint(4 * (y2 - s * x - c * y)).astype(np.int64)])
    return rows, off <= np.maximum(4, 0.3 * np.hypot(dx2, dy2))


def agreeing(votes: DataFrame, corners: DataFrame, least: int, share: float) -> DataFrame:
    """a, b of the pairs of images for which enough corner pairs of a agree on one turn, scale and shift; votes has a, b, pa, pb (a before b).

    Enough are least, and share by the corners of the image with fewer: one box that two whole pictures have in common is
    not enough, though as many corners may be all that a small part of a picture has. corners has id, n_corners.
    """
    kind = votes.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(held: pa.Table) -> pa.RecordBatch:
            pair, p, q = (held.column(c).to_numpy() for c in ("pair", "pa", "pb"))
            at = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
            of, best = np.repeat(np.arange(len(at)), np.diff(np.r_[at, len(pair)])), np.zeros(len(at), np.int64)
            move, right = moves(p, q)
            # votes are counted in bins of four grids, so that no bound between bins parts votes that agree
            for dx, dy in ((0, 0), (0, 16), (16, 0), (16, 16)):
                rows = np.stack([p, (move[3] + dy) // 32, (move[2] + dx) // 32, move[1], move[0], of])[:, right]
                rows = rows[:, np.lexsort(rows)]
                if not rows.shape[1]:
                    continue
                new = np.r_[True, (np.diff(rows) != 0).any(0)]  # a corner pair that both tables found counts once
                rows = rows[:, new]
                first = np.flatnonzero(np.r_[True, (np.diff(rows[1:]) != 0).any(0)])
                np.maximum.at(best, rows[5][first], np.diff(np.r_[first, rows.shape[1]]))
            some = held.take(pa.array(at[best >= least]))
            return pa.record_batch([some.column("a").combine_chunks(), some.column("b").combine_chunks(), pa.array(best[best >= least])], names=["a", "b", "n"])

        for held in whole_groups(batches, "pair"):
            yield counted(held)

    dealt = votes.select("a", "b", "pa", "pb", F.xxhash64("a", "b").alias("pair")).repartition("pair").sortWithinPartitions("pair", "a", "b")
    found = dealt.mapInArrow(run, f"a {kind}, b {kind}, n long")
    for c in ("a", "b"):
        found = found.join(corners.select(F.col("id").alias(c), F.col("n_corners").alias(f"corners_{c}")), c)
    return found.where(F.col("n") >= F.least("corners_a", "corners_b") * share).select("a", "b")


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Sorted batches as tables of whole groups of rows with one key."""
    held = None
    for batch in batches:
        new = pa.Table.from_batches([batch])
        held = new if held is None else pa.concat_tables([held, new])
        values = held.column(key).to_numpy()
        if not len(values):
            continue
        cut = int(np.flatnonzero(np.r_[True, values[1:] != values[:-1]])[-1])
        if cut:
            yield held.slice(0, cut)
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield held


def pairs_within(group: np.ndarray, other: np.ndarray, chunk: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """i < j of all rows of one group (which lie together) that differ in other, about chunk at a time."""
    at = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    held, n = [], 0
    for a, b in zip(at.tolist(), [*at[1:].tolist(), len(group)], strict=True):
        for i in range(a, b - 1):
            j = np.flatnonzero(other[i + 1 : b] != other[i]) + i + 1
            if len(j):
                held.append((np.full(len(j), i), j))
                n += len(j)
                if n >= chunk:
                    yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
                    held, n = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def turnings(held: pa.Table) -> np.ndarray:
    """For each row a set, as bits, of the turns and scales that would bring its place to one of the key's places whose image isn't joined with its own.

    ways has the turns and scales of the key's places, lows and highs the least and greatest root of the images of each.
    """
    place, root, ways = held.column("place").to_numpy(), held.column("root").to_numpy(), held.column("ways").combine_chunks()
    of = np.repeat(np.arange(len(place)), np.diff(ways.offsets.to_numpy()))
    way, low, high = (held.column(c).combine_chunks().flatten().to_numpy() for c in ("ways", "lows", "highs"))
    apart = (low != root[of]) | (high != root[of])
    of, way = of[apart], way[apart]
    bit = ((way >> 3) - (place[of] >> 3 & 31) & 31) * 9 + (way & 7) - (place[of] & 7) + 4
    sets = np.zeros((len(place), 5), np.uint64)  # 32 turns by 9 differences of scale
    np.bitwise_or.at(sets, (of, bit >> 6), np.uint64(1) << (bit & 63).astype(np.uint64))
    return sets


def first_votes(pairs: DataFrame) -> DataFrame:
    """key, a, pa, b, pb: the least of a key's images with each of its others, and with itself for its other places; pairs has id, key, place of the corner pairs of distinct images."""
    by_key = Window.partitionBy("key").orderBy("id", "place")
    first = pairs.select("key", "id", "place", F.first("id").over(by_key).alias("a"), F.first("place").over(by_key).alias("pa"))
    return saved(first.where("id != a or place != pa").select("key", "a", "pa", F.col("id").alias("b"), F.col("place").alias("pb")), "image-votes")


def linked(star: DataFrame, corners: DataFrame, votes: int, share: float) -> DataFrame:
    """node, root of the images that chains of links join; star is what first_votes gave, corners has id, n_corners.

    Images that share a key vote. At first all of a key's images vote with the least one only, which
    joins most copies. Then images that aren't joined, but have keys in common, are brought together by two keys at once, since
    a link needs two votes at least (so votes is 2 or more): each image has a row for every two of its keys that one turn and scale could bring to
    images it isn't joined with, as votes that agree have both in common; and just images with such a row in common (two keys and
    how they are turned and scaled to each other) vote. So no link between different classes is left out, and neither
    large classes nor corner pairs that many unlike pictures have cost much more than their rows.
    """
    if votes < 2:
        raise ValueError("votes must be 2 or more")
    kind = star.schema["a"].dataType.simpleString()
    found = saved(agreeing(star.where("a != b"), corners, votes, share), "image-links")
    downward = lambda e: e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    roots = saved(components(downward(found)), "image-roots")

    def rooted(df: DataFrame, column: str) -> DataFrame:
        return df.join(small(roots.select(F.col("node").alias("__node"), F.col("root").alias(f"root_{column}"))), F.col(column) == F.col("__node"), "left").drop("__node").withColumn(f"root_{column}", F.coalesce(f"root_{column}", column))

    open_ = rooted(rooted(star, "a"), "b").withColumn("apart", F.col("root_a") != F.col("root_b"))
    by_key = Window.partitionBy("key")
    there = open_.withColumn("open", F.max("apart").over(by_key)).where("open")
    side = lambda x: there.select("key", F.col(x).alias("id"), F.col(f"p{x}").alias("place"), F.xxhash64(f"root_{x}").alias("root"))
    members = side("b").unionByName(side("a").distinct())
    # a place's low byte has its turn and scale: so few are there for a key of any size
    of_way = Window.partitionBy("key", "way")
    kinds = members.repartition("key").withColumn("way", F.col("place").bitwiseAND(255))
    kinds = kinds.withColumns({"low": F.min("root").over(of_way), "high": F.max("root").over(of_way)}).withColumn("kinds", F.collect_set(F.struct("way", "low", "high")).over(by_key))
    kinds = kinds.withColumns({f"{c}s": F.col("kinds").getField(c) for c in ("way", "low", "high")})

    def by_two(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in whole_groups(batches, "image"):
            key, place, root = (held.column(c).to_numpy() for c in ("key", "place", "root"))
            ids, open_to = held.column("id").combine_chunks(), turnings(held)
            for i, j in pairs_within(held.column("image").to_numpy(), place):
                some = (open_to[i] & open_to[j]).any(1)
                i, j = i[some], j[some]
                swapped = key[i] == key[j]  # either may come first
                i, j = np.r_[i, j[swapped]], np.r_[j, i[swapped]]
                if not len(i):
                    continue
                way = ((place[j] >> 3) - (place[i] >> 3) & 31) << 4 | (place[j] & 7) - (place[i] & 7) + 4
                two = (key[i].view(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)) ^ (key[j].view(np.uint64) * np.uint64(0x94D049BB133111EB))
                two = (two ^ (two >> np.uint64(31)) ^ (way.astype(np.uint64) << np.uint64(55))) * np.uint64(0x9E3779B97F4A7C15)
                yield pa.record_batch([pa.array((two ^ (two >> np.uint64(32))).view(np.int64)), ids.take(pa.array(i)), pa.array(root[i]), pa.array(place[i]), pa.array(place[j])], names=["two", "id", "root", "p", "q"])

    def all_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in whole_groups(batches, "two"):
            root, p, q = (held.column(c).to_numpy() for c in ("root", "p", "q"))
            ids = held.column("id").combine_chunks()
            for i, j in pairs_within(held.column("two").to_numpy(), root):
                both = [ids.take(pa.array(np.r_[x, x])) for x in (i, j)]
                yield pa.record_batch([both[0], pa.array(np.r_[p[i], q[i]]), both[1], pa.array(np.r_[p[j], q[j]])], names=["a", "pa", "b", "pb"])

    grouped = kinds.withColumn("image", F.xxhash64("id")).repartition("image").sortWithinPartitions("image", "key", "place")
    twos = grouped.select("image", "id", "key", "place", "root", "ways", "lows", "highs").mapInArrow(by_two, f"two long, id {kind}, root long, p long, q long")
    more = twos.repartition("two").sortWithinPartitions("two", "id", "p", "q").mapInArrow(all_apart, f"a {kind}, pa long, b {kind}, pb long")
    rest = saved(agreeing(more, corners, votes, share), "image-links")
    discard(star)
    return components(downward(found.union(rest)))


def copies(images: DataFrame, id_col: str = "image_id", data_col: str = "image", votes: int = VOTES, share: float = SHARE) -> DataFrame:
    """id_col, class_id (the least id that links reach) and n_corners.

    Images are linked if so many of their corner pairs agree on one turn, scale and shift: votes, and
    share by the corners of the image with fewer. Equal files are one content.
    Anything but a binary PGM file, nulls among it, has no corners and is linked to equal files only; rows with a
    null id are of the class of equal files that have one; without such a file their class_id is null. An empty table gives no rows.
    """
    found = saved(described(images, id_col, data_col), "corners")
    rows = saved(found.select("id", "whole", "n_corners"), "images")
    each = rows.where("id is not null").groupBy("id", "whole").agg(F.count("*").alias("n"), F.min("n_corners").alias("n_corners"))
    first = saved(rows.groupBy("whole").agg(F.min("id").alias("first")), "contents")
    # a content is told by its least id; of several contents of one id the one with the least MD5 takes part for all of them
    chief = first.groupBy(F.col("first").alias("id")).agg(F.min("whole").alias("whole"))
    others = saved(each.join(chief, ["id", "whole"], "left_anti").select("id", "whole"), "copies")
    distinct = found.where("id is not null").join(small(others), ["id", "whole"], "left_anti")
    if not each.where("n > 1").isEmpty():
        distinct = distinct.dropDuplicates(["id"])
    pairs = distinct.select("id", F.explode(F.arrays_zip("keys", "places")).alias("p")).select("id", F.col("p.keys").alias("key"), F.col("p.places").alias("place"))
    star = first_votes(pairs)
    discard(found)
    roots = linked(star, each.join(chief, ["id", "whole"], "left_semi").select("id", "n_corners"), votes, share)
    classes = first.join(roots, F.col("first") == F.col("node"), "left").select(F.col("whole").alias("of"), F.coalesce("root", "first").alias("class_id"))
    return rows.join(classes, F.col("whole") == F.col("of")).select(F.col("id").alias(id_col), "class_id", "n_corners")


def rendered(vector: np.ndarray, size: int = 64) -> np.ndarray:
    """A picture of a vector of 64 numbers: a smooth ground with sixteen rectangles on it."""
    v = np.nan_to_num(np.asarray(vector, float))
    v = np.resize(v, 64) if len(v) else np.zeros(64)
    x = resized(v.reshape(8, 8), size / 8)
    x = 110 + 60 * x / (np.abs(v).max() + 1e-9)
    part = lambda i: np.modf(np.abs(v[i % 64]) * 997.0)[0]
    for i in range(16):
        left, top = int(part(4 * i) * (size - 12)), int(part(4 * i + 1) * (size - 12))
        w, h = 5 + int(part(4 * i + 2) * 14), 5 + int(part(4 * i + 3) * 14)
        x[top : top + h, left : left + w] = 20 + 215 * part(7 * i + 3)
    return np.clip(np.rint(x), 0, 255)


def edited(gray: np.ndarray, kind: int) -> np.ndarray:
    """A cropped, brightened or turned copy, or all of these, by the last bits of kind."""
    out = gray
    if kind % 2:
        out = out[6 + kind % 5 :, 4 + kind % 7 :]
    if kind // 2 % 2:
        out = np.clip(np.rint(out * 0.85 + 18), 0, 255)
    return np.rot90(out) if kind // 4 % 2 else out


def gallery(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """image_id, image: for each vector its picture (2 id) and an edited copy (2 id + 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                some, ids, files = batch.slice(i, 1024), [], []
                for key, vector in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                    gray = rendered(np.array([0.0 if x is None else x for x in vector or []]))
                    ids += [2 * key, 2 * key + 1]
                    files += [pgm(gray), pgm(edited(gray, key % 7 + 1))]
                yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(files, pa.binary())], names=["image_id", "image"])

    return embeddings.where(F.col(id_col).isNotNull()).select(id_col, vector_col).mapInArrow(run, "image_id long, image binary")
