import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.conftest import SF
from tests.llm.test_simhash import classes

from sluice.llm import media
from sluice.llm.queries import op2_media


def test_files():
    gray = np.arange(12.0).reshape(3, 4)
    assert (media.gray_of(media.pgm(gray)) == gray).all()
    for bad in (None, b"", b"GIF89a", b"P5 4 3 255\n123", b"P5 0 3 255\n"):
        assert media.gray_of(bad) is None


def test_descriptors_follow_turns_and_crops():
    gray = media.rendered(np.random.default_rng(4).normal(size=64))
    bits = lambda x: {d[4:] for d in media.descriptors(x) if d[3] == 1.0}  # noqa: E731 (smaller scales are sampled anew in a crop)
    own = bits(gray)
    assert len(own) > 15
    assert len(own & bits(np.rot90(gray))) > len(own) / 2
    assert len(own & bits(gray[8:, 6:])) > len(own) / 3
    assert media.descriptors(np.zeros((5, 5))) == [] and media.descriptors(np.zeros((64, 64))) == []


@settings(max_examples=20, deadline=None)
@given(st.integers(1, 12), st.integers(1, 12), st.sampled_from([1.0, 0.5, 2.0]))
def test_resized(h, w, scale):
    x = media.resized(np.full((h, w), 7.0), scale)
    assert np.allclose(x, 7.0)


def test_query_links_every_edited_copy_and_no_other(spark):
    rows = {r.image_id: r for r in op2_media(spark, SF).collect()}
    assert len(rows) == 2 * spark.read.parquet(f"{SF}/embeddings.parquet").count()
    right = sum(rows[i].class_id == rows[i - i % 2].image_id == i - i % 2 for i in rows)
    assert right == len(rows)


def test_odd_images(spark):
    gray = media.rendered(np.random.default_rng(5).normal(size=64))
    files = [(1, media.pgm(gray)), (2, media.pgm(gray)), (3, media.pgm(media.edited(gray, 7))), (4, None), (5, None), (6, b"no image"), (7, media.pgm(np.zeros((9, 9)))), (7, media.pgm(np.zeros((9, 9)))), (None, media.pgm(gray)), (None, None)]
    images = spark.createDataFrame(files, "image_id long, image binary")
    rows = media.copies(images).collect()
    assert len(rows) == len(files)
    assert {(r.image_id, r.class_id) for r in rows} == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 6), (7, 7), (None, 1), (None, 4)}
    assert media.copies(spark.createDataFrame([], "image_id long, image binary")).count() == 0
    extra = images.selectExpr("*", "1 as class_id", "'k' as key", "2 as n_corners")
    assert {(r.image_id, r.class_id) for r in media.copies(extra).collect()} == {(r.image_id, r.class_id) for r in rows}


def test_large_group_of_copies(spark):
    """More copies than a shard compares pair by pair still make one class."""
    gray = media.rendered(np.random.default_rng(6).normal(size=64))
    files = []
    for i in range(60):
        x = gray.copy()
        x[0, i % 60] = 255 - x[0, i % 60]
        files.append((i, media.pgm(x)))
    assert {r.class_id for r in media.copies(spark.createDataFrame(files, "image_id long, image binary")).collect()} == {0}


def brute(pairs, corners, least, share):
    """Classes by all pairs of images and all pairs of their corner pairs that share a key."""
    by = {}
    for i, key, place in pairs:
        by.setdefault(i, []).append((key, place))
    links = []
    for a in by:
        for b in by:
            if a < b:
                met = [(p, q) for k, p in by[a] for m, q in by[b] if k == m]
                if not met:
                    continue
                rows, right = media.moves(*np.array(met, np.int64).T)
                most = 0
                for dx in (0, 16):
                    for dy in (0, 16):
                        bins = {}
                        for (p, _), t, r, x, y, ok in zip(met, *rows.tolist(), right.tolist()):
                            if ok:
                                bins.setdefault((t, r, (x + dx) // 32, (y + dy) // 32), set()).add(p)
                        most = max([most, *map(len, bins.values())])
                if most >= max(least, share * min(corners[a], corners[b])):
                    links.append((b, a))
    return classes(sorted(corners), links)


def test_links_match_all_pairs(spark):
    """Pictures with overlapping parts, copies and common corner pairs: the same classes as by all pairs."""
    rng = np.random.default_rng(11)
    pairs, corners = [], {}
    for i in range(60):
        corners[i] = int(rng.integers(2, 40))
        group = i % 9
        for key in rng.choice(20, 6, replace=False).tolist():
            spot = np.random.default_rng(100 * group + key).integers(20, 200, 2) + (i % 2) * 8
            pairs.append((i, 1000 * group + key if rng.random() < 0.8 else key, int(spot[0] << 44 | spot[1] << 28 | 530 << 18 | 540 << 8 | 3 << 3)))
        pairs.append((i, 77, int(rng.integers(0, 200) << 44 | rng.integers(0, 200) << 28 | 530 << 18 | 540 << 8)))
    want = brute(pairs, corners, 2, 0.08)
    assert 15 < len(set(want.values())) < 55
    roots = media.linked(media.first_votes(spark.createDataFrame(pairs, "id long, key long, place long")), spark.createDataFrame(list(corners.items()), "id long, n_corners long"), 2, 0.08)
    assert {r.node: r.root for r in roots.collect() if r.node != r.root} == {i: r for i, r in want.items() if i != r}


def test_turned_links_match_all_pairs(spark):
    """Turned and scaled copies, a key that a picture has twice, and turns that don't agree: the same classes as by all pairs."""
    rng = np.random.default_rng(13)
    pairs, corners = [], {}
    for i in range(80):
        corners[i] = int(rng.integers(2, 40))
        group, quarter, level = i % 11, i % 4, int(rng.integers(0, 2)) * 4 if i % 5 else int(rng.integers(0, 5))
        for key in rng.choice(20, 6, replace=False).tolist():
            own = np.random.default_rng(100 * group + key)
            for spot in own.integers(20, 200, (1 + (key < 4), 2)).tolist():
                turn = 3 + 8 * quarter if rng.random() < 0.9 else int(rng.integers(0, 32))
                c, s = [(1, 0), (0, 1), (-1, 0), (0, -1)][quarter]
                x, y, scale = c * spot[0] - s * spot[1], s * spot[0] + c * spot[1], media.SCALES[level]
                x, y, dx, dy = (int(round(v)) for v in (400 + x / scale, 400 + y / scale, 512 + 18 * c - 28 * s, 512 + 18 * s + 28 * c))
                # an unlike picture may have a key too, as any two boxes have
                pairs.append((i, 1000 * group + key if rng.random() < 0.8 else key, x << 44 | y << 28 | dx << 18 | dy << 8 | turn % 32 << 3 | level))
    want = brute(pairs, corners, 2, 0.08)
    assert 15 < len(set(want.values())) < 70
    votes = media.first_votes(spark.createDataFrame(pairs, "id long, key long, place long"))
    roots = media.linked(votes, spark.createDataFrame(list(corners.items()), "id long, n_corners long"), 2, 0.08)
    assert {r.node: r.root for r in roots.collect() if r.node != r.root} == {i: r for i, r in want.items() if i != r}


def test_doublets_of_many_corners():
    rng = np.random.default_rng(12)
    found = [(float(x), float(y), 0, 1.0, int(a), int(b)) for x, y, a, b in zip(rng.permutation(3000)[:1200], rng.permutation(3000)[:1200], rng.integers(0, 2**62, 1200), rng.integers(0, 2**62, 1200))]
    keys, places = media.doublets(found)
    x, y, dx, dy, _, _ = media.unpacked(places)
    at = {(f[0], f[1]) for f in found}
    assert len(keys) >= 2 * 1200 and all((a, b) in at and (a + c, b + d) in at for a, b, c, d in zip(x, y, dx, dy))
    assert media.doublets(found[:1])[0].size == media.doublets([])[0].size == 0


def share_found(spark, change, n=120):
    """Of n pictures, the share whose changed copy is in their class; no two pictures may be in one class."""
    files = []
    for i in range(n):
        gray = media.rendered(np.random.default_rng(1000 + i).normal(size=64))
        files += [(2 * i, media.pgm(gray)), (2 * i + 1, media.pgm(change(gray, np.random.default_rng(i))))]
    of = {r.image_id: r.class_id for r in media.copies(spark.createDataFrame(files, "image_id long, image binary")).collect()}
    assert all(of[2 * i] == 2 * i and of[2 * i + 1] in (2 * i, 2 * i + 1) for i in range(n))
    return sum(of[2 * i + 1] == 2 * i for i in range(n)) / n


def cropped(size):
    def crop(gray, rng):
        y, x = rng.integers(0, 65 - size, 2)
        return gray[y : y + size, x : x + size]

    return crop


@pytest.mark.parametrize("change", [cropped(36), cropped(40), lambda g, rng: np.clip(np.rint(g + rng.normal(0, 4, g.shape)), 0, 255), lambda g, rng: np.rot90(g, rng.integers(1, 4)), lambda g, rng: np.clip(g * 0.7 + 40, 0, 255)])
def test_changed_copies_are_found(spark, change):
    assert share_found(spark, change) >= 0.9


def test_small_part_of_a_busy_picture(spark):
    """The part's own corners are weaker than those of the rest."""
    rng = np.random.default_rng(10)
    gray = np.kron(rng.integers(0, 2, (32, 32)) * 255.0, np.ones((6, 6)))
    gray[:60, :60] = np.kron(rng.integers(0, 2, (10, 10)) * 40.0 + 100, np.ones((6, 6)))
    files = [(1, media.pgm(gray)), (2, media.pgm(gray[:56, :56]))]
    assert {r.class_id for r in media.copies(spark.createDataFrame(files, "image_id long, image binary")).collect()} == {1}


def test_keys_of_images_are_not_joined_with_each_other(spark, monkeypatch):
    """What a key's images have in common comes by windows, a row for each row."""
    from pyspark.sql.classic.dataframe import DataFrame

    met, join = [], DataFrame.join
    monkeypatch.setattr(DataFrame, "join", lambda self, other, on=None, how=None: met.append(on) or join(self, other, on, how))
    pairs = [(i, key, (20 + key) << 44 | 30 << 28 | 530 << 18 | 540 << 8) for i in range(4) for key in range(1 + 10 * (i // 2), 4 + 10 * (i // 2))] + [(0, 11, 1 << 44)]
    votes = media.first_votes(spark.createDataFrame(pairs, "id long, key long, place long"))
    roots = media.linked(votes, spark.createDataFrame([(i, 5) for i in range(4)], "id long, n_corners long"), 2, 0.08)
    assert {r.node: r.root for r in roots.collect() if r.node != r.root} == {1: 0, 3: 2} and met and "key" not in [x for x in met if isinstance(x, str)]
