import hashlib
from collections import defaultdict

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests.llm.conftest import SF
from tests.test_queries import rows as comparable

from sluice.llm import digests, mixing, queries, sharding


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    ours, theirs = queries.queries()[name](spark, SF).toPandas(), con.sql(queries.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns) and comparable(ours) == comparable(theirs)


# mixing


def filled(sizes):
    """Targets by sharing out again and again, sources in order."""
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    left, out = 1.5 * sum(sizes.values()), {}
    while True:
        open_ = [s for s in sizes if s not in out]
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            return out | share
        for s in over:
            out[s] = 2 * sizes[s]
            left -= 2 * sizes[s]


@settings(max_examples=10, deadline=None)
@given(st.dictionaries(st.one_of(st.none(), st.text(alphabet="abé", max_size=3)), st.integers(0, 500), min_size=1, max_size=7))
def test_targets(spark, sizes):
    out = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    want = filled(sizes)
    assert {r.source for r in out} == set(sizes)
    assert all(abs(r.target - want[r.source]) < 1e-6 for r in out)


def test_mix(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 50), f"s{i % 4 if i % 3 else 0}") for i in range(3000)], "doc_id long, text string, source string")
    mixed = mixing.mix(docs)
    taken = mixed.groupBy("source").agg(F.sum(F.col("copies") * F.col("mix_size")).alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r.taken / r.target - 1) < 0.01 for r in taken)
    first, again = (sorted(map(tuple, m.select("doc_id", "copies").collect())) for m in (mixed, mixing.mix(docs.repartition(7))))
    assert first == again and max(c for _, c in first) <= 2
    assert mixing.emitted(mixed).count() == sum(c for _, c in first)


def test_mix_odd_rows(spark, odd):
    out = mixing.mix(odd)
    rows = out.collect()
    assert len(rows) == odd.count() and all(0 <= r.copies <= 2 and r.target <= 2 * r.source_size for r in rows)
    assert {r.mix_size for r in rows if not r.text} == {0}
    assert mixing.mix(odd.where("false")).count() == 0 and mixing.mix(odd.where("text is null")).count() == 2


# sharding


def extended(rows, limit):
    """Extendible hashing by a loop: bucket (bits) -> rows."""
    buckets, todo = {}, [("", rows)]
    while todo:
        bits, items = todo.pop()
        if sum(r[1] for r in items) <= limit or len(bits) == 60:
            if items:
                buckets[bits] = items
            continue
        parts = defaultdict(list)
        for r in items:
            parts[f"{r[0]:060b}"[len(bits)]].append(r)
        todo += [(bits + b, part) for b, part in parts.items()]
    return buckets


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 40)), max_size=60), st.sampled_from([20, 45, 200]))
def test_shards(spark, docs, limit):
    out = sharding.sharded(spark.createDataFrame([(i, "x" * n) for i, n in docs], "doc_id long, text string"), limit=limit).collect()
    h = lambda i: int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16)
    want = extended([(h(i), n) for i, n in docs if n <= limit], limit)
    got = defaultdict(list)
    for r in out:
        got[r.shard].append((h(r.doc_id), len(r.text)))
    assert sorted((b, sorted(v)) for b, v in got.items() if not b.endswith("+")) == sorted((b, sorted(v)) for b, v in want.items())
    assert len(out) == len(docs) and all(r.oversize == (r.shard_size > limit) for r in out)


def test_shards_odd_rows(spark, odd, tmp_path):
    out = sharding.sharded(odd, limit=100)
    assert out.count() == odd.count() and out.where("oversize").count() >= 2
    sharding.write_shards(out.where("shard_size <= 100"), str(tmp_path / "s"))
    sizes = spark.read.parquet(str(tmp_path / "s")).groupBy("shard_name").agg(F.sum(F.octet_length("text")).alias("n"))
    assert sizes.where("n > 100").count() == 0
    assert sharding.sharded(odd.where("false")).count() == 0


# digests


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=80))
def test_digest(text):
    data = text.encode()
    counts = [0] * digests.BUCKETS
    padded = data + bytes(9)
    for i in range(len(data)):
        for salt, (a, b, c) in enumerate(digests.TRIPLETS):
            key = padded[i + a] | padded[i + b] << 8 | padded[i + c] << 16
            key = (key + (salt << 24)) * 2654435761 & 0xFFFFFFFF
            key ^= key >> 15
            counts[(key * 2246822519 & 0xFFFFFFFF) >> 23] += 1
    assert digests.counted(data).tolist() == counts
    ranked = sorted(counts)
    cuts = [ranked[digests.BUCKETS * q // 4 - 1] for q in (1, 2, 3)]
    packed = digests.digest(data)[1:]
    codes = [packed[i // 4] >> (6 - 2 * (i % 4)) & 3 for i in range(digests.BUCKETS)]
    assert codes == [sum(c > q for q in cuts) for c in counts]
    assert digests.likeness(digests.digest(data), digests.digest(data)) == 1.0


def plain_likeness(a, b):
    """Differences of quartile codes, one bucket after another, and of the lengths."""
    code = lambda d, i: d[1 + i // 4] >> (6 - 2 * (i % 4)) & 3
    score = sum((0, 1, 2, 6)[abs(code(a, i) - code(b, i))] for i in range(512)) + 2 * min(16, abs(a[0] - b[0]))
    most = 512 * sum((0, 1, 2, 6)[abs(x - y)] for x in range(4) for y in range(4)) / 16
    return 1 - min(score, most) / most


def test_likeness_by_buckets(documents):
    some = [digests.digest(t.encode()) for _, t in documents[:40]] + [digests.digest(b""), digests.digest(b"x"), digests.digest(b"ab" * 50_000)]
    for a in some:
        for b in some[:12] + some[-3:]:
            assert abs(digests.likeness(a, b) - plain_likeness(a, b)) < 1e-12


def test_edits_query(spark, documents):
    docs = documents[::-1]
    got = {r.doc_id: r for r in queries.op10_digests(spark, SF).collect()}
    fresh = {i: digests.digest(t.encode()) for i, t in docs}
    assert len(got) == len(docs)
    for k, (i, t) in enumerate(docs):
        j, following = docs[(k + 1) % len(docs)]
        changed = (t[: len(t) - len(t) // 2] + following[: len(t) // 2]).encode()
        r = got[i]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(t), hashlib.sha256(changed).hexdigest(), fresh[i].hex(), digests.digest(changed).hex())
        assert r.near_edited == digests.likeness(fresh[i], digests.digest(changed)) and r.near_next == digests.likeness(fresh[i], fresh[j])
    assert sum(r.near_edited > r.near_next for r in got.values()) > 0.95 * len(got)


@pytest.mark.parametrize("size", [1 << 12, 1 << 25])
def test_edits_odd_rows(spark, odd, size):
    rows = digests.with_edits(odd, part_bytes=size).collect()
    ordered = sorted(((r.doc_id, r.text or "") for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=True)
    want = sorted((str(i), hashlib.sha256(digests.edited(t, ordered[(k + 1) % len(ordered)][1]).encode()).hexdigest()) for k, (i, t) in enumerate(ordered))
    assert sorted((str(r.doc_id), r.edited_sha256) for r in rows) == want
    alone = digests.with_edits(odd.where("doc_id = 5").limit(1)).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0
    assert digests.with_edits(odd.where("false")).count() == 0
    assert digests.fingerprints(odd).count() == odd.count()
