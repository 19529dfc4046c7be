import math
import random
from collections import Counter

import numpy as np
import pytest
from tests.llm.conftest import SF

from sluice.llm import ranked_search
from sluice.llm.queries import op13_search, table


def plain(docs, items, k):
    """Every document against every item; (item, rank, id, score), null ids last among equals."""
    counts = [(i, Counter(ranked_search.words_of(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counts:
            m = 50 + (50 * c.total() * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(ranked_search.words_of(text)) if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, rank, None if none else i, -score) for rank, (score, none, i) in enumerate(sorted(scored)[:k], 1)]
    return out


def order(rows):
    return sorted(map(tuple, rows), key=repr)


def test_terms():
    assert ranked_search.words_of("Ab-c É\x7fÀb\x00x_9 日本\u3000語") == ["ab".encode(), b"c", "É".encode(), "Àb".encode(), b"x", b"9", "日本\u3000語".encode()]
    assert ranked_search.words_of(None) == ranked_search.words_of(" -_") == []


def test_query(spark, documents):
    items = [tuple(r) for r in table(spark, SF, "benchmark").collect()]
    got = op13_search(spark, SF)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert order(got.collect()) == order(plain(documents, items, 50))


def test_bisection_brings_like_documents_together():
    rng = np.random.default_rng(0)
    topic = rng.integers(0, 8, 512)
    doc = np.repeat(np.arange(512), 20)
    term = topic[doc] * 40 + rng.integers(0, 40, len(doc))
    pairs = np.unique(doc * 320 + term)
    order = ranked_search.bisected(pairs // 320, pairs % 320, 512, 320, 3)
    assert sorted(order) == list(range(512))
    purity = np.mean([np.bincount(topic[order[i : i + 64]]).max() / 64 for i in range(0, 512, 64)])
    assert purity > 0.8  # an eighth by chance is 0.2


def texts(n, seed=1):
    rng = random.Random(seed)
    topics = [[f"t{k}w{i}" for i in range(30)] for k in range(12)]
    out = [(i, " ".join(rng.choices(topics[rng.randrange(12)], k=rng.randint(5, 60)) + rng.choices(topics[0], k=5))) for i in range(n)]
    return out + [(n + i, out[7][1]) for i in range(n // 2)]  # a third are copies of one text


@pytest.mark.parametrize("shard,cluster,sample,block", [(64, 8, 256, 1 << 20), (20, 4, 1000, 100), (4096, 64, 8192, 1 << 20), (16, 16, 0, 1 << 20)])
def test_shards_clusters_and_blocks_of_any_size(spark, shard, cluster, sample, block):
    docs, rng = texts(400), random.Random(5)
    items = [(i, " ".join(rng.choices(docs[rng.randrange(600)][1].split(), k=6))) for i in range(12)] + [(50, docs[7][1]), (51, "nowhere"), (50, docs[7][1])]
    rows, asked = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = ranked_search.search(rows, asked, k=10, shard=shard, cluster=cluster, sample=sample, block_bytes=block)
    assert order(got.collect()) == order(plain(docs, items, 10))


def test_clusters_below_the_bound_are_not_visited(spark, monkeypatch):
    docs = texts(3000)
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, t in docs for w in ranked_search.words_of(t)}))}
    rows = ranked_search.counted(spark.createDataFrame(docs, "doc_id long, text string"), vocabulary, "doc_id", "text").toArrow()
    corpus = ranked_search.Corpus(len(docs), sum(rows["size"].to_pylist()))
    row = ranked_search.build_shard(rows, corpus, 32).to_pylist()[0]
    shard = ranked_search.Shard(row["names"], row["whole"], **{c: row[c] for c in ranked_search.COLUMNS[3:]})
    shard.unpack()
    asked = np.array(sorted(vocabulary[w] for w in (b"t5w1", b"t5w2", b"t5w3")))
    query, visits = ranked_search.Query(1, asked, np.array([9, 8, 7])), []
    zeros = np.zeros
    monkeypatch.setattr(np, "zeros", lambda *a, **b: (visits.append(a[0]), zeros(*a, **b))[1])
    shard.best(query, len(docs), 32, 10, 0, np.arange(len(docs)))
    clusters = -(-len(docs) // 32)
    assert sum(v == 32 for v in visits) < clusters / 3


def test_odd_rows(spark, odd):
    items = [(1, "same text of some WORDS here"), (1, "same text of some WORDS here"), (None, "no id at all"), (2, None), (3, ""), (4, "é ß 日本語 one two x a")]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", ranked_search.F.lit(9)).withColumn("score", ranked_search.F.lit("s"))
    rows = odd.withColumn("score", ranked_search.F.lit("s")).withColumn("item_id", ranked_search.F.lit("s"))
    want = plain([(r.doc_id, r.text) for r in odd.collect()], items, 3)
    assert order(ranked_search.search(rows, asked, k=3, shard=4, cluster=2).collect()) == order(want)
    assert ranked_search.search(rows.limit(0), asked).count() == 0
    assert ranked_search.search(rows, asked.limit(0)).count() == 0
    assert ranked_search.search(rows, asked.where("item_id = 2")).count() == 0
