"""Ranked lexical search over documents that recursive graph bisection has put in order.

Bisection halves the documents again and again, and swaps them between halves as long as
that lowers the cost of coding each term's postings, so that documents with like terms
come to lie together. Its top levels are fitted on a bounded sample, whose splits every
document then follows to a shard; in a shard all documents are bisected. A shard's order is cut
into clusters, and the index holds each term's greatest impact in each cluster. A query visits shards and
clusters by the bound that these impacts give, and stops where no bound reaches its worst kept score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from sluice.llm.common import discard, saved

#: Letters and digits of ASCII, and all that isn't ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: A-Z become a-z, and what no term holds becomes a space.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
#: Documents of a shard and of a cluster; the sample for the top levels; rounds of swaps a level.
SHARD, CLUSTER, SAMPLE, ROUNDS = 4096, 64, 8192, 8
#: Queries are taken together up to so many bytes of text, which bounds the terms that go to all tasks.
BLOCK_BYTES = 4 << 20
UNIT = 1_000_000_000


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(LETTERS).split()


def gains(term: np.ndarray, node: np.ndarray, right: np.ndarray, n_terms: int, sizes: np.ndarray) -> np.ndarray:
    """What moving a document that has the term to the other half of its node saves, for each posting; node and right: of each posting's document."""
    here = node * n_terms + term
    degree = np.stack([np.bincount(here[~right], minlength=len(sizes) * n_terms), np.bincount(here[right], minlength=len(sizes) * n_terms)]).astype(float)
    n = np.repeat(sizes.T.astype(float), n_terms, axis=1)
    cost = lambda d: d * np.log2(n / (d + 1))
    now = cost(degree).sum(axis=0)
    after = [cost(np.maximum(degree + np.array(step)[:, None], 0)).sum(axis=0) for step in ((-1, 1), (1, -1))]
    return np.where(right, (now - after[1])[here], (now - after[0])[here])


def bisected(doc: np.ndarray, term: np.ndarray, n_docs: int, n_terms: int, levels: int, rounds: int = ROUNDS, seen: list | None = None) -> np.ndarray:
    """The documents in order. doc and term: the postings. All nodes of a level are worked on at once.

    seen: gets, for each level, what each term says in each node for the right half (a row a node).
    """
    order = np.arange(n_docs)
    for level in range(levels):
        edges = np.arange((1 << level) + 1) * n_docs >> level
        sizes = np.diff(edges)
        if sizes.max() < 2:
            break
        node_at = np.repeat(np.arange(1 << level), sizes)
        half = edges[:-1] + (sizes + 1) // 2
        right_at = np.arange(n_docs) >= half[node_at]
        halves = np.maximum(1, np.stack([(sizes + 1) // 2, sizes // 2], axis=1))
        node, right = np.empty(n_docs, np.int64), np.empty(n_docs, bool)
        for _ in range(rounds):
            node[order], right[order] = node_at, right_at
            gain = np.bincount(doc, gains(term, node[doc], right[doc], n_terms, halves), n_docs)
            # in each half the documents that gain the most come first, and pairs of equal rank swap
            by = np.lexsort((order, -gain[order], right_at, node_at))
            order = order[by]
            rank = np.arange(n_docs) - np.where(right_at, half[node_at], edges[:-1][node_at])
            mate = np.where(right_at, edges[:-1][node_at] + rank, half[node_at] + rank)
            paired = (rank < (sizes // 2)[node_at]) & (mate < n_docs)
            swap = np.flatnonzero(paired & ~right_at)
            swap = swap[gain[order[swap]] + gain[order[mate[swap]]] > 1e-9]
            if not len(swap):
                break
            order[swap], order[mate[swap]] = order[mate[swap]], order[swap]
        if seen is not None:
            node[order], right[order] = node_at, right_at
            here = node[doc] * n_terms + term
            left_n, right_n = (np.bincount(here[mask], minlength=n_terms << level) for mask in (~right[doc], right[doc]))
            seen.append(np.log2((right_n + 0.5) / (left_n + 0.5)).astype(np.float32).reshape(1 << level, n_terms))
    return order


@dataclass(frozen=True)
class Splits:
    """The top levels of a bisection: for each level what each term says for the right half of each node, and where the halves part."""

    says: list[np.ndarray]
    middle: list[np.ndarray]

    def leaf(self, terms: np.ndarray) -> int:
        node = 0
        for says, middle in zip(self.says, self.middle, strict=True):
            node = 2 * node + int(says[node, terms].sum() > middle[node])
        return node


def fitted(sample: list[np.ndarray], n_terms: int, levels: int) -> Splits:
    """Bisects the sample (the terms of each document), then parts each node at the median of what its documents' terms say."""
    seen: list[np.ndarray] = []
    if levels and sample:
        doc = np.repeat(np.arange(len(sample)), [len(x) for x in sample])
        bisected(doc, np.concatenate(sample), len(sample), n_terms, levels, seen=seen)
    nodes, middle = np.zeros(len(sample), np.int64), []
    for says in seen:
        said = np.array([says[k, x].sum() for k, x in zip(nodes, sample, strict=True)])
        middle.append(np.array([np.median(said[nodes == k]) if (nodes == k).any() else 0.0 for k in range(len(says))]))
        nodes = 2 * nodes + (said > middle[-1][nodes])
    return Splits(seen, middle)


@dataclass(frozen=True)
class Corpus:
    """What scores need of all documents: how many have terms, and how many terms these have."""

    docs: int
    terms: int

    def impact(self, tf: np.ndarray, size: np.ndarray) -> np.ndarray:
        length = 50 + (50 * size * self.docs) // max(1, self.terms)
        return (UNIT * tf) // (1000 * tf + 20 * length)

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.docs + 2) / (2 * df + 1)))


def counted(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """id, size (all its terms, with repeats), terms (numbers in the vocabulary) and tfs of each document with at least one term."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, sizes, terms, tfs = [], [], [], []
            for i, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                words = text.translate(LETTERS).split() if text else []
                if words:
                    tf = Counter(map(vocabulary.get, words))
                    tf.pop(None, None)
                    at.append(i)
                    sizes.append(len(words))
                    terms.append(list(tf))
                    tfs.append(list(tf.values()))
            ids = batch.column(0).take(pa.array(at, pa.int64()))
            lists = [pa.array(x, pa.list_(pa.int32())) for x in (terms, tfs)]
            yield pa.record_batch([ids, pa.array(sizes, pa.int64()), *lists], names=["id", "size", "terms", "tfs"])

    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, size long, terms array<int>, tfs array<int>")


def dealt(rows: DataFrame, n_docs: int, n_terms: int, shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """rows with their shard: the leaf to which the fitted splits lead, and a part of it where more documents than ``shard`` go there.

    The splits are fitted on about ``sample`` documents, by a hash of their places, twice as many at most; every document is dealt.
    """
    chance = F.pmod(F.xxhash64(F.spark_partition_id(), F.monotonically_increasing_id()), F.lit(1 << 30))
    some = rows.select("terms", chance.alias("h")).where(F.col("h") < int((1 << 30) * min(1.0, sample / max(1, n_docs)))).select("terms")
    known = [np.array(r.terms, np.int64) for r in some.limit(2 * sample).collect()]  # bounded by sample and vocabulary
    levels = max(0, min(math.ceil(math.log2(max(1, n_docs) / shard)), int(math.log2(max(1, len(known)) / 8))))
    splits = fitted(known, n_terms, levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = [splits.leaf(np.array(x, np.int64)) for x in batch.column("terms").to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(leaf, pa.int32())], names=[*batch.schema.names, "leaf"])

    kind = rows.schema["id"].dataType.simpleString()
    led = saved(rows.mapInArrow(run, f"id {kind}, size long, terms array<int>, tfs array<int>, leaf int"), "led")
    counts = {r.leaf: -(-r["count"] // shard) for r in led.groupBy("leaf").count().collect()}  # a row a leaf
    parts = F.create_map(*(F.lit(x) for kv in counts.items() for x in kv)) if counts else F.create_map(F.lit(0), F.lit(1))
    # a part gets some documents more than others, as their hashes fall
    return led.withColumn("part", F.pmod(F.xxhash64(F.spark_partition_id(), F.monotonically_increasing_id()), parts[F.col("leaf")]).cast("int"))


def build_shard(group: pa.Table, corpus: Corpus, cluster: int) -> pa.Table:
    """One row: the shard's documents in order, and for each term and cluster its greatest impact and its postings."""
    sizes = group["size"].to_numpy()
    n = len(sizes)
    lists = group["terms"].combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    doc = np.repeat(np.arange(n), lengths)
    names, term = np.unique(lists.flatten().to_numpy(), return_inverse=True)
    impact = corpus.impact(group["tfs"].combine_chunks().flatten().to_numpy().astype(np.int64), sizes[doc])
    levels = max(0, math.ceil(math.log2(max(1, n) / cluster)))
    order = bisected(doc, term, n, max(1, len(names)), levels)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    by = np.lexsort((place[doc], term))
    term, at, impact = term[by], place[doc[by]], impact[by]
    cell = term * (n // cluster + 1) + at // cluster
    starts = np.flatnonzero(np.diff(cell, prepend=-1))
    most = np.maximum.reduceat(impact, starts) if len(starts) else impact
    cells = lambda x: pa.array([x.tolist()], pa.list_(pa.int64()))
    whole = np.maximum.reduceat(impact, np.flatnonzero(np.diff(term, prepend=-1))) if len(term) else impact
    columns = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.concat_arrays(group["id"].chunks).take(pa.array(order))), cells(names), cells(whole)]
    columns += [pa.array([x.astype(kind).tobytes()]) for x, kind in ((term[starts], "<i4"), (at[starts] // cluster, "<i4"), (starts, "<i4"), (most, "<i8"), (at, "<i4"), (impact, "<i8"))]
    return pa.table(columns, names=["ids", "names", "whole", "cell_term", "cell_cluster", "cell_start", "cell_most", "at", "impact"])


def build_index(rows: DataFrame, corpus: Corpus, cluster: int = CLUSTER) -> DataFrame:
    """A row a shard, written to the shared folder. A shard is one task's, bounded by what ``dealt`` gives it."""
    kind = rows.schema["id"].dataType.simpleString()
    blobs = ", ".join(f"{c} binary" for c in ("cell_term", "cell_cluster", "cell_start", "cell_most", "at", "impact"))
    made = rows.groupBy("leaf", "part").applyInArrow(lambda g: build_shard(g.select(["id", "size", "terms", "tfs"]), corpus, cluster), f"ids array<{kind}>, names array<long>, whole array<long>, {blobs}")
    return saved(made, "shards")


@dataclass(frozen=True)
class Query:
    item: object
    terms: np.ndarray
    weights: np.ndarray


class Shard:
    """A shard's row as arrays."""

    def __init__(self, names: list[int], whole: list[int], **blobs: bytes) -> None:
        self.names, self.whole = np.array(names, np.int64), np.array(whole, np.int64)
        self.blobs = blobs

    def bound(self, query: Query) -> int:
        at = np.searchsorted(self.names, query.terms)
        at[at == len(self.names)] = 0
        there = self.names[at] == query.terms if len(self.names) else np.zeros(len(at), bool)
        return int((query.weights * self.whole[at] * there).sum()) if len(self.names) else 0

    def unpack(self) -> None:
        for name, raw in self.blobs.items():
            setattr(self, name, np.frombuffer(raw, "<i8" if name in ("cell_most", "impact") else "<i4"))
        self.first = np.searchsorted(self.cell_term, np.arange(len(self.names) + 1))
        self.behind = np.append(self.cell_start[1:], len(self.at))

    def best(self, query: Query, n_docs: int, cluster: int, k: int, floor: int, rank: np.ndarray) -> list[tuple[int, int]]:
        """(place, score) of the k best of at least floor and above 0. Clusters come by their bounds, and none whose bound is below the worst kept score is visited. rank: the places' order by id."""
        known = np.isin(query.terms, self.names)
        rows = [(slice(self.first[t], self.first[t + 1]), w) for t, w in zip(np.searchsorted(self.names, query.terms[known]).tolist(), query.weights[known].tolist(), strict=True)]
        bounds = np.zeros(-(-n_docs // cluster), np.int64)
        for cells, w in rows:
            bounds[self.cell_cluster[cells]] += w * self.cell_most[cells]
        order = np.argsort(-bounds, kind="stable")
        kept_at, kept_score = np.empty(0, np.int64), np.empty(0, np.int64)
        for c in order.tolist():
            if bounds[c] < floor or bounds[c] <= 0:
                break
            score = np.zeros(cluster, np.int64)
            for cells, w in rows:
                i = cells.start + int(np.searchsorted(self.cell_cluster[cells], c))
                if i < cells.stop and self.cell_cluster[i] == c:
                    here = slice(self.cell_start[i], self.behind[i])
                    score[self.at[here] - c * cluster] += w * self.impact[here]
            found = np.flatnonzero((score >= floor) & (score > 0))
            if len(found):
                kept_at, kept_score = np.append(kept_at, found + c * cluster), np.append(kept_score, score[found])
                top = np.lexsort((rank[kept_at], -kept_score))[:k]
                kept_at, kept_score = kept_at[top], kept_score[top]
                if len(kept_at) == k:
                    floor = max(floor, int(kept_score[-1]))
        return list(zip(kept_at.tolist(), kept_score.tolist(), strict=True))


def ranks(ids: pa.Array) -> np.ndarray:
    """Each place's rank by id, null ids last."""
    rank = np.empty(len(ids), np.int64)
    rank[pc.array_sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
    return rank


COLUMNS = ["ids", "names", "whole", "cell_term", "cell_cluster", "cell_start", "cell_most", "at", "impact"]


def searched(index: DataFrame, queries: list[Query], cluster: int, k: int, floors: list[int]) -> DataFrame:
    """q, id and score: the best of each query in each shard whose bound reaches the query's floor."""
    kind = index.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                own = {c: batch.column(c)[row] for c in batch.schema.names}
                ids = own["ids"].values
                blobs = {c: own[c].as_py() for c in COLUMNS[3:]}
                shard = Shard(own["names"].values.to_numpy(), own["whole"].values.to_numpy(), **blobs)
                asked = [j for j, q in enumerate(queries) if (bound := shard.bound(q)) > 0 and bound >= floors[j]]
                if not asked:
                    continue
                shard.unpack()
                rank = ranks(ids)
                found = [(j, at, score) for j in asked for at, score in shard.best(queries[j], len(ids), cluster, k, floors[j], rank)]
                of, at, score = zip(*found, strict=True) if found else ((), (), ())
                yield pa.record_batch([pa.array(of, pa.int32()), ids.take(pa.array(at, pa.int64())), pa.array(score, pa.int64())], names=["q", "id", "score"])

    return index.select(COLUMNS).mapInArrow(run, f"q int, id {kind}, score long")


def best_shards(index: DataFrame, queries: list[Query]) -> DataFrame:
    """The shards that have the greatest bound of some query, at most one a query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, names, whole in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                shard = Shard(names.values.to_numpy(), whole.values.to_numpy())
                bounds = [shard.bound(q) for q in queries]
                yield pa.record_batch([pa.array([key] * len(bounds), pa.int64()), pa.array(range(len(bounds)), pa.int32()), pa.array(bounds, pa.int64())], names=["shard", "q", "bound"])

    keyed = index.withColumn("shard", F.xxhash64("ids", "cell_start"))
    bounds = keyed.select("shard", "names", "whole").mapInArrow(run, "shard long, q int, bound long")
    top = bounds.groupBy("q").agg(F.max_by("shard", F.struct("bound", "shard")).alias("shard")).select("shard").distinct()
    return keyed.join(F.broadcast(top), "shard", "left_semi").drop("shard")


def top_k(found: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def blocks(items: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[Row]]:
    """The queries, some bytes of text at a time."""
    some, size = [], 0
    for row in items.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).toLocalIterator():
        some.append(row)
        size += len(row.text or "")
        if size >= block_bytes:
            yield some
            some, size = [], 0
    if some:
        yield some


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", shard: int = SHARD, cluster: int = CLUSTER, sample: int = SAMPLE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_col, rank, id_col and score: the k best documents of each item, those of score above 0; equal scores by ascending id, null ids last.

    Null and empty texts have no terms: such documents aren't found and count nowhere, such items find nothing. Rows that share an id are
    documents of their own, and equal items are ranked each. Other columns aren't read. Empty tables give no rows. The index holds the
    terms that the items of a block ask for; document sizes and counts are over all terms.
    """
    out = None
    for some in blocks(items, item_col, item_text, block_bytes):
        asked = [sorted(set(words_of(r.text))) for r in some]
        vocabulary = {w: i for i, w in enumerate(sorted(set().union(*asked)))}
        rows = saved(counted(docs, vocabulary, id_col, text_col), "counted")
        total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
        corpus = Corpus(*total)
        df = dict(rows.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # a row a term asked for
        numbers = [np.array([vocabulary[w] for w in words], np.int64) for words in asked]
        queries = [Query(r.item, x, np.array([corpus.weight(df.get(int(t), 0)) for t in x], np.int64)) for r, x in zip(some, numbers, strict=True)]
        led = dealt(rows, corpus.docs, len(vocabulary), shard, sample)
        index = build_index(led, corpus, cluster)
        discard(rows)
        first = top_k(searched(best_shards(index, queries), queries, cluster, k, [0] * len(queries)), k)
        floors = [0] * len(queries)
        for r in first.where(F.col("rank") == k).select("q", "score").collect():  # a row a query at most
            floors[r.q] = r.score
        found = top_k(searched(index, queries, cluster, k, floors), k)
        names = docs.sparkSession.createDataFrame([(j, q.item) for j, q in enumerate(queries)], f"q int, item {items.schema[item_col].dataType.simpleString()}")
        part = found.join(F.broadcast(names), "q").select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")
        out = part if out is None else out.unionByName(part)
    if out is None:
        schema = f"`{item_col}` {items.schema[item_col].dataType.simpleString()}, rank int, `{id_col}` {docs.schema[id_col].dataType.simpleString()}, score long"
        return docs.sparkSession.createDataFrame([], schema)
    return out


#: SQL for DuckDB: every document against every item by their terms.
ORACLE = f"""with lower as (select row_number() over () as r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}') as ws from documents),
d as (select r, doc_id, ws, len(ws) as n from lower where len(ws) > 0),
c as (select count(*)::bigint as docs, sum(n)::bigint as terms from d),
tf as (select r, term, count(*) as tf from (select r, unnest(ws) as term from d) group by r, term),
df as (select term, count(*) as df from tf group by term),
asked as (select distinct b, item_id, term from (select row_number() over () as b, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')) as term from benchmark)),
scores as (select b, item_id, r, doc_id, sum(floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::bigint * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::bigint as score
  from asked join df using (term) join tf using (term) join d using (r), c group by b, item_id, r, doc_id)
select item_id, rank, doc_id, score from (select item_id, doc_id, score, (row_number() over (partition by b order by score desc, doc_id))::int as rank from scores where score > 0) where rank <= 50"""
