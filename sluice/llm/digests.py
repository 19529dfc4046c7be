"""Quartile bucket digests: a text's byte triplets, hashed to buckets and counted, as two bits a bucket.

A bucket's code tells which quartile of all buckets its count lies in; a byte for
the logarithm of the length stands before the codes. Triplets take bytes that lie
some way apart, since adjacent ones tell languages rather than texts.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import parts_for, saved

BUCKETS = 512
TRIPLETS = ((0, 3, 6), (0, 4, 9))
#: A difference of one, two and three quartiles counts so much.
STEPS = np.array([0, 1, 2, 6])
#: What the codes of unrelated random digests differ by on average, which is the greatest score.
BOUND = BUCKETS * (6 * 1 + 4 * 2 + 2 * 6) / 16


def counted(text: bytes) -> np.ndarray:
    """How many triplets of the text, padded by zero bytes, fall to each bucket."""
    reach = max(t[2] for t in TRIPLETS)
    a = np.frombuffer(text + bytes(reach), np.uint8).astype(np.uint32)
    n, total = len(text), np.zeros(BUCKETS, np.int64)
    if not n:
        return total
    shift = np.uint32(33 - BUCKETS.bit_length())
    for salt, (i, j, k) in enumerate(TRIPLETS):
        key = a[i : i + n] | (a[j : j + n] << np.uint32(8)) | (a[k : k + n] << np.uint32(16))
        key = (key + np.uint32(salt << 24)) * np.uint32(2654435761)
        key ^= key >> np.uint32(15)
        key *= np.uint32(2246822519)
        total += np.bincount(key >> shift, minlength=BUCKETS)
    return total


def digest(text: bytes) -> bytes:
    """A length byte (quarters of octaves), then the quartile codes, four a byte."""
    counts = counted(text)
    ranked = np.sort(counts)
    quartiles = ranked[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = np.searchsorted(quartiles, counts).astype(np.uint8).reshape(-1, 4)
    packed = codes[:, 0] << 6 | codes[:, 1] << 4 | codes[:, 2] << 2 | codes[:, 3]
    return bytes([min(255, round(4 * math.log2(len(text) + 1)))]) + packed.tobytes()


#: The difference of two bytes of codes.
PAIRS = np.array([[sum(int(STEPS[abs((a >> s & 3) - (b >> s & 3))]) for s in (0, 2, 4, 6)) for b in range(256)] for a in range(256)], np.int64)


def likeness(a: bytes, b: bytes) -> float:
    """1 less the digests' difference by its bound: 1 for equal digests, 0 where they differ as unrelated random ones do or more."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    score = int(PAIRS[x[1:], y[1:]].sum()) + min(16, abs(int(x[0]) - int(y[0]))) * BUCKETS // 256
    return 1 - min(score, BOUND) / BOUND


def edited(text: str, following: str) -> str:
    """text with its last half (rounded down) replaced by as many first characters of the following text, or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


NAMES = ["n_chars", "edited_sha256", "digest", "edited_digest", "near_edited", "near_next"]
KINDS = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
SCHEMA = "n_chars long, edited_sha256 string, digest binary, edited_digest binary, near_edited double, near_next double"


def compared(text: str, own: bytes, following: str, other: bytes) -> tuple:
    changed = edited(text, following).encode()
    new = digest(changed)
    return len(text), hashlib.sha256(changed).hexdigest(), own, new, likeness(own, new), likeness(own, other)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and digest of every row; null texts are empty ones."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array([digest(t or b"") for t in batch.column(1).cast(pa.binary()).to_pylist()], pa.binary())], names=["id", "digest"])

    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, digest binary").withColumnRenamed("id", id_col)


def with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_bytes: int = 32 << 20) -> DataFrame:
    """id_col, n_chars, edited_sha256, digest, edited_digest, near_edited, near_next of every row, with the next row by descending id.

    Null texts are empty. Rows with one id follow each other by descending text, null
    ids come last; after the last row comes the first (a lone row follows itself). An
    empty table gives no rows. Rows are dealt to ranges of ids; only a range's first and
    last row meet those of the ranges beside it, in a join over one row a range.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    order = [F.col("id").desc_nulls_last(), F.col("text").desc()]
    dealt = rows.repartitionByRange(parts_for(docs, text_col, part_bytes), order[0]).sortWithinPartitions(*order)
    id_type = pa.int64() if kind in ("bigint", "long") else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None

        def rows_of(ids: list, marks: list, texts: list, out: list[tuple], of: pa.DataType) -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 6, KINDS, strict=True)]
            n = len(ids)
            return pa.record_batch([pa.array(ids, of), pa.array([part] * n, pa.int64()), pa.array(marks, pa.string()), pa.array(texts, pa.string()), *columns], names=["id", "part", "mark", "edge", *NAMES])

        for batch in batches:
            of = id_type or batch.schema.field(0).type
            ids, out = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = digest(text.encode())
                if last is None:
                    yield rows_of([key], ["first"], [text], [(None,) * 6], of)
                else:
                    ids.append(last[0])
                    out.append(compared(last[1], last[2], text, own))
                last = key, text, own
            if ids:
                yield rows_of(ids, [None] * len(ids), [None] * len(ids), out, of)
        if last is not None:
            yield rows_of([last[0]], ["last"], [last[1]], [(None,) * 6], of)

    done = saved(dealt.mapInArrow(run, f"id {kind}, part long, mark string, edge string, {SCHEMA}"), "digests")
    firsts = done.where("mark = 'first'").select(F.col("part").alias("next_part"), F.col("edge").alias("following"))
    lasts = done.where("mark = 'last'").select("id", "part", F.col("edge").alias("text"))
    parts = lasts.select("part")  # one row a range
    ring = parts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy(F.lit(0)))).alias("next_part"))
    edges = lasts.join(ring, "part").join(firsts, "next_part").select("id", "text", "following")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [compared(a, digest(a.encode()), b, digest(b.encode())) for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 6, KINDS, strict=True)]
            yield pa.record_batch([batch.column(0), *columns], names=["id", *NAMES])

    joined = edges.mapInArrow(close, f"id {kind}, {SCHEMA}")
    return done.where("mark is null").select("id", *NAMES).unionByName(joined).withColumnRenamed("id", id_col)
