"""Alignment of two tokenizers' tokens over the bytes of a text.

Tokenizer A is a file of the tokenizers library with byte-level entries, B one of the
sentencepiece library, which puts a space before the text, so A gets space + text. The
intervals of B's tokens are a static index; each A token is looked up in it by bisection
for the B tokens it overlaps, and a gap between A tokens that no B token spans ends a group.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import bounded_batches, kept, saved

#: Words that a Python worker keeps; pairs of ids that it may hold at once.
KEEP, MOST_PAIRS = 400_000, 4_000_000


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves, the others follow from U+0100 on."""
    own = [b for b in range(256) if chr(b).isprintable() and b not in (32, 160, 173)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pool:
    """The ids of words, one word after another."""

    def __init__(self) -> None:
        self.ids, self.ends, self.n = np.empty(1 << 12, np.uint32), np.zeros(1 << 10, np.int64), 0

    def put(self, ids: list[list[int]]) -> None:
        used = int(self.ends[self.n])
        flat = np.array([x for row in ids for x in row], np.uint32)
        while used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while self.n + len(ids) >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ids[used : used + len(flat)] = flat
        self.ends[self.n + 1 : self.n + len(ids) + 1] = used + np.cumsum([len(row) for row in ids])
        self.n += len(ids)

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words at these places in a row, and how many each has."""
        size = self.ends[at + 1] - self.ends[at]
        first = np.cumsum(size) - size
        return self.ids[np.arange(size.sum()) + np.repeat(self.ends[at] - first, size)], size


class Both:
    """Both tokenizers, and what they made of the words met so far (all are forgotten beyond ``keep``).

    A word is a space and what follows up to the next space behind anything but white
    space. Neither tokenizer has a token over such a place (``apart``), so a
    text's tokens are its words' tokens in a row. Where B could have one, whole texts are words.
    """

    def __init__(self, a_path: str, b_path: str, keep: int = KEEP) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b, self.keep = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path), keep
        self.a.encode_special_tokens = True
        letters = byte_letters()
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.a_bytes = [bytes(letters[c] for c in x) if all(c in letters for c in x) else x.encode() for x in names]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(m[1], 16)]) if (m := re.fullmatch("<0x([0-9A-F]{2})>", x)) else x.replace("▁", " ").encode() for x in pieces]
        self.apart = not any(re.search(r"[^\s▁]▁", x) for x in pieces) and not any(re.search(r"\S ", x.decode(errors="replace")) for x in self.a_bytes)
        self.a_size, self.b_size = (np.array([len(x) for x in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        self.wide = max(len(names), len(pieces)) > 1 << 16
        self.forget()

    def forget(self) -> None:
        self.at: dict[str, int] = {}
        self.a_pool, self.b_pool, self.exact = Pool(), Pool(), np.empty(0, bool)

    def words(self, text: str) -> list[str]:
        """The text's words without the space before each."""
        if not self.apart:
            return [text]
        parts = text.split(" ")
        if "" not in parts and not any(p[-1].isspace() for p in parts):
            return parts
        out, glue = [], False
        for p in parts:
            if glue:
                out[-1] += " " + p
            else:
                out.append(p)
            glue = not p or p[-1].isspace()
        return out

    def encode(self, words: list[str]) -> tuple[list[list[int]], list[list[int]], list[bool]]:
        """A's ids of space + word, B's of word, and whether the bytes of both are those of space + word."""
        a, b = [], []
        for i in range(0, len(words), 1024):
            some = words[i : i + 1024]
            a += [x.ids for x in self.a.encode_batch_fast([" " + w for w in some], add_special_tokens=False)]
            b += self.b.encode(some, num_threads=1)
        joined = lambda table, ids: b"".join([table[x] for x in ids])
        exact = [(raw := b" " + w.encode()) == joined(self.a_bytes, x) == joined(self.b_bytes, y) for w, x, y in zip(words, a, b, strict=True)]
        return a, b, exact

    def places(self, words: list[str]) -> np.ndarray:
        """Where the words are in the pools; new ones are encoded."""
        if len(self.at) > self.keep:
            self.forget()
        new = [w for w in dict.fromkeys(words) if w not in self.at]
        if new:
            a, b, exact = self.encode(new)
            self.at.update(zip(new, range(self.a_pool.n, self.a_pool.n + len(new)), strict=True))
            self.a_pool.put(a)
            self.b_pool.put(b)
            self.exact = np.concatenate([self.exact, np.array(exact, bool)])
        return np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))


def both(a_path: str, b_path: str, keep: int = KEEP) -> Both:
    return kept(("both", a_path, b_path, keep, os.getpid()), lambda: Both(a_path, b_path, keep))


def groups(a_size: np.ndarray, b_size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last A token and the last B token of each group; sizes: the tokens' bytes, of which both have as many."""
    a_end, b_end = np.cumsum(a_size), np.cumsum(b_size)
    low = np.searchsorted(b_end, a_end - a_size, "right")  # the first B token that ends behind A's start
    high = np.searchsorted(b_end - b_size, a_end, "left") - 1  # the last that starts before A's end
    unspanned = np.append(high[:-1] < low[1:], [True] * min(1, len(high)))
    last = np.flatnonzero(unspanned)
    return last, high[last]


def written(a: np.ndarray, b: np.ndarray, a_last: np.ndarray, b_last: np.ndarray, table: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Groups as a1,a2|b1;a3|b2,b3; for all texts, with the places behind each group. table: from ``decimals``."""
    n = table.shape[0] // 3
    a_count, b_count = np.diff(a_last, prepend=-1), np.diff(b_last, prepend=-1)
    a_mark, b_mark = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    a_mark[a_last], b_mark[b_last] = n, 2 * n
    codes = np.empty(len(a) + len(b), np.int64)
    codes[np.arange(len(a)) + np.repeat(b_last - b_count + 1, a_count)] = a + a_mark
    codes[np.arange(len(b)) + np.repeat(a_last + 1, b_count)] = b + b_mark
    letters = table[codes]
    size = np.cumsum((letters != 0).sum(axis=1))
    flat = letters.ravel()
    return flat[flat != 0].tobytes(), size, a_last + b_last + 2


def decimals(n: int) -> np.ndarray:
    """The numbers below n with a comma, then those with a bar, then with a semicolon, as rows of bytes that end in zeros."""
    width = len(str(n)) + 1
    rows = b"".join((b"%d" % i + mark).ljust(width, b"\0") for mark in (b",", b"|", b";") for i in range(n))
    return np.frombuffer(rows, np.uint8).reshape(3 * n, width)


NAMES = ["id", "row", "n_a", "n_b", "n_groups", "groups", "groups_sha256", "link_a", "link_b"]


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", keep: int = KEEP, with_groups: bool = True) -> DataFrame:
    """id, row (a number of its own), n_a, n_b, n_groups, groups, groups_sha256, and link_a and link_b: the ids of each linked pair, as binary.

    Texts that are null or empty, or whose tokens aren't the bytes of space + text, have no tokens: zeros, and empty
    strings. Rows that share an id stay rows of their own. Other columns aren't read. An empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, row = both(a_path, b_path, keep), TaskContext.get().partitionId() << 40
        table = kept_table(of)
        width = "<u4" if of.wide else "<u2"
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for low, high in slices(texts):
                out = list(of_texts(of, table, texts[low:high], width, with_groups))
                n = high - low
                rows = pa.array(range(row, row + n), pa.int64())
                row += n
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(),) * 3 + (pa.string(),) * 2 + (pa.binary(),) * 2, strict=True)]
                yield pa.record_batch([batch.column(0).slice(low, n), rows, *columns], names=NAMES)

    fields = f"id {kind}, row long, n_a long, n_b long, n_groups long, groups string, groups_sha256 string, link_a binary, link_b binary"
    return docs.select(id_col, text_col).mapInArrow(run, fields)


def kept_table(of: Both) -> np.ndarray:
    if not hasattr(of, "table"):
        of.table = decimals(max(len(of.a_bytes), len(of.b_bytes)))
    return of.table


def slices(texts: list[str | None], chars: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of texts of about so many characters."""
    low, size = 0, 0
    for i, text in enumerate(texts):
        if i > low and size + len(text or "") > chars:
            yield low, i
            low, size = i, 0
        size += len(text or "")
    if low < len(texts):
        yield low, len(texts)


def of_texts(of: Both, table: np.ndarray, texts: list[str | None], width: str, with_groups: bool) -> Iterator[tuple]:
    """n_a, n_b, n_groups, groups, their hash, and the ids of linked pairs, of each text."""
    words = [of.words(t) if t else [] for t in texts]
    count = np.array([len(w) for w in words], np.int64)
    at = of.places([x for w in words for x in w])
    doc = np.repeat(np.arange(len(texts)), count)
    for i in np.unique(doc[~of.exact[at]]).tolist():  # rare: the whole text as one word, or no tokens
        whole = of.encode([texts[i]])
        same = whole[2][0]
        if not same:
            a, b = (b"".join([t[x] for x in ids[0]]) for t, ids in ((of.a_bytes, whole[0]), (of.b_bytes, whole[1])))
            same = a == b == b" " + texts[i].encode()
        count[i] = 0
        if same:
            of.a_pool.put(whole[0])
            of.b_pool.put(whole[1])
            of.exact = np.append(of.exact, True)
            at, doc = np.append(at, of.a_pool.n - 1), np.append(doc, i + len(texts))
    keep = (count[doc % len(texts)] > 0) | (doc >= len(texts))
    at, doc = at[keep], doc[keep] % max(1, len(texts))
    order = np.argsort(doc, kind="stable")
    at, doc = at[order], doc[order]
    (a, a_words), (b, b_words) = of.a_pool.take(at), of.b_pool.take(at)
    a_last, b_last = groups(of.a_size[a], of.b_size[b])
    a_of, b_of = np.bincount(doc, a_words, len(texts)).astype(np.int64), np.bincount(doc, b_words, len(texts)).astype(np.int64)
    ends = np.cumsum(a_of)
    upto = np.searchsorted(a_last, ends, "left")  # groups before the end of each text
    data, sizes, behind = written(a, b, a_last, b_last, table)
    link_a, link_b = a[a_last].astype(width), b[b_last].astype(width)
    low = 0
    for i, high in enumerate(upto.tolist()):
        if high == low:
            yield 0, 0, 0, "" if with_groups else None, "", b"", b""
            continue
        text = data[(int(sizes[behind[low - 1] - 1]) if low else 0) : int(sizes[behind[high - 1] - 1]) - 1]
        yield int(a_of[i]), int(b_of[i]), high - low, text.decode() if with_groups else None, hashlib.sha256(text).hexdigest(), link_a[low:high].tobytes(), link_b[low:high].tobytes()
        low = high


def pair_key(a: bytes, b: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(a, kind).astype(np.int64) << 32 | np.frombuffer(b, kind).astype(np.int64)


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    unique, at = np.unique(np.concatenate(keys), return_inverse=True)
    return unique, np.bincount(at, np.concatenate(counts), len(unique)).astype(np.int64)


def pair_counts(links: DataFrame, wide: bool, most: int = MOST_PAIRS) -> DataFrame:
    """key (A's id << 32 | B's id), n (links that hold it linked), best (whether n is the highest of its B id); a task adds up before it sends, for up to ``most`` pairs at a time."""
    kind = "<u4" if wide else "<u2"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, size = [], [], 0
        for batch in batches:
            found = [pair_key(a, b, kind) for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            new = np.unique(np.concatenate(found), return_counts=True)
            keys.append(new[0])
            counts.append(new[1])
            size += len(new[0])
            if size > most:
                one, many = summed(keys, counts)
                keys, counts, size = [one], [many], len(one)
                if size > most // 2:
                    yield pa.record_batch([pa.array(one), pa.array(many)], names=["key", "n"])
                    keys, counts, size = [], [], 0
        if keys:
            one, many = summed(keys, counts)
            yield pa.record_batch([pa.array(one), pa.array(many)], names=["key", "n"])

    counted = links.select("link_a", "link_b").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    top = Window.partitionBy(F.col("key").bitwiseAND(0xFFFFFFFF))  # at most as many rows as A has ids
    return counted.withColumn("best", F.col("n") == F.max("n").over(top))


def with_counts(links: DataFrame, wide: bool, most: int = MOST_PAIRS) -> DataFrame:
    """links with n_best (its links whose pair is its B id's most frequent) and count_sum (its links' counts).

    Up to ``most`` different pairs, whose number the vocabularies bound, tasks read the table of pairs from the shared folder, 17 bytes
    a pair; beyond that each row's pairs are joined with it.
    """
    pairs = saved(pair_counts(links, wide, most), "pairs")
    kind = "<u4" if wide else "<u2"
    if pairs.count() > most:

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    key, times = np.unique(pair_key(a, b, kind), return_counts=True)
                    yield pa.record_batch([pa.array([row] * len(key), pa.int64()), pa.array(key), pa.array(times)], names=["row", "key", "times"])

        each = links.where("n_groups > 0").select("row", "link_a", "link_b").mapInArrow(spread, "row long, key long, times long").join(pairs, "key")
        sums = each.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
        return links.join(sums, "row", "left").fillna(0, ["n_best", "count_sum"])
    path, names = pairs.saved_at, [f.name for f in links.schema]

    def load() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        fs, root = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
        table = pads.dataset(root, filesystem=fs, format="parquet").to_table()
        key = table["key"].to_numpy()
        order = np.argsort(key)
        return key[order], table["n"].to_numpy()[order], table["best"].to_numpy()[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, best = kept(("pairs", path, os.getpid()), load)
        for batch in batches:
            found = [pair_key(a, b, kind) for a, b in zip(batch.column("link_a").to_pylist(), batch.column("link_b").to_pylist(), strict=True)]
            at = np.searchsorted(key, np.concatenate(found))
            ends = np.cumsum([len(x) for x in found])
            total = lambda x: np.diff(np.append(0, np.cumsum(x, dtype=np.int64))[ends], prepend=0)
            yield pa.record_batch([*batch.columns, pa.array(total(best[at])), pa.array(total(n[at]))], names=[*names, "n_best", "count_sum"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in links.schema)
    return links.mapInArrow(run, f"{fields}, n_best long, count_sum long")


def alignments(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", keep: int = KEEP, with_groups: bool = False, most: int = MOST_PAIRS) -> DataFrame:
    """id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 and, if wanted, groups of every row, as ``aligned`` and ``with_counts`` say."""
    spark = docs.sparkSession
    bounded_batches(spark, "4m")
    wide = Both(a_path, b_path).wide
    made = saved(aligned(docs, a_path, b_path, id_col, text_col, keep, with_groups), "alignment")
    out = with_counts(made, wide, most).withColumn("n_links", F.col("n_groups")).withColumnRenamed("id", id_col)
    return out.select(id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *(["groups"] if with_groups else []))
