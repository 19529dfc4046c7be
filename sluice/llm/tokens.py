"""Token ids by a tokenizer file of the tokenizers library, and flat binary files of them.

A token file set is a folder with, for each part, ``part-N.bin`` (the ids as flat
little-endian unsigned integers, 16 bits wide if the vocabulary allows, else 32),
``part-N.idx`` (64-bit offsets, in ids, of the documents in the part and of its
end) and ``part-N.doc`` (the 64-bit document ids). Parts and the documents in them
ascend by document id; a part's base is the sum of the ids in the parts before it.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import fresh_path, kept, parts_for, saved, trim

END_ID, KEEP = 1, 1_000_000
#: Letters that have just one form, and what may follow them as one run of punctuation.
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")
NO_ID = -(2**63)
#: A text whose ids show how a tokenizer treats white space, cases and punctuation.
PROBE = "Hello  World,\tHELLO hello! hello!?\nÉlan élan. ÀÉ (five) x's 123 a-b AbC Word;word: the  THE The, \u00df \u00c5ngstr\u00f6m"


class Encoder:
    """Encodes texts word by word and keeps what it has encoded, up to ``keep`` words; beyond, those in one slice only go first.

    Where the tokenizer treats white space as a mere separator (its normaliser and
    pre-tokeniser drop it), a text's ids are its words' ids in a row. Where it has end-of-word
    ids, makes lower case and splits letters from punctuation, new words of letters are encoded many at
    a time as one text. A probe text shows at the start which of these hold; without the first, texts are encoded whole.
    """

    def __init__(self, path: str, keep: int = KEEP) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.keep = Tokenizer.from_file(path), keep
        size = self.tokenizer.get_vocab_size()
        self.wide = size > 1 << 16
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = np.array([bool(suffix) and (self.tokenizer.id_to_token(i) or "").endswith(suffix) for i in range(size)])
        one = lambda text: self.whole([text])[0]
        words = PROBE.split()
        self.apart = one(PROBE) == list(chain.from_iterable(map(one, words)))
        plain = [m.groups() for w in words if (m := PLAIN.fullmatch(w))]
        if not all(one(core + tail) == one(core.lower()) + (one(tail) if tail else []) for core, tail in plain):
            self.ends[:] = False  # it tells cases apart, or joins letters and punctuation
        self.forget()

    def forget(self) -> None:
        """at has a word's place in begin and size, which tell where its ids are in pool."""
        self.at: dict[str, int] = {}
        self.pool, self.used = np.empty(1 << 16, np.uint32), 0
        self.begin, self.size, self.hits, self.n = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 0

    def trim(self) -> None:
        """Keeps the words that came in the most slices, half of keep at most."""
        hits, least = self.hits[: self.n], 2
        while (hits >= least).sum() > self.keep // 2:
            least += 1
        words = [w for w, i in self.at.items() if hits[i] >= least]
        places = np.array([self.at[w] for w in words], np.int64)
        ids, ends = self.take(places)
        often = hits[places] // 2
        self.forget()
        self.put(words, ids, np.diff(ends, prepend=0))
        self.hits[: self.n] = often

    def put(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Keeps words with so many of the ids each."""
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        while self.n + len(words) > len(self.begin):
            self.begin, self.size, self.hits = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.size, self.hits))
        self.pool[self.used : self.used + len(ids)] = ids
        here = slice(self.n, self.n + len(words))
        self.size[here] = sizes
        self.hits[here] = 0
        self.begin[here] = self.used + np.cumsum(sizes) - sizes
        self.at.update(zip(words, range(self.n, self.n + len(words)), strict=True))
        self.used, self.n = self.used + len(ids), self.n + len(words)

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words at these places in a row, and where each word's end there."""
        size = self.size[at]
        ends = np.cumsum(size)
        return self.pool[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.begin[at] - (ends - size), size)], ends

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [got.ids for i in range(0, len(texts), 4096) for got in self.tokenizer.encode_batch_fast(texts[i : i + 4096], add_special_tokens=False)]

    def put_whole(self, words: list[str]) -> None:
        ids = self.whole(words)
        self.put(words, np.array(list(chain.from_iterable(ids)), np.uint32), np.array(list(map(len, ids)), np.int64))

    def learn(self, new: list[str]) -> None:
        plain = [m.groups() if self.ends.any() and (m := PLAIN.fullmatch(w)) else None for w in new]
        rest = dict.fromkeys(w for w, p in zip(new, plain, strict=True) if not p)
        rest.update(dict.fromkeys(p[1] for p in plain if p and p[1]))
        self.put_whole([w for w in rest if w not in self.at])
        cores = [w for w in dict.fromkeys(p[0].lower() for p in plain if p) if w not in self.at]
        for i in range(0, len(cores), 1024):
            part = cores[i : i + 1024]
            ids = np.array(self.whole([" ".join(part)])[0], np.uint32)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(part) and ends[-1] == len(ids):
                self.put(part, ids, np.diff(ends, prepend=0))
            else:
                self.put_whole(part)
        both = []
        for w, p in zip(new, plain, strict=True):
            if p:
                core = self.at[p[0].lower()]
                if p[1]:
                    both.append((w, core, self.at[p[1]]))
                else:
                    self.at[w] = core
        if both:
            words, core, tail = zip(*both, strict=True)
            ids, ends = self.take(np.array([core, tail], np.int64).T.ravel())
            self.put(list(words), ids, np.diff(ends[1::2], prepend=0))

    def encode(self, texts: pa.Array, step: int = 1 << 17) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of the texts (null: empty), some at a time, in a row, and where each text's end there; step: words at a time."""
        if not self.apart:
            for low in range(0, len(texts), 256):
                rows = self.whole([t or "" for t in texts.slice(low, 256).to_pylist()])
                yield np.array(list(chain.from_iterable(rows)), np.uint32), np.cumsum([len(r) for r in rows])
            return
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))  # words may hold other white space, which the tokenizer sees to
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        if self.n > self.keep or self.used > 16 * self.keep:
            self.trim()
        at = list(map(self.at.get, words))
        new = [i for i, x in enumerate(at) if x is None]
        if new:
            self.learn([words[i] for i in new])
            for i in new:
                at[i] = self.at[words[i]]
        places = np.array(at, np.int64)
        self.hits[places] += 1
        if max(map(len, words), default=0) > 64:
            for word in words:
                if len(word) > 64:
                    self.at.pop(word, None)
                    self.at.pop(word.lower(), None)
        del words, at, new
        edges, indices, low = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py(), coded.indices.to_numpy(), 0
        while low < len(texts):
            high = max(low + 1, int(np.searchsorted(edges, edges[low] + step, "right")) - 1)
            ids, ends = self.take(places[indices[edges[low] : edges[high]]])
            yield ids, np.concatenate([[0], ends])[edges[low + 1 : high + 1] - edges[low]]
            low = high


def encoder(path: str, keep: int = KEEP) -> Encoder:
    """One encoder for each file and Python worker."""
    return kept(("encoder", path, keep, os.getpid()), lambda: Encoder(path, keep))


def encoded(texts: pa.Array, path: str, end_id: int | None = END_ID, keep: int = KEEP) -> Iterator[bytes]:
    """The ids of each text (null: empty) with end_id behind them, as unsigned 32-bit integers; keep: words to keep, which with the slices' size bounds the memory."""
    end, of, step_bytes = b"" if end_id is None else np.array([end_id], "<u4").tobytes(), encoder(path, keep), max(1 << 20, min(16 << 20, 18 * keep))
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy())
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + step_bytes, "right")))
        for ids, ends in of.encode(texts.slice(at, upto - at)):
            data, a = memoryview(ids.astype("<u4", copy=False)).cast("B"), 0
            for b in (ends * 4).tolist():
                yield bytes(data[a:b]) + end
                a = b
            del data, ids, ends
        trim()  # a slice's words and ids
        at = upto


def write_token_files(docs: DataFrame, tokenizer: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = END_ID, part_bytes: int = 64 << 20) -> tuple[DataFrame, str]:
    """Writes the ids of all documents; returns the manifest (part, docs, tokens, base, wide) and the folder.

    Null texts are empty documents, which hold end_id alone. Rows with one id stand
    in the order of their texts, null ids first (as the least 64-bit integer). A part is
    written under another name and moved into place, so a task that runs again leaves
    the same files. folder: a URI that pyarrow.fs knows and all executors reach.
    """
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "tokens")
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        part, offsets, ids = TaskContext.get().partitionId(), [0], []
        wide = encoder(tokenizer).wide
        fs.create_dir(root, recursive=True)
        name, attempt = f"{root}/part-{part:06d}", uuid.uuid4().hex
        with fs.open_output_stream(f"{name}.bin.{attempt}") as out:
            for batch in batches:
                ids += [NO_ID if x is None else x for x in batch.column(0).to_pylist()]
                for data in encoded(batch.column(1), tokenizer, end_id):
                    offsets.append(offsets[-1] + len(data) // 4)
                    out.write(data if wide else np.frombuffer(data, "<u4").astype("<u2").tobytes())
        for kind, rows in (("idx", offsets), ("doc", ids)):
            with fs.open_output_stream(f"{name}.{kind}.{attempt}") as out:
                out.write(np.array(rows, "<i8").tobytes())
        for kind in ("bin", "idx", "doc"):
            fs.move(f"{name}.{kind}.{attempt}", f"{name}.{kind}")
        yield pa.record_batch([[part], [len(ids)], [offsets[-1]], [wide]], names=["part", "docs", "tokens", "wide"])

    ordered = docs.repartitionByRange(parts_for(docs, "text", part_bytes), "id").sortWithinPartitions("id", "text")
    manifest = saved(ordered.mapInArrow(run, "part long, docs long, tokens long, wide boolean"), "manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    return manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0))), folder


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files; local files are memory-mapped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        local = isinstance(fs, pafs.LocalFileSystem)

        def flat(name: str, kind: str) -> np.ndarray:
            if local:
                return np.memmap(name, kind, "r") if os.path.getsize(name) else np.empty(0, kind)
            with fs.open_input_file(name) as f:
                return np.frombuffer(f.read(), kind)

        for part, base, wide in (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True)):
            name = f"{root}/part-{part:06d}"
            ids, offsets, docs = flat(f"{name}.bin", "<u4" if wide else "<u2"), flat(f"{name}.idx", "<i8"), flat(f"{name}.doc", "<i8")
            for i in range(0, len(docs), 4096):
                at = offsets[i : i + 4097]
                crcs = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                some = np.array(docs[i : i + 4096])
                yield pa.record_batch([pa.array(some, mask=some == NO_ID), pa.array(base + at[:-1]), pa.array(np.diff(at)), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    rows = manifest.where("docs > 0").select("part", "base", "wide").repartition(max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
