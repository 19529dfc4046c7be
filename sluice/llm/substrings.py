"""Repeated passages across documents: confirmed on their words by shards, located by sharded Aho-Corasick automata.

Documents are dealt to buckets by a hash of id and text. Within every window of
``width`` words the word sequence of ``GRAM`` words with the least hash is the
window's anchor, so equal windows have equal anchors. The steps:

1. each bucket sends its distinct anchors to shards by hash; a shard tells each
   bucket which of its anchors other documents have as well, and which are hot;
2. each bucket sends the words of the windows over such anchors to the shards, each
   distinct stretch once, with the least and the greatest id that has it there. Hot
   anchors, around which many different texts stand, are sent window by window and
   dealt by the window, so that no shard gets all of them. A shard compares the
   words themselves and finds the owner of each window: the least id of all that has it;
3. a shard sends each bucket the passages (words of adjoining windows with one owner) that some
   document there has after their owner. The bucket compiles them to an automaton over
   words with pyahocorasick and streams all of its documents through it; what it finds in a
   document after the passage's owner goes.

Hashes only nominate: two windows are one where all of their words are equal, and a
word goes only where the automaton finds a passage around it. A bucket sends a
stretch once however often it has it, so the rows for a very common one are as many as buckets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import parts_for, release

WIDTH, GRAM = 13, 5
NO_ID = 2**63 - 1  # a null id comes after all others
MULTIPLIER = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(MULTIPLIER, -1, 1 << 64)
BLANK = np.zeros(256, bool)
BLANK[[32, *range(9, 14)]] = True
U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def squeezed(x: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes(), 1)


def unsqueezed(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


class Words:
    """The words of some texts as hashes, in a row; counts has how many each text has."""

    def __init__(self, texts: list[bytes], block: int = 1 << 20) -> None:
        counts, hashes, at = [], [], 0
        while at < len(texts):
            upto, size = at, 0
            while upto < len(texts) and (upto == at or size + len(texts[upto]) < block):
                size, upto = size + len(texts[upto]), upto + 1
            some = texts[at:upto]
            raw = np.frombuffer(b" " + b" ".join(some) + b" ", np.uint8)
            blank = BLANK[raw]
            starts, ends = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1, np.flatnonzero(~blank[:-1] & blank[1:]) + 1
            powers = np.full(len(raw) + 1, MULTIPLIER, U)
            powers[0] = 1
            np.cumprod(powers, out=powers)
            total = np.concatenate([np.zeros(1, U), np.cumsum((raw.astype(U) + U(1)) * powers[:-1])])
            back = np.full(len(raw) + 1, INVERSE, U)
            back[0] = 1
            np.cumprod(back, out=back)
            hashes.append(mixed((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(U)))
            edges = np.cumsum([1, *(len(t) + 1 for t in some)])
            counts.append(np.diff(np.searchsorted(starts, edges)))
            at = upto
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, U)
        self.counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        self.ends = np.cumsum(self.counts)
        self.starts = self.ends - self.counts

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each window that lies in one text: its first word, its text, its anchor's hash; and the hashes of all GRAM-word sequences."""
        h = self.hashes
        if len(h) < width:
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(0, U), np.zeros(0, U)
        n = min(GRAM, width)
        gram = np.zeros(len(h) - n + 1, U)
        for j in range(n):
            gram = mixed(gram + h[j : len(gram) + j])
        least = gram[: len(h) - width + 1].copy()
        for j in range(1, width - n + 1):
            np.minimum(least, gram[j : j + len(least)], out=least)
        doc = np.repeat(np.arange(len(self.counts)), self.counts)
        first = np.flatnonzero(doc[: len(least)] == doc[width - 1 :])
        return first, doc[first], least[first], gram

    def keys(self, first: np.ndarray, gram: np.ndarray, width: int) -> np.ndarray:
        """48 hash bits of the windows that begin at first."""
        n = min(GRAM, width)
        key = np.full(len(first), width, U)
        for j in [*range(0, width - n, n), width - n]:
            key = mixed(key + gram[first + j])
        return key >> U(16)


ANCHOR = U((1 << 48) - 1)  # an anchor only nominates; 48 bits of it travel
HOT = 4096  # an anchor with more occurrences is sent window by window


def runs(anchor: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Where the anchor or the text changes."""
    return np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])]) if len(anchor) else np.zeros(0, np.int64)


def shard_of(x: np.ndarray, shards: int) -> np.ndarray:
    """Shards ascend with x, which has 48 bits; of the top 32."""
    return ((x >> U(16)) * U(shards)) >> U(32)


def cells(x: np.ndarray, shards: int) -> list[tuple[int, int, int]]:
    """(shard, from, to) of ascending x."""
    if not len(x):
        return []
    of = shard_of(x, shards)
    at = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    return list(zip(of[at].tolist(), at.tolist(), [*at[1:].tolist(), len(of)], strict=True))


def coded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for each word of the texts, whose words one space parts; equal numbers just for equal words. Where each text's begin and end."""
    lists = pc.split_pattern(pa.array(texts, pa.binary()).cast(pa.string()), " ")
    at = lists.offsets.to_numpy().astype(np.int64)
    codes = lists.flatten().dictionary_encode().indices.to_numpy().astype(np.int64)
    empty = np.fromiter((not t for t in texts), bool, len(texts))
    return codes, at[:-1], at[1:] - empty


def named(codes: np.ndarray, width: int) -> np.ndarray:
    """A number for the width codes from each place on; equal numbers just for equal codes. By doubling."""
    name, have = codes, 1
    while have < width and len(name):
        step = min(have, width - have)
        name = np.unique(name[: max(0, len(name) - step)] * (name.max() + 1) + name[step:], return_inverse=True)[1]
        have += step
    return name


def owned(spans: list[bytes], least: np.ndarray, greatest: np.ndarray, width: int) -> Iterator[tuple[int, bytes, int]]:
    """(span, passage, owner) of each run of windows of a span that have one owner, before the greatest id of those that have the span.

    spans are words parted by one space, least and greatest the ids of the documents that have them; a
    window's owner is the least id of all spans in which the same words stand.
    """
    codes, starts, ends = coded(spans)
    name = named(codes, width)
    sizes = np.maximum(ends - starts - width + 1, 0)
    of = np.repeat(np.arange(len(spans)), sizes)
    place = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    if not len(of):
        return
    _, which = np.unique(name[starts[of] + place], return_inverse=True)
    first = np.full(which.max() + 1, NO_ID, np.int64)
    np.minimum.at(first, which, least[of])
    owner = first[which]
    late = owner < greatest[of]
    of, place, owner = of[late], place[late], owner[late]
    if not len(of):
        return
    at = np.flatnonzero(np.r_[True, (np.diff(of) != 0) | (np.diff(place) != 1) | (np.diff(owner) != 0)])
    last, words = -1, []
    for s, a, b, o in zip(of[at].tolist(), place[at].tolist(), (place[np.r_[at[1:], len(of)] - 1] + width).tolist(), owner[at].tolist(), strict=True):
        if s != last:
            last, words = s, spans[s].split(b" ")
        yield s, b" ".join(words[a:b]), o


def located(texts: list[bytes], ids: list[int], passages: dict[bytes, int], width: int) -> list[np.ndarray | None]:
    """For each text (words parted by one space) which of its words lie in an occurrence of a passage whose owner is before its id; None for none.

    Occurrences come from an automaton over all passages (words -> owner); all texts stream through it.
    """
    if not passages:
        return [None] * len(texts)
    codes, starts, ends = coded([*texts, *passages])
    # a node looks through its branches one by one, so a word is two letters of an alphabet of its own each, which keeps branches few
    base = math.isqrt(int(codes.max())) + 1
    letters = np.column_stack([codes // base + 1, codes % base + base + 2]).astype("<u4").tobytes().decode("utf-32-le")
    automaton = ahocorasick.Automaton()
    n = len(texts)
    for a, b, owner in zip(starts[n:].tolist(), ends[n:].tolist(), passages.values(), strict=True):
        automaton.add_word(letters[2 * a : 2 * b], (b - a, owner))
    automaton.make_automaton()
    out: list[np.ndarray | None] = []
    for a, b, own_id in zip(starts[:n].tolist(), ends[:n].tolist(), ids, strict=True):
        change = None
        if b - a >= width:
            for end, (length, owner) in automaton.iter(letters[2 * a : 2 * b]):
                if owner < own_id:
                    if change is None:
                        change = [0] * (b - a + 1)
                    change[end // 2 + 1 - length] += 1
                    change[end // 2 + 1] -= 1
        out.append(None if change is None else np.cumsum(change[:-1]) > 0)
    return out


class Bucket:
    """A bucket's rows in the order of id and text, so that every step sees them alike; one space parts the words of its texts."""

    def __init__(self, rows: pa.Table, id_col: str, text_col: str) -> None:
        release()
        ids = [NO_ID if x is None else x for x in rows.column(id_col).to_pylist()]
        texts = [b" ".join(t.split()) if t else b"" for t in rows.column(text_col).cast(pa.binary()).to_pylist()]
        self.order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
        self.ids = np.array([ids[i] for i in self.order], np.int64)
        self.texts = [texts[i] for i in self.order]


def table_of(rows: list[tuple], **columns: pa.DataType) -> pa.Table:
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * len(columns), columns.values(), strict=True)], names=list(columns))


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, bucket_bytes: int = 8 << 20, hot: int = HOT) -> DataFrame:
    """All rows and columns of docs, with n_words, n_removed, removed (spans of words, end exclusive) and kept_text.

    A word goes if a window of width words covers it whose word sequence also starts in a
    document with a smaller id; kept_text has the others, joined by one space. Null
    texts have no words. Rows that share an id are one document's as far as
    owners go, so they don't remove one another's words; rows with a null id come
    after all others and remove nothing. An empty table gives no rows.
    id_col is an integer. Columns of docs that are named like those added give way to them.
    hot: occurrences above which an anchor's windows are dealt one by one; it changes no result.
    """
    docs = docs.drop("n_words", "n_removed", "removed", "kept_text")
    n = parts_for(docs, text_col, bucket_bytes)
    dealt = docs.withColumn("__bucket", F.pmod(F.xxhash64(id_col, text_col), F.lit(n)).cast("int")).repartition(n, "__bucket")

    def anchors(rows: pa.Table) -> pa.Table:
        own = Bucket(rows, id_col, text_col)
        _, doc, anchor, _ = Words(own.texts).windows(width)
        at = runs(anchor, doc)
        value, ids = anchor[at] & ANCHOR, own.ids[doc[at]]
        order = np.argsort(value, kind="stable")
        value, ids = value[order], ids[order]
        start = np.flatnonzero(np.r_[True, value[1:] != value[:-1]]) if len(value) else np.zeros(0, np.int64)
        times = np.minimum(np.diff(np.r_[start, len(value)]), (1 << 15) - 1)
        many = np.minimum.reduceat(ids, start) != np.maximum.reduceat(ids, start) if len(start) else np.zeros(0, bool)
        value, bucket, seen = value[start], rows.column("__bucket")[0].as_py(), (times * 2 + many).astype("<u2")
        out = [(s, bucket, squeezed(np.diff(value[i:j], prepend=U(0))), squeezed(seen[i:j])) for s, i, j in cells(value, n)]
        return table_of(out, __shard=pa.int32(), bucket=pa.int32(), a=pa.binary(), b=pa.binary())

    def nominate(rows: pa.Table) -> pa.Table:
        values = [np.cumsum(unsqueezed(x, "<u8"), dtype=U) for x in rows.column("a").to_pylist()]
        seen = np.concatenate([unsqueezed(x, "<u2") for x in rows.column("b").to_pylist()]).astype(np.int64)
        _, which = np.unique(np.concatenate(values), return_inverse=True)
        times, own = np.bincount(which, seen >> 1), np.bincount(which, seen & 1)
        # an anchor recurs if several buckets have it, or two documents of one
        recurs = ((np.bincount(which) > 1) | (own > 0))[which]
        marked = np.concatenate(values) << U(1) | (times > hot)[which].astype(U)
        out, at = [], 0
        for bucket, v in zip(rows.column("bucket").to_pylist(), values, strict=True):
            here = slice(at, at + len(v))
            at += len(v)
            if recurs[here].any():
                out.append((bucket, rows.column("__shard")[0].as_py(), squeezed(np.diff(marked[here][recurs[here]], prepend=U(0)))))
        return table_of(out, __bucket=pa.int32(), shard=pa.int32(), data=pa.binary())

    def claim(rows: pa.Table, known: pa.Table) -> pa.Table:
        claims: dict[int, dict[bytes, list[int]]] = {}
        if rows.num_rows and known.num_rows:
            own = Bucket(rows, id_col, text_col)
            words = Words(own.texts)
            told = sorted(zip(known.column("shard").to_pylist(), known.column("data").to_pylist(), strict=True))
            marks = np.concatenate([np.cumsum(unsqueezed(x, "<u8"), dtype=U) for _, x in told])
            recurring, is_hot = marks >> U(1), (marks & U(1)).astype(bool)
            first, doc, anchor, gram = words.windows(width)
            at = runs(anchor, doc)
            end = np.r_[at[1:], len(anchor)] - 1
            value = anchor[at] & ANCHOR
            where = np.minimum(np.searchsorted(recurring, value), len(recurring) - 1)
            hit = recurring[where] == value
            single = np.repeat(hit & is_hot[where], end - at + 1)
            cold = hit & ~is_hot[where]
            shard = np.r_[shard_of(value[cold], n), shard_of(words.keys(first[single], gram, width), n)]
            begin, last, of = np.r_[first[at[cold]], first[single]], np.r_[first[end[cold]], first[single]] + width, np.r_[doc[at[cold]], doc[single]]
            order = np.argsort(of, kind="stable")  # by document, so that ids ascend
            here, text, base = -1, [], words.starts.tolist()
            ids = own.ids.tolist()
            for s, d, a, b in zip(*(x[order].tolist() for x in (shard, of, begin, last)), strict=True):
                if d != here:
                    here, text = d, own.texts[d].split(b" ")
                got = claims.setdefault(s, {}).setdefault(b" ".join(text[a - base[d] : b - base[d]]), [ids[d], ids[d]])
                got[1] = ids[d]
        bucket = rows.column("__bucket")[0].as_py() if rows.num_rows else 0
        out = [(s, bucket, zstandard.compress(b"\n".join(c), 1), *(squeezed(np.array(x, "<i8")) for x in zip(*c.values(), strict=True))) for s, c in claims.items()]
        return table_of(out, __shard=pa.int32(), bucket=pa.int32(), spans=pa.binary(), least=pa.binary(), greatest=pa.binary())

    def confirm(rows: pa.Table) -> pa.Table:
        spans, sizes = [], []
        for x in rows.column("spans").to_pylist():
            some = zstandard.decompress(x).split(b"\n")
            spans += some
            sizes.append(len(some))
        least, greatest = (np.concatenate([unsqueezed(x, "<i8") for x in rows.column(c).to_pylist()]) for c in ("least", "greatest"))
        buckets, ends = rows.column("bucket").to_pylist(), np.cumsum(sizes)
        found: list[dict[bytes, int]] = [{} for _ in buckets]
        for span, passage, owner in owned(spans, least, greatest, width):
            found[int(np.searchsorted(ends, span, "right"))][passage] = owner
        out = [(bucket, zstandard.compress(b"\n".join(of), 1), squeezed(np.array(list(of.values()), "<i8"))) for bucket, of in zip(buckets, found, strict=True) if of]
        return table_of(out, __bucket=pa.int32(), passages=pa.binary(), owners=pa.binary())

    extra = [("n_words", pa.int64()), ("n_removed", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_text", pa.string())]

    def locate(rows: pa.Table, known: pa.Table) -> pa.Table:
        own = Bucket(rows, id_col, text_col)
        passages: dict[bytes, int] = {}
        for blob, owners in zip(known.column("passages").to_pylist(), known.column("owners").to_pylist(), strict=True):
            passages.update(zip(zstandard.decompress(blob).split(b"\n"), unsqueezed(owners, "<i8").tolist(), strict=True))
        out: list[list] = [[], [], [], []]
        for text, gone in zip(own.texts, located(own.texts, own.ids.tolist(), passages, width), strict=True):
            spans, n_words, removed = [], text.count(b" ") + bool(text), 0
            if gone is not None:
                edge = np.flatnonzero(np.diff(np.r_[0, gone.astype(np.int8), 0]))
                spans, removed = [{"start": s, "end": e} for s, e in edge.reshape(-1, 2).tolist()], int(gone.sum())
                text = b" ".join(w for w, x in zip(text.split(b" "), gone.tolist(), strict=True) if not x)
            for column, x in zip(out, (n_words, removed, spans, text.decode()), strict=True):
                column.append(x)
        base = rows.drop_columns(["__bucket"]).take(pa.array(own.order, pa.int64()))
        for (name, kind), column in zip(extra, out, strict=True):
            base = base.append_column(name, pa.array(column, kind))
        return base

    first = dealt.groupBy("__bucket").applyInArrow(anchors, "__shard int, bucket int, a binary, b binary")
    nominated = first.groupBy("__shard").applyInArrow(nominate, "__bucket int, shard int, data binary")
    claims = dealt.groupBy("__bucket").cogroup(nominated.groupBy("__bucket")).applyInArrow(claim, "__shard int, bucket int, spans binary, least binary, greatest binary")
    passages = claims.groupBy("__shard").applyInArrow(confirm, "__bucket int, passages binary, owners binary")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return dealt.groupBy("__bucket").cogroup(passages.groupBy("__bucket")).applyInArrow(locate, f"{kinds}, n_words long, n_removed long, removed array<struct<start:long,end:long>>, kept_text string")


#: What op8_substrings returns, over a view documents, by DuckDB.
ORACLE = r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
windows as (select doc_id, i, array_to_string(ws[i : i + 12], ' ') as g from (select doc_id, ws, unnest(range(1, len(ws) - 11)) as i from w)),
owners as (select g, min(doc_id) as owner from windows group by g),
gone as (select distinct doc_id, i + k as j from windows join owners using (g), (select unnest(range(13)) as k) where owner < doc_id),
each as (select doc_id, unnest(range(1, len(ws) + 1)) as j, unnest(ws) as word from w),
kept as (select e.doc_id, count(g.j) as n_removed, string_agg(case when g.j is null then word end, ' ' order by e.j) as kept from each e left join gone g on e.doc_id = g.doc_id and e.j = g.j group by e.doc_id)
select w.doc_id, len(ws)::bigint as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from w left join kept k on w.doc_id = k.doc_id
"""
