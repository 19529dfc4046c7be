"""Secret scans by a trigram inverted index of the documents.

The index holds, for each block of documents and each trigram (three bytes of UTF-8,
A-Z as a-z), which of the block's documents have it. A rule's regular expression gives
a Boolean query over trigrams that any matching text must satisfy; postings are
intersected and united block by block, and the documents left are verified by the
expression itself. Rules without mandatory trigrams are verified on every document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as op
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import discard, saved

#: A block ends at so many bytes of text or documents; positions in it have 16 bits.
BLOCK_BYTES, BLOCK_DOCS = 4 << 20, 1 << 16
#: A literal part may stand for so many strings before it is cut in two.
MOST_STRINGS = 64
#: Candidates of more bytes than this aren't broadcast.
BROADCAST_BYTES = 32 << 20


@dataclass(frozen=True)
class Rule:
    """Matches of pattern, leftmost and non-overlapping, whose group has at least so many characters; fold: ASCII letters in either case."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    fold: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.fold else 0))


ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A run of 16 or more is found as such: shorter runs would fail anyway.
BASE = (Rule("assign", ASSIGN, 12, 2, True), Rule("access", "AKIA[A-Z0-9]+", 18), Rule("hex", "[0-9a-f]{16,}"))
MORE = (
    Rule("private", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", "gh[pousr]_[0-9A-Za-z]{36,}"),
    Rule("slack", "xox[abprs]-[0-9A-Za-z-]{10,}"),
    Rule("jwt", r"eyJ[0-9A-Za-z_-]{8,}\.eyJ[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]{8,}"),
    Rule("google", "AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", "[rs]k_(?:live|test)_[0-9A-Za-z]{16,}"),
    Rule("url", r"://[^\x20\x09-\x0D/:@]+:[^\x20\x09-\x0D/@]+@"),
)
RULES = BASE + MORE

#: A query is a trigram (an int), or ("and" | "or", parts); ANY holds for every document.
Query = int | tuple
ANY: Query = ("and", frozenset())


def both(parts: list[Query]) -> Query:
    flat = frozenset(x for p in parts for x in (p[1] if isinstance(p, tuple) and p[0] == "and" else [p]))
    return next(iter(flat)) if len(flat) == 1 else ("and", flat)


def either(parts: list[Query]) -> Query:
    flat = frozenset(x for p in parts for x in (p[1] if isinstance(p, tuple) and p[0] == "or" else [p]))
    return ANY if ANY in flat else next(iter(flat)) if len(flat) == 1 else ("or", flat)


def of_string(s: bytes) -> Query:
    return both([s[i] << 16 | s[i + 1] << 8 | s[i + 2] for i in range(len(s) - 2)])


def of_strings(strings: frozenset[bytes]) -> Query:
    return either([of_string(s) for s in strings])


def folded(char: int, flags: int) -> bytes | None:
    """The bytes of a character as the index has them; None where it may match others than its own two cases."""
    c = chr(char)
    if flags & re.IGNORECASE and not flags & re.ASCII and (not c.isascii() or c.lower() in "iks"):
        return None
    return (c.lower() if c.isascii() else c).encode("utf-8", "surrogatepass")


def of_class(items: list, flags: int) -> frozenset[bytes] | None:
    chars = []
    for what, value in items:
        if what is op.LITERAL:
            chars.append(value)
        elif what is op.RANGE and value[1] - value[0] < MOST_STRINGS:
            chars += range(value[0], value[1] + 1)
        else:
            return None
    strings = frozenset(folded(c, flags) for c in chars)
    return None if None in strings or len(strings) > MOST_STRINGS // 4 else strings


def of_node(what, value, flags: int) -> tuple[frozenset[bytes] | None, Query]:
    """All strings that the node can match (None: too many to tell), and what a text must have where it matches."""
    strings, must = None, ANY
    if what is op.LITERAL:
        one = folded(value, flags)
        strings = None if one is None else frozenset([one])
    elif what is op.IN:
        strings = of_class(value, flags)
    elif what is op.SUBPATTERN:
        strings, must = of_sequence(value[3], (flags | value[1]) & ~value[2])
    elif what is op.ATOMIC_GROUP:
        strings, must = of_sequence(value, flags)
    elif what is op.BRANCH:
        parts = [of_sequence(p, flags) for p in value[1]]
        union = frozenset().union(*(s or () for s, _ in parts))
        strings = union if all(s is not None for s, _ in parts) and len(union) <= MOST_STRINGS else None
        must = either([q if s is None else of_strings(s) for s, q in parts])
    elif what in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
        low, high, part = value
        inner, need = of_sequence(part, flags)
        if inner is not None and (low, high) in ((0, 1), (1, 1)):
            strings = inner | frozenset([b""] if low == 0 else [])
        elif low:
            must = need if inner is None else of_strings(inner)
    elif what in (op.AT, op.ASSERT, op.ASSERT_NOT):
        strings = frozenset([b""])
    return strings, must


def of_sequence(nodes, flags: int) -> tuple[frozenset[bytes] | None, Query]:
    """of_node for one node after another; literal parts that touch are joined, so trigrams may span them."""
    tails, needs, exact = frozenset([b""]), [], True
    for what, value in nodes:
        strings, must = of_node(what, value, flags)
        if strings is not None and len(tails) * len(strings) <= MOST_STRINGS:
            tails = frozenset(a + b for a in tails for b in strings)
            continue
        needs += [of_strings(tails), must]
        tails, exact = frozenset([b""]) if strings is None else strings, False
    return (tails, ANY) if exact else (None, both([*needs, of_strings(tails)]))


def trigram_query(rule: Rule) -> Query:
    """What a text must have for the rule to match anywhere; ANY where no trigram is mandatory."""
    tree = parser.parse(rule.pattern, re.ASCII | (re.IGNORECASE if rule.fold else 0))
    strings, must = of_sequence(tree, tree.state.flags)
    return must if strings is None else of_strings(strings)


def wanted(query: Query) -> set[int]:
    return {query} if isinstance(query, int) else set().union(*(wanted(q) for q in query[1]))


def holds(query: Query, postings: dict[int, int], everyone: int) -> int:
    """The documents of a block that satisfy the query, as bits; postings: the bits of each trigram."""
    if isinstance(query, int):
        return postings.get(query, 0)
    kind, parts = query
    bits = everyone if kind == "and" else 0
    for part in parts:
        bits = bits & holds(part, postings, everyone) if kind == "and" else bits | holds(part, postings, everyone)
    return bits


FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def pairs_of(texts: list[bytes]) -> np.ndarray:
    """Each trigram with each text that has it, once, as trigram << 16 | position, ascending; some bytes at a time."""
    found = []
    for low in range(0, len(texts), 256):
        some = texts[low : low + 256]
        data = np.frombuffer(b"".join(some).translate(FOLD), np.uint8)
        of = np.repeat(np.arange(low, low + len(some), dtype=np.uint64), [len(t) for t in some])
        for a in range(0, max(0, len(data) - 2), BLOCK_BYTES):
            b = min(a + BLOCK_BYTES, len(data) - 2)
            own = of[a:b] == of[a + 2 : b + 2]  # not over the end of a text
            tri = data[a:b].astype(np.uint64) << np.uint64(16) | data[a + 1 : b + 1].astype(np.uint64) << np.uint64(8) | data[a + 2 : b + 2]
            found.append(np.unique((tri << np.uint64(16) | of[a:b])[own]))
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)


def block_rows(block: int, ids: pa.Array, keys: pa.Array, texts: list[bytes]) -> pa.RecordBatch:
    """A row for each trigram of the block, with its documents' positions as differences of 16 bits, and a row with the documents' ids and keys."""
    pairs = pairs_of(texts)
    tri, at = (pairs >> np.uint64(16)).astype(np.int32), (pairs & np.uint64(0xFFFF)).astype(np.uint16)
    starts = np.flatnonzero(np.diff(tri, prepend=-1))
    steps = np.diff(at, prepend=np.uint16(0)).astype("<u2")
    steps[starts] = at[starts]
    n = len(starts)
    ends = np.append(starts, len(pairs)).astype(np.int32) * 2
    postings = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(steps.tobytes())])
    listed = lambda x: pa.concat_arrays([pa.nulls(n, pa.list_(x.type)), pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)])
    columns = [pa.array([block] * (n + 1), pa.int64()), pa.array([*tri[starts].tolist(), None], pa.int32()), pa.concat_arrays([postings, pa.nulls(1, pa.binary())]), listed(ids), listed(keys)]
    return pa.record_batch(columns, names=["block", "trigram", "postings", "ids", "keys"])


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, key and text; rows with equal ids and keys count as one candidate, which the rule's expression then judges."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The trigram index of all whole texts (null: empty), written to the shared folder: block, trigram, postings, ids, keys.

    It holds every trigram, so that it serves rules that come later too.
    """
    rows = keyed(docs, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = [t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()]
            low, size = 0, 0
            for i, text in enumerate(texts):
                if i > low and (size + len(text) > BLOCK_BYTES or i - low >= BLOCK_DOCS):
                    yield block_rows(block, batch.column(0).slice(low, i - low), batch.column(1).slice(low, i - low), texts[low:i])
                    low, size, block = i, 0, block + 1
                size += len(text)
            if low < len(texts):
                yield block_rows(block, batch.column(0).slice(low), batch.column(1).slice(low), texts[low:])
                block += 1

    return saved(rows.mapInArrow(run, f"block long, trigram int, postings binary, ids array<{kind}>, keys array<long>"), "trigrams")


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """id, key and rules (their numbers) of the documents whose trigrams satisfy a rule's query, for rules that have one."""
    queries = {i: q for i, rule in enumerate(rules) if (q := trigram_query(rule)) != ANY}
    asked = sorted(set().union(*(wanted(q) for q in queries.values())))
    kind = index.schema["ids"].dataType.elementType

    def run(block: pa.Table) -> pa.Table:
        postings, ids, keys = {}, None, None
        for tri, steps, own, key in zip(*(block.column(c) for c in ("trigram", "postings", "ids", "keys")), strict=True):
            if tri.is_valid:
                bits = np.zeros(BLOCK_DOCS, np.uint8)
                bits[np.cumsum(np.frombuffer(steps.as_py(), "<u2"), dtype=np.int64)] = 1
                postings[tri.as_py()] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
            else:
                ids, keys = own.values, key.values
        everyone, at, which = (1 << len(ids)) - 1, [], []
        for i, query in queries.items():
            bits = holds(query, postings, everyone)
            here = np.flatnonzero(np.unpackbits(np.frombuffer(bits.to_bytes(-(-len(ids) // 8), "little"), np.uint8), bitorder="little"))
            at += here.tolist()
            which += [i] * len(here)
        at = pa.array(at, pa.int64())
        return pa.table([ids.take(at), keys.take(at), pa.array(which, pa.int32())], names=["id", "key", "rule"])

    needed = index.where(F.col("trigram").isin(asked) | F.col("trigram").isNull())
    found = needed.groupBy("block").applyInArrow(run, f"id {kind.simpleString()}, key long, rule int")
    return found.distinct().groupBy("id", "key").agg(F.sort_array(F.collect_set("rule")).alias("rules"))  # a set of at most len(rules)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, index: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """id_col and spans (kind, start, stop in code points, by start, then as rules are listed) of every row.

    Null texts are empty ones, which have no spans; rows that share an id, null or not, are
    judged each by its own text. An empty table gives no rows. Other columns aren't read. index: one that
    build_index made of these rows, else it is made here and removed again. Candidates are broadcast where
    they have broadcast_bytes at most, and joined by a shuffle of the documents beyond that.
    """
    rows = keyed(docs, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()
    made = build_index(docs, id_col, text_col) if index is None else None
    found = saved(candidates(made if index is None else index, rules), "candidates")
    if made is not None:
        discard(made)
    size = found.agg(F.sum(F.coalesce(F.octet_length(F.col("id").cast("string")), F.lit(0)) + 16 + 4 * F.size("rules"))).first()[0] or 0
    few = found.select(F.col("id").alias("c_id"), F.col("key").alias("c_key"), "rules")
    few = F.broadcast(few) if size <= broadcast_bytes else few.hint("shuffle_merge")
    joined = rows.join(few, F.col("id").eqNullSafe(F.col("c_id")) & (F.col("key") == F.col("c_key")), "left").select("id", "text", "rules")
    always = [i for i, rule in enumerate(rules) if trigram_query(rule) == ANY]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [rule.compiled() for rule in rules]
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            out = []
            for text, some in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                spans = []
                for i in sorted(always + (some or [])):
                    rule = rules[i]
                    spans += [(m.start(), i, m.end()) for m in compiled[i].finditer(text) if len(m[rule.group]) >= rule.least]
                out.append([{"kind": rules[i].kind, "start": a, "stop": b} for a, i, b in sorted(spans)])
            yield pa.record_batch([batch.column(0), pa.array(out, span)], names=["id", "spans"])

    return joined.mapInArrow(run, f"id {kind}, spans array<struct<kind: string, start: long, stop: long>>").withColumnRenamed("id", id_col)


def listed(spans: F.Column) -> F.Column:
    """spans as kind:start:stop, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def cased(pattern: str) -> str:
    """The pattern with [xX] for each letter outside classes and escapes: RE2's own folding also takes letters beyond ASCII for s and k."""
    return re.sub(r"\\x..|\\.|\[(?:\\.|[^\]])*\]|([a-z])", lambda m: f"[{m[1]}{m[1].upper()}]" if m[1] else m[0], pattern)


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """SQL for DuckDB: the lengths of what lies between matches, and of the matches, add up to their places."""
    parts = []
    for i, rule in enumerate(rules):
        pattern = (cased(rule.pattern) if rule.fold else rule.pattern).replace("{16,}", "+" if rule.kind == "hex" else "{16,}").replace("'", "''")
        least = 16 if rule.kind == "hex" else rule.least
        parts.append(f"""select r, {i} as o, '{rule.kind}' as kind, stop - length(m) as start, stop from (
  select r, m, g, sum(length(m) + length(s)) over (partition by r order by i) as stop from (
    select r, unnest(range(len(ms))) as i, unnest(ms) as m, unnest(gs) as g, unnest(ss[1:len(ms)]) as s from (
      select r, regexp_extract_all(text, '{pattern}') as ms, regexp_extract_all(text, '{pattern}', {rule.group}) as gs, string_split_regex(text, '{pattern}') as ss from t))) where length(g) >= {least}""")
    base = ", ".join(f"'{r.kind}'" for r in BASE)
    counts = ", ".join(f"count(*) filter (kind = '{r.kind}') as n_{r.kind}" for r in BASE)
    entry = "kind || ':' || start::varchar || ':' || stop::varchar, ',' order by start, o"
    return f"""with t as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
hits as ({" union all ".join(parts)}),
each as (select r, {counts}, string_agg({entry}) filter (kind in ({base})) as base, string_agg({entry}) as spans from hits group by r)
select doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) as n_{r.kind}" for r in BASE)}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans from t left join each using (r)"""


ORACLE = oracle()
