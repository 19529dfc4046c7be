import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import SF
from tests.llm.test_simhash import classes
from tests.llm.test_substrings import brute
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from sluice.llm import mixing, toxicity
from sluice.llm.queries import TOKENIZER


def near_copies(docs):
    """Ids that stay, by all pairs."""
    sets = {}
    for r in docs:
        w = (r.text or "").encode().lower().split()
        sets[r.doc_id] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))}
    links = [(a, b) for a in sets for b in sets if b < a and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    return {i for i, r in classes(sorted(sets), links).items() if i == r}


def cut(docs):
    words, gone = brute([(r.doc_id, r.text) for r in docs], 13)
    out = {}
    for r, w, g in zip(docs, words, gone):
        if not sum(g):
            out[r.doc_id] = r.text
        elif sum(g) < len(w):
            out[r.doc_id] = b" ".join(x for x, y in zip(w, g) if not y).decode()
    return out


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, docs.collect()
    labels = dict(duckdb.sql(f"select doc_id, toxic from '{SF}/labels.parquet'").fetchall())
    stages = dict(corpus_pipeline.STAGES)
    kinds = docs.schema

    def after(name):
        out = stages[name](spark, spark.createDataFrame(rows, kinds), SF)
        assert out.columns == columns and out.schema["n_chars"].dataType == kinds["n_chars"].dataType
        return out.collect()

    got = after("toxicity")
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet").where(~toxicity.held_out()))
    import pyarrow as pa

    one_by_one = {r.doc_id for r in rows if next(model.scores(pa.array([r.text]))) < 0.7}
    assert {r.doc_id for r in got} == one_by_one
    gone = [labels[r.doc_id] for r in rows if r.doc_id not in one_by_one and r.doc_id in labels]
    assert sum(gone) >= 5 and all(gone)
    rows = got

    got = after("near_copies")
    assert len(got) == len({r.doc_id for r in got}) < len(rows) and {r.doc_id for r in got} == near_copies(rows)
    rows = got

    got = after("repeated_passages")
    assert {r.doc_id: r.text for r in got} == cut(rows) and all(len(r.text) == r.n_chars for r in got)
    rows = got

    got = after("mixing")
    con = duckdb.connect()
    documents = spark.createDataFrame(rows, kinds).toPandas()
    con.register("documents", documents)
    sizes = {r.doc_id: len(r.text.encode().split()) for r in rows}
    want = {i: taken // sizes[i] for i, taken in con.sql(f"select doc_id, taken from ({mixing.ORACLE})").fetchall() if sizes[i]}
    assert {i: n for i, n in Counter(r.doc_id for r in got).items() if sizes[i]} == {i: n for i, n in want.items() if n}
    rows = got

    pieces = stages["packing"](spark, spark.createDataFrame(rows, kinds), SF).collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    ids = {r.doc_id: np.array([*tokenizer.encode(r.text, add_special_tokens=False).ids, 1], "<u4") for r in rows}
    times = Counter(r.doc_id for r in rows)
    covered, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.doc_tokens == len(ids[p.doc_id]) and p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start : p.start + p.length].tobytes())
        covered[p.doc_id] += range(p.start, p.start + p.length)
        sequences[p.sequence_id].append((p.offset, p.length))
    assert {i: Counter(x) for i, x in covered.items()} == {i: Counter({k: n for k in range(len(ids[i]))}) for i, n in times.items()}
    for of in sequences.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(of), [*sorted(of)[1:], (sum(n for _, n in of), 0)])) and sum(n for _, n in of) <= 2048


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:4]])
def test_odd_rows(spark, odd, name):
    """Nulls, empties, ties, repeats, and columns that operators add themselves, which keep their values."""
    stage = dict(corpus_pipeline.STAGES)[name]
    extra = odd.withColumns({"n_words": F.lit("mine"), "mix_size": F.lit(7), "score": F.lit("s"), "a.b": F.lit("dot")})
    own = [c for c in extra.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
    values = {tuple(r[c] for c in own) for r in extra.select([f"`{c}`" for c in extra.columns]).collect()}
    before = Counter((r.doc_id, r.text) for r in extra.collect())
    out = stage(spark, extra, SF)
    assert out.columns == extra.columns and out.schema["target"].dataType == extra.schema["target"].dataType
    rows = out.collect()
    assert {tuple(r[c] for c in own) for r in rows} <= values and {(r.doc_id, r.text) for r in rows} <= set(before)
    if name in ("toxicity", "repeated_passages"):
        assert Counter((r.doc_id, r.text) for r in rows) == before  # nothing here is toxic, and what repeats is short
        assert {r.n_chars for r in rows} == {r.n_chars for r in extra.collect()}
    assert stage(spark, extra.drop("n_chars", "lang"), SF).count() == len(rows)
    assert stage(spark, extra.where("false"), SF).count() == 0


def test_odd_rows_packed(spark, odd):
    pieces = corpus_pipeline.pack_windows(spark, odd, SF).collect()
    assert Counter(p.doc_id for p in pieces if p.start + p.length == p.doc_tokens) == Counter(r.doc_id for r in odd.collect())
    assert corpus_pipeline.pack_windows(spark, odd.where("false"), SF).count() == 0


def test_registered(spark):
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert names["pipeline"](spark, SF).count() > 0
