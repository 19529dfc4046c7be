import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.conftest import SF

from sluice.llm import substrings
from sluice.llm.queries import op8_substrings


def brute(docs, width):
    """Row number -> (words, which go)."""
    order = lambda i: (docs[i][0] is None, docs[i][0] or 0)
    words = [(t or "").encode().split() for _, t in docs]
    first = {}
    for i in sorted(range(len(docs)), key=order):
        for j in range(len(words[i]) - width + 1):
            first.setdefault(tuple(words[i][j : j + width]), order(i))
    gone = []
    for i, w in enumerate(words):
        flags = [False] * len(w)
        for j in range(len(w) - width + 1):
            if first[tuple(w[j : j + width])] < order(i):
                flags[j : j + width] = [True] * width
        gone.append(flags)
    return words, gone


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 9)), st.one_of(st.none(), st.text(alphabet="ab \n", max_size=60))), max_size=12), st.sampled_from([2, 5, 7]))
def test_against_brute_force(spark, docs, width):
    out = substrings.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string"), width=width).collect()
    words, gone = brute(docs, width)
    want = sorted(str((d[0], d[1], len(w), sum(g), b" ".join(x for x, y in zip(w, g) if not y).decode())) for d, w, g in zip(docs, words, gone))
    assert sorted(str((r.doc_id, r.text, r.n_words, r.n_removed, r.kept_text)) for r in out) == want
    for r in out:
        flags = [any(s.start <= i < s.end for s in r.removed) for i in range(r.n_words)]
        assert sum(flags) == r.n_removed


def test_query_matches_brute_force(spark, documents):
    words, gone = brute(documents, 13)
    want = {d[0]: (len(w), sum(g), hashlib.sha256(b" ".join(x for x, y in zip(w, g) if not y)).hexdigest()) for d, w, g in zip(documents, words, gone)}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in op8_substrings(spark, SF).collect()} == want
    assert sum(x[1] for x in want.values()) > 1000


@pytest.mark.parametrize("bucket", [1, 1 << 20])
def test_odd_rows(spark, odd, bucket):
    out = substrings.repeated_passages(odd, bucket_bytes=max(bucket, 1 << 14))
    rows = out.collect()
    assert len(rows) == odd.count() and set(odd.columns) <= set(out.columns)
    assert sum(r.n_removed for r in rows) == 0  # what repeats here does so within a document, or is short
    assert substrings.repeated_passages(odd.where("false")).count() == 0


def test_squeezed():
    import numpy as np

    for kind in ("<u8", "<i8", "<u4", "?"):
        x = np.arange(5).astype(kind)
        assert (substrings.unsqueezed(substrings.squeezed(x), kind) == x).all()


def folded_pair(n=10):
    """Two words of 2^n letters whose polynomial hashes modulo 2^64 are equal for any odd multiplier."""
    word = "".join("ab"[i.bit_count() & 1] for i in range(1 << n))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_words_are_compared_not_hashes(spark):
    one, other = folded_pair()
    shared = " ".join(f"w{i}" for i in range(12))
    rows = [(1, f"{shared} {one}"), (2, f"{shared} {other}"), (3, f"{shared} {other}")]
    out = {r.doc_id: (r.n_removed, r.kept_text) for r in substrings.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: (0, rows[0][1]), 2: (0, rows[1][1]), 3: (13, "")}


def test_only_the_automaton_removes():
    """Without its finds nothing goes; the passages come from shards that have other buckets' words, not positions."""
    texts, ids = [b"x a b c d y", b"a b c d", b"a b c"], [1, 2, 3]
    got = substrings.located(texts, ids, {b"a b c d": 1, b"b c d y": 9}, 3)
    assert [None if x is None else x.tolist() for x in got] == [None, [True] * 4, None]
    assert substrings.located(texts, ids, {}, 3) == [None] * 3


def test_hot_anchors_change_nothing(spark):
    """One phrase in very many different texts; all of its windows are dealt one by one, or none."""
    rows = [(i, f"u{i} v{i} w{i} " + " ".join(f"p{j}" for j in range(9)) + f" x{i % 7} y{i % 5} z{i} q{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    words, gone = brute(rows, 10)
    want = {d[0]: [i for i, g in enumerate(flags) if g] for d, flags in zip(rows, gone)}
    assert any(want.values())
    for hot in (0, 50, 1 << 30):
        out = substrings.repeated_passages(docs, width=10, bucket_bytes=2048, hot=hot).collect()
        assert {r.doc_id: [i for s in r.removed for i in range(s.start, s.end)] for r in out} == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=30), st.integers(1, 14))
def test_named(codes, width):
    import numpy as np

    got = substrings.named(np.array(codes, np.int64), width).tolist()
    whole = [tuple(codes[i : i + width]) for i in range(len(codes) - width + 1)]
    pairs = set(zip(got, whole))
    assert len(got) == len(whole) or not whole
    assert not whole or len(pairs) == len(set(got)) == len(set(whole))
