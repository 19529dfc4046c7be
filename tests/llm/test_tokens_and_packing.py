import os
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.conftest import ODD_TEXTS, SF
from tokenizers import Tokenizer

from sluice.llm import packing, tokens
from sluice.llm.queries import TOKENIZER, op7_token_files, op9_packing

whole = Tokenizer.from_file(TOKENIZER)


def ids_of(text):
    return np.array([*whole.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40), st.text(alphabet="aB.,'s1 \n\x1ćé<|endoftext|>", max_size=40)), min_size=1, max_size=5))
def test_encoder(texts):
    assert list(tokens.encoded(pa.array(texts, pa.string()), TOKENIZER)) == [ids_of(t) for t in texts]


def test_encoder_that_forgets():
    rng = random.Random(0)
    words = ["".join(rng.choices("abcdeé.,", k=rng.randint(1, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choices(words, k=200)) for _ in range(40)]
    encoder = tokens.Encoder(TOKENIZER, keep=500)
    for i in range(0, 40, 4):
        got = []
        for ids, ends in encoder.encode(pa.array(texts[i : i + 4]), step=100):
            got += [x.astype("<u4").tobytes() for x in np.split(ids, ends[:-1])]
        assert got == [ids_of(t)[:-4] for t in texts[i : i + 4]]


def cased_file(folder):
    """A tokenizer of few letters that tells cases apart, with end-of-word ids."""
    from tokenizers import models, pre_tokenizers

    letters = sorted(set("Helo Wrd,!HELLOWRDhelowrdAbcé".replace(" ", "")))
    vocab = {x: i for i, x in enumerate([*letters, *(f"{x}</w>" for x in letters), "He", "he", "lo</w>", "ld</w>", "HE"])}
    made = Tokenizer(models.BPE(vocab=vocab, merges=[("H", "e"), ("h", "e"), ("l", "o</w>"), ("l", "d</w>"), ("H", "E")], end_of_word_suffix="</w>"))
    made.pre_tokenizer = pre_tokenizers.Whitespace()
    made.save(str(folder / "cased.json"))
    return str(folder / "cased.json")


TEXTS = ["Hello World", "HELLO, hello!", "hello world", "", None, "Hello  hello\tHELLO\nhe,He", "Abc " * 300]


def test_tokenizers_of_other_kinds_give_the_ids_of_whole_texts(tmp_path):
    from sluice.llm.queries import BYTE_BPE

    for path in (cased_file(tmp_path), BYTE_BPE, TOKENIZER):
        plainly = Tokenizer.from_file(path)
        want = [np.array(plainly.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in TEXTS]
        assert list(tokens.encoded(pa.array(TEXTS, pa.string()), path, end_id=None)) == want
        tokens.encoder(path).forget()
    given = tokens.Encoder(TOKENIZER)
    assert given.apart and given.ends.any()


def test_token_files_query(spark, documents):
    at, want = 0, {}
    for i, t in documents:
        data = ids_of(t)
        want[i] = (at, len(data) // 4, zlib.crc32(data))
        at += len(data) // 4
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in op7_token_files(spark, SF).collect()} == want


def test_token_files_of_odd_rows(spark, odd):
    manifest, folder = tokens.write_token_files(odd, TOKENIZER, part_bytes=1 << 16)
    rows = sorted(tokens.read_token_files(manifest, folder).collect(), key=lambda r: r.start)
    assert len(rows) == odd.count() and [r.doc_id is None for r in rows[:2]] == [True, True]
    assert [r.doc_id for r in rows[2:]] == sorted(r.doc_id for r in rows[2:])
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))
    assert sorted(r.ids_crc32 for r in rows) == sorted(zlib.crc32(ids_of(r.text)) for r in odd.collect())
    path = folder.removeprefix("file:").replace("//", "/")
    sizes = {n: os.path.getsize(f"{path}/{n}") for n in os.listdir(path)}
    assert sum(v for n, v in sizes.items() if n.endswith(".bin")) == 2 * sum(r.n_tokens for r in rows)
    assert not [n for n in sizes if n.count(".") > 1]
    assert tokens.read_token_files(*tokens.write_token_files(odd.where("false"), TOKENIZER)).count() == 0


def check_pieces(rows, docs, capacity, ids):
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id, r.doc_tokens].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    waste = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
        waste += 0 if at & (at - 1) == 0 else capacity - at
    assert sorted(sequences) == list(range(len(sequences)))
    assert sum(r.length for r in rows) == sum(len(x) // 4 for x in ids)
    assert waste == 0
    return pieces


def test_packing_query(spark, documents):
    rows = op9_packing(spark, SF).collect()
    data = {i: ids_of(t) for i, t in documents}
    for (i, n), parts in check_pieces(rows, documents, 2048, data.values()).items():
        at = 0
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == at and zlib.crc32(data[i][4 * at : 4 * (at + r.length)]) == r.ids_crc32
            at += r.length
        assert at == n == len(data[i]) // 4


def test_packing_odd_rows(spark, odd):
    rows = packing.pack(odd, TOKENIZER, capacity=64).collect()
    check_pieces(rows, None, 64, [ids_of(r.text) for r in odd.collect()])
    long = {r.start: r for r in rows if r.doc_id == 8}
    assert sum(r.length for r in long.values()) == len(ids_of(ODD_TEXTS[8])) // 4
    assert packing.pack(odd.where("false"), TOKENIZER).count() == 0


def test_one_length_only(spark):
    """No multiset of equal lengths fills a window, so all are laid end to end and cut."""
    text = "the and of to " * 11
    n = len(ids_of(text)) // 4
    docs = spark.createDataFrame([(i, text) for i in range(300)], "doc_id long, text string")
    rows = packing.pack(docs, TOKENIZER, capacity=64).collect()
    for parts in check_pieces(rows, None, 64, [ids_of(text)] * 300).values():
        for r in parts:
            assert zlib.crc32(ids_of(text)[4 * r.start : 4 * (r.start + r.length)]) == r.ids_crc32
    assert n == 45


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(0, 3), max_size=6), st.integers(0, 20))
def test_fullest(counts, room):
    used = packing.fullest(counts, room)
    assert all(n <= counts[x] for x, n in used.items())
    sums = {0}
    for x, n in counts.items():
        sums = {s + x * k for s in sums for k in range(n + 1)}
    assert sum(x * n for x, n in used.items()) == max(s for s in sums if s <= room)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 15), st.integers(1, 40), max_size=8))
def test_plan_places_all(counts):
    plan, sequences = packing.Plan(counts, 16), defaultdict(list)
    for x, n in counts.items():
        for rank in range(n):
            parts = plan.place(x, rank)
            assert sum(p[1] for p in parts) == x and [p[0] for p in parts] == np.cumsum([0, *(p[1] for p in parts[:-1])]).tolist()
            for _, length, seq, offset in parts:
                sequences[seq].append((offset, length))
    assert sorted(sequences) == list(range(plan.sequences))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at & (at - 1) == 0


def test_wide_vocabulary_is_known():
    assert not tokens.encoder(TOKENIZER).wide
    with pytest.raises(Exception):
        tokens.Encoder("/nonexistent.json")


def test_memory_goes_back_between_slices_and_operators(monkeypatch):
    """What earlier operators left in a worker's heaps goes before an encoder is made, and what a slice took after it."""
    import pyarrow as pa

    from sluice.llm import common, tokens

    calls = []
    monkeypatch.setattr(common, "trim", lambda: calls.append("all"))
    monkeypatch.setattr(tokens, "trim", lambda: calls.append("slice"))
    common._kept.clear()
    common.release()  # nothing is kept, but heaps may be full of what was
    assert calls == ["all"]
    assert len(list(tokens.encoded(pa.array(["one two " * 100_000] * 5 + [None]), TOKENIZER, keep=1000))) == 6
    assert calls[1] == "all" and calls.count("slice") >= 3
