import hashlib
from collections import Counter, defaultdict

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.conftest import SF
from tokenizers import Tokenizer

from sluice.llm import alignment
from sluice.llm.queries import BYTE_BPE, PIECES, op12_alignment

whole_a = Tokenizer.from_file(BYTE_BPE)
whole_a.encode_special_tokens = True
whole_b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
both = alignment.Both(BYTE_BPE, PIECES)


def plain(text):
    """n_a, n_b, groups as text, and links of the whole text, by walking its bytes."""
    if not text:
        return 0, 0, "", []
    a, b = whole_a.encode(" " + text, add_special_tokens=False).ids, whole_b.encode(text)
    raw = (" " + text).encode()
    if b"".join(both.a_bytes[x] for x in a) != raw or b"".join(both.b_bytes[x] for x in b) != raw:
        return 0, 0, "", []

    def ended(ids, table):
        at, out = 0, {}
        for x in ids:
            at += len(table[x])
            out[at] = x
        return out

    a_ends, b_ends = ended(a, both.a_bytes), ended(b, both.b_bytes)
    groups, links, left, right = [], [], [], []
    for at in range(1, len(raw) + 1):
        left += [a_ends[at]] if at in a_ends else []
        right += [b_ends[at]] if at in b_ends else []
        if at in a_ends and at in b_ends:
            groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
            links.append((a_ends[at], b_ends[at]))
            left, right = [], []
    assert not left and not right
    return len(a), len(b), ";".join(groups), links


def wanted(rows):
    found = [(i, *plain(t)) for i, t in rows]
    count = Counter(link for *_, links in found for link in links)
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return [(i, n_a, n_b, len(links), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links), hashlib.sha256(groups.encode()).hexdigest() if n_a else "") for i, n_a, n_b, groups, links in found]


def test_byte_letters_are_those_of_the_file():
    letters = alignment.byte_letters()
    assert len(letters) == 256 and set(letters.values()) == set(range(256))
    assert {c for i in range(50_256) for c in whole_a.id_to_token(i)} <= set(letters)
    assert both.apart


PIECES_OF_TEXT = ["a", "word", " ", "  ", "\n", " \n", "\n ", "\t", "don't", "'s", "1234", "é", "日本語", "\U0001f600", "\xa0", "\u3000", "\x1c", "\x85", "▁", "<|endoftext|>", "<s>", "<0x41>", ".,!", "ﬁ", "İ", "\u200b", "\x00"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.lists(st.sampled_from(PIECES_OF_TEXT), max_size=12).map("".join), st.text(max_size=20)), min_size=1, max_size=4))
def test_words_give_the_tokens_of_whole_texts(texts):
    got = list(alignment.of_texts(both, alignment.kept_table(both), texts, "<u2", True))
    for (n_a, n_b, n_groups, groups, sha, link_a, link_b), text in zip(got, texts, strict=True):
        want = plain(text)
        assert (n_a, n_b, groups) == want[:3], text
        assert n_groups == len(want[3]) and sha == (hashlib.sha256(want[2].encode()).hexdigest() if want[0] else "")
        assert list(zip(alignment.np.frombuffer(link_a, "<u2").tolist(), alignment.np.frombuffer(link_b, "<u2").tolist(), strict=True)) == want[3]


def test_query(spark, documents):
    got = op12_alignment(spark, SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(wanted(documents))


@pytest.mark.parametrize("most", [alignment.MOST_PAIRS, 100])
def test_odd_rows_and_both_ways_to_count(spark, odd, most):
    more = spark.createDataFrame([(5, "two ▁ kinds"), (None, "  <|endoftext|> <s>"), (6, "and  two   spaces \n\n  here ")], "doc_id long, text string")
    rows = odd.select("doc_id", "text").union(more).withColumn("n_best", alignment.F.lit("own")).withColumn("row", alignment.F.lit(1))
    got = alignment.alignments(rows, BYTE_BPE, PIECES, keep=10, most=most, with_groups=True)
    order = lambda x: sorted(map(tuple, x), key=repr)
    assert order(r[:8] for r in got.collect()) == order(wanted([(r.doc_id, r.text) for r in rows.collect()]))
    assert {r.groups for r in got.collect()} == {plain(r.text)[2] for r in rows.collect()}
    assert alignment.alignments(rows.limit(0), BYTE_BPE, PIECES).count() == 0
