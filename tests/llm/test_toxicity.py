import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests.llm.conftest import SF

from sluice.llm import toxicity
from sluice.llm.queries import op1_toxicity


def distance(a, b):
    """Edits with swaps of neighbours, each letter in one edit at most."""
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            best = min(rows[i - 1][j] + 1, row[j - 1] + 1, rows[i - 1][j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, rows[i - 2][j - 2] + 1)
            row.append(best)
        rows.append(row)
    return rows[-1][-1]


TERMS = {"abcab": 4.0, "abca": 4.0, "cabbacabb": 4.0, "bbbaa": 4.0}


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="abc", max_size=11))
def test_automaton_against_distances(word):
    auto = test_automaton_against_distances.__dict__.setdefault("auto", toxicity.Automaton(TERMS, {}))
    form = toxicity.plain(word)
    near = min(((d, t) for t in auto.terms if (d := distance(form, t)) <= toxicity.edits_for(len(t))), default=None)
    found = auto.match(word)
    assert (found is None) == (near is None)
    if near:
        assert found[1] == 4.0 * (1.0, 0.8, 0.5)[near[0]]


def test_matches():
    auto = toxicity.Automaton({"idiot": 4.0, "scum": 4.0}, {"^vequ": 3.0, "=réêen": 2.0}, frozenset({"idiom"}))
    assert [auto.match(w) and auto.match(w)[0] for w in ("IDIOT!", "1d1ot", "idoit", "idiooot", "idiom", "scam", "vequille", "vequ", "réêen", "reeen")] == ["idiot", "idiot", "idiot", "idiot", None, None, "^vequ", None, "=réêen", None]


def test_quotation():
    words = 'he said that the word "you idiot" hurts him'.split()
    quoted = toxicity.quotation(words, 6)
    assert quoted > toxicity.quotation("what an idiot indeed".split(), 2) == 0.0
    assert toxicity.quotation('they said "idiot" once'.split(), 2) == 1.0


def test_texts_without_words():
    scorer = toxicity.Scorer({"idiot": 4.0}, {})
    found = list(scorer.matches(pa.array([None, "", "an idiot", " \n", "idiot"])))
    assert [len(f) for _, f in found] == [0, 0, 1, 0, 1]


def test_no_labels_is_the_prior(spark, odd):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(odd, none)
    assert (model.coefficients == toxicity.PRIOR).all()
    out = toxicity.score(odd.withColumn("toxicity", F.lit("x")), model).collect()
    assert len(out) == odd.count() and all(0 < r.toxicity < 0.5 for r in out)
    assert toxicity.score(odd.where("false"), model).count() == 0
    odd_labels = spark.createDataFrame([(0, None), (None, 1), (1, 1), (1, 1), (3, 0), (4, 7)], "doc_id long, toxic int")
    assert toxicity.score(odd, toxicity.fit(odd, odd_labels)).count() == odd.count()


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.1")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = {True: [0, 0, 0, 0], False: [0, 0, 0, 0]}
    for r in op1_toxicity(spark, sf).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1
        if r.doc_id in labels:
            got[r.held_out][2 * labels[r.doc_id] + r.predicted] += 1
    clean, false, missed, caught = got[True]
    assert caught / (caught + missed) >= 0.9 and false / (clean + false) < 0.01


def plain_score(model, text):
    """The score by a loop over all words and terms."""
    s, words = model.scorer, (text or "").split()
    uses = {}
    quoted = 0.0
    for at, word in enumerate(words):
        form, name = toxicity.plain(word), toxicity.bare(word)
        near = min(((d, t) for t in map(toxicity.plain, s.terms) if t and abs(len(t) - len(form)) <= 2 and (d := distance(form, t)) <= toxicity.edits_for(len(t))), default=None)
        weights = {toxicity.plain(t): w for t, w in s.terms.items()}
        if near and (not near[0] or form not in s.clean):
            key, weight = near[1], weights[near[1]] * (1.0, 0.8, 0.5)[near[0]]
        else:
            stems = [k for k in s.exact if k == f"={name}" or k[0] == "^" and name.startswith(k[1:]) and len(name) > len(k) - 1]
            if not stems:
                continue
            key = max(stems, key=lambda k: (k[0] == "=", len(k)))
            weight = s.exact[key]
        low = max(0, at - 16)
        quote = toxicity.quotation(words[low : at + 17], at - low)
        n, most = uses.get(key, (0.0, 0.0))
        uses[key] = (n + 1 - quote, max(most, weight))
        quoted += weight * quote
    direct = 0.0
    for key, (n, weight) in uses.items():
        usual = s.rates.get(key, 0.0) * len(words)
        direct += weight * max(0.0, n - usual - 1.5 * usual**0.5)
    z = np.dot(model.coefficients, [1, min(direct, toxicity.MOST_WEIGHT), min(quoted, toxicity.MOST_WEIGHT), np.log1p(len(words) / 100)])
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def test_scores_against_a_loop(spark, documents):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{SF.replace('0.001', '0.01')}/labels.parquet").where(~toxicity.held_out()))
    texts = [None, "", 'he said: "you idiot" and left', "1d1ot scvm !!!", "an  idoit,  a   morron"] + [t for _, t in documents if len(t.split()) < 400][:60]
    texts += [f"{t} stupid trash {t} worhtless" for t in texts[5:15]]
    got = list(model.scores(pa.array(texts, pa.string())))
    assert np.allclose(got, [plain_score(model, t) for t in texts]) and max(got) > 0.9 and min(got) < 0.1


def test_memory_bounds_change_no_score():
    words = [f"{a}{b}{c}diot scum{a}{b}" for a in "aei" for b in "xyz" for c in "ij"]
    texts = pa.array([" ".join(words[i : i + 4]) for i in range(len(words) - 3)])
    free, tight = (toxicity.Scorer({"idiot": 4.0, "scum": 4.0}, {}, keep=k, states=n) for k, n in ((10**6, 10**6), (2, 3)))
    assert list(free.matches(texts, step_bytes=8)) == list(tight.matches(texts, step_bytes=8))


def test_copies_of_one_label_count_once(spark):
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join([*base[:i], f"x{i}", *base[i + 1 :]]) for i in range(0, 200, 20)]
    rows = [(t, y) for y in (0, 1) for t in (*texts, texts[0])] + [("quite another text", 0), (None, 1)]
    got = toxicity.without_copies(spark.createDataFrame(rows, "text string, y int")).collect()
    assert sorted(r.y for r in got if r.text and "w199" in r.text) in ([0, 1], [0, 0, 1, 1]) and len(got) <= 6
