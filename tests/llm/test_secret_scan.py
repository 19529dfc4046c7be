import hashlib
import random
import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.conftest import SF

from sluice.llm import secret_scan
from sluice.llm.queries import op11_secrets
from sluice.llm.secret_scan import ANY, RULES, Rule

KEY = "AKIA" + "ABCDEFGH01234567"
HEX = "0123456789abcdef" * 2
SAMPLES = [f"PassWord : '{HEX}'", f'api_key="{HEX}', f"APIKEY = {KEY}", KEY, "AKIA" * 5, "AKIA" * 4 + "Z", HEX + "G" + HEX[:15], "ghp_" + "a1B" * 12, "xoxb-12345-abcdef", "eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl", "AIza" + "x" * 35, "sk_live_" + "9" * 16, "https://bob:pass@host", "-----BEGIN RSA PRIVATE KEY-----", "ſecret = abcdefghijklmnop", "token==abcdefghijkl", "secret\n= abcdefghijklmnop", "passwdpassword=abcdefghijklmnopq"]


def plain(text, rules=RULES):
    found = []
    for i, rule in enumerate(rules):
        pattern = rule.pattern.replace("{16,}", "+") if rule.kind == "hex" else rule.pattern
        for m in re.finditer(pattern, text or "", re.A | (re.I if rule.fold else 0)):
            if len(m[rule.group]) >= (16 if rule.kind == "hex" else rule.least):
                found.append((m.start(), i, rule.kind, m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


def bits_of(text):
    data = text.encode().translate(secret_scan.FOLD)
    return {data[i] << 16 | data[i + 1] << 8 | data[i + 2]: 1 for i in range(len(data) - 2)}


def test_queries_of_the_rules():
    without = [r.kind for r in RULES if secret_scan.trigram_query(r) == ANY]
    assert without == ["hex"]
    asked = secret_scan.wanted(secret_scan.trigram_query(RULES[1]))
    assert asked == {int.from_bytes(b"aki"), int.from_bytes(b"kia")}


@pytest.mark.parametrize("pattern", ["ab?c(de|fg)+h", "(foo|ba[rz])qux|zip*zap", "x{2,3}yz", "(?:abc)*def", "a[^b]cde", "(?=abc)abd", "abc|", r"\bword\b", "(a|b|c)(d|e|f)(g|h)ijk", "[a-z]+://[a-z]{2,}", "(?i:AbC)dE", "aaa(?P<n>bbb)(?P=n)"])
def test_a_match_satisfies_its_query(pattern):
    rng = random.Random(pattern)
    query = secret_scan.trigram_query(Rule("r", pattern))
    letters = sorted(set(re.sub(r"[^a-zA-Z:/]", "", pattern))) + [" "]
    hits = 0
    for _ in range(20_000):
        text = "".join(rng.choices(letters, k=rng.randint(1, 14)))
        if re.search(pattern, text, re.A):
            hits += 1
            assert secret_scan.holds(query, bits_of(text), 1) == 1, (pattern, text)
    assert hits or query != ANY


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*SAMPLES, " ", "é", "\n", '"', "日本", "K"]), max_size=6).map("".join))
def test_no_match_is_missed(text):
    for i, rule in enumerate(RULES):
        if plain(text, RULES[i : i + 1]):
            assert secret_scan.holds(secret_scan.trigram_query(rule), bits_of(text), 1) == 1, rule


def digests(text):
    spans = plain(text)
    said = lambda x: ",".join(f"{k}:{a}:{b}" for k, a, b in x)
    base = [s for s in spans if s[0] in ("assign", "access", "hex")]
    count = lambda k: sum(s[0] == k for s in spans)
    return count("assign"), count("access"), count("hex"), hashlib.sha256(said(base).encode()).hexdigest(), said(spans)


def test_query(spark, documents):
    got = {r.doc_id: tuple(r)[1:] for r in op11_secrets(spark, SF).collect()}
    assert got == {i: digests(t) for i, t in documents}


def test_sql_agrees_on_samples(spark):
    rng = random.Random(3)
    texts = [*SAMPLES, "", None, *(" ".join(rng.choices(SAMPLES, k=4)) for _ in range(30)), *("".join(rng.choices(SAMPLES, k=3)) for _ in range(30))]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", list(enumerate(texts)))
    assert {r[0]: r[1:] for r in con.sql(secret_scan.ORACLE).fetchall()} == {i: digests(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("limit", [secret_scan.BROADCAST_BYTES, 0])
def test_odd_rows(spark, odd, limit, monkeypatch):
    monkeypatch.setattr(secret_scan, "BLOCK_DOCS", 5)
    more = spark.createDataFrame([(None, SAMPLES[0]), (3, SAMPLES[1]), (3, SAMPLES[1]), (3, SAMPLES[2]), (None, None), (77, "pad " * 600_000 + SAMPLES[0] + " pad" * 600_000)], "doc_id long, text string")
    rows = odd.select("doc_id", "text").union(more).withColumn("spans", secret_scan.F.lit(1)).withColumn("key", secret_scan.F.lit("k"))
    got = secret_scan.scan(rows, broadcast_bytes=limit)
    assert got.columns == ["doc_id", "spans"]
    order = lambda x: sorted(x, key=repr)
    assert order((r.doc_id, [(s.kind, s.start, s.stop) for s in r.spans]) for r in got.collect()) == order((r.doc_id, plain(r.text)) for r in rows.collect())
    assert secret_scan.scan(rows.limit(0)).count() == 0


def test_an_index_serves_later_rules(spark, odd):
    index = secret_scan.build_index(odd)
    late = (Rule("three", "id three"), Rule("short", "ha"), Rule("none", "nowhere"))
    got = secret_scan.scan(odd, late, index=index).where("size(spans) > 0").collect()
    assert sorted((r.doc_id is None, r.spans[0].kind) for r in got) == sorted((r.doc_id is None, k) for r in odd.collect() for k, *_ in plain(r.text, late)[:1])
    assert {tuple(r.rules) for r in secret_scan.candidates(index, late).collect()} == {(0,)}
