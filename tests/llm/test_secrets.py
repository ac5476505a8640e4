import hashlib
import math
import random
import re
import time

import pytest
from llm_cases import awkward, frame

from quire.llm import queries, secrets

SF_DIR = "/root/testdata/sf0.001"
PATTERNS = {
    "assign": (re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 16),
}


def plain_base(text):
    found = []
    for number, (kind, (pattern, group, least)) in enumerate(PATTERNS.items()):
        found += [(m.start(), number, kind, m.end(), m[group]) for m in pattern.finditer(text or "") if len(m[group]) >= least]
    return sorted(found)


def plain_spans(text, ratios):
    base = plain_base(text)
    rest = list(text or "")
    for start, _, _, end, _ in base:
        rest[start:end] = " " * (end - start)
    more = []
    for m in re.finditer(f"[A-Za-z0-9+/_=-]{{{secrets.LEAST_TOKEN},}}", "".join(rest)):
        pairs = list(zip(m[0], m[0][1:]))
        if all(sum(ratios[ord(a) * 128 + ord(b)] for a, b in some) >= secrets.LOG_ODDS for some in (pairs, dict.fromkeys(pairs))):
            more.append((m.start(), 3, "markov", m.end(), m[0]))
    return sorted(base + more)


def texts():
    rng = random.Random(3)
    parts = ["token = ", "Password: '", "api_key=", "ApiKey :\"", "secret", "AKIA", "🙂é", " ", "\n", "abc", "deadbeef" * 3, "=",
             "A1B2" * 5, "passwd=short ", "the quick brown", "x" * 30, "aGVsbG8gd29ybGQ+/Zm9v", "00ff" * 9, "toKen:password: abcdefghijklmnop", "ſecret=abcdefghijklmn"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(300)]
    many = "".join(f"token={rng.randrange(10**14):014d} é " for _ in range(1500))
    return [*made, many, "", None]


@pytest.fixture(scope="module")
def ratios(spark):
    return secrets.train(secrets.labelled_tokens(spark, spark.read.parquet(f"{SF_DIR}/documents.parquet")))


def test_spans_by_brute_force(spark, ratios):
    df = frame(spark, texts(), "1 AS secrets")
    found = {r.doc_id: [tuple(s) for s in r.secrets] for r in secrets.scan(df, ratios).select("doc_id", "secrets").collect()}
    for i, text in enumerate(texts()):
        assert found[i] == plain_spans(text, ratios), repr(text)[:200]


def test_masked(spark, ratios):
    df = secrets.with_masked(secrets.scan(frame(spark, texts()), ratios), out="m").select("doc_id", "m")
    for row in df.collect():
        text = texts()[row.doc_id]
        if text is None:
            assert row.m is None
            continue
        out, at = [], 0
        for start, _, _, end, _ in plain_spans(text, ratios):
            if start >= at:
                out += [text[at:start], secrets.MASK]
            at = max(at, end)
        assert row.m == "".join(out) + text[at:]


def test_rest_of_a_covered_token(spark, ratios):
    """What a fixed format leaves of a random token is judged and masked too."""
    rng = random.Random(1)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    key = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    token = "X" + key(40) + "0123456789abcdef0123" + "Z" + key(40)
    rows = secrets.with_masked(secrets.scan(frame(spark, [f"see {token} there", f"short {key(16)} key"]), ratios)).orderBy("doc_id").collect()
    assert {s.kind for s in rows[0].secrets} == {"hex", "markov"} and re.fullmatch("see (<SECRET>){3} there", rows[0].masked)
    assert rows[1].masked == "short <SECRET> key"


def test_long_texts_take_time_in_proportion(spark, ratios):
    """A token of a million characters, and a hundred thousand spans, within the time of a few tests."""
    rng = random.Random(6)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    long = "".join(rng.choices(alphabet, k=1_000_000)).replace("AKIA", "AKIB")
    many = "".join(f"token={rng.randrange(10**14):014d} é " for _ in range(100_000))
    started = time.perf_counter()
    df = secrets.with_masked(secrets.scan(frame(spark, [f"data:{long} end", many]), ratios))
    one, two = sorted(df.selectExpr("size(secrets) AS n", "secrets[0].kind AS kind", "masked").collect())
    assert time.perf_counter() - started < 90
    assert (one.n, one.kind, one.masked) == (1, "markov", "data:<SECRET> end")
    assert two.n == 100_000 and two.masked == "<SECRET> é " * 100_000


def test_awkward(spark, ratios):
    found = secrets.scan(awkward(spark), ratios)
    assert found.count() == 9 and found.columns == ["doc_id", "text", "secrets"]
    assert found.where("size(secrets) > 0").count() == 0
    assert secrets.scan(awkward(spark).limit(0), ratios).count() == 0


def test_train(spark):
    samples = spark.createDataFrame([("abab", False), ("zzzz", True), (None, True), ("q", False)], "token string, is_random boolean")
    ratios = secrets.train(samples, smoothing=0.5)
    a, b = ord("a"), ord("b")
    assert math.isclose(ratios[a * 128 + b], math.log(0.5 / 64) - math.log(2.5 / 66))
    assert secrets.train(samples.limit(0)) == [0.0] * 128 * 128


def test_held_out(ratios):
    rng = random.Random(5)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    score = lambda t: min(sum(ratios[ord(a) * 128 + ord(b)] for a, b in some) for some in (list(zip(t, t[1:])), set(zip(t, t[1:]))))
    keys = ["".join(rng.choice(alphabet) for _ in range(32)) for _ in range(500)]
    assert sum(score(k) >= secrets.LOG_ODDS for k in keys) >= 490
    assert all(score(w) < secrets.LOG_ODDS for w in ("antidisestablishmentarianism", "thingandtionedereningther", "________________________"))


def test_query(spark):
    rows = queries.registered()["op1_secret_scan"](spark, SF_DIR).collect()
    source = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert len(rows) == len(source)
    for row in rows:
        base = plain_base(source[row.doc_id])
        listed = ",".join(f"{kind}:{start}:{end}" for start, _, kind, end, _ in base)
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(b[1] == n for b in base) for n in range(3)]
        assert set(filter(None, listed.split(","))) <= set(row.spans.split(","))
