"""Secret scans, whitening and spelling variants against plain versions and by hand."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tertulia.llm import secrets, spelling, whitening
from tests.llm import brute

ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def plain_base(text):
    """The base spans, by the scanner of the standard library."""
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    spans = [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]
    return (*(sum(f[2] == k for f in found) for k in ("assign", "access", "hex")), hashlib.sha256(",".join(spans).encode()).hexdigest())


def texts_with_parts(n=150):
    """Texts strung together from parts, near misses, empty lines and letters beyond the basic plane."""
    r = random.Random(5)
    parts = ["password = hunter2hunter", "passwd:'short'", "TOKEN==abc", 'api_key="%s"' % ("k" * 12), "apikey: x", "AKIA" + "Q1" * 8, "AKIAQ1", "AKIA" * 5,
             "0f" * 16, "0f" * 15, "secret:secret=abcdefgh", "user=ann", "user_id: bo7", "pwd = 1234", "mail x.y@z.example", "https://h.example/a?b=c",
             "db://u:pw@h.example/x", "Zx9" * 9, "\n", "\n\n", "\n \t\n", "word " * 30, "é𝒳ñ", " ", "'", '"']
    texts = ["".join(r.choice(parts) + r.choice(["", " ", "\n"]) for _ in range(r.randint(0, 25))) for _ in range(n)]
    return [None, "", *texts]


def frame(spark, texts, schema="doc_id long, text string, kind int, row string, parts string"):
    return spark.createDataFrame([(k, t, 1, "r", "p") for k, t in enumerate(texts)], schema)


def test_base_spans_equal_the_plain_scanner(spark):
    texts = texts_with_parts()
    got = {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in secrets.op11(frame(spark, texts)).collect()}
    assert got == {k: plain_base(t) for k, t in enumerate(texts)}


def test_parts_link_as_pairwise_sql_says(spark):
    duckdb = pytest.importorskip("duckdb")
    texts = texts_with_parts(300)
    con = duckdb.connect()
    con.register("documents", frame(spark, texts).select("doc_id", "text").toPandas())
    rows = secrets.op11(frame(spark, texts)).collect()
    assert sorted(map(tuple, rows)) == sorted(con.execute(secrets.oracle()).fetchall())
    assert any("token" in r.spans for r in rows) and any("endpoint" in r.spans for r in rows)


def spans_of(spark, text):
    return [(s["kind"], text[s["start"]: s["end"]]) for s in secrets.secrets(frame(spark, [text])).first()["spans"]]


@pytest.mark.parametrize(("text", "spans"), [
    ("user=ann pwd = 1234", [("ident", "user=ann"), ("secret", "pwd = 1234")]),
    ("user=ann\npwd = 1234", [("ident", "user=ann"), ("secret", "pwd = 1234")]),
    ("user=ann\n\npwd = 1234", []),  # another scope
    ("user=ann" + " x" * 120 + " pwd = 1234", []),  # out of reach
    ("user=ann and nothing else", []), ("pwd = 1234", []), ("Zx9Zx9Zx9Zx9Zx9Zx9Zx9", []),
    ("AKIAQ1Q1Q1Q1Q1Q1 with Zx9Zx9Zx9Zx9Zx9Zx9Zx9", [("access", "AKIAQ1Q1Q1Q1Q1Q1"), ("token", "Zx9Zx9Zx9Zx9Zx9Zx9Zx9")]),
    ("see https://h.example/a for user=ann pwd=1234", [("endpoint", "https://h.example/a"), ("ident", "user=ann"), ("secret", "pwd=1234")]),
    ("db://u:pw@h.example/x", [("endpoint", "db://u:pw@h.example/x")]),
    ("password = hunter2hunter", [("assign", "password = hunter2hunter")]),  # the weak secret there is no second one
])
def test_weak_parts_need_their_complement(spark, text, spans):
    assert spans_of(spark, text) == spans


def test_secrets_in_odd_tables(spark):
    same = spark.createDataFrame([(1, "user=a1b pwd=1234"), (1, "nothing"), (None, "token: abcdefgh"), (None, None)], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_assign, r.spans) for r in secrets.op11(same).collect())
    assert got == [("1", 0, ""), ("1", 0, "ident:0:8,secret:9:17"), ("None", 0, ""), ("None", 1, "assign:0:15")]
    many = " user=ann pwd = 1234\n" * 4000 + "x" * 300_000
    assert len(secrets.secrets(frame(spark, [many])).first()["spans"]) == 8000
    assert secrets.op11(frame(spark, [])).count() == 0


def plain_whitened(vectors, top=8):
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(0)
    y = x - sums / n
    values, directions = np.linalg.eigh(y.T @ y / n)
    values, directions = values[::-1], directions[:, ::-1]
    return ((n * x - sums) ** 2).sum(1), y @ directions[:, :top] / np.sqrt(values[:top]), values[:top] / values.sum()


def test_whitening_equals_a_dense_solver(spark):
    r = np.random.default_rng(2)
    turn = r.normal(size=(20, 20)) * np.linspace(3, 0.05, 20)
    vectors = (r.normal(size=(700, 20)) @ turn.T + r.normal(size=20)).astype(np.float32)
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    bad = [(9001, None), (9002, [None] + [1.0] * 19), (9003, [float("nan")] * 20), (9004, [float("inf")] * 20), (9005, [1.0, 2.0]), (9006, [])]
    out = whitening.op12(spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").repartition(5)).collect()
    deviation, coordinates, shares = plain_whitened(vectors)
    assert len(out) == 8 * len(vectors) and {x.n for x in out} == {len(vectors)}
    got = np.zeros_like(coordinates)
    for x in out:
        got[x.vec_id, x.component - 1] = x.whitened
        assert x.deviation == deviation[x.vec_id]
        assert abs(x.explained / shares[x.component - 1] - 1) < 1e-9 and 0 <= x.identity_error < 1e-9
    assert np.abs(got * np.sign((got * coordinates).sum(0)) - coordinates).max() < 1e-8


def test_factors_of_odd_matrices():
    r = np.random.default_rng(4)
    for d in (1, 2, 3, 7, 16):
        a = r.normal(size=(d, d + 2))
        values, vectors = whitening.principal(a @ a.T)
        assert np.allclose(vectors @ np.diag(values) @ vectors.T, a @ a.T) and np.allclose(vectors.T @ vectors, np.eye(d))
        assert list(values) == sorted(values, reverse=True)
    thin = r.normal(size=(6, 2))
    factor, order = whitening.pivoted_cholesky(thin @ thin.T)
    assert factor.shape == (6, 2) and np.allclose((factor @ factor.T), (thin @ thin.T)[order][:, order])
    assert whitening.principal(np.zeros((3, 3)))[0].size == 0


def test_whitening_of_odd_tables(spark):
    schema = "vec_id long, embedding array<double>, key string, vector int"
    table = lambda rows: spark.createDataFrame([(*r, "k", 1) for r in rows], schema)
    for rows in ([], [(1, None)], [(1, [])], [(1, [0.5, 0.5])], [(1, [0.5, 0.5])] * 9):
        assert whitening.op12(table(rows)).count() == 0
    rows = [(None, [1.0, 2.0]), (None, [3.0, 1.0]), (1, [3.0, 1.0]), (1, [1e300, -1e300])]
    out = whitening.op12(table(rows)).collect()
    assert len(out) == 4 and {x.deviation for x in out} == {None}  # rank 1, beyond a long
    # A column that repeats another leaves one direction without variance, which is left out.
    flat = [(k, [k / 7, k / 7, (k * k % 11) / 3]) for k in range(40)]
    assert {x.component for x in whitening.op12(table(flat)).collect()} == {1, 2}


def plain_words(docs):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(brute.TO_LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(counts):
    others = {w: [v for v in counts if near(w, v)] for w in counts}
    best = {w: min(v, key=lambda x: (-counts[x], x), default=None) for w, v in others.items()}
    form = {w: b if b and counts[b] >= 5 * counts[w] else None for w, b in best.items()}
    out = {}
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(others[w]), counts[form[w]] if form[w] else None)
    return out


def found(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_variants_equal_brute_force(spark):
    """Few letters, so that words are near in every way, runs of equal letters included."""
    r = random.Random(8)
    words = {"".join(r.choice("aab") for _ in range(r.randint(6, 9))) for _ in range(250)} | {"straße", "strasse", "Élèves", "élèves", "aaaaaa", "aaaaaaa", "a" * 400}
    docs = [(k, " ".join(r.choice(sorted(words)[: 5 + k]) for _ in range(60)) + (" " + "a" * 400 + "é" * 6) * 3) for k in range(120)]
    docs += [(None, docs[0][1]), (7, docs[0][1]), (3, None), (4, "")]
    out = found(spelling.op13(spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, word string, n int").repartition(3)))
    assert out == plain_variants(plain_words(docs))


def test_roots_follow_long_chains(spark):
    letters = "abcdefghij"
    counts = {"x" * 6 + letters[:k] + "y" * (10 - k): 5 ** (k + 1) for k in range(11)}
    out = found(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert out == plain_variants(counts)
    assert {v[1] for v in out.values()} == {"x" * 6 + letters}


def test_ties_go_to_the_smallest_word(spark):
    counts = {"abcdef": 5, "abcdeg": 25, "abcdeh": 25, "ábcdef": 24, "zzzzzz": 5}
    assert found(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long"))) == plain_variants(counts)
    assert spelling.variants(spark.createDataFrame([], "word string, n long")).count() == 0
    assert spelling.op13(spark.createDataFrame([], "doc_id long, text string")).count() == 0
