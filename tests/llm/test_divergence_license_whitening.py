"""Source divergence, license scans and whitening against plain versions in
Python, on small made-up tables and through the registered queries."""

import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq
import pytest

from qtrail.llm import license_scan as LS
from qtrail.llm import queries as Q
from qtrail.llm import source_divergence as SD
from qtrail.llm import whitening as W
from qtrail.llm.common import ship_package

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def spark(spark):
    ship_package(spark)
    return spark


# -- source divergence -------------------------------------------------------
def terms_of(text):
    return [t.decode() for t in re.findall(rb"[a-z\x80-\xff]+", (text or "").encode().lower())]


def plain_divergence(docs, least=10, top=10):
    count, held, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in docs:
        lang, source, terms = lang or "", source or "", terms_of(text)
        groups.add((lang, source))
        count[lang, source].update(terms)
        held[lang].update(set(terms))
    out = set()
    for lang in {g for g, _ in groups}:
        kept = [t for t, n in held[lang].items() if n >= least]
        sources = [s for g, s in groups if g == lang]

        def shares(counts):
            total = sum(counts[t] for t in kept) + 2 * len(kept)
            return {t: 1 + SD.SCALE * (counts[t] + 2) // total for t in kept}

        p = {s: shares(count[lang, s]) for s in sources}
        whole = Counter()
        for s in sources:
            whole.update(count[lang, s])
        q = shares(whole)
        price = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(-sum(price(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            own = [(-price(p[s][t], q[t]), t.encode(), t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            out |= {(lang, s, "pair", o, -v, r) for r, (v, _, o) in enumerate(sorted(pairs), 1)}
            out |= {(lang, s, "term", t, -v, r) for r, (v, _, t) in enumerate(sorted(own)[:top], 1)}
    return out


def divergence(spark, docs, **more):
    df = spark.createDataFrame([(i, *d, i, "x") for i, d in enumerate(docs)],
                               "doc_id long, text string, lang string, source string, term long, n string")
    pairs, terms = SD.divergence(df, **more)
    return {(r.lang, r.source, part, r.item, r.value, r["rank"])
            for part, rows in (("pair", pairs), ("term", terms)) for r in rows.collect()}


def made_up(rng, n):
    words = [f"{a}{b}" for a in ("ab", "Éa", "日", "zz", "Q") for b in "abcdefgh"]
    return [(" ,1".join(rng.choices(words, k=rng.randrange(60))), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s2", "s2", "", "s5"]))
            for _ in range(n)]


def test_divergence_equals_a_plain_version(spark):
    docs = made_up(random.Random(1), 120)
    docs += [(None, "en", "silent"), ("", None, None), ("only here", "xx", "a"), ("only there", "xx", "b"), (None, "alone", "one")]
    docs += [("tie tie2", "en", "s1")] * 12  # repeated rows, ties
    docs += [("ab " * 40_000 + "x" * 3_000_000 + " zzb", "de", "s1")]  # long, and one long term
    assert divergence(spark, docs) == plain_divergence(docs)
    assert divergence(spark, docs, least_docs=1, top=3) == plain_divergence(docs, 1, 3)
    assert divergence(spark, docs[:0] or [("a", "b", "c")], least_docs=5) == set()
    empty = spark.createDataFrame([], "text string, lang string, source string")
    assert [x.count() for x in SD.divergence(empty)] == [0, 0]


def test_divergence_over_many_blocks(spark, monkeypatch):
    """One source holds half of the rows; blocks, chunks and flushes are small."""
    for name, value in {"GROUPS": 2, "ROWS": 40, "PAIRS": 50, "HELD": 30, "SEGMENT": 40}.items():
        monkeypatch.setattr(SD, name, value)
    rng = random.Random(2)
    docs = [(t, "en", "hot" if i % 2 else f"s{i % 14}") for i, (t, _, _) in enumerate(made_up(rng, 160))]
    assert divergence(spark, docs, least_docs=3) == plain_divergence(docs, 3)


def test_joint_tables_and_shares():
    rng = np.random.default_rng(3)
    a, b = rng.random((50, 7)) < 0.3, rng.random((50, 9)) < 0.3
    got = np.zeros((7, 9), np.int64)
    for i, j, n in SD.products(*np.nonzero(a), *np.nonzero(b), 9):
        got[i, j] += n
    assert (got == a.astype(int).T @ b.astype(int)).all()
    n = np.array([0, 5, 10**14, 3 * 10**15])
    d = np.array([2, 7, 10**15, 9 * 10**15])
    assert SD.shares(n, d).tolist() == [1 + SD.SCALE * (int(x) + 2) // int(y) for x, y in zip(n, d)]


# -- license scans -----------------------------------------------------------
def plain_base(text):
    words = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())
    places = []
    for t in LS.BASE_PHRASES:
        phrase = t.text.encode().split()
        places += [(i, t.label) for i in range(len(words)) if words[i:i + len(phrase)] == phrase]
    return len(words), sorted(places)


MIT = LS.MORE_TEMPLATES[11].text
TEXTS = [None, "", " ", "MIT License", "mit-license, MIT LICENSE mit license", "cc by", "CC BY-NC 4.0", "the Apache License, Version 2.0",
         "gnu general public license version 3", "gnu general gnu general public license", "mit licenses", "é mit license é",
         "public license gnu general", "license " * 50, "x " * 70_000 + "mit license " + "y " * 70_000 + "apache license", "a" * 2_000_000,
         "b " + MIT + " c", MIT.replace("hereby ", "").replace("Software and", "Software, its data and"), MIT[:60], "mit license " * 3000]


def test_license_scan_equals_plain_matching(spark):
    docs = spark.createDataFrame([(i, t, "s", i, "z") for i, t in enumerate([*TEXTS, "MIT License"])],
                                 "doc_id long, text string, spans string, first int, hash string")
    got = {r.doc_id: r for r in LS.scan(docs).collect()}
    for i, t in enumerate([*TEXTS, "MIT License"]):
        n, places = plain_base(t)
        assert got[i].n_words == n
        assert sorted((s.first, s.label) for s in got[i].spans if s.base) == places
    labels = {i: {s.label for s in r.spans} for i, r in got.items()}
    assert labels[6] == {"cc-by", "cc-by-nc"} and labels[7] == {"apache", "apache-2.0"} and labels[8] == {"gpl", "gpl-3"}
    # A notice is found whole, with words lost and put in, and not by its beginning.
    notice = [[s for s in got[i].spans if s.label == "mit" and not s.base] for i in (16, 17, 18)]
    assert [len(n) for n in notice] == [1, 1, 0]
    assert notice[0][0].share == 1 and 0.8 < notice[1][0].share < 1
    assert notice[0][0].first <= 1 and notice[0][0].words >= len(MIT.split())
    assert LS.scan(docs.limit(0)).count() == 0


def test_license_hashes_only_propose(spark, monkeypatch):
    """With all words hashed alike, what is proposed is still verified."""
    monkeypatch.setattr(LS, "grams", lambda words, k: np.where(np.arange(words.size) <= words.size - k, np.uint64(1), np.uint64(0)))
    rows = LS.verified(spark.createDataFrame([(0, "apache mit license", [(3, 1, 3), (1, 0, 2)])],
                                             "doc_id long, text string, spans array<struct<template:int,first:long,after:long>>"),
                       LS.TEMPLATES, "doc_id").collect()
    assert [(s.label, s.first) for s in rows[0].spans] == [("mit", 1)]
    assert LS.in_order(b"a b c d".split(), b"a x c d".split()) == 3


def test_license_template_table_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(LS, "MOST_GRAMS", 1)
    docs = spark.createDataFrame([(0, "under the mit license"), (1, "no")], "doc_id long, text string")
    assert {r.doc_id: [s.label for s in r.spans] for r in LS.scan(docs).collect()} == {0: ["mit"], 1: []}


def test_license_query_on_given_documents(spark):
    got = {r.doc_id: r for r in Q.op12_license_scan(spark, SF).collect()}
    rows = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    assert len(got) == len(rows)
    for row in rows:
        n, places = plain_base(row["text"])
        r = got[row["doc_id"]]
        assert (r.n_words, r.n_base) == (n, len(places))
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        base = sorted({label for _, label in places})
        assert r.base_labels == ",".join(base) and set(base) <= set(r.labels.split(",") if r.labels else [])
        assert r.labels == ",".join(sorted(set(r.labels.split(",")))) and 0 <= r.score <= 1 and (r.score == 1 or not places)


# -- whitening ---------------------------------------------------------------
def plain_whitening(vectors, k=8):
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    dev = [sum((n * r[j] - s[j]) ** 2 for j in range(d)) for r in x]
    mean = [Fraction(t, n) for t in s]
    z = np.array([[float(r[j] - mean[j]) for j in range(d)] for r in x])
    cov = z.T @ z / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return dev, z @ u / np.sqrt(e), e / np.trace(cov)


def whiten(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n int, d string")
    return W.whiten(df, **more)


def test_whitening_equals_a_plain_version(spark):
    rng = np.random.default_rng(5)
    base = (rng.normal(size=(300, 12)) * np.linspace(2, 0.1, 12)).astype(np.float32)
    vectors = [*base.tolist(), *base[:40].tolist()]  # repeated rows
    rows = [(i, v, 1, "x") for i, v in enumerate(vectors)]
    bad = [None, [], [None] * 12, [float("nan")] + [0.0] * 11, [float("inf")] + [0.0] * 11, [0.0] * 11 + [float("-inf")]]
    out = whiten(spark, rows + [(1000 + i, v, 1, "x") for i, v in enumerate(bad)] + [(None, vectors[0], 1, "x")])
    vectors.append(vectors[0])
    dev, white, explained = plain_whitening(vectors)
    got = out.collect()
    assert {r.component for r in got} == set(range(1, 9)) and len(got) == 8 * len(vectors)
    by = {(r.vec_id, r.component): r for r in got if r.vec_id is not None}
    assert all(by[i, 1].deviation == dev[i] and by[i, 1].n == len(vectors) for i in range(len(rows)))
    mine = np.array([[by[i, k].whitened for k in range(1, 9)] for i in range(len(rows))])
    sign = np.sign((mine * white[:-1]).sum(0))
    assert np.abs(mine * sign - white[:-1]).max() < 1e-9
    assert np.allclose([by[0, k].explained for k in range(1, 9)], explained, rtol=1e-10)
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


def test_whitening_of_flat_empty_and_mixed_tables(spark):
    assert whiten(spark, [(1, [1.0, 2.0], 0, "")] * 5).count() == 0  # no variance
    one = whiten(spark, [(i, [float(i), 3.0, 2.0 * i], 0, "") for i in range(9)])  # one direction
    assert {r.component for r in one.collect()} == {1} and one.count() == 9
    assert whiten(spark, [(1, None, 0, "")]).count() == 0
    assert whiten(spark, []).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    mixed = whiten(spark, [(i, [float(i % 3), float(i % 5)], 0, "") for i in range(30)] + [(100 + i, [float(i)], 0, "") for i in range(7)])
    sizes = Counter((r.n, r.component) for r in mixed.collect())
    assert sizes == {(30, 1): 30, (30, 2): 30, (7, 1): 7}
    with pytest.raises(Exception, match="exact products"):
        whiten(spark, [(1, [1e38, 0.0], 0, ""), (2, [0.0, 0.0], 0, "")])


def test_sums_stay_exact_past_64_bits(spark):
    rows = [(i, [float((-1) ** i * 2**18), float(i)], 0, "") for i in range(64)]
    got = {r.vec_id: r.deviation for r in whiten(spark, rows).collect()}
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v, _, _ in rows]
    s = [sum(r[j] for r in x) for j in range(2)]
    want = [sum((64 * r[j] - s[j]) ** 2 for j in range(2)) for r in x]
    assert [int(got[i]) for i in range(64)] == want and max(want) > 2**63


@pytest.mark.parametrize("matrix", [np.eye(6) * 3, np.diag([5.0, 5, 5, 2, 2, 1, 0, 0]), np.array([[0.0, 1], [1, 0]]) + np.eye(2) * 1,
                                    np.diag([1, 1 - 1e-13, 1 - 1e-9, 0.5])])
def test_components_of_equal_eigenvalues(matrix):
    e, v = W.leading_components(matrix, 8)
    want = [x for x in np.linalg.eigvalsh(matrix)[::-1][:8] if x > 1e-9]
    assert np.allclose(e, want, atol=1e-13) and np.allclose(v @ v.T, np.eye(len(e)), atol=1e-12)
    assert np.allclose(matrix @ v.T, v.T * e, atol=1e-12)


def test_inertia_counts():
    rng = np.random.default_rng(8)
    for _ in range(20):
        a = rng.normal(size=(9, 9))
        a = a + a.T
        shift = float(rng.normal())
        assert W.eigenvalues_above(a, shift) == int((np.linalg.eigvalsh(a) > shift).sum())
    assert W.eigenvalues_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1  # a 2 x 2 pivot
    assert W.eigenvalues_above(np.zeros((3, 3)), 0.0) == 0


def test_whitening_query_on_given_embeddings(spark):
    table = pq.read_table(f"{SF}/embeddings.parquet")
    dev, white, explained = plain_whitening(table.column("embedding").to_pylist())
    by = {(r.vec_id, r.component): r for r in Q.op13_whitening(spark, SF).collect()}
    ids = table.column("vec_id").to_pylist()
    assert len(by) == 8 * len(ids) and all(by[i, 1].deviation == d for i, d in zip(ids, dev))
    mine = np.array([[by[i, k].whitened for k in range(1, 9)] for i in ids])
    sign = np.sign((mine * white).sum(0))
    assert np.abs(mine * sign - white).max() < 1e-8
    assert max(r.identity_error for r in by.values()) < 1e-8
