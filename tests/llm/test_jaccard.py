"""The Jaccard join against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pandas as pd

from tallybook.llm import jaccard_join as jj


def brute(docs):
    sets = {}
    for i, t in docs.items():
        ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(ws[k : k + 5]) for k in range(max(1, len(ws) - 4))} if ws else set()
    top = {i: i for i in docs}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    ids = sorted(docs)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    top[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def check(spark, docs):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs.items()], "doc_id long, text string, n int, token string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jj.similar_documents(df).collect()}
    want = brute(docs)
    assert got == want, [(i, got.get(i), want[i]) for i in want if got.get(i) != want[i]][:5]


def test_small_cases(spark):
    check(spark, {1: None, 2: "", 3: " \n", 4: "a b", 5: "A B", 6: "a b c", 7: "a  b\tc", 8: "a a a a a a a", 9: "é É", 10: "É é", 11: "a\x1cb c d e f"})
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jj.similar_documents(empty).count() == 0


def test_random_near_copies(spark, monkeypatch):
    monkeypatch.setattr(jj, "SIDE", 8)
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(4))
    passage = [word() for _ in range(30)]
    docs, i = {}, 0
    for _ in range(12):
        base = [word() for _ in range(rng.choice([6, 20, 40, 80]))] + passage * rng.choice([0, 0, 1])
        for _ in range(rng.choice([1, 2, 5, 25])):
            ws = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                k = rng.randrange(len(ws))
                ws[k : k + rng.choice([0, 1])] = [word()]
            docs[i] = " ".join(ws)
            i += 1
    for _ in range(30):
        docs[i] = " ".join(passage + [word() for _ in range(rng.choice([1, 3, 8]))])
        i += 1
    order = list(docs.values())
    rng.shuffle(order)
    check(spark, dict(enumerate(order, 10)))


def test_corpus(spark, sf):
    rows = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text").collect()
    check(spark, {r.doc_id: r.text for r in rows})


def test_components_of_long_chains(spark):
    """A path of 1000 nodes with shuffled ids, a star, a clique and a random forest, each one component or as by hand."""
    rng = random.Random(7)
    path = rng.sample(range(100_000), 1000)
    edges = list(zip(path, path[1:]))
    edges += [(200_050, k) for k in range(200_000, 200_100) if k != 200_050]
    edges += [(a, b) for a in range(300_000, 300_020) for b in range(a) if b >= 300_000]
    edges += [(400_000 + rng.randrange(300), 400_000 + rng.randrange(300)) for _ in range(200)]
    edges = [e for e in edges if e[0] != e[1]]
    top = {}

    def root(i):
        while top.setdefault(i, i) != i:
            i = top[i]
        return i

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        top[y] = x
    got = {r.sid: r.label for r in jj.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: root(i) for i in list(top)}
    assert {got[i] for i in path} == {min(path)}
    assert jj.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shared_tokens_travel_packed():
    """Gaps and narrow counts of a range come back as they were, in fewer bytes than 8 and 4 each."""
    rng = np.random.default_rng(5)
    tokens = np.unique(rng.integers(0, 1 << 50, 5000, dtype=np.uint64))
    docs = np.zeros(len(tokens), dtype=np.uint16)
    part = pd.DataFrame({"block": ["a", "b"], "range": 0, "tokens": [jj._pack(tokens)] * 2, "docs": [docs.tobytes()] * 2})
    out = jj._shared_in_range(part)
    for t, d, c in zip(out["tokens"], out["docs"], out["df"]):
        count = len(d) // 2
        assert (jj._unpack(t, count) == tokens).all() and (jj._wide(c, count) == 2).all()
        assert len(t) < 6 * count + 8 and len(c) == count
    for most in (200, 300, 70_000):
        df = np.array([2, most])
        assert jj._wide(jj._narrow(df), 2).tolist() == [2, most]
