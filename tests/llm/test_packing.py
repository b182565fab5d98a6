"""Packing: exact round trip against the tokenizer, no padding, neighbours on the curve."""

from __future__ import annotations

import collections
import itertools
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tallybook.llm import packing as pk
from tallybook.llm.queries import QUERIES
from tallybook.llm.vector import slices

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", None, " ", "Hello World", "it's DON'T 12345", "<|endoftext|>x a<|startoftext|> <|endoftext|>", "a b  c\x85d\x1ce", "é ́x İI ß ﬁ",
    "日本語 text 🙂🙂", "x" * 3000, "\n\n\t y\x0b\x0c", "Σίσυφος ΟΔΟΣ", "a​b ﻿c", "word " * 5000, "가 ᆨ",
]


def flat_ids(tok, text):
    return [*tok.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, docs, tok):
    """``docs``: list of (id, text); ids may repeat."""
    want = collections.Counter((i, tuple(flat_ids(tok, t))) for i, t in docs)
    sequences, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for s in sequences.values():
        s.sort()
        assert s[0][0] == 0 and all(a + n == b for (a, n), (b, _) in itertools.pairwise(s))
        size = sum(n for _, n in s)
        assert size == 2048 or size < 2048 and size & (size - 1) == 0
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        pieces[r.doc_id].append((r.start, r.length, r.doc_tokens, bytes(r.ids)))
    got = collections.Counter()
    for i, part in pieces.items():
        at = 0
        for start, length, total, data in part:
            ids = np.frombuffer(data, dtype="<u4").tolist()
            assert len(ids) == length and start == at, (i, start, at)
            whole = ids if start == 0 else whole + ids  # noqa: F821
            at = start + length
            if at == total:
                got[i, tuple(whole)] += 1
                at = 0
        assert at == 0
    assert got == want


def test_odd_texts_copies_and_long_documents(spark):
    tok = Tokenizer.from_file(TOKENIZER)
    docs = [*enumerate(ODD), *((100 + i, "the same copy " * 30) for i in range(300)), *[(5, "one id twice")] * 3, (None, "no id"), (900, "long text. " * 60_000)]
    df = spark.createDataFrame([(i, t, 7, "x") for i, t in docs], "doc_id long, text string, start int, ids string").repartition(3)
    check(pk.pack(df, TOKENIZER).collect(), docs, tok)
    assert pk.pack(df.limit(0), TOKENIZER).count() == 0
    assert pk.pack(spark.createDataFrame([], "doc_id long, text string"), TOKENIZER).count() == 0
    one = pk.pack(spark.createDataFrame([("a", None)], "doc_id string, text string"), TOKENIZER).collect()
    assert [(r.doc_id, r.start, r.length, r.doc_tokens, r.offset) for r in one] == [("a", 0, 1, 1, 0)]


def test_other_tokenizers_take_whole_texts(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    docs = list(enumerate(ODD))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    check(pk.pack(df, path).collect(), docs, tok)


def test_registered_query(spark, sf):
    sf = sf.replace("0.001", "0.01")
    tok = Tokenizer.from_file(TOKENIZER)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op11_packing"](spark, sf).collect()
    ids = {i: flat_ids(tok, t) for i, t in docs.items()}
    at = dict.fromkeys(docs, 0)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], dtype="<u4")
        assert r.start == at[r.doc_id] and zlib.crc32(part.tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        at[r.doc_id] += r.length
    assert at == {i: len(x) for i, x in ids.items()}
    fill = collections.Counter()
    for r in rows:
        fill[r.sequence_id] += r.length
    assert sum(n == 2048 or n & (n - 1) == 0 for n in fill.values()) == len(fill)


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2), (2, 1), (1, 5)])
def test_the_curve_visits_every_cell_and_steps_to_neighbours(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    key = pk.hilbert(cells, bits)
    assert sorted(key.tolist()) == list(range(len(cells)))
    walk = cells[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_near_copies_are_near_on_the_curve(spark, sf):
    """Documents that share a language come in longer runs than by chance."""
    rows = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet").select("text", "lang").collect()
    key = np.concatenate([pk.curve_key(b, o) for _, b, o in slices(pa.array([r.text for r in rows]))])
    langs = np.array([r.lang for r in rows])[np.argsort(key, kind="stable")]
    changes = (langs[1:] != langs[:-1]).mean()
    by_chance = 1 - sum((langs == x).mean() ** 2 for x in set(langs))
    assert changes < 0.5 * by_chance, (changes, by_chance)
