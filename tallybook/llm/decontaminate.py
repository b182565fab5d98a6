"""Benchmark decontamination: latent semantic retrieval, then word order and answer checks.

Words are coded once (32 bits each, without case and outer punctuation); all passes work on the codes.

1. How often each hashed term comes in all documents is counted in one pass; it gives the inverse passage frequencies.
2. Randomised SVD of the TF-IDF matrix of all passages (``PASSAGE`` words each): two passes multiply it, block by block, with a thin matrix
   and its transpose; the products of the tasks are summed as a tree.  The first one finds the range, the second one the singular vectors in it.
   A term's latent vector is its row, weighted and whitened, ``RANK`` numbers.
3. A window's vector is a difference of running sums.  Items of like lengths share windows, ``WIDER`` times as long as the longest and one from every
   half of the shortest; those whose cosine with the item is ``GATE`` or more are candidates.  The gate is low: it is set by planted copies with up to 40% of the words changed, or half as many
   words put in, of which it lets more than 95% through (measured in the tests against brute force over all windows).
   Items of fewer than ``SHORT`` words say too little for a direction; for them every window is a candidate.
4. A candidate goes on if its surroundings have enough of the item's rare terms, an exact bound: an item's terms are split into frequent and
   rare ones, where the split tells most; at most all its frequent words can be matched, so ``ORDER`` of its words need a known number of rare ones.
5. It is a leak if a window of twice the item's length has ``ORDER`` of the item's words in order (longest common subsequence)
   and, where the item has an answer, at least ``ANSWER`` of the answer's words come there in order.  Items without an answer (no
   answer column, or NULL) are judged by their words alone.

Windows cover whole texts.  Items are a stated query set; they are taken in blocks of at most ``BLOCK`` items, one search per block, so
what a search broadcasts is bounded whatever the size of the benchmark.

Cases: NULL and empty texts or items match nothing; repeated documents are found each, repeated items count as one each; of several
places in a document the first one found counts; very long texts are searched whole; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import functools
import math
import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import freeze, remove
from .vector import slices, word_bounds

TERMS = 4096
RANK = 64
PASSAGE = 256
GATE = 0.22
WIDER = 1.2
ALIKE = 1.25
SHORT = 12
ORDER = 0.6
ANSWER = 0.6
BLOCK = 20_000
CHUNK = 1 << 15  # words taken at once
HASH_BYTES = 1 << 19  # of texts whose words are hashed at once
STEP = 4  # windows start at multiples of so many words
_TOGETHER = 256  # items looked at at once
_FAN = 64
_SLICE = 256  # terms in one part of a sum


_STRIPPED = np.zeros(256, dtype=bool)
_STRIPPED[[*string.punctuation.encode()]] = True
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_U = np.uint64


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, up to ``n`` of them, modulo 2^64; a worker keeps one table, as all slices but those of long texts share it."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(n, base, dtype=_U)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def word_hashes(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code of each word, where each text's words begin).  A code is 32 bits of a polynomial in the word's bytes, taken
    without the punctuation at its ends, which all words share by one running sum; 0 for punctuation alone."""
    starts, ends, inside = word_bounds(buf, offs)
    begin = np.searchsorted(starts, offs)
    if not len(starts):
        return np.zeros(0, dtype=np.uint32), begin
    core = np.append(np.flatnonzero(inside & ~_STRIPPED[buf]), len(buf))
    first = core[np.searchsorted(core, starts)]
    some = first < ends
    last = core[np.maximum(np.searchsorted(core, ends) - 1, 0)] + 1
    power, inverse = _powers(max(len(buf), HASH_BYTES))
    sums = np.concatenate([np.zeros(1, dtype=_U), np.cumsum((buf.astype(_U) + _U(1)) * power[: len(buf)], dtype=_U)])
    first, last = np.where(some, first, 0), np.where(some, last, 0)
    h = (sums[last] - sums[first]) * inverse[first]
    h = (h ^ (h >> _U(31))) * _U(0x7FB5D329728EA185)
    h ^= h >> _U(32)
    return np.where(some, np.maximum((h & _U(0xFFFFFFFF)).astype(np.uint32), 1), 0).astype(np.uint32), begin


class Codes:
    """32-bit codes of raw words without case and outer punctuation; 0 for punctuation alone."""

    def batch(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(codes, where each text's begin) of the slices of a column."""
        for _, buf, offs in slices(pc.utf8_lower(texts), HASH_BYTES):
            yield word_hashes(buf, offs)

    def of(self, text: str | None) -> np.ndarray:
        return next(self.batch(pa.array([text], pa.string())))[0]


_CODES = Codes()


def term_ids(codes: np.ndarray) -> np.ndarray:
    """Hashed terms of word codes, 1 .. TERMS - 1; 0 stays 0."""
    return np.where(codes == 0, 0, 1 + codes % (TERMS - 1)).astype(np.uint16)


def coded(docs: DataFrame) -> DataFrame:
    """``docs`` (id, text) as (id, codes): the word codes of every text, 4 bytes a word, written once for all later passes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for codes, begin in _CODES.batch(batch.column(1)):
                n = len(begin) - 1
                data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(begin.astype(np.int64) * 4), pa.py_buffer(np.ascontiguousarray(codes))])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), data.cast(pa.binary())], names=["id", "codes"])
                at += n

    kind = docs.schema["id"].dataType.simpleString()
    return freeze(docs.mapInArrow(run, f"id {kind}, codes binary"), "word-codes")


def tree_sum(parts: DataFrame, n_tasks: int) -> DataFrame:
    """Sums of float64 vectors: rows (task, slice, data) to one row per slice, adding at most ``_FAN`` rows in one group."""

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(d) for d in group["data"])
        return pd.DataFrame({"task": [int(group["task"].iloc[0]) // _FAN], "slice": [int(group["slice"].iloc[0])], "data": [total.tobytes()]})

    while n_tasks > 1:
        n_tasks = math.ceil(n_tasks / _FAN)
        parts = parts.withColumn("_up", F.floor(F.col("task") / _FAN)).groupBy("slice", "_up").applyInPandas(add, _PART)
    return parts


_PART = "task long, slice int, data binary"


def _gather(docs: DataFrame, work, width: int) -> np.ndarray:
    """Sum over all documents of what ``work(codes, total)`` adds to a TERMS x width array in each task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, task = np.zeros((TERMS, width)), None
        for part in batches:
            task = int(part["task"].iloc[0]) if task is None and len(part) else task
            work([np.frombuffer(c, dtype=np.uint32) for c in part["codes"]], total)
        if task is not None:
            for k in range(0, TERMS, _SLICE):
                yield pd.DataFrame({"task": [task], "slice": [k // _SLICE], "data": [total[k : k + _SLICE].tobytes()]})

    parts = freeze(docs.select(F.spark_partition_id().cast("long").alias("task"), "codes").mapInPandas(run, _PART), "term-parts")
    n = (parts.agg(F.max("task")).first()[0] or 0) + 1
    out = np.zeros((TERMS, width))
    for row in tree_sum(parts, max(2, n)).collect():  # TERMS x width numbers
        out[row["slice"] * _SLICE : (row["slice"] + 1) * _SLICE] = np.frombuffer(row["data"]).reshape(-1, width)
    remove(parts)
    return out


def term_rates(docs: DataFrame) -> np.ndarray:
    """Share of each hashed term in the words of all documents; ``docs``: codes."""

    def count(texts, total):
        for codes in texts:
            total[:, 0] += np.bincount(term_ids(codes), minlength=TERMS)

    n = _gather(docs, count, 1)[:, 0]
    return (n + 1) / (n.sum() + TERMS)


def _passages(texts: list[np.ndarray]) -> Iterator[np.ndarray]:
    """Counts of terms in passages, up to 256 x TERMS at once."""
    rows = [t[k : k + PASSAGE] for t in map(term_ids, texts) for k in range(0, len(t), PASSAGE)]
    for a in range(0, len(rows), 256):
        part = rows[a : a + 256]
        place = np.repeat(np.arange(len(part)) * TERMS, [len(r) for r in part])
        yield np.bincount(place + np.concatenate(part), minlength=len(part) * TERMS).reshape(len(part), TERMS).astype(np.float32)


def latent_terms(docs: DataFrame, rates: np.ndarray, seed: int = 17) -> np.ndarray:
    """Latent vector of each hashed term, TERMS x RANK, by a randomised SVD of all passages of ``docs`` (codes)."""
    weight = -np.log1p(-np.clip((1 - rates) ** PASSAGE, 1e-12, 1 - 1e-12)).astype(np.float64)
    weight[0] = 0.0

    def product(thin: np.ndarray) -> np.ndarray:
        """A' A thin, where A has a row of unit length for every passage."""
        own, idf = thin.astype(np.float32), weight.astype(np.float32)

        def add(texts, total):
            for counts in _passages(texts):
                counts *= idf
                counts /= np.maximum(np.sqrt(np.einsum("ij,ij->i", counts, counts)), 1e-9)[:, None]
                total += counts.T @ (counts @ own)

        return _gather(docs, add, thin.shape[1])

    start = np.random.default_rng(seed).standard_normal((TERMS, RANK))
    basis = np.linalg.qr(product(start))[0]
    small = basis.T @ product(basis)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    values = np.maximum(values, 0)
    scale = 1 / np.sqrt(values + 1e-3 * max(values.max(initial=0.0), 1e-12))
    return (weight[:, None] * (basis @ vectors) * scale).astype(np.float32)


def word_masks(a: list) -> dict:
    """The places of each word as bits."""
    masks: dict = {}
    for i, w in enumerate(a):
        masks[w] = masks.get(w, 0) | 1 << i
    return masks


def common_length(length: int, hits: list[int]) -> int:
    """Length of the longest common subsequence with a list of so many words; ``hits``: the masks of the other one's words that are in it."""
    full = (1 << length) - 1
    row = full
    for m in hits:
        m &= row
        row = ((row + m) | (row - m)) & full
    return length - row.bit_count()


def lcs_length(a: list, b: list) -> int:
    """Length of the longest common subsequence, by bits."""
    return common_length(len(a), list(filter(None, map(word_masks(a).get, b))))


class Item:
    def __init__(self, item_id, text: str, answer: str | None):
        self.id = item_id
        self.codes = _CODES.of(text)
        self.words = self.codes[self.codes > 0].tolist()
        self.masks = word_masks(self.words)
        self.answer = [c for c in _CODES.of(answer).tolist() if c]
        self.wide = 2 * STEP * math.ceil(len(self.codes) / STEP) + STEP  # of a window
        self.pace = STEP  # between the windows that are looked at
        self.least = max(1, math.ceil(ORDER * len(self.words) - 1e-9))

    def rare(self, rates: np.ndarray) -> tuple[np.ndarray, int]:
        """Terms of the rare words, and how many of them any window with ``least`` of the words has."""
        terms, n = np.unique(term_ids(np.array(self.words, dtype=np.uint32)), return_counts=True)
        order = np.argsort(-rates[terms], kind="stable")
        terms, n = terms[order], n[order]
        need = self.least - np.concatenate([[0], np.cumsum(n)[:-1]])  # without the first so many terms
        chance = self.wide * np.cumsum(rates[terms][::-1])[::-1]
        tells = np.where(need > chance, need * np.log(np.maximum(need, 1) / chance) - need + chance, 0.0)
        k = int(tells.argmax())
        return terms[k:], int(need[k])

    def leaked(self, codes: np.ndarray, pos: int, more: int = 0) -> tuple[float, int]:
        """Share of the item's words in order in a window that begins in the ``more`` words from ``pos`` on, or 0 if none is a leak, and where it begins."""
        whole = codes[pos : pos + self.wide + more].tolist()
        hits = list(filter(None, map(self.masks.get, whole)))
        if len(hits) < self.least or common_length(len(self.words), hits) < self.least:
            return 0.0, pos
        for start in range(0, more + 1, STEP):
            ws = whole[start : start + self.wide]
            n = lcs_length(self.words, ws)
            if n >= self.least:
                break
        else:
            return 0.0, pos
        # the last start that keeps all of it is where the copy begins; the window from there has the rest of the copy
        low, high = 0, len(ws) - n
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if lcs_length(self.words, ws[mid:]) == n else (low, mid - 1)
        pos += start + low
        ws = codes[pos : pos + self.wide].tolist()
        if lcs_length(self.answer, ws) < ANSWER * len(self.answer):
            return 0.0, pos
        return lcs_length(self.words, ws) / len(self.words), pos


def _running(blocks: np.ndarray, kind: type) -> np.ndarray:
    """Sums of each row's first 0, 1, 2, ... numbers."""
    out = np.zeros((len(blocks), blocks.shape[1] + 1), dtype=kind)
    np.cumsum(np.ascontiguousarray(blocks), axis=1, dtype=kind, out=out[:, 1:])
    return out


class Searcher:
    """Searches texts (arrays of word codes) for items.  ``latent``: vectors of the terms."""

    def __init__(self, rates: np.ndarray, latent: np.ndarray, items: list[tuple]):
        self.latent = np.ascontiguousarray(latent.T)
        self.items = sorted((i for i in (Item(*x) for x in items) if i.words), key=lambda i: (len(i.words) >= SHORT, i.wide))
        self.groups = []  # items of like lengths, their rare terms (TERMS x items), how many of these are needed, their vectors
        at = 0
        while at < len(self.items):
            first, end = self.items[at], at
            while end < len(self.items) and end - at < _TOGETHER and self._alike(first, self.items[end]):
                end += 1
            part = self.items[at:end]
            known = np.zeros((TERMS, len(part)), dtype=np.uint8)
            need = np.zeros(len(part), dtype=np.int64)
            vectors = np.zeros((len(part), latent.shape[1]), dtype=np.float32)
            for k, item in enumerate(part):
                if len(first.words) >= SHORT:
                    item.pace = max(1, len(first.codes) // (2 * STEP)) * STEP
                terms, need[k] = item.rare(rates)
                known[terms, k] = 1
                own = latent[term_ids(item.codes)].sum(axis=0)
                vectors[k] = own / max(float(np.sqrt(own @ own)), 1e-9)
            self.groups.append((part, known, need, vectors))
            at = end
        self.widest = max((i.wide + 2 * i.pace for i in self.items), default=STEP)

    @staticmethod
    def _alike(first: Item, other: Item) -> bool:
        if len(first.words) < SHORT:
            return other.wide == first.wide and len(other.words) < SHORT
        return len(other.codes) <= ALIKE * len(first.codes)

    def search(self, texts: list[np.ndarray]) -> Iterator[tuple[int, object, float, int]]:
        """(text, item id, share in order, word position) of every leak; texts are taken together, ``CHUNK`` words at once."""
        held: list[tuple[int, int, np.ndarray]] = []
        size, found = 0, set()
        for t, codes in enumerate(texts):
            for at in range(0, len(codes), CHUNK):
                held.append((t, at, codes))
                size += min(CHUNK, len(codes) - at)
                if size >= CHUNK:
                    yield from self._together(held, found)
                    held, size = [], 0
        if held:
            yield from self._together(held, found)

    def _together(self, held, found: set) -> Iterator[tuple]:
        """One pass over pieces of texts; each begins at a multiple of ``STEP``.  A window may reach into the next piece: the check
        of a candidate sees its own text only."""
        parts, begins = [], [0]
        for _, at, codes in held:
            own = codes[at : at + CHUNK + self.widest]
            gap = -len(own) % STEP
            parts += [own, np.zeros(gap, dtype=np.uint32)]
            begins.append(begins[-1] + len(own) + gap)
        flat, starts_of = term_ids(np.concatenate(parts)), np.array(begins[:-1])
        n = len(flat) // STEP
        terms = [flat[k::STEP].astype(np.intp) for k in range(STEP)]
        sums = _running(sum(np.take(self.latent, t, axis=1) for t in terms), np.float64)
        for part, known, need, vectors in self.groups:
            if len(part[0].words) < SHORT:
                yield from self._short(part, known, need, flat, n, held, begins, starts_of, found)
                continue
            pace, size = part[0].pace, math.ceil(WIDER * len(part[-1].codes) / STEP)
            starts = np.arange(0, n, pace // STEP)
            own = (np.take(sums, np.minimum(starts + size, n), axis=1) - sums[:, : n : pace // STEP]).astype(np.float32)
            norm = np.sqrt(np.einsum("ij,ij->j", own, own))
            near = own.T @ vectors.T >= GATE * np.maximum(norm, 1e-9)[:, None]
            row, col = np.nonzero(near)
            first = np.maximum(starts[row] - pace // STEP, 0)  # a copy begins within a pace before or after the window
            room = (part[-1].wide + 2 * pace) // STEP
            rare = _running(sum(np.take(known, t, axis=0) for t in terms).T, np.int32)
            enough = rare[col, np.minimum(first + room, n)] - rare[col, first] >= need[col]
            for k in np.flatnonzero(enough).tolist():
                yield from self._check(part[col[k]], int(starts[row[k]]) * STEP, held, begins, starts_of, found)

    def _short(self, items, known, need, flat, n, held, begins, starts_of, found) -> Iterator[tuple]:
        """Items of one width that say too little for a direction: every window with enough of their rare terms."""
        hits = np.take(known, flat, axis=0).reshape(n, STEP, -1)
        blocks = hits.sum(axis=1, dtype=np.uint8)
        sums = np.zeros((n + 1, len(items)), dtype=np.int64)
        np.cumsum(blocks, axis=0, out=sums[1:])
        wide = items[0].wide // STEP
        near = sums[np.minimum(np.arange(n) + wide, n)] - sums[:n] >= need
        for k, j in np.argwhere(near).tolist():
            yield from self._check(items[j], k * STEP, held, begins, starts_of, found)

    @staticmethod
    def _check(item, pos, held, begins, starts_of, found) -> Iterator[tuple]:
        """Verify a candidate window at ``pos`` of the joined pieces, with a pace on either side."""
        piece = int(np.searchsorted(starts_of, pos, "right")) - 1
        text, at, codes = held[piece]
        if (text, item.id) in found:
            return
        own = pos + at - begins[piece]
        first = max(0, own - item.pace)
        share, pos = item.leaked(codes, first, own - first + item.pace)
        if share:
            found.add((text, item.id))
            yield text, item.id, share, pos


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", answer_col: str | None = None, block: int = BLOCK,
) -> DataFrame:
    """Rows (id, item_id, lcs_share, word_position): one per document and leaked item."""
    texts = coded(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    spark = docs.sparkSession
    rates = term_rates(texts)
    space = spark.sparkContext.broadcast((rates, latent_terms(texts, rates)))
    answer = F.col(answer_col) if answer_col else F.lit(None).cast("string")
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"), answer.alias("answer"))
    items = items.where(F.col("text").isNotNull() & F.col("item").isNotNull()).distinct()
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, `{item_col}` {item_kind}, lcs_share double, word_position long"
    found = None
    blocks = max(1, math.ceil(items.count() / block))
    for k in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        held = spark.sparkContext.broadcast([tuple(r) for r in own.collect()])  # at most about ``block`` items

        def search(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            finder = Searcher(*space.value, held.value)
            for part in batches:
                ids = list(part["id"])
                hits = finder.search([np.frombuffer(c, dtype=np.uint32) for c in part["codes"]]) if finder.items else ()
                rows = [(ids[t], item, float(share), pos) for t, item, share, pos in hits]
                yield pd.DataFrame(rows, columns=[id_col, item_col, "lcs_share", "word_position"])

        part = texts.mapInPandas(search, schema)
        found = part if found is None else found.unionAll(part)
    return found
