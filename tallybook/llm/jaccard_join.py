"""N-gram Jaccard join: prefix filters under several global orders, intersected before exact verification.

A document's set holds its distinct shingles (five words, A-Z lower-cased), hashed to 64 bits; a shorter text is one
shingle.  Two sets link when 100 x intersection >= 75 x union.  Under any order of all tokens that is the same for all documents, two linked
sets share a token among the first ``n - ceil(0.75 n) + 1`` of each.  Three orders are used, all of them rare tokens
first but with other ties: candidates must share a prefix token under each.

1. Sets are cut into ranges of the hash and shuffled as packed arrays (all 64 bits, as gaps), one row per block of documents
   and range.  Each range counts its tokens and returns those that are in two documents or more.
2. All tokens that two documents share are among the returned ones, so sets go on as lists of those.  A document of which
   under 75 of 100 tokens came back can't link with anything and leaves here.  Equal sets become one class.
3. Every prefix token of the first order is a bucket.  The member with the most common tokens leads; the others are
   checked against it, and the links of all leaders give first components.  Members outside the leader's component are compared
   with those of other components in the bucket, in blocks of ``SIDE`` x ``SIDE``, under length, the other two orders and a
   bound on the intersection (bitmaps of 4 bits a token or more), and verified exactly.  So every link between different components is found, but a group
   of near copies is not paired out.
4. Components of the links by contraction, in a number of rounds that grows with the logarithm of the nodes; equal sets share the label of their class.

Cases: NULL and empty texts have no shingles and link with nothing; equal texts are one class; rows that share an id
are one document each; ids are whole numbers; very long texts are compared whole; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import freeze, remove
from .vector import LOWER, Recent, slices, word_codes

SHINGLE = 5
PERCENT = 75
BLOCK_TOKENS = 1 << 20
RANGE_TOKENS = 1 << 20  # about, in one range
SIDE = 1024
BITS = 2048
CACHE_SIZE = 200_000
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit numbers."""
    x = (x ^ (x >> _U(31))) * _U(0x7FB5D329728EA185)
    x = (x ^ (x >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


class WordCodes:
    """64-bit hashes of words."""

    def __init__(self):
        self.known = Recent(CACHE_SIZE)

    def _hashes(self, words: list[str]) -> list[int]:
        return [xxhash.xxh3_64_intdigest(w) for w in words]

    def shingle_sets(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Distinct shingle hashes of each text, ascending; all texts of a slice are hashed together."""
        for _, buf, offs in slices(texts):
            codes, begin, values, _ = word_codes(LOWER[buf], offs)
            word = np.array(self.known.find(values.to_pylist(), self._hashes), dtype=np.uint64)[codes]
            size = np.diff(begin)
            mixed = np.full(len(word), SHINGLE, dtype=np.uint64)
            last = len(word) - SHINGLE + 1
            for k in range(SHINGLE):
                mixed[: max(0, last)] = _mix(mixed[: max(0, last)] + word[k : k + max(0, last)])
            for a, n in zip(begin.tolist(), size.tolist()):
                if n >= SHINGLE:
                    own = np.sort(mixed[a : a + n - SHINGLE + 1])
                    keep = np.ones(len(own), dtype=bool)
                    np.not_equal(own[1:], own[:-1], out=keep[1:])
                    yield own if keep.all() else own[keep]
                else:
                    yield _one_shingle(word[a : a + n])

    def shingles(self, text: str | None) -> np.ndarray:
        return next(self.shingle_sets(pa.array([text], pa.string())))


def _one_shingle(words: np.ndarray) -> np.ndarray:
    """The one shingle of a text of fewer words; none without words."""
    mixed = np.full(min(1, len(words)), len(words), dtype=np.uint64)
    for k in range(len(words)):
        mixed = _mix(mixed + words[k : k + 1])
    return mixed


_WORDS = WordCodes()  # the cache outlives a task


def signature(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    if not len(tokens):
        return 0, 0
    return tuple(np.array([tokens.sum(dtype=_U), _mix(tokens ^ _U(0x9E3779B97F4A7C15)).sum(dtype=_U)], dtype=_U).view(np.int64).tolist())


def least_overlap(n, m):
    """Smallest intersection of linked sets of sizes n and m."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


def prefix_length(n):
    return n - -(-PERCENT * n // 100) + 1


_META = "idx int, id long, has_id boolean, n int, s1 long, s2 long"
_PACKED = f"block string, range int, {_META}, tokens binary, docs binary"


def packed_sets(docs: DataFrame, bits: int) -> DataFrame:
    """``docs`` (id, text) as two kinds of rows: a negative range: one per document; else the tokens of a block in one range.

    A block is named by its place in the input, so that a task that runs again makes the same ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _WORDS
        task = TaskContext.get().partitionId()
        block = 0
        meta, sets, seen, size = [], [], set(), 0

        def flush():
            own = pd.DataFrame(meta, columns=["idx", "id", "has_id", "n", "s1", "s2"])
            yield own.assign(block=f"{task}-{block}", range=-1 - (task + block) % (1 << bits), tokens=None, docs=None)
            if sets:
                tokens = np.concatenate([t for _, t in sets])
                owner = np.repeat(np.array([i for i, _ in sets], dtype=np.uint16), [len(t) for _, t in sets])
                order = np.argsort(tokens)
                tokens, owner = tokens[order], owner[order]
                part = (tokens >> _U(64 - bits)).astype(np.int64) if bits else np.zeros(len(tokens), dtype=np.int64)
                first = np.flatnonzero(np.diff(part, prepend=-1))
                ends = [*first[1:], len(tokens)]
                yield pd.DataFrame({
                    "block": f"{task}-{block}", "range": part[first], "idx": 0, "id": 0, "has_id": False, "n": 0, "s1": 0, "s2": 0,
                    "tokens": [_pack(tokens[a:b]) for a, b in zip(first, ends)], "docs": [owner[a:b].tobytes() for a, b in zip(first, ends)],
                })

        for batch in batches:
            for i, tokens in zip(batch.column(0).to_pylist(), codes.shingle_sets(batch.column(1))):
                sig = (len(tokens), *signature(tokens))
                meta.append((len(meta), 0 if i is None else int(i), i is not None, *sig))
                if len(tokens) and sig not in seen:
                    seen.add(sig)
                    sets.append((len(meta) - 1, tokens))
                    size += len(tokens)
                if size >= BLOCK_TOKENS or len(meta) >= 65_000:
                    for out in flush():
                        yield pa.RecordBatch.from_pandas(out[_COLUMNS], schema, preserve_index=False)
                    meta, sets, seen, size, block = [], [], set(), 0, block + 1
        if meta:
            for out in flush():
                yield pa.RecordBatch.from_pandas(out[_COLUMNS], schema, preserve_index=False)

    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in _PACKED.split(", ")])
    return docs.select("id", "text").mapInArrow(run, _PACKED)


_COLUMNS = [c.split()[0] for c in _PACKED.split(", ")]
_SHARED = f"block string, {_META}, tokens binary, docs binary, df binary"


def _pack(tokens: np.ndarray) -> bytes:
    """Ascending tokens: the first one, then the gaps in as few bytes each as the widest one needs."""
    gaps = np.diff(tokens)
    width = max(1, -(-int(gaps.max()).bit_length() // 8)) if len(gaps) else 1
    return tokens[:1].tobytes() + gaps.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpack(data: bytes, count: int) -> np.ndarray:
    out = np.zeros((count, 8), dtype=np.uint8)
    out[0] = np.frombuffer(data, dtype=np.uint8, count=8)
    if count > 1:
        width = (len(data) - 8) // (count - 1)
        out[1:, :width] = np.frombuffer(data, dtype=np.uint8, offset=8).reshape(-1, width)
    return np.cumsum(out.view(np.uint64)[:, 0], dtype=np.uint64)


def _narrow(df: np.ndarray) -> bytes:
    """Counts in 1, 2 or 4 bytes each, as the largest one needs."""
    return df.astype(next(d for d in (np.uint8, np.uint16, np.uint32) if df.max() <= np.iinfo(d).max)).tobytes()


def _wide(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(data, dtype=f"u{len(data) // count}").astype(np.uint32)


def _shared_in_range(part: pd.DataFrame) -> pd.DataFrame:
    """Tokens of one range that are in two documents or more, back to their blocks; rows of documents pass through."""
    if part["range"].iloc[0] < 0:
        return part.drop(columns="range").assign(df=None)
    pieces = [_unpack(t, len(d) // 2) for t, d in zip(part["tokens"], part["docs"])]
    tokens, place, count = np.unique(np.concatenate(pieces), return_inverse=True, return_counts=True)
    out, at = [], 0
    for block, docs, piece in zip(part["block"], part["docs"], pieces):
        df = count[place[at : at + len(piece)]]
        at += len(piece)
        keep = df > 1
        if keep.any():
            owner = np.frombuffer(docs, dtype=np.uint16)[keep]
            out.append((block, _pack(piece[keep]), owner.tobytes(), _narrow(df[keep])))
    named = pd.DataFrame(out, columns=["block", "tokens", "docs", "df"])
    return named.assign(idx=0, id=0, has_id=False, n=0, s1=0, s2=0)[[c.split()[0] for c in _SHARED.split(", ")]]


_SETS = "id long, n int, s1 long, s2 long, tokens binary, df binary, lead double"


def _gather_block(block: pd.DataFrame) -> pd.DataFrame:
    """Sets of one block with at least 75 of 100 tokens shared: tokens and their counts, rare ones first."""
    meta, parts = block[block["tokens"].isna()], block[block["tokens"].notna()]
    if not len(parts) or not len(meta):
        return pd.DataFrame([], columns=[c.split()[0] for c in _SETS.split(", ")])
    tokens = np.concatenate([_unpack(t, len(d) // 2) for t, d in zip(parts["tokens"], parts["docs"])])
    owner = np.concatenate([np.frombuffer(t, dtype=np.uint16) for t in parts["docs"]])
    df = np.concatenate([_wide(t, len(d) // 2) for t, d in zip(parts["df"], parts["docs"])])
    order = np.lexsort((tokens, df, owner))
    tokens, owner, df = tokens[order], owner[order], df[order]
    first = np.flatnonzero(np.diff(owner.astype(np.int64), prepend=-1))
    rows = {int(i): (k, s1, s2, n) for i, k, s1, s2, n in zip(meta["idx"], meta["id"], meta["s1"], meta["s2"], meta["n"])}
    out = []
    for a, b in zip(first, [*first[1:], len(tokens)]):
        i, s1, s2, n = rows[int(owner[a])]
        if 100 * (b - a) >= PERCENT * n:
            lead = float(np.log2(df[a:b]).sum() / n)
            out.append((i, n, s1, s2, tokens[a:b].tobytes(), df[a:b].tobytes(), lead))
    return pd.DataFrame(out, columns=[c.split()[0] for c in _SETS.split(", ")])


def _prefixes(tokens: np.ndarray, df: np.ndarray, n: int) -> list[np.ndarray]:
    """Shared tokens in the prefixes of the three orders; the n - len(tokens) unshared ones come first in all of them."""
    size = prefix_length(n) - (n - len(tokens))
    ties = (tokens, _mix(tokens), _mix(~tokens))
    ranks = (df, df, np.log2(df).astype(np.int64))
    return [tokens[np.lexsort((t, r))[:size]] for t, r in zip(ties, ranks)]


def _bitmap(tokens: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros(bits, dtype=bool)
    out[(_mix(tokens) % _U(bits)).astype(np.int64)] = True
    return np.packbits(out)


def _prints(tokens: np.ndarray) -> np.ndarray:
    """32 bits of each token, distinct and ascending."""
    return np.unique((_mix(tokens) >> _U(32)).astype(np.uint32))


def buckets(sets: DataFrame) -> DataFrame:
    """Rows (token, sid, n, lead): one per set and 32-bit print of a prefix token of the first order; tokens with one print share a bucket."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for sid, n, lead, t, d in zip(part["sid"], part["n"], part["lead"], part["tokens"], part["df"]):
                own = _prints(_prefixes(np.frombuffer(t, dtype=_U), np.frombuffer(d, dtype=np.uint32), n)[0])
                yield pd.DataFrame({"token": own.astype(np.int64), "sid": sid, "n": n, "lead": lead})

    return sets.select("sid", "n", "lead", "tokens", "df").mapInPandas(run, "token long, sid long, n int, lead double")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` that link, exactly."""
    own = sets.select("sid", "n", "tokens", "df")
    side = lambda c: own.select(F.col("sid").alias(c), F.struct("n", "tokens", "df").alias(f"set_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            keep = []
            for x, y in zip(part["set_a"], part["set_b"]):
                t, u = (np.frombuffer(s["tokens"], dtype=_U) for s in (x, y))
                need = least_overlap(x["n"], y["n"])
                ok = min(len(t), len(u)) >= need
                if ok:
                    # every order's filter must let the pair through before it is counted
                    p, q = (_prefixes(v, np.frombuffer(s["df"], dtype=np.uint32), s["n"]) for v, s in ((t, x), (u, y)))
                    ok = all(len(np.intersect1d(f, g, assume_unique=True)) for f, g in zip(p, q))
                keep.append(ok and len(np.intersect1d(t, u, assume_unique=True)) >= need)
            yield part.loc[keep, ["a", "b"]]

    return both.mapInPandas(run, "a long, b long")


def _lengths_fit(n, m):
    return (100 * F.least(n, m) >= PERCENT * F.greatest(n, m))


def links(sets: DataFrame) -> DataFrame:
    """Links (a, b) that connect whatever any links connect.  ``sets``: sid, n, tokens, df, lead."""
    posts = buckets(sets)
    sizes = posts.groupBy("token").agg(F.count(F.lit(1)).alias("size"), F.max(F.struct("lead", "sid", "n")).alias("top")).where("size > 1")
    posts = freeze(posts.join(sizes, "token").select("token", "sid", "n", "size", F.col("top.sid").alias("top"), F.col("top.n").alias("top_n")), "jaccard-buckets")
    led = posts.where((F.col("sid") != F.col("top")) & _lengths_fit(F.col("n"), F.col("top_n")))
    first = freeze(verified(led.select(F.col("top").alias("a"), F.col("sid").alias("b")).distinct(), sets), "jaccard-led")
    # buckets with two sets have no more pairs than the one that was checked
    marked = posts.where("size > 2").drop("top_n").join(components(first), "sid", "left")
    labelled = freeze(marked.withColumn("label", F.coalesce("label", "sid")), "jaccard-labelled")
    remove(posts)
    heads = labelled.where("sid = top").select("token", F.col("label").alias("top_label"))
    opened = labelled.join(heads, "token").withColumn("open", F.col("label") != F.col("top_label")).drop("top", "top_label")
    opened = freeze(opened, "jaccard-open")
    remove(labelled)
    left = opened.groupBy("token").agg(F.sum(F.col("open").cast("int")).alias("open_size")).where("open_size > 0")
    marked = opened.join(left, "token").join(_filters(sets), "sid")
    rows, cols = F.ceil(F.col("open_size") / SIDE).cast("int"), F.ceil(F.col("size") / SIDE).cast("int")
    spot = lambda n, salt: F.pmod(F.xxhash64(F.lit(salt), "sid"), n).cast("int")
    keep = ["token", "sid", "n", "label", "bits", "others", "firsts"]
    a = marked.where("open").withColumn("row", spot(rows, 1)).withColumn("col", F.explode(F.sequence(F.lit(0), cols - 1)))
    b = marked.withColumn("col", spot(cols, 2)).withColumn("row", F.explode(F.sequence(F.lit(0), rows - 1)))
    cells = a.select(*keep, "row", "col", F.lit(True).alias("ours")).unionAll(b.select(*keep, "row", "col", F.lit(False).alias("ours")))
    pairs = cells.groupBy("token", "row", "col").applyInPandas(_cell_pairs, "a long, b long").distinct()
    second = freeze(verified(pairs, sets), "jaccard-rest")
    remove(opened)
    return first.unionAll(second)


def _width(n: int) -> int:
    """Bits of the bitmap of a set of ``n`` tokens: 4 a token at least, a power of two."""
    return max(BITS, 1 << (4 * n - 1).bit_length())


def _filters(sets: DataFrame) -> DataFrame:
    """Bitmap of each set's tokens, bitmaps of its second and third prefix, and the prints of the first one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            bits, others, firsts = [], [], []
            for n, t, d in zip(part["n"], part["tokens"], part["df"]):
                tokens = np.frombuffer(t, dtype=_U)
                first, second, third = _prefixes(tokens, np.frombuffer(d, dtype=np.uint32), n)
                firsts.append(_prints(first).tobytes())
                bits.append(_bitmap(tokens, _width(n)).tobytes())
                others.append(_bitmap(second, 512).tobytes() + _bitmap(third, 512).tobytes())
            yield pd.DataFrame({"sid": part["sid"], "bits": bits, "others": others, "firsts": firsts})

    return sets.select("sid", "n", "tokens", "df").mapInPandas(run, "sid long, bits binary, others binary, firsts binary")


def _halved(bits: np.ndarray) -> np.ndarray:
    """Bitmaps of half the width; a token's bit is its hash modulo the width."""
    half = bits.shape[-1] // 2
    return bits[..., :half] | bits[..., half:]


def _cell_pairs(cell: pd.DataFrame) -> pd.DataFrame:
    """Pairs of one cell of a bucket, not connected yet, that pass length, both other orders and the bound on the intersection.

    A pair belongs to the bucket of the smallest print that its two sets share: one of them at least is open there,
    since the leader can be connected with one side only.
    """
    cell = cell.sort_values("n", kind="stable")
    ours, theirs, found = cell[cell["ours"]], cell[~cell["ours"]], []
    if len(ours) and len(theirs):
        view = lambda f, c: [np.frombuffer(x, dtype=_U) for x in f[c]]
        ids, n, labels = (theirs[c].to_numpy() for c in ("sid", "n", "label"))
        others, bits = np.stack(view(theirs, "others")), view(theirs, "bits")
        token = np.uint32(cell["token"].iloc[0])
        prefixes = [np.frombuffer(x, dtype=np.uint32) for x in theirs["firsts"]]
        half = others.shape[1] // 2
        # sizes ascend, and so do the widths of the bitmaps: one table for each width
        widths = np.array([len(x) for x in bits])
        cuts = [0, *(np.flatnonzero(np.diff(widths)) + 1).tolist(), len(widths)]
        tables = [(a, b, np.stack(bits[a:b])) for a, b in zip(cuts, cuts[1:])]
        for sid, size, label, own, mine, prefix in zip(ours["sid"], ours["n"], ours["label"], view(ours, "bits"), view(ours, "others"), ours["firsts"]):
            # sets that fit are next to each other; each filter sees what the one before let through
            a, b = np.searchsorted(n, -(-PERCENT * size // 100)), np.searchsorted(n, 100 * size // PERCENT, side="right")
            at = a + np.flatnonzero(labels[a:b] != label)
            meet = others[at] & mine
            at = at[meet[:, :half].any(axis=1) & meet[:, half:].any(axis=1)]
            for first, last, table in tables:
                k = at[(at >= first) & (at < last)]
                if not len(k):
                    continue
                there, here = table[k - first], own
                # sizes that fit differ by a third at most, so widths by one step
                if there.shape[1] > len(here):
                    there = _halved(there)
                elif there.shape[1] < len(here):
                    here = _halved(here)
                need = least_overlap(size, n[k])
                # tokens of one set that can't be in the other: bits set there only, one token each at least
                ok = n[k] - np.bitwise_count(there & ~here).sum(axis=1, dtype=np.int64) >= need
                ok &= size - np.bitwise_count(here & ~there).sum(axis=1, dtype=np.int64) >= need
                if ok.any():
                    prefix_ = np.frombuffer(prefix, dtype=np.uint32)
                    smaller = set(prefix_[: np.searchsorted(prefix_, token)].tolist())
                    near = [i for i in k[ok].tolist() if smaller.isdisjoint(prefixes[i].tolist())]
                    found += [(min(sid, x), max(sid, x)) for x in ids[near].tolist()]
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def components(edges: DataFrame) -> DataFrame:
    """(sid, label) of every node of an edge: the smallest node it is connected with.

    Every round, each node goes to the first of itself and its neighbours and on to where that one goes; nodes that meet become
    one, until no edge is left.  First is the least id, which ends stars and groups of copies in two rounds, in every other
    later round the least hash of round and id: at most half of the nodes, on average, are first among their neighbours then, so
    the rounds grow with the logarithm of the nodes, whatever the order of ids along a chain.
    """
    both = freeze(edges.select("a", "b").unionAll(edges.select(F.col("b"), F.col("a"))).distinct().toDF("sid", "other"), "cc-edges")
    hops: list[DataFrame] = []
    while both.limit(1).count():
        k = len(hops)
        ranked = lambda c: F.struct((F.xxhash64(F.lit(k), c) if k > 1 and k % 2 == 0 else F.lit(0)).alias("p"), F.col(c).alias("to"))  # noqa: B023, E731
        near = both.groupBy("sid").agg(F.min(ranked("other")).alias("near"))
        near = freeze(near.select("sid", F.least("near", ranked("sid"))["to"].alias("to")), "cc-near")
        hop = freeze(near.join(near.toDF("to", "far"), "to").select("sid", F.col("far").alias("to")), "cc-hops")
        hops.append(hop)
        moved = both.join(hop.toDF("sid", "x"), "sid").join(hop.toDF("other", "y"), "other").where("x <> y")
        both = freeze(moved.select(F.col("x").alias("sid"), F.col("y").alias("other")).distinct(), "cc-edges")
    if not hops:
        return both.select("sid", F.col("sid").alias("label"))
    ends = hops.pop()
    while hops:
        on = hops.pop().join(ends.toDF("to", "end"), "to", "left")
        ends = freeze(on.select("sid", F.coalesce("end", "to").alias("to")), "cc-ends")
    least = freeze(ends.groupBy("to").agg(F.min("sid").alias("label")), "cc-least")
    return freeze(ends.join(least, "to").select("sid", "label"), "cc-labels")


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(30, max(0, int(np.ceil(np.log2(max(1, total / 6 / RANGE_TOKENS))))))
    ranges = packed_sets(texts, bits).groupBy("range").applyInPandas(_shared_in_range, _SHARED)
    ranges = freeze(ranges, "jaccard-ranges")
    meta = freeze(ranges.where("tokens is null").select(F.when(F.col("has_id"), F.col("id")).alias("id"), "n", "s1", "s2"), "jaccard-documents")
    shared = freeze(ranges.groupBy("block").applyInPandas(_gather_block, _SETS), "jaccard-shared")
    remove(ranges)
    key = ["n", "s1", "s2"]
    classes = meta.where("n > 0 and id is not null").groupBy(*key).agg(F.min("id").alias("sid"))
    ranked = F.row_number().over(Window.partitionBy(*key).orderBy("id"))  # one row per block at most
    sets = shared.withColumn("_k", ranked).where("_k = 1").drop("_k", "id").join(classes, key)
    sets = freeze(sets, "jaccard-classes")
    remove(shared)
    label = components(links(sets))
    remove(sets)
    named = classes.join(label, "sid", "left").select(*key, F.coalesce("label", "sid").alias("component_id"))
    out = meta.join(named, key, "left")
    return out.select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")
    )
