"""Packing documents into sequences of equal length, in the order of a Hilbert curve through their hashed vectors.

1. The words of a document are hashed to random directions in ``DIMS`` dimensions; their mean is its point, a projection of
   its hashed word vector.  The point's place on a Hilbert curve (``GRID`` bits a dimension) is its key.
2. Documents are range-sorted by the key; a group with one key is cut by a hash of its rows' places, so its size does not matter.
3. Each range is one stream: texts become token ids, and neighbours follow each other without a gap; every ``length`` ids are a
   sequence.  Documents are cut where a sequence ends.  What is left at the end of a range makes sequences whose lengths are
   powers of two, which need no padding either.

Each text is tokenized once, after the sort.  Where the tokenizer drops white space, the ids of a word don't depend on its
neighbours: then the distinct words of a slice are looked up in a cache of the worker, and only new ones reach the tokenizer.

Cases: NULL and empty texts are the end id alone; very long texts are cut into as many pieces as needed; rows with one id are packed
one by one; ties on the curve go by a hash of the row's place; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import array
import json
import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vector import LOWER, Recent, byte_level, mark_cuts, slices, spread, sums, word_bounds, word_codes

LENGTH = 2048
END = 1
DIMS = 4
GRID = 12
SPREAD = 6.0
CACHE_WORDS = 300_000
LETTERS = re.compile("[a-zß-öø-ÿ]+")  # lower case, composed
_U = np.uint64
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=_U)


def points(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Mean direction of the words of each text of a slice, texts x DIMS; words are told apart by length and first eight bytes."""
    buf = LOWER[buf]
    starts, ends, _ = word_bounds(buf, offs)
    wide = np.concatenate([buf, np.zeros(8, dtype=np.uint8)])
    eight = np.ndarray(len(buf) + 1, dtype="<u8", buffer=wide, strides=(1,))
    size = ends - starts
    h = (eight[starts] & _MASKS[np.minimum(size, 8)]) + size.astype(_U)
    for _ in range(2):
        h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    begin = np.searchsorted(starts, offs)
    parts = h.view(np.uint16).reshape(-1, 4)[:, :DIMS]
    count = np.maximum(1, np.diff(begin))
    return np.stack([(sums(parts[:, d].astype(np.int64), begin) / count / 32768 - 1) * (np.diff(begin) > 0) for d in range(DIMS)], axis=1)


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of grid coordinates (0 .. 2^bits - 1).

    The bits are read off from the top: each level names the orthant, as the curve walks it, and the flips and the rotation
    of axes that the curve makes in it are undone for the levels below.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for d in range(dims):
            flip = (x[d] >> level) & 1 == 1
            swap = np.where(flip, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | ((x[d] >> level) & 1)
    return key


def curve_key(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Hilbert key of each text of a slice."""
    unit = 0.5 + 0.5 * np.tanh(SPREAD * points(buf, offs))
    return hilbert(np.minimum((unit * (1 << GRID)).astype(np.int64), (1 << GRID) - 1), GRID)


class TextIds:
    """Token ids of the texts of a slice, with a cache of words.  ``spec``: text of a tokenizers .json file.

    Words of Latin lower-case letters only are pre-tokens as they are for tokenizers with this kind of steps, and go to the model at once.
    """

    def __init__(self, spec: str, end: int):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        self.tok = Tokenizer.from_str(spec)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.end = array.array("I", [end]).tobytes()
        conf = json.loads(spec)
        steps = conf.get("pre_tokenizer") or {}
        kinds = [x.get("type") for x in steps.get("pretokenizers") or [steps]]
        first = (steps.get("pretokenizers") or [steps])[0]
        drops = kinds[0] == "Split" and first.get("behavior") == "Removed" and first.get("invert") and r"[^\s\p{L}\p{N}]+" in str(first["pattern"].get("Regex"))
        norms = conf.get("normalizer") or {}
        norms = [x.get("type") for x in norms.get("normalizers") or [norms] if x]
        self.by_word = bool(drops) or kinds[0] in ("WhitespaceSplit", "Whitespace", "BertPreTokenizer")
        self.by_mark = bool(drops) or kinds[0] in ("Whitespace", "BertPreTokenizer")
        self.direct = bool(drops) and kinds[1:] == ["ByteLevel"] and set(norms) <= {"NFC", "Replace", "Lowercase"} and conf["model"]["type"] == "BPE"
        self.lowers = "Lowercase" in norms
        self.special = [t["content"].lower().encode() for t in conf.get("added_tokens", [])]
        self.known = Recent(CACHE_WORDS)  # ids as bytes

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of words that are not known yet, four bytes an id."""
        plain = [self.direct and LETTERS.fullmatch(w) is not None for w in words]
        hard = iter(self.tok.encode_batch_fast([w for w, p in zip(words, plain) if not p], add_special_tokens=False))
        tokenize = self.tok.model.tokenize
        ids = ([t.id for t in tokenize(byte_level(w))] if p else next(hard).ids for w, p in zip(words, plain))
        return [array.array("I", x).tobytes() for x in ids]

    def slice_ids(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts with the end id behind each, and where each text's begin (one more than texts)."""
        if self.by_word:
            if self.lowers:
                lower = LOWER[buf]
                data = lower.tobytes()
                buf = buf if any(s in data for s in self.special) else lower
            codes, begin, values, _ = word_codes(buf, offs, cut=mark_cuts(buf) if self.by_mark else None)
        else:
            values = pa.array([bytes(buf[a:b]).decode() for a, b in zip(offs[:-1], offs[1:])])
            codes, begin = np.arange(len(values)), np.arange(len(values) + 1)
        own = self.known.find(values.to_pylist(), self._ids)
        pool = np.frombuffer(b"".join([*own, self.end]), dtype="<u4")
        sizes = np.fromiter(map(len, own), dtype=np.int64, count=len(own)) // 4
        start = np.insert((np.cumsum(sizes) - sizes)[codes], begin[1:], len(pool) - 1)
        size = np.insert(sizes[codes], begin[1:], 1)
        flat = pool[spread(start, size)]
        return flat, np.concatenate([[0], np.cumsum(size)])[begin + np.arange(len(begin))]


class Packer:
    """Cuts a stream of documents into sequences.  What does not fill a sequence yet is carried on."""

    def __init__(self, length: int, first: int, id_type: pa.DataType):
        self.length, self.next = length, first
        self.rest = (pa.array([], id_type), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype="<u4"), np.zeros(1, dtype=np.int64))

    def add(self, names: pa.Array, flat: np.ndarray, offs: np.ndarray) -> pa.RecordBatch:
        ids, start, total, held, at = self.rest
        ids = pa.concat_arrays([ids, names])
        start = np.concatenate([start, np.zeros(len(names), dtype=np.int64)])
        total = np.concatenate([total, np.diff(offs)])
        flat, at = np.concatenate([held, flat]), np.concatenate([at, at[-1] + offs[1:]])
        full = len(flat) // self.length * self.length
        out = self._pieces(ids, start, total, flat, at, np.arange(0, full + 1, self.length))
        k = int(np.searchsorted(at, full, side="right")) - 1  # the part that goes on begins in this one
        if full == len(flat):
            self.rest = (ids.slice(len(ids)), start[:0], total[:0], flat[:0], at[:1] * 0)
        else:
            left = start[k:].copy()
            left[0] += full - at[k]
            self.rest = (ids.slice(k), left, total[k:], flat[full:].copy(), np.concatenate([[0], at[k + 1 :] - full]))
        return out

    def close(self) -> pa.RecordBatch:
        size = len(self.rest[3])
        cuts = [1 << b for b in range(size.bit_length() - 1, -1, -1) if size >> b & 1]
        return self._pieces(*self.rest, np.concatenate([[0], np.cumsum(cuts, dtype=np.int64)]).astype(np.int64))

    def _pieces(self, ids, start, total, flat, at, cuts) -> pa.RecordBatch:
        """Pieces up to the last of the cuts."""
        bounds = np.union1d(at[at < cuts[-1]], cuts).astype(np.int64)
        begin, size = bounds[:-1], np.diff(bounds)
        part, seq = np.searchsorted(at, begin, side="right") - 1, np.searchsorted(cuts, begin, side="right") - 1
        data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(bounds * 4), pa.py_buffer(np.ascontiguousarray(flat))])
        columns = [start[part] + begin - at[part], size, total[part], self.next + seq, begin - cuts[seq]]
        self.next += len(cuts) - 1
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(part)), *(pa.array(c.astype(np.int64)) for c in columns), data.cast(pa.binary())],
            names=["id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
        )


_WORKER: dict[str, TextIds] = {}  # the cache outlives a task


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: the id, start, length, doc_tokens, sequence_id, offset, ids (little-endian, four bytes an id).

    ``tokenizer``: path of a tokenizers .json file on the driver.  sequence_id is the range times 2^33 plus the number in the range.
    """
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    shared, worker = docs.sparkSession.sparkContext.broadcast(spec), uuid.uuid4().hex

    @F.arrow_udf("long")
    def place(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            found = [curve_key(buf, offs) for _, buf, offs in slices(texts)]
            yield pa.array(np.concatenate(found) if found else np.zeros(0, dtype=np.int64))

    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))
    own = own.select("id", "text", place("text").alias("key"), F.xxhash64("id", "row").alias("tie"))
    own = own.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie").select("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = None
        if worker not in _WORKER:
            _WORKER.clear()
            _WORKER[worker] = TextIds(shared.value, end)
        tokens = _WORKER[worker]
        for batch in batches:
            ids = batch.column(0)
            packer = packer or Packer(length, TaskContext.get().partitionId() << 33, ids.type)
            for row, buf, offs in slices(batch.column(1)):
                yield packer.add(ids.slice(row, len(offs) - 1), *tokens.slice_ids(buf, offs))
            pa.default_memory_pool().release_unused()
        if packer:
            yield packer.close()

    kind = docs.schema[id_col].dataType.simpleString()
    out = own.mapInArrow(run, f"id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
    return out.withColumnRenamed("id", id_col)


def pack_report(docs: DataFrame, tokenizer: str) -> DataFrame:
    out = pack(docs, tokenizer)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
