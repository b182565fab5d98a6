"""Token counts by a two-tier lookup in the map tasks; no pre-token is ever shuffled.

A text is cut into pre-tokens at its blanks (a word goes with the space before it) and between letters and marks, and its token count is the sum of theirs.
Tier one is a compact hash table of frequent pre-tokens with their lengths, broadcast to all tasks; tier two is a cache in each
worker, filled by the tokenizer itself with what the table misses.  Each distinct pre-token of a slice of a batch is looked up
once.  The table is a cache as well: which pre-tokens it holds changes the speed and never a count.  It is filled from a bounded
sample of documents (``TABLE_DOCS``, by a hash of the text) and has at most ``TABLE_SIZE`` entries, so its broadcast has a fixed bound.

The byte-level pattern, which the tokenizer file names, takes a run of blanks before a word but for the last one by itself, and
the last one with the word if it is a space; so cuts there change nothing.  Texts with other white space than blanks or with
special strings of the tokenizer are encoded whole, as are all texts for a tokenizer of another kind.

Cases: NULL counts as empty (0 bytes, 0 tokens); long texts are never cut; repeated rows are counted alike; an empty table gives no
rows; further columns are kept, but one named like the result is replaced.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import others
from .vector import LATIN, Recent, byte_level, segment_codes, slices, sums

TABLE_DOCS = 2000
TABLE_SIZE = 32768
CACHE_SIZE = 300_000
CACHE_CHARS = 64
LIMIT = 1024
#: White space that is no blank, or that engines may class differently.
ODD_BLANKS = r"[\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"

LETTERS = re.compile(f" ?[{LATIN}]+")


class Counter:
    """Counts tokens in one Python worker.  ``spec``: text of a tokenizers .json file; ``table``: pre-tokens and their lengths."""

    def __init__(self, spec: str, table: dict[str, int]):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        self.tok = Tokenizer.from_str(spec)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.table = pa.array(list(table), pa.large_string())
        self.sizes = np.array([*table.values(), 0], dtype=np.int64)
        self.cache = Recent(CACHE_SIZE)
        conf = json.loads(spec)
        split = conf.get("pre_tokenizer") or {}
        self.model = conf["model"]["type"]
        self.splits = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True) and not conf.get("normalizer")
        self.odd = "|".join([ODD_BLANKS, *(re.escape(t["content"]) for t in conf.get("added_tokens", []))])

    def encoded(self, texts: list[str]) -> list[int]:
        return [len(code.ids) for code in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def sizes_of(self, pieces: list[str]) -> list[int]:
        """Tokens of pre-tokens; Latin letters, after a space or not, are spelled for the model as the byte-level step spells them."""
        plain = [self.splits and self.model == "BPE" and LETTERS.fullmatch(p) is not None for p in pieces]
        hard = iter(self.encoded([p for p, easy in zip(pieces, plain) if not easy]))
        tokenize = self.tok.model.tokenize
        return [len(tokenize(byte_level(p))) if easy else next(hard) for p, easy in zip(pieces, plain)]

    def lengths(self, pieces: pa.Array) -> np.ndarray:
        """Tokens of each pre-token."""
        at = pc.fill_null(pc.index_in(pieces, self.table), len(self.table)).to_numpy()
        out = self.sizes[at]
        missed = np.flatnonzero(at == len(self.table))
        out[missed] = self.cache.find(pieces.take(pa.array(missed)).to_pylist(), self.sizes_of, CACHE_CHARS)
        return out

    def whole(self, texts: pa.Array) -> np.ndarray:
        """Which texts the tokenizer itself must take."""
        if not self.splits:
            return np.ones(len(texts), dtype=bool)
        return pc.fill_null(pc.match_substring_regex(texts, self.odd), False).to_numpy(zero_copy_only=False)

    def counts(self, texts: pa.Array) -> np.ndarray:
        whole, out = self.whole(texts), np.zeros(len(texts), dtype=np.int64)
        if self.splits:
            for row, buf, offs in slices(texts):
                codes, begin, values = segment_codes(buf, offs)
                out[row : row + len(offs) - 1] = sums(self.lengths(values)[codes], begin)
        for k in np.flatnonzero(whole):
            text = texts[k].as_py()
            out[k] = self.encoded([text])[0] if text else 0
        return out


_WORKER: dict[str, Counter] = {}  # the caches outlive a task


def _counter(key: str, shared) -> Counter:
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Counter(*shared.value)
    return _WORKER[key]


def frequent_table(docs: DataFrame, spec: str, text_col: str = "text") -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of at most about ``TABLE_DOCS`` documents; the sample is counted in 8 tasks."""
    share = min(1.0, TABLE_DOCS / max(1, docs.count()))
    picked = docs.select(F.col(text_col).alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(share * (1 << 20)))

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, buf, offs in slices(batch.column(0)):
                codes, _, values = segment_codes(buf, offs)
                count = np.bincount(codes, minlength=len(values))
                best = np.argsort(-count, kind="stable")[:TABLE_SIZE]
                yield pa.RecordBatch.from_arrays([values.take(pa.array(best)).cast(pa.string()), pa.array(count[best])], names=["piece", "n"])

    pieces = picked.limit(2 * TABLE_DOCS).repartition(8).mapInArrow(top, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    names = [r.piece for r in pieces.where(F.length("piece") <= CACHE_CHARS).orderBy(F.desc("n"), "piece").limit(TABLE_SIZE).collect()]
    return dict(zip(names, Counter(spec, {}).encoded(names))) if names else {}


def count_tokens(docs: DataFrame, tokenizer: str, text_col: str = "text", out: str = "n_tokens") -> DataFrame:
    """``docs`` with the token count of each whole text.  ``tokenizer``: path of a tokenizers .json file on the driver."""
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    shared = docs.sparkSession.sparkContext.broadcast((spec, frequent_table(docs, spec, text_col)))
    key = uuid.uuid4().hex

    @F.arrow_udf("long")
    def count(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            yield pa.array(_counter(key, shared).counts(texts))

    return docs.select(*others(docs, out), count(F.col(text_col)).alias(out))


def token_report(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """Id, n_bytes, n_tokens and whether a document is over ``limit`` tokens."""
    own = docs.select(F.col(id_col), F.col(text_col))
    return count_tokens(own, tokenizer, text_col).select(
        id_col, F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_bytes"), "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
