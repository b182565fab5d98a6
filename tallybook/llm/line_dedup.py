"""Line dedup: overlapping three-line windows, repeated ones removed but for their first occurrence.

Lines are split at line feeds; blank, tab and carriage return at their ends do not count, blank lines are skipped (they
stay in the text).  Every three consecutive lines are a window.  How a text is broken into lines must not decide whether a
passage of more than ``LONG_WORDS`` words that repeats is found, so a run of fewer lines with so many words is a window as well; this is
one rule for all texts, whatever their length.  ``long_words=None`` leaves windows of three lines only.  Windows are hashed to 128 bits and
counted over all documents; the first occurrence (smallest id, then row, then position) stays.  A line is removed if a later
occurrence of a repeated window covers it.  The earliest copy of a line is never removed, as only a line that has an
earlier equal line can be covered by a later occurrence.

Built-in functions only.  A window in a third of all documents is combined in the map tasks before it is shuffled; its
occurrences go back by a join, which Spark may split.

Every row is a document of its own, with a key that is written with its text: rows without an id, or with one id, lose
their own repeated lines only.

Cases: a NULL text stays NULL, an empty one empty; documents of fewer than three lines have long windows at most; rows
without an id come last; ties of an id go by the row's place; an empty table gives no rows; further columns are kept, but those named like a result
(n_lines, n_removed) are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import TEXT_CODEC, WORD, free, freeze, others

LONG_WORDS = 50
_ENDS = " \t\r"


def line_windows(docs: DataFrame, row_col: str, id_col: str = "doc_id", text_col: str = "text", long_words: int | None = LONG_WORDS) -> DataFrame:
    """Rows (place, row, start, end, w1, w2): one per window; start and end are line positions in the whole text, places are in
    the order of occurrences.  ``docs`` have a key per row."""
    line = lambda x, i: F.struct(i.alias("p"), F.btrim(x, F.lit(_ENDS)).alias("t"))
    lines = F.filter(F.transform(F.split(text_col, "\n", -1), line), lambda s: s["t"] != "")
    hashed = F.transform(
        lines,
        lambda s: F.struct(
            s["p"].alias("p"), F.xxhash64(s["t"]).alias("a"), F.xxhash64(F.lit(1), s["t"]).alias("b"),
            F.regexp_count(s["t"], F.lit(WORD)).alias("n"),
        ),
    )
    h = docs.select(F.col(id_col).alias("id"), F.col(row_col).alias("row"), hashed.alias("h"))
    far = F.greatest(F.size("h"), F.lit(1))
    z = F.arrays_zip(F.col("h").alias("x"), F.slice("h", 2, far).alias("y"), F.slice("h", 3, far).alias("z"))

    def spans(s):
        x, y, w = s["x"], s["y"], s["z"]

        def span(parts, last, long):
            ok = last["p"].isNotNull()
            if long:
                ok = ok & (sum((p["n"] for p in parts[1:]), parts[0]["n"]) > long_words)
            return F.when(
                ok,
                F.struct(
                    x["p"].alias("start"), last["p"].alias("end"),
                    F.xxhash64(F.lit(len(parts)), *[p["a"] for p in parts]).alias("w1"),
                    F.xxhash64(F.lit(len(parts)), *[p["b"] for p in parts]).alias("w2"),
                ),
            )

        more = [span([x], x, True), span([x, y], y, True)] if long_words is not None else []
        return F.array(span([x, y, w], w, False), *more)

    exploded = h.select("id", "row", F.explode(F.flatten(F.transform(z, spans))).alias("s")).where("s is not null")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "row", F.col("s.start").alias("start"))
    return exploded.select(place.alias("place"), "row", "s.*")


def repeated_lines(windows: DataFrame) -> DataFrame:
    """Per row the positions covered by later occurrences of repeated windows, sorted: row, gone."""
    seen = windows.groupBy("w1", "w2").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = windows.join(seen.drop("n"), ["w1", "w2"]).where("place > first").select("row", "start", "end").distinct()
    return later.groupBy("row").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.sequence("start", "end"))))).alias("gone")
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", long_words: int | None = LONG_WORDS) -> DataFrame:
    """``docs`` with repeated lines taken out of the text, plus n_lines and n_removed (of lines in the old text)."""
    row, gone, lines = free(docs, "_row"), free(docs, "_gone"), free(docs, "_lines")
    held = freeze(docs.withColumn(row, F.monotonically_increasing_id()), "line-rows", TEXT_CODEC)
    found = repeated_lines(line_windows(held, row, id_col, text_col, long_words)).toDF(row, gone)
    # the text travels as its lines: split once, below the join
    split = held.withColumn(lines, F.split(text_col, "\n", -1)).drop(text_col)
    both = split.join(found, row, "left")
    # stretches between removed lines: each line is copied once, however many are removed
    ends = F.concat(F.array(F.lit(-1)), F.col(gone), F.array(F.size(lines)))
    pairs = F.arrays_zip(ends.alias("a"), F.slice(ends, 2, F.size(gone) + 1).alias("b"))
    kept = F.transform(pairs, lambda s: F.slice(F.col(lines), s["a"] + 2, F.coalesce(s["b"] - s["a"], F.lit(1)) - 1))
    new = F.array_join(F.when(F.col(gone).isNull(), F.col(lines)).otherwise(F.flatten(kept)), "\n")
    rest = others(docs, "n_lines", "n_removed")
    names = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    return both.select(
        *[new.alias(c) if c == text_col else x for c, x in zip(names, rest)],
        F.when(F.col(lines).isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce(F.when(F.col(gone).isNotNull(), F.size(gone)), F.lit(0)).cast("long").alias("n_removed"),
    )
