"""Line dedup by winnowing over word hashes, with every match carried past line ends.

A text is its words; a window is ``min_words`` words in a row, wherever its lines begin and end.  A window's
fingerprint is the least hash of the shorter runs (half as many words) inside it, so equal windows have equal
fingerprints, and neighbouring windows mostly share theirs: a text sends one mark for each stretch of windows
with the same fingerprint.  Only where a fingerprint stands at two places are the windows themselves sent;
they are joined on fingerprint and window hash with the first place in (doc_id, text hash, word) order, which
stays.  Later ones go, and their union is the whole repeated passage to the word, inside lines as well.  Every
word that goes stands at an earlier place that stays or has an earlier one itself.

Rows that are shuffled are marks and windows (hashes and positions), pre-aggregated per fingerprint, so a
passage that a third of all documents hold is one row per task.  Of texts that are equal as a whole only the
first one sends them; the others go.  Texts are cut in place: a line goes if all its words go, and keeps its
other words if some do.

Defined cases: words are what stands between white space, so how lines are broken or indented does not matter;
a blank line goes if the words before and after it do; a null text stays null and an empty one empty; null
doc_ids come last; rows repeated in full are one document, and each keeps what it keeps; within one document
a later window goes if it does not overlap the first; texts are read whole; empty tables and other columns
pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import BATCH_ROWS, sized_broadcast, staged

MIN_WORDS = 50
CHUNK = 1 << 17  # bytes of a text that are hashed at a time
MULTIPLIER = 0x9E3779B97F4A7C15
BYTES, PLACES = (np.random.default_rng(seed).integers(0, 2**64 - 1, size, np.uint64, True) | np.uint64(1) for seed, size in ((11, 256), (12, 1 << 17)))
WORD = re.compile(r"\S+")

MARK_COLUMNS = ["doc_id", "th", "marks"]
WINDOW_COLUMNS = ["doc_id", "th", "start", "fingerprint", "window"]


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of every word: its bytes and their places, summed and mixed; some ``CHUNK`` bytes at a time."""
    line = (" ".join(text.split()) + " ").encode("utf-8")
    if len(line) == 1:
        return np.empty(0, np.uint64)
    data = np.frombuffer(line, np.uint8)
    ends = np.flatnonzero(data == 32)
    starts = np.r_[0, ends[:-1] + 1]
    out, at = np.empty(len(starts), np.uint64), 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + CHUNK)))
        part = data[starts[at] : ends[stop - 1] + 1]
        firsts = (starts[at:stop] - starts[at]).astype(np.int32)
        place = np.arange(len(part), dtype=np.int32) - np.repeat(firsts, np.diff(np.append(firsts, len(part))))
        weight = PLACES[place & (len(PLACES) - 1)]
        if len(part) > CHUNK:  # a word that long
            weight = weight * (2 * (place // len(PLACES)).astype(np.uint64) + np.uint64(1))
        out[at:stop] = np.add.reduceat(BYTES[part] * weight, firsts)
        at = stop
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    both = []
    for x in (MULTIPLIER, pow(MULTIPLIER, -1, 1 << 64)):
        run = np.full(n, x, np.uint64)
        run[0] = 1
        both.append(np.cumprod(run))
    return both[0], both[1]


def run_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words."""
    ahead, back = _powers(1 << max(10, len(words).bit_length()))
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * ahead[: len(words)], out=sums[1:])
    x = (sums[width:] - sums[:-width]) * back[: len(words) - width + 1]
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        values, size = np.minimum(values[:-size], values[size:]), 2 * size
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def fingerprints(words: np.ndarray, min_words: int) -> np.ndarray:
    """The fingerprint of every window of a text with at least ``min_words`` words."""
    gram = (min_words + 1) // 2
    return sliding_least(run_hashes(words, gram), min_words - gram + 1)


def marks(prints: np.ndarray, min_words: int) -> np.ndarray:
    """One fingerprint for each stretch of windows; two if a stretch is longer than one place can make it."""
    starts = np.flatnonzero(np.r_[True, prints[1:] != prints[:-1]])
    lengths = np.diff(np.r_[starts, len(prints)])
    return np.repeat(prints[starts], np.where(lengths > min_words - (min_words + 1) // 2 + 1, 2, 1))


def repeated_windows(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, th (hash of the text), firsts, lasts (first words of the first and the last window of every
    unbroken row of windows that repeat an earlier place; -1 if the text does as a whole)."""
    rows = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("th"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, out = [], []
            for i, text in enumerate(batch["text"].to_pylist()):
                words = word_hashes(text)
                if len(words) >= min_words:
                    at.append(i)
                    out.append(marks(fingerprints(words, min_words), min_words).view(np.int64))
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch["doc_id"].take(at), batch["th"].take(at), pa.array(out, pa.list_(pa.int64()))], MARK_COLUMNS)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, cols = [], [[], [], []]
            for i, (text, wanted) in enumerate(zip(batch["text"].to_pylist(), batch["wanted"], strict=True)):
                words = word_hashes(text)
                prints = fingerprints(words, min_words)
                here = np.flatnonzero(np.isin(prints.view(np.int64), wanted.values.to_numpy(zero_copy_only=False)))
                at.append(np.full(len(here), i))
                for col, x in zip(cols, (here.astype(np.int32), prints[here].view(np.int64), run_hashes(words, min_words)[here].view(np.int64)), strict=True):
                    col.append(x)
            if at:
                where = pa.array(np.concatenate(at), pa.int64())
                arrays = [pa.array(np.concatenate(x)) for x in cols]
                yield pa.RecordBatch.from_arrays([batch["doc_id"].take(where), batch["th"].take(where), *arrays], WINDOW_COLUMNS)

    marked = staged(rows.mapInArrow(mark, f"doc_id {kind}, th long, marks array<long>"), "line_marks", BATCH_ROWS)
    row = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id")
    copied = marked.groupBy("th").agg(F.min(row).alias("least"), F.max(row).alias("most"))
    copied = copied.where(~F.col("least").eqNullSafe(F.col("most"))).select("th", F.col("least.doc_id").alias("__least"))
    copied = sized_broadcast(staged(copied, "line_copies").withColumn("__copied", F.lit(True)))
    marked = marked.join(copied, "th", "left").withColumn("copy", F.col("__copied").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("__least")))
    copies = marked.where("copy").select("doc_id", "th").distinct().withColumn("firsts", F.array(F.lit(-1))).withColumn("lasts", F.array(F.lit(-1)))
    sent = marked.where("not copy").select("doc_id", "th", F.explode("marks").alias("fingerprint"))
    twice = staged(sent.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fingerprint"), "line_twice")
    wanted = sent.join(sized_broadcast(twice), "fingerprint").groupBy("doc_id", "th").agg(F.collect_set("fingerprint").alias("wanted"))
    wanted = sized_broadcast(staged(wanted, "line_wanted").withColumnsRenamed({"doc_id": "__id", "th": "__th"}))
    asked = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("th") == F.col("__th"))).select("doc_id", "th", "text", "wanted")
    windows = staged(asked.mapInArrow(send, f"doc_id {kind}, th long, start int, fingerprint long, window long"), "line_windows", BATCH_ROWS)
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "th", "start")
    firsts = (
        windows.groupBy("fingerprint", "window")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("fingerprint", "window", "first")
    )
    same_doc = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("th") == F.col("first.th"))
    later = windows.join(firsts, ["fingerprint", "window"]).where(~same_doc | (F.col("start") >= F.col("first.start") + min_words))
    starts = F.col("starts")
    rows_of = lambda step: F.filter(starts, lambda x, i: ~F.get(starts, i + step).eqNullSafe(x + step))
    spans = later.groupBy("doc_id", "th").agg(F.sort_array(F.collect_set("start")).alias("starts"))
    return spans.select("doc_id", "th", rows_of(-1).alias("firsts"), rows_of(1).alias("lasts")).unionByName(copies)


def cut_text(text: str, firsts: np.ndarray, lasts: np.ndarray, min_words: int) -> tuple[str, int]:
    """``text`` without the windows that begin at words from one of ``firsts`` to its one of ``lasts``, and
    how many lines went."""
    lines = text.split("\n")
    sizes = [len(x.split()) for x in lines]
    edges = np.zeros(sum(sizes) + 1, np.int64)
    edges[firsts] = 1
    edges[lasts + min_words] -= 1
    gone = [True, *(np.cumsum(edges[:-1]) > 0).tolist(), True]  # as are the ends of the text
    kept, at = [], 1
    for line, size in zip(lines, sizes, strict=True):
        if not size:
            if not (gone[at - 1] and gone[at]):
                kept.append(line)
            continue
        flags = gone[at : at + size]
        at += size
        if True not in flags:
            kept.append(line)
        elif False in flags:
            parts, begun = [], None
            for m, flag in zip(WORD.finditer(line), flags, strict=True):
                if flag:
                    begun = None
                elif begun is None:
                    begun = m.start()
                    parts.append(m[0])
                else:
                    parts[-1] = line[begun : m.end()]
            kept.append(" ".join(parts))
    return "\n".join(kept), len(lines) - len(kept)


def _cut(min_words: int) -> Column:
    """struct<text, removed> of __cut_text, __firsts and __lasts."""

    @F.arrow_udf("struct<text: string, removed: long>")
    def cut(texts: pa.Array, firsts: pa.Array, lasts: pa.Array) -> pa.Array:
        out = []
        for text, *spans in zip(texts.to_pylist(), firsts, lasts, strict=True):
            out.append((None, None) if text is None else cut_text(text, *(x.values.to_numpy(zero_copy_only=False) for x in spans), min_words))
        kept, removed = zip(*out, strict=True) if out else ((), ())
        return pa.StructArray.from_arrays([pa.array(kept, pa.string()), pa.array(removed, pa.int64())], ["text", "removed"])

    # not to be repeated: Spark evaluates a deterministic function once more for a filter on n_removed, in other Python workers
    return cut.asNondeterministic()("__cut_text", "__firsts", "__lasts")


def drop_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with its own columns, texts without later repeated passages, and n_lines, n_removed
    (lines that went whole; named with a leading underscore pair)."""
    found = staged(repeated_windows(docs, min_words), "line_runs")
    found = sized_broadcast(found.select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), F.col("firsts").alias("__firsts"), F.col("lasts").alias("__lasts")))
    same = docs["doc_id"].eqNullSafe(F.col("__id")) & (F.xxhash64(docs["text"]) == F.col("__th"))
    whole = F.coalesce(F.element_at("__firsts", 1) < 0, F.lit(False))
    joined = docs.join(found, same, "left").withColumn("__cut_text", F.when(F.col("__firsts").isNotNull() & ~whole, F.col("text")))
    cut = joined.withColumn("__cut", _cut(min_words))
    n_lines = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(F.split("text", "\n", -1))).cast("long")
    removed = F.when(whole, n_lines).otherwise(F.coalesce("__cut.removed", F.lit(0).cast("long")))
    text = F.when(whole, F.lit("")).when(F.col("__firsts").isNotNull(), F.col("__cut.text")).otherwise(F.col("text"))
    columns = [text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return cut.select(*columns, n_lines.alias("__n_lines"), removed.alias("__n_removed"))
