"""Benchmark decontamination: a broadcast hash set of normalised test windows.

Every benchmark item becomes its windows of ``width`` consecutive words (one shorter window for a
shorter item).  Document windows are hashed, looked up in the broadcast table of test windows,
and every hit is verified word by word.  Hit words, hit items and the verdict follow per
document, in one pass over the documents: the row of a document's first window always stays, the
others only if they hit, so only hits are shuffled (by document).  A test set of more than
``block_windows`` windows is looked up in blocks of that size, each a bounded broadcast.

Defined cases: a null or wordless text has no words and no hits; null doc_ids are documents like
any other; rows repeated in full each get their result; a null item_id hits but is not listed;
empty tables give no hits or no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ascii_lower, staged

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CASED_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WIDTH = 13
BLOCK_WINDOWS = 500_000


def words(text: Column) -> Column:
    """A-Z lower-cased words; null gives none."""
    parts = F.filter(F.split(ascii_lower(text), NOT_WORD), lambda w: w != "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def _window_hashes(hashes: Column, n: Column, width: int) -> Column:
    one = lambda i: F.xxhash64(F.lit(width), F.slice(hashes, i, F.lit(width)))
    return F.when(n >= width, F.transform(F.sequence(F.lit(1), n - (width - 1)), one)).otherwise(
        F.array().cast("array<bigint>")
    )


def test_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Distinct test windows: h, width, window (its words), items (sorted item_ids as strings)."""
    items = (
        benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("words"))
        .withColumn("n", F.size("words"))
        .where("n > 0")
        .withColumn("width", F.least("n", F.lit(width)))
        .withColumn("start", F.explode(F.sequence(F.lit(1), F.col("n") - F.col("width") + 1)))
        .withColumn("window", F.slice("words", F.col("start"), F.col("width")))
    )
    return (
        items.withColumn("h", F.xxhash64("width", F.transform("window", lambda w: F.xxhash64(w))))
        .groupBy("h", "width", "window")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )


test_windows.__test__ = False


def _lookup(hashed: DataFrame, widths: list[int], block: DataFrame, first_block: bool) -> DataFrame:
    """Rows (doc_id, th, n, first, span, items): each document's first row and its verified hits."""
    n = F.col("n")
    before, offsets = F.lit(0), {}
    for width in widths:
        offsets[width] = before
        before = before + F.greatest(n - (width - 1), F.lit(0))
    offset = reduce(lambda c, w: F.when(F.col("width") == w, offsets[w]).otherwise(c), widths, F.lit(0))
    start = (F.col("i") - offset).cast("int")
    hit = F.col("window").isNotNull() & (F.slice("words", start + 1, F.col("width")) == F.col("window"))
    first = F.coalesce(F.col("i"), F.lit(0)) == 0
    keep = (hit | first) if first_block else hit
    return (
        hashed.select("doc_id", "th", "n", "words", F.posexplode_outer("hashes").alias("i", "h"))
        .join(F.broadcast(block), "h", "left" if first_block else "inner")
        .where(keep)
        .select(
            "doc_id", "th", "n",
            (first if first_block else F.lit(False)).cast("long").alias("first"),
            F.when(hit, F.struct(start.alias("s"), (start + F.col("width")).alias("e"))).alias("span"),
            F.when(hit, F.col("items")).alias("items"),
        )
    )


def find_contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row per document: doc_id, th (hash of the text), n_words, n_hit, spans (merged word
    ranges [s, e)), items (sorted ids of the items with occurring windows)."""
    tests = staged(test_windows(benchmark, width), "test_windows")
    widths = [r[0] for r in tests.select("width").distinct().orderBy(F.desc("width")).collect()] or [width]  # <= width values
    n_blocks = max(1, -(-tests.count() // block_windows))
    # stage by stage, so that each array is made once
    hashed = (
        docs.select("doc_id", "text", words(F.col("text")).alias("words"))
        .withColumn("n", F.size("words"))
        .select("doc_id", F.xxhash64("text").alias("th"), "words", "n", F.transform("words", lambda w: F.xxhash64(w)).alias("wh"))
        .select("doc_id", "th", "words", "n", F.concat(*[_window_hashes(F.col("wh"), F.col("n"), w) for w in widths]).alias("hashes"))
    )
    block = lambda b: tests if n_blocks == 1 else tests.where(F.pmod("h", F.lit(n_blocks)) == b)
    rows = reduce(DataFrame.union, [_lookup(hashed, widths, block(b), b == 0) for b in range(n_blocks)])
    none = F.array().cast("array<struct<s:int,e:int>>")
    merge = lambda acc, x: F.when((F.size(acc) > 0) & (x["s"] <= F.get(acc, F.size(acc) - 1)["e"]), F.concat(
        F.slice(acc, F.lit(1), F.size(acc) - 1),
        F.array(F.struct(F.get(acc, F.size(acc) - 1)["s"].alias("s"), F.greatest(F.get(acc, F.size(acc) - 1)["e"], x["e"]).alias("e"))),
    )).otherwise(F.concat(acc, F.array(x)))
    return (
        rows.groupBy("doc_id", "th")
        .agg(
            F.max("n").alias("n_words"),
            F.sum("first").alias("copies"),
            F.sort_array(F.collect_set("span")).alias("raw"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
        .withColumn("spans", F.aggregate("raw", none, merge))
        .withColumn("n_hit", F.aggregate("spans", F.lit(0), lambda a, x: a + x["e"] - x["s"]))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select("doc_id", "th", F.col("n_words").cast("long").alias("n_words"), F.col("n_hit").cast("long").alias("n_hit"), "spans", "items")
    )


def is_contaminated() -> Column:
    """Some hit words, and at least one word in twenty."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", width: int = WIDTH) -> DataFrame:
    """``docs`` with its own columns: without contaminated documents, or with every hit word cut
    out of the texts (mode ``spans``; the characters between words stay)."""
    if mode not in ("documents", "spans"):
        raise ValueError("mode must be 'documents' or 'spans'")
    found = find_contamination(docs, benchmark, width)
    found = staged(
        (found.where(is_contaminated()) if mode == "documents" else found.where("n_hit > 0"))
        .select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), F.col("spans").alias("__spans")).distinct(),
        "contaminated",
    )
    same = docs["doc_id"].eqNullSafe(F.col("__id")) & (F.xxhash64(docs["text"]) == F.col("__th"))
    if mode == "documents":
        return docs.join(found, same, "left_anti")
    text = F.col("text")
    hit = lambda i: F.exists("__spans", lambda s: (s["s"] <= i) & (i < s["e"]))
    cased = F.regexp_extract_all(text, F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"), F.lit(1))
    kept = F.transform(cased, lambda w, i: F.when(hit(i), F.lit("")).otherwise(w))
    between = F.split(text, CASED_WORD, -1)
    joined = F.array_join(F.zip_with(between, kept, lambda b, w: F.concat(b, F.coalesce(w, F.lit("")))), "")
    cut = docs.join(found, same, "left").withColumn("__text", F.when(F.col("__spans").isNull(), text).otherwise(joined))
    return cut.select(*[F.col("__text").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])
