"""N-gram Jaccard join as a blocked sparse matrix product.

Rows of the incidence matrix are distinct n-gram sets (documents with equal sets are one row), columns
are n-gram hashes.  Columns stand in one global order, frequent ones last (any order gives whole results;
this one keeps rare columns in front).  If two sets reach the threshold, their first ``k`` common n-grams
lie in the leading columns of both, whose number follows from the set's size.  Only leading columns that
two rows of like size share are kept, and a row with too few of them is linked with nothing and goes.

Columns with the same first row form a block of the product, with the rows that hold any of them: two linked
rows share a leading column, so they meet in its block.  Rows first meet with the leading columns that others
hold too; whole sets go only to rows that have enough of these in common with another one, and of the blocks
that the two share only to the first.  A task multiplies them (columns in strips,
overlaps accumulated), so its counts are final and pairs below the threshold end there.  What leaves the task is a forest of its links, less than a row per row.  Large blocks are
cut into tiles by size class and hash; two tiles meet if their sizes allow a link, and every tile holds a
bounded number of rows and n-grams (one row at least), so a hot column costs work in pairs of tiles, not memory.

Defined cases: a null or wordless text has no n-grams and is linked with nothing (its component is its own
doc_id); fewer than ``n`` words are one n-gram; rows repeated in full fall in one class; a null doc_id is
linked like any other and never names a component unless all of its component are null; other columns are
ignored.  Sets are compared by 64-bit n-gram hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ledgerline.llm.common import BATCH_ROWS, checked_broadcast, staged

N = 5
PERCENT = 80  # threshold, in hundredths
LEAD = 8  # common n-grams asked for among the leading columns,
LEAD_SHARE = 32  # or one in so many of a larger set
LOCAL_COUNT = 3  # a column's count is reported by a chunk of documents from this on
FREQUENT_LEAST = 8  # columns with at least so many counted rows come last in the order
MAX_FREQUENT = 2_000_000  # and at most so many, the most frequent
CHUNK = 4_000_000
CORE_ROUNDS = 2
TILE_ROWS = 1024  # rows of a tile of a block, and their n-grams together
TILE_CELLS = 1_000_000
TILE_KEY = ["first", "lo", "hi"]  # of a pair of tiles: the block, and both tiles
STRIP = 4_000_000  # numbers of the dense strip of a tile's matrix
SEND_ROWS = 10_000  # rows that leave a task at a time
CACHE = 50_000  # words; a larger one costs a task more memory and no less time


class WordHashes(dict):
    """Word -> 64-bit hash, a cache of bounded size."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE:
            self.clear()
        out = self[word] = xxhash.xxh64_intdigest(word)
        return out


def ngram_set(text: str | None, hashes: WordHashes, n: int = N) -> np.ndarray:
    """Sorted distinct hashes of a text's word n-grams; one of the whole sequence if it is shorter."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter([hashes[w] for w in words], np.uint64, len(words))
    width = min(n, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for i in range(width):
        out = (out ^ h[i : len(h) - width + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *(len(a) for a in arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), _signed(flat))


def repeated(values: np.ndarray) -> pa.RecordBatch:
    """token, n of the ``values`` that come ``LOCAL_COUNT`` times or more.  Sorts them where they are, so that
    a task holds its chunk once."""
    values.sort()
    far = LOCAL_COUNT - 1
    many = values[far:] == values[: len(values) - far]
    many[1:] &= values[1 : len(many)] != values[: max(0, len(many) - 1)]  # where a run begins
    tokens = values[: len(many)][many]
    times = np.searchsorted(values, tokens, "right") - np.searchsorted(values, tokens, "left")
    return pa.RecordBatch.from_arrays([_signed(tokens), pa.array(times.astype(np.int64))], ["token", "n"])


def frequent_columns(docs: DataFrame, n: int = N) -> DataFrame:
    """n-gram hashes that several rows hold, the most frequent first, from counts over all documents.
    Columns that stay below ``LOCAL_COUNT`` in every chunk are not reported, and those beyond
    ``MAX_FREQUENT`` are left out; they only keep their place in the order."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, size = WordHashes(), np.empty(CHUNK, np.uint64), 0
        for batch in batches:
            for text in batch["text"].to_pylist():
                columns = ngram_set(text, hashes, n)
                if size + len(columns) > len(held):
                    yield repeated(held[:size])
                    size = 0
                    if len(columns) > len(held):
                        held = np.empty(len(columns), np.uint64)
                held[size : size + len(columns)] = columns
                size += len(columns)
        if size:
            yield repeated(held[:size])

    counted = docs.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    counted = staged(counted.where(F.col("n") >= FREQUENT_LEAST), "frequent", BATCH_ROWS)
    # the counts that at most MAX_FREQUENT columns reach; the order may hold any set of columns
    least, held = FREQUENT_LEAST, counted.count()
    while held > MAX_FREQUENT:
        least *= 2
        held = counted.where(F.col("n") >= least).count()
    return counted.where(F.col("n") >= least)


def common_asked(size: int, percent: int, lead: int) -> int:
    """Leading columns that a set of this size has in common with every larger one it is linked with, at least."""
    return max(1, min(max(lead, size // LEAD_SHARE), -(-size * percent // 100)))


def lead_length(size: int, percent: int, lead: int) -> tuple[int, int]:
    """Leading columns of a set of this size, and the common ones that a linked set has at least among the
    leading columns of both: those that the smallest set it may be linked with asks for."""
    least = -(-size * percent // 100)
    return size - least + common_asked(size, percent, lead), common_asked(least, percent, lead)


def incidence(docs: DataFrame, frequent: Broadcast, n: int, percent: int, lead: int) -> DataFrame:
    """doc_id, text_hash, size, row (hash of the whole set), k (common columns asked for), rare and often
    (leading columns) per document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, (last, place) = WordHashes(), frequent.value
        for batch in batches:
            sizes, names, rare, common, asked = [], [], [], [], []
            for text in batch["text"].to_pylist():
                columns = ngram_set(text, hashes, n)
                length, k = lead_length(len(columns), percent, lead) if len(columns) else (0, 0)
                names.append(xxhash.xxh64_intdigest(columns.tobytes()) if len(columns) else 0)
                head, tail = columns, columns[:0]
                if len(columns) and len(last):
                    at = np.searchsorted(last, columns)
                    at = np.minimum(at, len(last) - 1)
                    often = last[at] == columns
                    head, tail = columns[~often], columns[often][np.argsort(place[at[often]], kind="stable")]
                sizes.append(len(columns))
                rare.append(head[:length])
                common.append(tail[: max(0, length - len(head))])
                asked.append(k)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_hash"], pa.array(sizes, pa.int64()), _signed(np.array(names, np.uint64)), pa.array(asked, pa.int32()), _lists(rare), _lists(common)],
                ["doc_id", "text_hash", "size", "row", "k", "rare", "often"],
            )

    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return texts.mapInArrow(rows, f"doc_id {kind}, text_hash long, size long, row long, k int, rare array<long>, often array<long>")


def components(links: DataFrame) -> DataFrame:
    """node, component (smallest node reached) of the nodes of ``links`` (a, b): every node hangs itself
    and its larger neighbours on its smallest one, then its smaller ones, until nothing moves."""
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "cc_edges")
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = staged(large, "cc_large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(least, "u")
        small = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).union(tied.select("u", F.col("m").alias("v")))
        small = staged(small.where("u <> v").distinct(), "cc_small")
        # a forest of stars is the fixed point: no node both hangs on another and is hung on
        done = small.join(small.select(F.col("u").alias("v")).distinct(), "v", "left_semi").isEmpty()
        edges = small
        if done and small.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all ``sets`` with each other: the product of their incidence matrix
    with its transpose, accumulated over strips of the columns that two of them share."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], (np.cumsum(count > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width = max(1, STRIP // len(sets))
    kind = np.float32 if max(map(len, sets)) < 1 << 24 else np.float64  # whole numbers are exact up to 2^24
    out = np.zeros((len(sets), len(sets)), kind)
    for least in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [least, least + width])
        strip = np.zeros((len(sets), min(width, int(column[-1]) + 1 - least)), kind)
        strip[owner[lo:hi], column[lo:hi] - least] = 1
        out += strip @ strip.T
    return out


def forest(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set the smallest place of a set that links within ``sets`` reach."""
    label = np.arange(len(sets))
    if len(sets) == 2:
        a, b = sets
        common = len(np.intersect1d(a, b, assume_unique=True))
        return label * (100 * common < percent * (len(a) + len(b) - common))
    common, size = overlaps(sets), np.array([len(s) for s in sets])
    left, right = [], []
    for least in range(0, len(sets), 256):
        part = common[least : least + 256].astype(np.int64)
        i, j = np.nonzero(100 * part >= percent * (size[least : least + 256, None] + size[None] - part))
        later = j > i + least
        left.append(i[later] + least)
        right.append(j[later])
    i, j = np.concatenate(left), np.concatenate(right)
    while True:
        before, least = label.copy(), np.minimum(label[i], label[j])
        np.minimum.at(label, i, least)
        np.minimum.at(label, j, least)
        label = label[label]
        if np.array_equal(before, label):
            return label


def may_link(first: int, blocks: list[np.ndarray], leading: list[np.ndarray], sizes: list[int], tiles: list[int], percent: int, lead: int) -> np.ndarray:
    """For each row of a pair of tiles of the block ``first`` whether its set is needed there, from the ``leading``
    columns in all its ``blocks``.  Two rows are left to the first block that both are in, and there to the pair of
    tiles that tells them apart."""
    size = np.array(sizes, np.int64)
    asked = np.array([common_asked(s, percent, lead) for s in sizes], np.int64)
    met = overlaps(leading) >= np.minimum.outer(asked, asked)
    met &= 100 * np.minimum.outer(size, size) >= percent * np.maximum.outer(size, size)
    if len(apart := np.unique(tiles)) > 1:
        met &= np.not_equal.outer(*[np.searchsorted(apart, tiles)] * 2)
    owner, block = np.repeat(np.arange(len(blocks)), [len(b) for b in blocks]), np.concatenate(blocks)
    owner, block = owner[block < first], block[block < first]
    order = np.argsort(block, kind="stable")
    for rows in np.split(owner[order], np.flatnonzero(np.diff(block[order])) + 1):
        if len(rows) > 1:
            met[np.ix_(rows, rows)] = False
    np.fill_diagonal(met, False)
    return met.any(axis=1)


def by_tiles(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """The key of one pair of tiles after another, and its rows' columns ``names``, lists as arrays."""
    key, rows = None, []
    for batch in batches:
        columns = []
        for column in (batch[c] for c in names):
            if pa.types.is_list(column.type):
                values, ends = column.values.to_numpy(), column.offsets.to_numpy()
                columns.append([values[i:j] for i, j in zip(ends[:-1], ends[1:], strict=True)])
            else:
                columns.append(column.to_pylist())
        keys = zip(*(batch[c].to_pylist() for c in TILE_KEY), strict=True)
        for now, *row in zip(keys, *columns, strict=True):
            if now != key:
                if rows:
                    yield key, [*zip(*rows, strict=True)]
                key, rows = now, []
            rows.append(row)
    if rows:
        yield key, [*zip(*rows, strict=True)]


class Product:
    """The incidence matrix of ``docs`` and the steps of its product with itself."""

    def __init__(self, docs: DataFrame, n: int, percent: int, lead: int):
        self.docs, self.n, self.percent, self.lead = docs.select("doc_id", "text"), n, percent, lead
        self.base = 1.001 * 100 / percent  # of the size classes: more than the ratio that linked sizes can have
        spark = docs.sparkSession
        frequent = frequent_columns(docs, n).toArrow()  # at most MAX_FREQUENT
        tokens = frequent["token"].to_numpy().astype(np.int64).view(np.uint64)
        order = np.argsort(tokens)
        shared = spark.sparkContext.broadcast((tokens[order], frequent["n"].to_numpy().astype(np.int64)[order]))
        self.rows = staged(incidence(self.docs, shared, n, percent, lead), "incidence", BATCH_ROWS)
        first = [F.first(c).alias(c) for c in ("size", "k", "rare", "often")]
        sets = self.rows.where("size > 0").groupBy("row").agg(F.min("doc_id").alias("doc_id"), *first)
        sets = staged(sets.withColumnRenamed("row", "hash"), "incidence_rows")
        # a row is named by its smallest doc_id, so that a column's first row is the oldest text; by its
        # hash if the doc_id is null, no whole number, or names several rows
        name = F.col("hash")
        if isinstance(self.docs.schema["doc_id"].dataType, IntegralType):
            several = sets.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("twice"))
            sets = sets.join(checked_broadcast(staged(several, "several")), F.col("doc_id") == F.col("twice"), "left")
            name = F.coalesce(F.when(F.col("twice").isNull(), F.col("doc_id").cast("long")), name)
        sets = sets.withColumn("row", name)
        self.sets = sets.select("row", "hash", "doc_id", "size", "k")
        self.cells = self._cells(sets)

    def _cells(self, sets: DataFrame) -> DataFrame:
        """row, first: the rows of every block, which is named by the first row of its columns.  Frequent
        columns, of which one may hold a third of all rows, are aggregated before they move."""
        token = Window.partitionBy("token")
        rare = sets.select("row", F.explode("rare").alias("token"))
        rare = rare.select("row", "token", F.min("row").over(token).alias("first"), F.max("row").over(token).alias("last")).where("first <> last")
        often = sets.select("row", F.explode("often").alias("token"))
        firsts = often.groupBy("token").agg(F.min("row").alias("first"), F.max("row").alias("last")).where("first <> last")
        often = often.join(checked_broadcast(staged(firsts.select("token", "first"), "columns")), "token")
        cells = rare.select("row", "first", "token").union(often.select("row", "first", "token"))
        cells = cells.groupBy("row", "first").agg(F.collect_list("token").alias("leading")).join(self.sets.select("row", "size", "k"), "row")
        cells = cells.withColumn("held", F.size("leading")).withColumn("level", F.floor(F.log("size") / math.log(self.base)))
        cells = staged(cells, "cells")
        self.leading = cells.select("row", "first", "leading", "size")
        cells = cells.drop("leading")
        for _ in range(CORE_ROUNDS):
            cells = self._core(cells)
        return cells

    def _core(self, cells: DataFrame) -> DataFrame:
        """Cells without those of rows that meet no row of a like size in a block, and without the rows that
        then share fewer than ``k`` leading columns with all others together: they are linked with nothing."""
        levels = cells.groupBy("first", "level").agg(F.count(F.lit(1)).alias("n"), F.min("size").alias("low"), F.max("size").alias("high"))
        block = Window.partitionBy("first").orderBy("level")  # a row per size class
        below = F.when(F.lag("level").over(block) == F.col("level") - 1, F.lag("high").over(block))
        above = F.when(F.lead("level").over(block) == F.col("level") + 1, F.lead("low").over(block))
        levels = checked_broadcast(staged(levels.select("first", "level", "n", below.alias("below"), above.alias("above")), "levels"))
        meets = (F.col("n") > 1) | (F.col("below") * 100 >= F.col("size") * self.percent) | (F.col("size") * 100 >= F.col("above") * self.percent)
        met = cells.join(levels, ["first", "level"]).where(meets).select(*cells.columns)
        core = met.groupBy("row").agg(F.sum("held").alias("all"), F.first("k").alias("k")).where("all >= k").select("row")
        return staged(met.join(checked_broadcast(staged(core, "core")), "row", "left_semi"), "core_cells")

    def tiles(self) -> DataFrame:
        """first, lo, hi, tile, row: the rows of every pair of tiles, and the tile they are of.  A block within a tile's bounds is one; a larger
        one is cut by size class and by hash."""
        blocks = self.cells.groupBy("first").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("cells")).where("n > 1")
        large = (F.col("n") > TILE_ROWS) | (F.col("cells") > TILE_CELLS)
        cells = staged(self.cells.join(blocks.select("first", large.alias("large")), "first"), "blocks")
        small = cells.where("not large").select("first", *(F.lit(0).cast("long").alias(c) for c in ("lo", "hi", "tile")), "row")
        cells = cells.where("large")
        cuts = F.greatest(F.ceil(F.count(F.lit(1)) / TILE_ROWS), F.ceil(F.sum("size") / TILE_CELLS))
        cuts = staged(cells.groupBy("first", "level").agg(cuts.alias("cuts")), "cuts")
        tile = lambda level, cut: F.shiftleft(level, 40) + cut
        own = cells.join(cuts, ["first", "level"]).withColumn("tile", tile(F.col("level"), F.pmod(F.xxhash64("row"), F.col("cuts"))))
        own = own.select("first", "row", "tile", F.explode(F.array(F.col("level") - 1, F.col("level"), F.col("level") + 1)).alias("level"))
        met = own.join(cuts, ["first", "level"]).select("first", "row", "tile", "level", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)).alias("cut"))
        other = tile(F.col("level"), F.col("cut"))
        return small.union(met.select("first", F.least("tile", other).alias("lo"), F.greatest("tile", other).alias("hi"), "tile", "row"))

    def met(self, tiles: DataFrame) -> DataFrame:
        """first, lo, hi, row: the rows of ``tiles`` that may link there, as told from their leading columns."""
        lists = self.leading.join(checked_broadcast(tiles.select("row").distinct()), "row", "left_semi")
        lists = lists.groupBy("row").agg(F.first("size").alias("size"), F.collect_list(F.struct("first", "leading")).alias("own"))
        lists = lists.select("row", "size", F.col("own.first").alias("blocks"), F.flatten("own.leading").alias("leading"))
        percent, lead = self.percent, self.lead

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found, size = [[np.empty(0, np.int64)] for _ in range(4)], 0
            for key, (rows, tile, sizes, blocks, leading) in by_tiles(batches, ["row", "tile", "size", "blocks", "leading"]):
                if len(rows) < 2:
                    continue
                here = np.array(rows, np.int64)[may_link(key[0], blocks, leading, sizes, tile, percent, lead)]
                for column, values in zip(found, (*(np.full(len(here), k) for k in key), here), strict=True):
                    column.append(values)
                size += len(here)
                if size >= SEND_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in found], [*TILE_KEY, "row"])
                    found, size = [[np.empty(0, np.int64)] for _ in range(4)], 0
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in found], [*TILE_KEY, "row"])

        asked = tiles.join(lists, "row").select(*TILE_KEY, "tile", "row", "size", "blocks", "leading")
        asked = asked.repartition(*TILE_KEY).sortWithinPartitions(*TILE_KEY)
        return asked.mapInArrow(choose, "first long, lo long, hi long, row long")

    def whole_sets(self, asked: DataFrame) -> DataFrame:
        """row, columns: the whole sets of the rows asked for, made anew from their texts."""
        asked = staged(self.sets.select("row", "hash", "doc_id").join(asked, "row", "left_semi"), "asked")
        names = checked_broadcast(asked.select(F.col("doc_id").alias("name")).distinct())
        texts = self.docs.join(names, self.docs["doc_id"].eqNullSafe(names["name"]), "left_semi")
        n = self.n

        def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes = WordHashes()
            for batch in batches:
                sets = [ngram_set(t, hashes, n) for t in batch["text"].to_pylist()]
                sets = [s for s in sets if len(s)]
                name = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64)
                yield pa.RecordBatch.from_arrays([_signed(name), _lists(sets)], ["hash", "columns"])

        made = texts.select("text").mapInArrow(make, "hash long, columns array<long>")
        made = made.join(checked_broadcast(asked.select("hash", "row")), "hash")
        return made.groupBy("row").agg(F.first("columns").alias("columns"))

    def links(self) -> DataFrame:
        """a, b: rows that links reach from each other, enough to give every component of the whole join."""
        tiles = staged(self.met(staged(self.tiles(), "tiles")), "met", BATCH_ROWS)
        sets = staged(self.whole_sets(tiles.select("row").distinct()), "sets", BATCH_ROWS)
        percent = self.percent

        def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found, size = [[np.empty(0, np.int64)] for _ in range(2)], 0
            for _, (rows, sets) in by_tiles(batches, ["row", "columns"]):
                if len(rows) < 2:
                    continue
                names, label = np.array(rows, np.int64), forest(list(sets), percent)
                moved = label != np.arange(len(sets))
                for column, values in zip(found, (names[moved], names[label[moved]]), strict=True):
                    column.append(values)
                size += moved.sum()
                if size >= SEND_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in found], ["a", "b"])
                    found, size = [[np.empty(0, np.int64)] for _ in range(2)], 0
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in found], ["a", "b"])

        blocks = tiles.join(sets, "row").select(*TILE_KEY, "row", "columns").repartition(*TILE_KEY).sortWithinPartitions(*TILE_KEY)
        return staged(blocks.mapInArrow(multiply, "a long, b long"), "links", BATCH_ROWS)


def jaccard_components(docs: DataFrame, n: int = N, percent: int = PERCENT, lead: int = LEAD) -> DataFrame:
    """doc_id, n_shingles, component_id per document: the smallest doc_id that links reach."""
    product = Product(docs, n, percent, lead)
    classes = staged(components(product.links()), "classes_all")
    named = product.sets.select("row", "doc_id").join(classes.withColumnRenamed("node", "row"), "row")
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("smallest"))
    named = named.join(smallest, "component").select("row", "smallest")
    firsts = product.sets.select("row", "hash", F.col("doc_id").alias("own")).join(named, "row", "left")
    firsts = firsts.select("hash", F.coalesce("smallest", "own").alias("component_id"))
    rows = product.rows.select("doc_id", "size", F.when(F.col("size") > 0, F.col("row")).alias("hash"))
    return rows.join(firsts, "hash", "left").select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component, that of its smallest doc_id (null comes last), then text hash.
    Rows are told apart by doc_id and text, so a row goes only if its own text is linked with the one that
    stays: other texts under a repeated doc_id, and rows without n-grams, stay.  Of rows that share the doc_id
    and text kept one stays, the first by its other columns."""
    product = Product(docs, n, percent, LEAD)
    classes = staged(components(product.links()), "classes_all")
    named = product.sets.select("row", "hash").join(classes.withColumnRenamed("node", "row"), "row", "left")
    named = named.select("hash", F.coalesce("component", "row").alias("component"))
    rows = product.rows.where("size > 0").select(F.col("row").alias("hash"), "doc_id", "text_hash")
    row = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_hash")
    sets = staged(rows.groupBy("hash").agg(F.min(row).alias("least"), F.count(F.lit(1)).alias("held")), "set_firsts").join(named, "hash")
    firsts = sets.groupBy("component").agg(F.min("least").alias("stays"), F.sum("held").alias("held")).where("held > 1")
    stays = staged(sets.join(firsts.select("component", "stays"), "component").select("hash", "stays"), "stays")
    member = rows.join(checked_broadcast(stays), "hash")
    same = F.col("doc_id").eqNullSafe(F.col("stays.doc_id")) & (F.col("text_hash") == F.col("stays.text_hash"))
    name = [F.col("doc_id").alias("__id"), F.col("text_hash").alias("__text")]
    counted = staged(member.groupBy("doc_id", "text_hash", same.alias("same")).agg(F.count(F.lit(1)).alias("held")), "near_duplicates")
    gone = staged(counted.where("not same").select(*name), "gone")
    again = staged(counted.where("same and held > 1").select(*name), "again")
    is_of = lambda left, right: left["doc_id"].eqNullSafe(right["__id"]) & (F.xxhash64(left["text"]) == right["__text"])
    kept = docs.join(checked_broadcast(gone), is_of(docs, gone), "left_anti")
    if again.isEmpty():
        return kept
    again = checked_broadcast(again)
    twice, once = (kept.join(again, is_of(kept, again), how) for how in ("left_semi", "left_anti"))
    others = [f"`{c}`" for c in docs.columns if c not in ("doc_id", "text")]
    one = twice.groupBy("doc_id", "text").agg(F.min(F.struct(F.lit(0).alias("__0"), *others)).alias("__r"))
    return once.unionByName(one.select("doc_id", "text", "__r.*").select(*[f"`{c}`" for c in docs.columns]))
