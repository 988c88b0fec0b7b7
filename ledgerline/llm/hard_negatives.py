"""Hard negatives by a BOND vertical scan.

Scores are integer inner products of vectors whose components are scaled and rounded down.  An
anchor's positives are its best other rows of the same label; for each positive the best rows of
other labels whose score lies in the window from ``low_percent`` to 100 per cent of the positive's
score are its hard negatives.

Rows are dealt by hash into blocks of ``block_rows``, kept by column, and the anchors into blocks of
``block_anchors``; a task holds one block of each, whatever the label, so a label with a third of all
rows is dealt like any other.  Within a block each anchor reads the dimensions in descending order of
its own magnitudes.  What the dimensions not yet read can still add lies between sums of the column's
least and greatest contributions; a candidate that cannot come among the best any more, or cannot reach
a window, leaves the anchor's candidate bitmap, until the scores of what is left are exact.  The scan
runs twice, for the positives and for the windows that follow from them; at most ``k`` rows of a block
and anchor (or window) leave a task.

Every anchor meets every row, as the question asks: with blocks of B rows and A anchors the rows travel
anchors / A times and the anchors rows / B times, so the traffic falls as the blocks grow.

Defined cases: rows whose id, label or vector is null, whose vector is empty, holds null or non-finite
components or has another length than the most common one, take no part; an id that comes more than
once counts once, with its least (label, vector); ties go to the smaller id; a window without rows, an
anchor without positives and an empty table give no rows; other columns are ignored.  Scores are exact;
a scaled component or a score beyond 64 bits fails.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import staged

BLOCK_ROWS = 8_192
BLOCK_ANCHORS = 8_192
READ_FIRST = 8  # dimensions read before the bitmap is first looked at
READ_NEXT = 4  # and between later looks
SEED = 29


def prepared(vectors: DataFrame, id_col: str, label_col: str, vec_col: str, scale: int, relabel: Column | None) -> DataFrame:
    """id, label, vec (array of long) of the rows that take part, one per id."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("vec"))
    good = F.size("vec") > 0
    good &= ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull()).where(good)
    if relabel is not None:
        rows = rows.withColumn("label", relabel)
    rows = rows.withColumn("vec", F.transform("vec", lambda x: F.floor(x * scale)))
    one = rows.groupBy("id").agg(F.min(F.struct("label", "vec")).alias("r")).select("id", "r.label", "r.vec")
    one = staged(one, "hard_vectors")
    top = one.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    return one.where(F.size("vec") == (top[0]["dim"] if top else 0))


def matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(rows, -1)


class Block:
    """Rows kept by column, with each column's least and greatest value."""

    def __init__(self, table: pa.Table, biggest: int):
        self.ids = table["id"].to_numpy()
        self.labels = np.asarray(table["label"].to_pylist())
        vecs = matrix(table["vec"], len(self.ids))
        # Python integers where the bounds might pass 64 bits
        self.kind = np.int64 if biggest * biggest * vecs.shape[1] < 1 << 61 else object
        self.cols = np.ascontiguousarray(vecs.T).astype(self.kind)
        self.least, self.most = self.cols.min(axis=1), self.cols.max(axis=1)

    def scan(self, anchor: np.ndarray, candidates: np.ndarray, ranges):
        """Read dimension after dimension; ``ranges(partial, low, high)`` gives the [from, to] ranges of
        partial sums that can still matter when between ``low`` and ``high`` is to come.  Returns the
        candidates left and their exact scores."""
        anchor = anchor.astype(self.kind)
        order = np.argsort(-np.abs(anchor), kind="stable")
        one, two = anchor * self.least, anchor * self.most
        low = np.r_[np.cumsum(np.minimum(one, two)[order][::-1])[::-1], 0]  # still to come before each step
        high = np.r_[np.cumsum(np.maximum(one, two)[order][::-1])[::-1], 0]
        partial = np.zeros(len(candidates), self.kind)
        whole = len(candidates) == self.cols.shape[1]
        for step, d in enumerate(order, 1):
            if not len(candidates):
                break
            if anchor[d]:
                partial += anchor[d] * (self.cols[d] if whole else self.cols[d][candidates])
            if (step >= READ_FIRST and (step - READ_FIRST) % READ_NEXT == 0) or step == len(order):
                keep = np.zeros(len(candidates), bool)
                for a, b in ranges(partial, low[step], high[step]):
                    keep |= (partial >= a) & (partial <= b)
                if not keep.all():
                    candidates, partial, whole = candidates[keep], partial[keep], False
        return candidates, partial


def kth_best(values: np.ndarray, k: int):
    """The k-th largest value, or None where there are fewer."""
    if len(values) < k:
        return None
    return np.partition(values, len(values) - k)[len(values) - k] if values.dtype != object else sorted(values)[-k]


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by smaller id."""
    if scores.dtype == object:
        return np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k], dtype=int)
    return np.lexsort((ids, -scores))[:k]


def positives_of_block(block: Block, anchors: pa.Table, k: int) -> pa.Table:
    out: list[tuple] = []
    vecs, labels = matrix(anchors["vec"], len(anchors)), anchors["label"].to_pylist()
    for name, label, vec in zip(anchors["id"].to_pylist(), labels, vecs, strict=True):
        start = np.flatnonzero((block.labels == label) & (block.ids != name))

        def among_best(partial, low, high):
            floor = kth_best(partial, k)
            top = partial.max()
            return [(partial.min() if floor is None else floor + low - high, top)]

        rows, scores = block.scan(vec, start, among_best)
        for i in best(block.ids[rows], scores, k):
            out.append((name, int(block.ids[rows[i]]), int(scores[i])))
    names = ["anchor_id", "row_id", "score"]
    return pa.table({n: pa.array([r[i] for r in out], pa.int64()) for i, n in enumerate(names)})


def negatives_of_block(block: Block, anchors: pa.Table, k: int, low_percent: int) -> pa.Table:
    out: list[tuple] = []
    vecs, labels = matrix(anchors["vec"], len(anchors)), anchors["label"].to_pylist()
    for name, label, vec, near in zip(anchors["id"].to_pylist(), labels, vecs, anchors["near"].to_pylist(), strict=True):
        windows = [(-(-low_percent * p["score"] // 100), p["score"], p["row_id"]) for p in near if p["score"] >= 0]
        if not windows:
            continue  # low_percent of a negative score lies above it
        start = np.flatnonzero(block.labels != label)

        def reach_windows(partial, low, high):
            found = []
            for bottom, top, _ in windows:
                floor = kth_best(partial[partial <= top - high], k)  # of those that surely end below the top
                least = bottom if floor is None else max(bottom, floor + low)
                found.append((least - high, top - low))
            return found

        rows, scores = block.scan(vec, start, reach_windows)
        for bottom, top, positive in windows:
            inside = np.flatnonzero((scores >= bottom) & (scores <= top))
            for i in inside[best(block.ids[rows[inside]], scores[inside], k)]:
                out.append((name, positive, int(block.ids[rows[i]]), top, int(scores[i])))
    names = ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"]
    return pa.table({n: pa.array([r[i] for r in out], pa.int64()) for i, n in enumerate(names)})


def mine_hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    k_positives: int = 5,
    k_negatives: int = 5,
    low_percent: int = 80,
    scale: int = 256,
    relabel: Column | None = None,
    id_col: str = "vec_id",
    label_col: str = "label",
    vec_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of every row where
    ``is_anchor``; it and ``relabel`` (the label to use) are expressions on ``id`` and ``label``."""
    rows = prepared(vectors, id_col, label_col, vec_col, scale, relabel)
    size = rows.agg(F.count("*").alias("n"), F.count_if(is_anchor).alias("a"), F.max(F.array_max(F.transform("vec", lambda x: F.abs(x)))).alias("m")).first()
    row_blocks, anchor_blocks = max(1, -(-size["n"] // block_rows)), max(1, -(-size["a"] // block_anchors))
    biggest = int(size["m"] or 0)
    blocks = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(n)).cast("int")
    placed = rows.withColumn("row_block", dealt(row_blocks)).withColumn("anchor_block", blocks(anchor_blocks))
    anchors = rows.where(is_anchor).withColumn("anchor_block", dealt(anchor_blocks))
    keys = ["row_block", "anchor_block"]

    def scan(asked: DataFrame, of_block, schema: str) -> DataFrame:
        def task(left: pa.Table, right: pa.Table) -> pa.Table:
            if not len(left) or not len(right):
                return pa.table({n.split()[0]: pa.array([], pa.int64()) for n in schema.split(", ")})
            return of_block(Block(left, biggest), right)

        spread = asked.withColumn("row_block", blocks(row_blocks))
        return placed.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInArrow(task, schema)

    ranked = lambda *by: F.row_number().over(Window.partitionBy(*by[:-1]).orderBy(F.desc(by[-1]), "row_id"))
    near = scan(anchors, lambda b, a: positives_of_block(b, a, k_positives), "anchor_id long, row_id long, score long")
    near = near.withColumn("rank", ranked("anchor_id", "score")).where(F.col("rank") <= k_positives)
    near = near.groupBy("anchor_id").agg(F.collect_list(F.struct("row_id", "score")).alias("near"))  # k_positives at most
    windows = staged(anchors.join(near.withColumnRenamed("anchor_id", "id"), "id"), "hard_windows")
    found = scan(windows, lambda b, a: negatives_of_block(b, a, k_negatives, low_percent),
                 "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
    found = found.withColumnRenamed("negative_id", "row_id").withColumn("rank", ranked("anchor_id", "positive_id", "negative_score"))
    return found.where(F.col("rank") <= k_negatives).select(
        "anchor_id", "positive_id", "rank", F.col("row_id").alias("negative_id"), "positive_score", "negative_score"
    )
