"""Approximate nearest neighbours by an inverted multi-index.

The unit vectors are split in two halves, each quantised by its own codebook (k-means on a bounded
sample of about ``sample_rows`` rows, drawn by hash); a row's cell is its pair of centroids and every row is indexed.
A query walks the centroid pairs in order of summed distance with a heap, until the cells walked
hold ``share`` of all rows (``min_candidates`` at least), and their rows are reranked by the exact
cosine in double precision.  ``share=1`` walks all cells and is exact.

Rows of a cell group (first centroid) are salted into blocks of ``block_rows`` and the queries dealt
into blocks of ``block_queries``, so a task holds one block of each whatever the hot cell or the
number of rows; only the best k of a block leave it.

Defined cases: rows whose id is null or whose vector is null, zero, of another length than the most
common one, or holds null or non-finite components take no part; an id that comes more than once
counts once, with the smallest of its vectors; ties go to the smaller id; empty tables give no rows;
other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import staged

CENTROIDS = 64
SAMPLE_ROWS = 20_000
SHARE = 0.45
MIN_CANDIDATES = 1_000
BLOCK_ROWS = 16_384
BLOCK_QUERIES = 2_048
WALKS_PER_TASK = 128
SEED = 11


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, vec (array of double), norm of the rows that take part, one per id."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    good = ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("vec", lambda x: x != 0)
    rows = rows.where(F.col("id").isNotNull() & F.col("vec").isNotNull()).where(good)
    rows = staged(rows.groupBy("id").agg(F.min("vec").alias("vec")), "ann_vectors")
    top = rows.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    dim = top[0]["dim"] if top else 0
    return rows.where(F.size("vec") == dim)


def kmeans(points: np.ndarray, k: int, seed: int, rounds: int = 10) -> np.ndarray:
    """Lloyd's rounds from seeded distinct points."""
    points = np.unique(points, axis=0)
    rng = np.random.default_rng(seed)
    centres = points[rng.permutation(len(points))[:k]].copy()
    for _ in range(rounds):
        near = nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        counts = np.bincount(near, minlength=len(centres))[:, None]
        centres = np.where(counts > 0, sums / np.maximum(counts, 1), centres)
    return centres


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None, :]


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return distances(points, centres).argmin(1)


def unit(vecs: np.ndarray) -> np.ndarray:
    vecs = vecs / np.abs(vecs).max(axis=1, keepdims=True)
    return vecs / np.sqrt((vecs * vecs).sum(axis=1, keepdims=True))


def walk(left: np.ndarray, right: np.ndarray, counts: np.ndarray, wanted: float) -> list[tuple[int, int]]:
    """Centroid pairs by summed distance until their cells hold ``wanted`` rows (multi-sequence
    walk: a pair is pushed once its neighbour in either order has been taken)."""
    by_left, by_right = left.argsort(kind="stable"), right.argsort(kind="stable")
    heap, seen, cells, held = [(left[by_left[0]] + right[by_right[0]], 0, 0)], {(0, 0)}, [], 0
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        a, b = int(by_left[i]), int(by_right[j])
        if counts[a, b]:
            cells.append((a, b))
            held += int(counts[a, b])
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(left) and y < len(right) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (left[by_left[x]] + right[by_right[y]], x, y))
    return cells


def exact_cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, always summed in the same order, so that equal vectors get equal scores."""
    norm = lambda x: np.sqrt((x * x).sum(axis=1))
    return (a * b).sum(axis=1) / (norm(a) * norm(b))


def best_of_block(rows: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best rows of this block for each query, among the cells that it walks."""
    rows = rows.sort_values(["second", "id"])
    vecs, ids = np.array(rows["vec"].tolist(), dtype=float), rows["id"].to_numpy()
    asked, names = np.array(queries["vec"].tolist(), dtype=float), queries["id"].to_numpy()
    unit_rows, unit_asked = unit(vecs), unit(asked)
    walks = np.zeros((len(queries), int(max(rows["second"].max(), max(x.max() for x in queries["seconds"]))) + 1), bool)
    for q, seconds in enumerate(queries["seconds"]):
        walks[q, seconds] = True
    second = rows["second"].to_numpy()
    starts = np.flatnonzero(np.r_[True, second[1:] != second[:-1]])
    found: list[tuple[np.ndarray, np.ndarray]] = []
    floor = np.full(len(queries), -np.inf)  # k-th best score so far
    for start, end in zip(starts, np.r_[starts[1:], len(ids)], strict=True):
        who = np.flatnonzero(walks[:, second[start]])
        if not len(who):
            continue
        near = unit_asked[who] @ unit_rows[start:end].T
        near[names[who][:, None] == ids[None, start:end]] = -np.inf
        if end - start >= k:
            floor[who] = np.maximum(floor[who], np.partition(near, -k, axis=1)[:, -k])
        q, r = np.nonzero(near >= floor[who][:, None] - 1e-9)
        keep = np.isfinite(near[q, r])
        found.append((who[q[keep]], start + r[keep]))
    if not found:
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
    q, r = (np.concatenate(x) for x in zip(*found, strict=True))
    near = np.einsum("ij,ij->i", unit_asked[q], unit_rows[r]) >= floor[q] - 1e-9
    q, r = q[near], r[near]
    out = pd.DataFrame({"query_id": names[q], "vec_id": ids[r], "score": exact_cosine(asked[q], vecs[r])})
    return out.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True]).groupby("query_id").head(k)


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    share: float = SHARE,
    min_candidates: int = MIN_CANDIDATES,
    centroids: int = CENTROIDS,
    sample_rows: int = SAMPLE_ROWS,
    block_rows: int = BLOCK_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """query_id, rank, vec_id, score: for every row where ``is_query`` (an expression on ``id``)
    the k nearest other rows."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vec_col)
    share_drawn = sample_rows / max(rows.count(), 1)
    drawn = F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(1 << 30)) < int(share_drawn * (1 << 30)) + 1
    sample = rows.where(drawn).orderBy("id").select("vec").toPandas()  # about sample_rows: ids are distinct
    result = "query_id long, vec_id long, score double"
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    points = unit(np.array(sample["vec"].tolist(), dtype=float))
    half = points.shape[1] // 2
    first, second = kmeans(points[:, :half], centroids, SEED), kmeans(points[:, half:], centroids, SEED + 1)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                u = unit(np.array(batch["vec"].tolist(), dtype=float))
                yield batch.assign(first=nearest(u[:, :half], first), second=nearest(u[:, half:], second))

    index = staged(rows.mapInPandas(place, "id long, vec array<double>, first int, second int"), "ann_index")
    counts = np.zeros((len(first), len(second)), np.int64)
    for r in index.groupBy("first", "second").count().collect():  # at most centroids ** 2 rows
        counts[r["first"], r["second"]] = r["count"]
    total = int(counts.sum())
    wanted = max(min_candidates, share * total)
    salts = F.element_at(F.array(*[F.lit(max(1, -(-int(n) // block_rows))) for n in counts.sum(1)]), F.col("first") + 1)

    def plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for name, vec in zip(batch["id"], batch["vec"], strict=True):
                u = unit(np.array([vec], dtype=float))
                left, right = distances(u[:, :half], first)[0], distances(u[:, half:], second)[0]
                groups: dict[int, list[int]] = {}
                for a, b in walk(left, right, counts, wanted + 1):  # one more: the query's own row
                    groups.setdefault(a, []).append(b)
                out += [(name, vec, a, b) for a, b in groups.items()]
            yield pd.DataFrame(out, columns=["id", "vec", "first", "seconds"])

    asked = index.where(is_query).select("id", "vec")
    n_asked = asked.count()
    query_blocks = max(1, -(-n_asked // block_queries))
    plans = asked.repartition(max(1, -(-n_asked // WALKS_PER_TASK)), "id").mapInPandas(plan, "id long, vec array<double>, first int, seconds array<int>")
    plans = plans.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int")
    )
    placed = index.withColumn("salt", F.pmod(F.xxhash64(F.lit(SEED), "id"), salts).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))
    )

    def rerank(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return best_of_block(left, right, k)

    keys = ["first", "salt", "block"]
    found = placed.groupBy(*keys).cogroup(plans.groupBy(*keys)).applyInPandas(rerank, result)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
