"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Every word and every word shape (case, digits, punctuation, length) has a sparse random index vector
drawn from its hash, so no word is without one; a word's vector is its own index vector plus those of its
neighbours, summed over a bounded sample of labelled texts (``sample_rows`` documents, of together at most
``sample_bytes``), and a word that the sample does not hold has its index vector alone.  A document is the
mean of its words' vectors and of its shapes' vectors, with the shares of repeated words, of line ends and
of words that the sample does not hold.  A two-layer numpy network is fitted on that sample, and its
probabilities are calibrated by one temperature on a held-back part of it.

Texts are scored whole, in tasks that hold the small model; nothing but text enters a score.

Defined cases: a null or empty text has the zero vector and the score that the network gives it; null
labels don't count; a document labelled more than once takes its smallest label; without labels of both
kinds the score is the share of label 1 (one half without any); a null doc_id is scored and never held
out; repeated rows score alike; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ledgerline.llm.common import staged

if TYPE_CHECKING:  # the driver's alone: tasks would hold it for nothing
    import pandas as pd

SAMPLE_ROWS = 3_000
SAMPLE_BYTES = 64 << 20
WORD_DIM, SHAPE_DIM = 64, 64
NONZERO = 4
WINDOW = 2
HIDDEN = 32
ROUNDS = 60
CACHE = 200_000
SEED = 3

LETTERS = re.compile(r"[^\W\d_]+")
EDGES = re.compile(r"^([\W_]*)(.*?)([\W_]*)$", re.S)


def name_hash(name: str) -> int:
    return xxhash.xxh64_intdigest(name.encode("utf-8"), SEED) - (1 << 63)


def index_sums(hashes: np.ndarray, times: np.ndarray, dim: int) -> np.ndarray:
    """Sum of the sparse index vectors of signed 64-bit ``hashes``, each taken ``times``: ``NONZERO`` places
    with signs, all read from the hash.  ``dim`` is a power of two."""
    out = np.zeros(dim)
    for k in range(NONZERO):
        out += np.bincount((hashes >> 12 * k) & (dim - 1), times * (1 - 2 * ((hashes >> 12 * k + 11) & 1)), dim)
    return out.astype(np.float32)


def index_rows(names: list[str], dim: int) -> np.ndarray:
    """Row 0: zero; then the index vector of every name."""
    h, out = np.array([name_hash(x) for x in names], np.int64), np.zeros((len(names) + 1, dim), np.float32)
    for k in range(NONZERO):
        np.add.at(out, (np.arange(1, len(h) + 1), (h >> 12 * k) & (dim - 1)), 1 - 2 * ((h >> 12 * k + 11) & 1))
    return out


def _punctuation(marks: str) -> str:
    if not marks:
        return ""
    kind = "end" if marks[0] in ".,;:?!" else "quote" if marks[0] in "\"'()[]«»“”‘’„" else "sign"
    return kind + ("s" if len(marks) > 1 else "")


def shape_of(word: str) -> str:
    before, core, after = EDGES.match(word).groups()
    letters = "".join(LETTERS.findall(core))
    case = "none" if not letters else "lower" if letters.islower() else "upper" if letters.isupper() and len(letters) > 1 else "title" if letters[0].isupper() else "mixed"
    digits = "d" if any(c.isdigit() for c in core) else ""
    inner = "i" if core and len(letters) < len(core) and not digits else ""
    length = min(4, len(core) // 4)
    return f"{_punctuation(before)}<{case}{digits}{inner}{length}>{_punctuation(after)}"


def core_of(word: str) -> str:
    return EDGES.match(word)[2].lower()


class Vectors:
    """Rows of word and shape vectors, and the row numbers of words."""

    def __init__(self, texts: Iterable[str]):
        docs = [t.split() for t in texts]
        cores = {w: core_of(w) for words in docs for w in words}
        held = sorted(set(cores.values()))
        self.words = {c: i + 1 for i, c in enumerate(held)}  # row 0: words that the sample does not hold
        index = index_rows(held, WORD_DIM)
        context = np.zeros_like(index)
        for words in docs:
            rows = np.array([self.words[cores[w]] for w in words], np.int64)
            for step in range(1, WINDOW + 1):
                if len(rows) > step:
                    np.add.at(context, rows[:-step], index[rows[step:]])
                    np.add.at(context, rows[step:], index[rows[:-step]])
        norm = np.sqrt((context**2).sum(1, keepdims=True))
        self.word_rows = index + context / np.maximum(norm, 1e-9)
        shapes = sorted({shape_of(w) for w in cores})
        self.shapes = {s: i + 1 for i, s in enumerate(shapes)}
        self.shape_rows = index_rows(["shape " + s for s in shapes], SHAPE_DIM)


class Pooler:
    """Documents to vectors, with a bounded cache of what is known about a word."""

    def __init__(self, vectors: Vectors):
        self.v, self.known = vectors, {}

    def look(self, word: str) -> tuple[int, int]:
        """A word's row, or the hash (below zero) of a word without one, and its shape's row."""
        if len(self.known) > CACHE:
            self.known.clear()
        core = core_of(word)
        row = self.v.words.get(core, 0) or name_hash(core) | -(1 << 63)
        out = self.known[word] = (row, self.v.shapes.get(shape_of(word), 0))
        return out

    def pool(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros((len(texts), WORD_DIM + SHAPE_DIM + 3), np.float32)
        for i, text in enumerate(texts):
            words = (text or "").split()
            if not words:
                continue
            known, look, n = self.known, self.look, len(words)
            pairs = np.array([known.get(w) or look(w) for w in words], np.int64)
            ids, shapes = pairs[:, 0], pairs[:, 1]
            # words and shapes that come often are summed by count
            rows, times = np.unique(ids, return_counts=True)
            new = np.searchsorted(rows, 0)  # those before have no row
            out[i, :WORD_DIM] = (times[new:] @ self.v.word_rows[rows[new:]] + index_sums(rows[:new], times[:new], WORD_DIM)) / n
            rows, times = np.unique(shapes, return_counts=True)
            out[i, WORD_DIM : WORD_DIM + SHAPE_DIM] = times @ self.v.shape_rows[rows] / n
            again = np.count_nonzero((pairs[1:] == pairs[:-1]).all(axis=1)) / n
            unseen = np.count_nonzero(ids < 0) / n
            out[i, -3:] = again, text.count("\n") / n, unseen
        return out


class Network:
    """Two layers, fitted by Adam on the logistic loss; ``temperature`` divides the logits."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        x = (x - self.mean) / self.scale
        held = rng.random(len(x)) < 0.2
        fit, yf = x[~held], y[~held]
        shapes = ((x.shape[1], HIDDEN), (HIDDEN,), (HIDDEN,), ())
        self.p = [rng.normal(0, 1 / np.sqrt(s[0] if s else 1), s) if i in (0, 2) else np.zeros(s) for i, s in enumerate(shapes)]
        m, v, step = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes], 0
        for _ in range(ROUNDS):
            order = rng.permutation(len(fit))
            for at in range(0, len(order), 64):
                part = order[at : at + 64]
                step += 1
                xb, yb = fit[part], yf[part]
                h = np.maximum(xb @ self.p[0] + self.p[1], 0)
                d = (1 / (1 + np.exp(-np.clip(h @ self.p[2] + self.p[3], -30, 30))) - yb) / len(part)
                dh = np.outer(d, self.p[2]) * (h > 0)
                grads = (xb.T @ dh + 1e-3 * self.p[0], dh.sum(0), h.T @ d + 1e-3 * self.p[2], d.sum())
                for i, g in enumerate(grads):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    self.p[i] = self.p[i] - 0.004 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        self.temperature = 1.0
        if held.any() and len(set(y[held])) == 2:
            z = self.logits((x[held] * self.scale) + self.mean)
            loss = lambda t: np.logaddexp(0, np.where(y[held] == 1, -z, z) / t).mean()
            self.temperature = float(min(np.geomspace(1, 8, 101), key=loss))

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum((x - self.mean) / self.scale @ self.p[0] + self.p[1], 0)
        return h @ self.p[2] + self.p[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> pd.DataFrame:
    """text, quality of at most ``sample_rows`` labelled documents that are not held out, by hash; of these
    the first whose texts have at most ``sample_bytes`` bytes together."""
    drawn = F.xxhash64(F.lit(SEED), "doc_id")
    known = (
        labels.where("quality is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(drawn, "doc_id").limit(sample_rows)
    )
    found = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # at most sample_rows rows
    one = staged(found.groupBy("doc_id", "quality").agg(F.min("text").alias("text")), "quality_sample")
    sizes = one.select("doc_id", drawn.alias("drawn"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"))
    so_far = sizes.withColumn("held", F.sum("size").over(Window.orderBy("drawn", "doc_id")))  # at most sample_rows rows
    fits = F.broadcast(so_far.where(F.col("held") <= sample_bytes).select("doc_id"))
    return one.join(fits, "doc_id").orderBy("doc_id").select("text", "quality").toPandas()


def _scored(docs: DataFrame, labels: DataFrame, columns: list[str], sample_rows: int) -> DataFrame:
    """``columns`` of ``docs`` (with text) and ``__score``."""
    sample = labelled_sample(docs, labels, sample_rows)
    y = sample["quality"].to_numpy(float)
    base = float(y.mean()) if len(y) else 0.5
    vectors = network = None
    if len(set(y)) == 2:
        texts = sample["text"].fillna("").tolist()
        vectors = Vectors(texts)
        network = Network(Pooler(vectors).pool(texts).astype(float), y)
    model = docs.sparkSession.sparkContext.broadcast((vectors, network))
    at = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, network = model.value
        pooler = Pooler(vectors) if network else None
        for batch in batches:
            texts = batch.column(at).to_pylist()
            score = network.score(pooler.pool(texts)) if network else np.full(len(texts), base)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score.astype(float), pa.float64())], [*columns, "__score"])

    rows = docs.select(*[f"`{c}`" for c in columns])
    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("__score", DoubleType())]))


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted (1: the score reaches the threshold) for every document."""
    scored = _scored(docs, labels, ["doc_id", "text"], sample_rows)
    good = (F.col("__score") >= threshold).cast("int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"), good.alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with its own columns, without the documents whose score is below the threshold."""
    return _scored(docs, labels, docs.columns, sample_rows).where(F.col("__score") >= threshold).drop("__score")
