"""Spelling variants by blocked Gram matrices of letter counts.

Words are counted over all texts; two words are near if they differ by one inserted, deleted or
replaced letter.  Then their letter counts differ by one letter, or by one letter for another: the
squared distance of the count vectors is 1 between neighbouring lengths and 0 or 2 within a length.

A block is a word's length with its letters counted by class (``class_letters``), so near words stand in the
same block or in one that differs by a letter moved from one class to another, or by a letter more.
Every word is at home in its own block and visits the blocks where a near word can stand - of each two
blocks of a length one visits the other, and shorter words visit the longer ones.  Where a block meets
its visitors, numpy multiplies their letter-count matrices; the products (Gram matrices) give all squared
distances, pairs of at most two are kept and their edit verified letter by letter.  Blocks without words
take no visitors.  A block with more words or visitors than a tile holds is cut into tiles, and every tile
of words meets every tile of visitors, so no task holds more than a tile of each, whatever the block;
small blocks share a task.  A word's partners are summed up in the task before they travel.

All of it grows with the number of distinct words rather than with the texts: the texts are read once,
occurrences are counted map-side.  Forms are followed to the last by doubling (form of form), as many
rounds as the factor between a word and its form allows.

Defined cases: a null text has no words; an empty table gives no rows; repeated rows count as often as
they come; a null id is the empty text in the hash; words of any length take part; ties as the contract
says; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ascii_lower, checked_broadcast, staged

# The letters of a word.
LETTERS = r"A-Za-zÀ-ÿ"
ALPHABET = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))

# Letters from common to rare: dealt to the classes in this order, the classes hold about as many each.
BY_USE = "eainrstoludcmpgvhbfqyxzjkw"

TILE_WORDS = 4_096  # words of a block that meet its visitors at once
TILE_VISITS = 32_768  # visitors of a block that a task holds at once
TASK_ROWS = 50_000  # words and visitors of the blocks that share a task, about
CELLS = 4_000_000  # of a product or of the letters held beside it


def class_letters(classes: int) -> list[str]:
    return ["".join(c for i, c in enumerate(BY_USE + ALPHABET[26:]) if i % classes == k) for k in range(classes)]


def classes_for(words: int) -> int:
    """More classes cut the words finer and send each to more blocks; results do not depend on it."""
    return max(3, min(8, round(math.log(max(words, 1), 10))))


def count_words(docs: DataFrame, id_col: str, text_col: str, min_length: int, min_count: int, typo_every: int | None) -> DataFrame:
    """word, n: the runs of letters, A-Z lower-cased, with at least ``min_length`` letters, counted
    over all texts.  With ``typo_every`` d, a run whose hash with its document's id is divisible by d
    loses one letter."""
    # runs of min_length letters at least; a shorter one gives no word, as letters only ever go
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))).alias("run"),
    )
    runs = runs.select("id", ascii_lower(F.col("run")).alias("run"))
    if typo_every:
        h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
        at = F.pmod(h, F.char_length("run")).cast("int")
        cut = F.concat(F.substring("run", F.lit(1), at), F.substr("run", at + 2))
        runs = runs.select(F.when(F.pmod(h, F.lit(typo_every)) == 0, cut).otherwise(F.col("run")).alias("run"))
    counted = runs.groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n"))
    return counted.where((F.char_length("word") >= min_length) & (F.col("n") >= min_count))


def block_key(counts: list[Column], moves: dict[int, int] | None = None) -> Column:
    """The block of the given class counts, changed by ``moves`` (class -> letters more)."""
    return F.concat_ws(",", *[(c + (moves or {}).get(i, 0)).cast("string") for i, c in enumerate(counts)])


def visited(counts: list[Column]) -> Column:
    """The blocks that a word of these class counts visits: its own, those of its length with a letter
    moved to a later class, those with a letter more."""
    keys = [block_key(counts)]
    keys += [block_key(counts, {i: 1}) for i in range(len(counts))]
    moved = [F.when(a > 0, block_key(counts, {i: -1, j: 1})) for i, a in enumerate(counts) for j in range(i + 1, len(counts))]
    return F.array_compact(F.array(*keys, *moved))


_INDEX = np.full(0x100, 0, np.uint8)
_INDEX[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
SHARED = 6
COLUMNS = 26 + SHARED
_COLUMN = np.array([*range(26), *(26 + i % SHARED for i in range(len(ALPHABET) - 26))])


def letters_of(words: list[str]) -> np.ndarray:
    """Words of one length as rows of letter numbers."""
    size = len(words[0])
    return _INDEX[np.array(words, dtype=f"<U{size}").view(np.uint32).reshape(len(words), size)]


def count_matrix(letters: np.ndarray) -> np.ndarray:
    """Letter counts, a row for each word; accented letters share ``SHARED`` columns, which can only
    bring words nearer, and the edit is verified."""
    columns = _COLUMN[letters]
    flat = np.arange(len(letters))[:, None] * COLUMNS + columns
    counts = np.bincount(flat.ravel(), minlength=len(letters) * COLUMNS).reshape(len(letters), COLUMNS)
    return counts.astype(np.float32 if letters.shape[1] < 2_000 else np.float64)  # squares stay exact


def squared_distances(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The Gram matrix of two blocks of counts, with the norms brought in by two more columns."""
    norm = lambda x: (x * x).sum(axis=1, keepdims=True)
    ones = lambda x: np.ones((len(x), 1), x.dtype)
    return np.hstack([one, norm(one), ones(one)]) @ np.hstack([-2 * other, ones(other), norm(other)]).T


class Letters:
    """A task's words as letters and letter counts; those of words over ``HELD`` letters are made when
    asked for, so that long words cost no more than they must."""

    HELD = 128

    def __init__(self, words: np.ndarray):
        self.words, self.sizes = words, np.fromiter(map(len, words), int, len(words))
        self.place, self.made = np.zeros(len(words), int), {}
        for size in np.unique(self.sizes[self.sizes <= self.HELD]).tolist():
            at = np.flatnonzero(self.sizes == size)
            self.place[at] = np.arange(len(at))
            letters = letters_of(words[at].tolist())
            self.made[size] = letters, count_matrix(letters)

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Letters and counts of rows of one length."""
        if made := self.made.get(int(self.sizes[rows[0]])):
            return made[0][self.place[rows]], made[1][self.place[rows]]
        letters = letters_of(self.words[rows].tolist())
        return letters, count_matrix(letters)


def near_pairs(home: np.ndarray, visitors: np.ndarray, letters: Letters) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs (home row, visitor row); home words have one length, visitors that or one less."""
    size, out = int(letters.sizes[home[0]]), []
    step = max(1, CELLS // max(size, len(ALPHABET)) // 8)
    checked = max(1, CELLS // size)
    for width in (size, size - 1):
        places = visitors[letters.sizes[visitors] == width]
        for v in range(0, len(places), step):
            part = places[v : v + step]
            seen, seen_counts = letters.of(part)
            rows = max(1, min(step, CELLS // len(part)))
            for h in range(0, len(home), rows):
                some = home[h : h + rows]
                own, counts = letters.of(some)
                a, b = np.nonzero(squared_distances(counts, seen_counts) <= 2)
                for at in range(0, len(a), checked):
                    x, y = a[at : at + checked], b[at : at + checked]
                    good = one_edit(own[x], seen[y])
                    if good.any():
                        out.append((some[x[good]], part[y[good]]))
    if not out:
        return np.zeros(0, int), np.zeros(0, int)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def one_edit(long: np.ndarray, short: np.ndarray) -> np.ndarray:
    """Row by row: whether one replaced letter, or one letter taken from ``long``, gives ``short``."""
    if long.shape[1] == short.shape[1]:
        return (long != short).sum(axis=1) == 1
    ahead = np.cumprod(long[:, :-1] == short, axis=1).sum(axis=1)  # letters alike from the left
    behind = np.cumprod((long[:, 1:] == short)[:, ::-1], axis=1).sum(axis=1)  # and from the right
    return ahead + behind >= short.shape[1]


def partners(rows: pa.Table) -> pa.Table:
    """Of one task's blocks: word, how many near words it met, the best of them (largest n, then
    smallest word) and its n."""
    out = []
    rows = rows.sort_by([(c, "ascending") for c in ("block", "tile", "visit_tile")])
    keys = [rows[c].to_numpy() for c in ("block", "tile", "visit_tile")]
    starts = np.flatnonzero(np.r_[True, np.logical_or.reduce([k[1:] != k[:-1] for k in keys])])
    words, ns, home, same = (rows[c].to_numpy() for c in ("word", "n", "home", "own"))
    letters = Letters(words)
    for start, end in zip(starts, np.r_[starts[1:], len(words)], strict=True):
        at, visit = start + np.flatnonzero(home[start:end]), start + np.flatnonzero(~home[start:end])
        if not len(at) or not len(visit):
            continue
        a, b = near_pairs(at, visit, letters)
        once = ~same[b] | (words[a] < words[b])  # two words of one block meet twice
        if once.any():
            out.append((np.r_[a[once], b[once]], np.r_[b[once], a[once]]))
    one, other = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, int), np.zeros(0, int))
    # a word's partners together, the best of them first
    names = np.unique(words, return_inverse=True)[1]  # numbers in the order of the words
    order = np.lexsort((names[other], -ns[other], names[one]))
    one, other = one[order], other[order]
    first = np.flatnonzero(np.r_[True, names[one][1:] != names[one][:-1]]) if len(one) else one
    met = np.diff(np.r_[first, len(one)])
    return pa.table({
        "word": pa.array(words[one[first]], pa.string()), "met": pa.array(met, pa.int64()),
        "best": pa.array(words[other[first]], pa.string()), "best_n": pa.array(ns[other[first]], pa.int64()),
    })


def near_words(
    words: DataFrame,
    tile_words: int = TILE_WORDS,
    tile_visits: int = TILE_VISITS,
    task_rows: int = TASK_ROWS,
    classes: int | None = None,
) -> DataFrame:
    """word, n_near, best, best_n of the words (word, n; distinct, at rest) that have near words."""
    classes = classes or classes_for(words.count())
    count = lambda letters: F.char_length("word") - F.char_length(F.translate("word", letters, ""))
    counts = [F.col(f"c{i}") for i in range(classes)]
    kept = staged(words.select("word", "n", *[count(x).alias(f"c{i}") for i, x in enumerate(class_letters(classes))]), "spelling_words")
    blocks = kept.groupBy(*counts).agg(F.count("*").alias("held"))
    visits = blocks.select(F.explode(visited(counts)).alias("block"), "held").groupBy("block").agg(F.sum("held").alias("visits"))
    blocks = blocks.select(block_key(counts).alias("block"), "held").join(visits, "block")
    tiles = lambda c, most: F.ceil(F.col(c) / most).cast("int")
    plan = staged(blocks.select("block", tiles("held", tile_words).alias("tiles"), tiles("visits", tile_visits).alias("visit_tiles"), (F.col("held") + F.col("visits")).alias("rows")), "spelling_blocks")
    total = plan.agg(F.sum(F.col("rows") * F.greatest("tiles", "visit_tiles"))).first()[0] or 0
    tasks = max(1, -(-int(total) // task_rows))
    plan = checked_broadcast(plan.drop("rows"))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt = lambda n: F.pmod(F.xxhash64("word"), F.col(n)).cast("int")
    home = kept.select("word", "n", block_key(counts).alias("block")).join(plan, "block")
    home = home.select("word", "n", "block", dealt("tiles").alias("tile"), spread("visit_tiles").alias("visit_tile"), F.lit(True).alias("home"), F.lit(True).alias("own"))
    guests = kept.select("word", "n", block_key(counts).alias("from"), F.explode(visited(counts)).alias("block")).join(plan, "block")
    guests = guests.select("word", "n", "block", spread("tiles").alias("tile"), dealt("visit_tiles").alias("visit_tile"), F.lit(False).alias("home"), (F.col("from") == F.col("block")).alias("own"))
    meet = home.unionByName(guests)
    task = F.pmod(F.xxhash64("block", "tile", "visit_tile"), F.lit(tasks))
    met = meet.groupBy(task.alias("task")).applyInArrow(partners, "word string, met long, best string, best_n long")
    most = F.min(F.struct((-F.col("best_n")).alias("m"), "best"))
    return met.groupBy("word").agg(F.sum("met").alias("n_near"), most.alias("top")).select("word", "n_near", "top.best", (-F.col("top.m")).alias("best_n"))


def roots(forms: DataFrame, rounds: int) -> DataFrame:
    """word, root of every word of ``forms`` (word, form): the last of its chain of forms, found by
    following twice as far in each round."""
    reached = forms.select("word", F.col("form").alias("root"))
    for _ in range(rounds):
        on = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        reached = staged(reached.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling_roots")
    return reached


def group_variants(
    docs: DataFrame,
    min_length: int = 7,
    min_count: int = 2,
    factor: int = 10,
    typo_every: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    **sizes: int,
) -> DataFrame:
    """word, form, root string; n, n_near, form_n long of every word counted."""
    words = staged(count_words(docs, id_col, text_col, min_length, min_count, typo_every), "spelling_counts")
    near = near_words(words, **sizes)
    is_form = F.col("best_n") >= factor * F.col("n")
    told = staged(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"),
        ),
        "spelling_forms",
    )
    most = told.agg(F.max("n")).first()[0] or 1
    links = math.ceil(math.log(most, factor)) + 1  # a form has factor times its word's n, so no chain is longer
    ends = roots(told.where(F.col("form").isNotNull()).select("word", "form"), math.ceil(math.log2(links)) if links > 1 else 0)
    return told.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
