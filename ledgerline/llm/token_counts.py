"""Token counts by rank-synchronous array merging.

A byte-level BPE vocabulary (a ``tokenizers`` JSON file) is a list of merges in rank order.  A text is
cut at the vocabulary's special strings, each of which is one token, and the rest into pre-tokens.
The distinct pre-tokens of a batch that are not yet known are held as ragged numpy arrays - one flat
array of symbols, one of the sequences' starts - and merged all at once: in each round every sequence
applies its own lowest-rank pair at all of that pair's places, sequences without a pair leave, and what
is left of a sequence is its token count.  A rule's two symbols are made by earlier rules (checked when
the file is read), so a sequence's lowest rank rises from round to round and merging all places of a
pair at once gives what merging them one by one gives.

The merges go to the tasks with the function (some 50,000 rules, whatever the input); texts never
leave their task, nothing is shuffled, and counts of pre-tokens are remembered up to ``REMEMBERED``
of them, which changes the speed alone.  A lost task is simply run again.

Pre-tokens are found by a pattern whose letter, number and space classes are those of the library for
the blocks of ``SETTLED``; a text with any other code point is cut by the library's own pre-tokenizer,
as Unicode tables differ between versions.

Defined cases: a null text is empty; an empty text has 0 bytes and 0 tokens; every row, repeated ones
and null ids included, gives one row; very long texts are cut piece by piece; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the byte-level pre-token pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Code point ranges on whose letters, numbers and spaces all tables in use agree.
SETTLED = [
    (0x0000, 0x052F), (0x1E00, 0x1EFF), (0x2000, 0x206F), (0x20A0, 0x20BF), (0x2100, 0x214F), (0x2190, 0x22FF),
    (0x2500, 0x26FF), (0x3000, 0x30FF), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3), (0xFF01, 0xFF5E), (0x1F300, 0x1F64F),
]

REMEMBERED = 1_000_000  # most pre-tokens whose counts a task keeps
PIECES = 200_000  # most pre-tokens of a text that are held at once
BATCH_CHARS = 8_000_000  # of text whose pre-tokens are merged together
NEVER = np.iinfo(np.int64).max


class Merges:
    """The rules of a vocabulary as sorted arrays: a pair's key, its rank and the symbol it makes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cut = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or cut["type"] != "ByteLevel" or cut["add_prefix_space"] or not cut.get("use_regex", True):
            raise ValueError(f"{path} is not a byte-level BPE vocabulary")
        if spec["normalizer"] or model.get("dropout") or model.get("ignore_merges") or model.get("end_of_word_suffix") or model.get("continuing_subword_prefix"):
            raise ValueError(f"{path} has settings that are not supported")
        self.special = [x["content"] for x in spec["added_tokens"]]
        if any(x["single_word"] or x["lstrip"] or x["rstrip"] for x in spec["added_tokens"]):
            raise ValueError(f"{path} has special strings with conditions")
        ids = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made = {ids[a + b]: rank for rank, (a, b) in enumerate(pairs)}
        if len(made) < len(pairs) or any(made.get(ids[x], -1) >= rank for rank, pair in enumerate(pairs) for x in pair):
            raise ValueError(f"{path}: a merge comes before its parts")
        self.width = max(ids.values()) + 1
        keys = np.array([ids[a] * self.width + ids[b] for a, b in pairs], np.int64)
        order = keys.argsort()
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.makes = np.array([ids[a + b] for a, b in pairs], np.int64)  # by rank
        self.bytes = np.array([ids[c] for c in byte_letters()], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols; ``NEVER`` where no rule merges it."""
        if not len(self.keys):
            return np.full(len(left), NEVER)
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NEVER)


def byte_letters() -> list[str]:
    """The letters that stand for bytes 0 to 255 in byte-level vocabularies: printable Latin-1
    characters for themselves, the others for code points from 256 on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def count_merged(pieces: list[bytes], merges: Merges) -> np.ndarray:
    """Number of symbols that are left of each (non-empty) piece once no rule applies."""
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    symbols = merges.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
    counts = lengths.copy()
    names = np.arange(len(pieces))  # of the sequences that are still merged
    ranks = np.full(len(symbols), NEVER)  # of the pair that begins at each symbol
    ranks[:-1] = merges.rank(symbols[:-1], symbols[1:])
    starts = np.r_[0, lengths.cumsum()]
    ranks[starts[1:] - 1] = NEVER
    while len(names):
        best = np.minimum.reduceat(ranks, starts[:-1])
        live = best < NEVER
        if not live.all():  # finished sequences leave
            counts[names[~live]] = np.diff(starts)[~live]
            keep = np.repeat(live, np.diff(starts))
            symbols, ranks, names, best = symbols[keep], ranks[keep], names[live], best[live]
            starts = np.r_[0, np.diff(starts)[live].cumsum()]
            if not len(names):
                break
        at = np.flatnonzero(ranks == np.repeat(best, np.diff(starts)))
        # in a run of overlapping places (aaa) every other one is taken, from the left
        run = np.cumsum(np.r_[True, np.diff(at) != 1])
        first = np.flatnonzero(np.r_[True, np.diff(run) != 0])
        at = at[(np.arange(len(at)) - first[run - 1]) % 2 == 0]
        symbols[at] = merges.makes[ranks[at]]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        ended = np.zeros(len(symbols), bool)
        ended[starts[1:] - 1] = True
        ended[at] |= ended[at + 1]
        lost = np.r_[0, np.cumsum(~keep)]
        starts = starts - lost[starts]
        at = at - lost[at]
        symbols, ranks, ended = symbols[keep], ranks[keep], ended[keep]
        touched = np.r_[at, at[at > 0] - 1]
        touched = touched[touched < len(symbols) - 1]
        ranks[touched] = merges.rank(symbols[touched], symbols[touched + 1])
        ranks[ended] = NEVER
    return counts


class Counter:
    """Token counts of texts, a batch at a time."""

    def __init__(self, merges: Merges):
        from tokenizers.pre_tokenizers import ByteLevel

        self.merges, self.known = merges, {}
        self.pattern = regex.compile(PATTERN)
        self.unsettled = regex.compile("[^" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in SETTLED) + "]")
        self.library = ByteLevel(add_prefix_space=False, use_regex=True)
        cuts = sorted(merges.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, cuts))) if cuts else None

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The text's pre-tokens, some at a time."""
        if text.isascii() or not self.unsettled.search(text):
            if len(text) <= PIECES:
                yield self.pattern.findall(text)
                return
            found = (m[0] for m in self.pattern.finditer(text))
        else:
            found = (text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text))
        while some := list(islice(found, PIECES)):
            yield some

    def learn(self, pieces: set[str]) -> None:
        if len(self.known) > REMEMBERED:
            self.known = {}
        if new := list(pieces.difference(self.known)):
            self.known.update(zip(new, count_merged([x.encode() for x in new], self.merges).tolist(), strict=True))

    def count(self, texts: list[str]) -> list[int]:
        totals, waiting, held = [0] * len(texts), [], 0

        def settle():
            self.learn(set().union(*(some for _, some in waiting)))
            for row, some in waiting:
                totals[row] += sum(map(self.known.__getitem__, some))
            waiting.clear()

        for row, text in enumerate(texts):
            parts = [text]
            if self.special and self.special.search(text):
                totals[row] += len(self.special.findall(text))
                parts = [x for x in self.special.split(text) if x]
            for part in parts:
                for some in self.pieces(part):
                    waiting.append((row, some))
                    held += sum(map(len, some))
                    if held >= BATCH_CHARS:
                        settle()
                        held = 0
        settle()
        return totals


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes long (UTF-8), n_tokens long of every row of ``docs``; ``vocabulary`` is the path of
    the JSON file, read by the driver."""
    merges = Merges(vocabulary)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("id", F.octet_length("text").cast("long").alias("n_bytes"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(merges)
        for batch in batches:
            n = counter.count(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["id"], batch["n_bytes"], pa.array(n, pa.int64())], ["id", "n_bytes", "n_tokens"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long").withColumnRenamed("id", id_col)
