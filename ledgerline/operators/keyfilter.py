"""A Bloom filter over a table's keys, made by aggregates and asked in the scan of another table.

The filter is blocked: a key's hash picks one block and one 64-bit word of it, a second hash sets
``BITS`` bits of that word.  Words are made by ``bit_or`` (a partial and a final aggregate) and
gathered per block of ``WORDS`` words, so the filter is a small table (``block``, ``words``) that is
joined by broadcast; a row is asked by two shifts and one comparison inside the scan's stage.

A filter never misses a key; at 16 bits a key about one other key in fifty passes as well.  Keys with a
NULL never pass, as they match nothing.  Its size is known from the number of distinct keys: beyond
``max_bytes`` no filter is made, and the caller joins without one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

WORDS = 512  # 64-bit words of a block: 4 KB
BITS = 4  # bits that a key sets in its word
BITS_PER_KEY = 16
MAX_FILTER_BYTES = 256 << 20  # of the broadcast table; 2 bytes a key, so some 128 million keys
SEED = 0x5EED  # of the second hash


@dataclass(frozen=True)
class KeyFilter:
    """The blocks (``block`` long, ``words`` array<long>), their number, and the distinct keys at rest."""

    blocks: DataFrame
    n_blocks: int
    distinct: DataFrame
    n_keys: int

    @property
    def n_bytes(self) -> int:
        return filter_bytes(self.n_blocks)


def filter_bytes(n_blocks: int) -> int:
    return n_blocks * WORDS * 8


def any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def common_types(one: DataFrame, other: DataFrame, keys: list[str]) -> dict[str, str]:
    """The types to which an equality of the two tables' keys casts them: equal keys then hash alike."""
    both = one.select(*keys).limit(0).union(other.select(*keys).limit(0))
    return {f.name: f.dataType.simpleString() for f in both.schema.fields}


def _hashes(keys: list[str], types: dict[str, str]) -> tuple[Column, Column]:
    cols = [F.col(k).cast(types[k]) for k in keys]
    return F.xxhash64(*cols), F.xxhash64(F.lit(SEED), *cols)


def _place(h: Column, n_blocks: int) -> tuple[Column, Column]:
    """Block, and word within it (from 0)."""
    slot = F.pmod(h, F.lit(n_blocks * WORDS))
    return F.floor(slot / WORDS).cast("long"), (slot % WORDS).cast("int")


def _mask(h: Column) -> Column:
    """A word with the bits of a key set."""
    bit = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(63).cast("int"))
    return reduce(lambda a, b: a.bitwiseOR(b), [bit(i) for i in range(BITS)])


def distinct_keys(rows: DataFrame, keys: list[str], types: dict[str, str]) -> DataFrame:
    """The distinct keys without a NULL, written once under the scratch folder and read back."""
    out = rows.select(*[F.col(k).cast(types[k]).alias(k) for k in keys]).filter(~any_null(keys)).dropDuplicates(keys)
    path = scratch_path(rows.sparkSession, "keys")
    out.write.parquet(path)
    return rows.sparkSession.read.schema(out.schema).parquet(path)


def key_filter(
    distinct: DataFrame,
    keys: list[str],
    types: dict[str, str],
    bits_per_key: int = BITS_PER_KEY,
    max_bytes: int = MAX_FILTER_BYTES,
    n_keys: int | None = None,
) -> KeyFilter | None:
    """The filter of ``distinct`` keys (see :func:`distinct_keys`), or None if it would be too large."""
    n_keys = distinct.count() if n_keys is None else n_keys
    n_blocks = max(1, -(-n_keys * bits_per_key // (WORDS * 64)))
    if filter_bytes(n_blocks) > max_bytes:
        return None
    one, two = _hashes(keys, types)
    block, word = _place(one, n_blocks)
    words = distinct.select(block.alias("block"), word.alias("word"), _mask(two).alias("mask")).groupBy("block", "word").agg(
        F.bit_or("mask").alias("bits"))
    at = F.map_from_entries(F.collect_list(F.struct("word", "bits")))  # WORDS entries at most
    blocks = words.groupBy("block").agg(at.alias("at")).select(
        "block", F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda i: F.coalesce(F.try_element_at("at", i), F.lit(0).cast("long"))).alias("words"))
    path = scratch_path(distinct.sparkSession, "keyfilter")
    blocks.write.parquet(path)
    return KeyFilter(distinct.sparkSession.read.schema(blocks.schema).parquet(path), n_blocks, distinct, n_keys)


def asked(rows: DataFrame, found: KeyFilter, keys: list[str], types: dict[str, str], flag: str) -> DataFrame:
    """``rows`` with the boolean ``flag``: false where the filter rules the row's key out."""
    one, two = _hashes(keys, types)
    block, word = _place(one, found.n_blocks)
    b, ws = f"{flag}_block", f"{flag}_words"
    near = F.broadcast(found.blocks.withColumnsRenamed({"block": b, "words": ws}))  # n_bytes, checked when made
    hit = F.element_at(F.col(ws), word + 1).bitwiseAND(_mask(two)) == _mask(two)
    joined = rows.withColumn(b, block).join(near, b, "left")
    return joined.withColumn(flag, F.coalesce(hit & ~any_null(keys), F.lit(False))).drop(b, ws)
