"""Versioned merge by key: base rows whose key has no delta, plus every delta.

Shuffle and skew notes:

* Only the delta *keys* matter for the anti-join, so they are de-duplicated
  first; the partial aggregate collapses a hot delta key map-side, before any
  shuffle.
* A base row with a NULL key can never match (SQL equality) and an anti-join
  keeps it.  So that such rows do not all hash to one reducer, the join has a
  hash beside the keys: of the keys on both sides, and of the whole row where
  a key is NULL.  The base is read once.
* With a filter over the delta keys (``prefilter``) most of the base stays where it is: rows that
  the filter rules out, NULL keys among them, are unchanged and skip the join; only possible
  matches are exchanged and joined exactly.  The base is scanned twice for it.
* Broadcast is not forced: AQE converts to a broadcast hash join when the
  de-duplicated keys measure small at runtime, and splits skewed base
  partitions (LeftAnti is a supported skew-join type) otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.keyfilter import KeyFilter, any_null, asked, common_types, distinct_keys, key_filter

SPREAD = "__spread"  # the hash beside the keys
MAYBE = "__maybe"  # whether the filter lets a row pass
ORDINAL = "__ordinal"  # a delta's place in its chain
FEW_KEYS = 1_000_000  # delta keys up to which a merge does without a filter: they are broadcast when small


def _keys(keys: str | list[str]) -> list[str]:
    ks = [keys] if isinstance(keys, str) else list(keys)
    if not ks:
        raise ValueError("at least one key column is needed")
    return ks


def _anti(base: DataFrame, delta_keys: DataFrame, ks: list[str]) -> DataFrame:
    """The anti-join on distinct, non-NULL delta keys of the base's own types."""
    whole = F.when(any_null(ks), F.xxhash64(*base.columns)).otherwise(F.xxhash64(*ks))
    spread = delta_keys.withColumn(SPREAD, F.xxhash64(*ks))
    return base.withColumn(SPREAD, whole).join(spread, [*ks, SPREAD], "left_anti").select(*base.columns)


def _in_types(base: DataFrame, ks: list[str], types: dict[str, str]) -> DataFrame:
    return base if all(base.schema[k].dataType.simpleString() == types[k] for k in ks) else base.withColumns({k: F.col(k).cast(types[k]) for k in ks})


def prefilter_for(base: DataFrame, deltas: DataFrame, keys: str | list[str], few: int = FEW_KEYS, **limits) -> KeyFilter | None:
    """A filter over the distinct delta keys, for :func:`unchanged_rows`; None with at most ``few`` keys
    (their broadcast leaves the base in place anyway) or if it would be larger than ``max_bytes``."""
    ks = _keys(keys)
    types = common_types(base, deltas, ks)
    distinct = distinct_keys(deltas, ks, types)
    n = distinct.count()
    return None if n <= few else key_filter(distinct, ks, types, n_keys=n, **limits)


def unchanged_rows(base: DataFrame, deltas: DataFrame, keys: str | list[str], prefilter: KeyFilter | None = None) -> DataFrame:
    """Base rows whose key does not occur among the deltas (an equi anti-join).

    ``prefilter`` is a filter over the deltas' keys, see :func:`prefilter_for`; the rows are the same.
    """
    ks = _keys(keys)
    types = common_types(base, deltas, ks)
    back = {k: F.col(k).cast(base.schema[k].dataType) for k in ks if base.schema[k].dataType.simpleString() != types[k]}
    wide = _in_types(base, ks, types)
    if prefilter is None:
        cast = deltas.select(*[F.col(k).cast(types[k]).alias(k) for k in ks])
        out = _anti(wide, cast.filter(~any_null(ks)).dropDuplicates(ks), ks)
        return out.withColumns(back) if back else out
    told = asked(wide, prefilter, ks, types, MAYBE)
    ruled_out = told.filter(~F.col(MAYBE)).select(*base.columns)
    possible = told.filter(F.col(MAYBE)).select(*base.columns)
    out = ruled_out.unionByName(possible.join(prefilter.distinct, ks, "left_anti").select(*base.columns))
    return out.withColumns(back) if back else out


def _checked(base: DataFrame, deltas: DataFrame) -> None:
    missing = [c for c in base.columns if c not in deltas.columns]
    if missing:
        raise ValueError(f"deltas lack base columns {missing}")


def merge_by_key(base: DataFrame, deltas: DataFrame, keys: str | list[str], prefilter: KeyFilter | None = None) -> DataFrame:
    """M4: the new version = unchanged base rows UNION ALL all deltas (by column name).

    Duplicate delta keys are all kept, as are NULL-keyed rows of both sides.
    """
    ks = _keys(keys)
    _checked(base, deltas)
    return unchanged_rows(base, deltas, ks, prefilter).unionByName(deltas.select(*base.columns))


def merge_chain(base: DataFrame, deltas: list[DataFrame], keys: str | list[str], prefilter: bool = False, **limits) -> DataFrame:
    """A base and its delta tables, oldest first, in one pass: for each key the rows of the newest table
    that holds it, else the base's.

    The rows are those of merging the tables one after the other: rows that repeat within the newest
    table all stay, rows with a NULL key stay from every table.  The base is read once (twice with
    ``prefilter``, see :func:`prefilter_for`) whatever the number of tables, and joined once with all keys.
    """
    ks = _keys(keys)
    for d in deltas:
        _checked(base, d)
    if not deltas:
        return base
    if len(deltas) == 1 and not prefilter:
        return merge_by_key(base, deltas[0], ks)
    tagged = reduce(lambda a, b: a.unionByName(b), [d.select(*base.columns).withColumn(ORDINAL, F.lit(i)) for i, d in enumerate(deltas)])
    newest = tagged.filter(~any_null(ks)).groupBy(*ks).agg(F.max(ORDINAL).alias(ORDINAL))
    last = tagged.join(newest, [*ks, ORDINAL], "left_semi").select(*base.columns)
    no_key = tagged.filter(any_null(ks)).select(*base.columns)  # of Parquet, row groups without NULLs are skipped
    found = prefilter_for(base, newest, ks, **limits) if prefilter else None
    return unchanged_rows(base, newest, ks, found).unionByName(last).unionByName(no_key)


def merge_by_key_outer_join(base: DataFrame, deltas: DataFrame, keys: str | list[str]) -> DataFrame:
    """The textbook form (LEFT OUTER JOIN + IS NULL + UNION ALL), kept for comparison."""
    ks = _keys(keys)
    renamed = deltas.select(*[F.col(k).alias(f"__d_{k}") for k in ks])
    cond = reduce(lambda a, b: a & b, [base[k] == renamed[f"__d_{k}"] for k in ks])
    kept = base.join(renamed, cond, "left_outer").filter(F.col(f"__d_{ks[0]}").isNull()).select(*base.columns)
    return kept.unionByName(deltas.select(*base.columns))
