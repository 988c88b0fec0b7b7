"""Keyword filter for many terms: a semi-join on tokens instead of one long pattern.

The rows are those of ``functions.text.keyword_match`` (a term as a whole token of the lower-cased
text), but the terms are a table.  A text's distinct tokens are taken once and matched with the terms
by a hash join, so the time does not depend on the number of terms; a term that is more than one token
is found by its longest token, and one without any token by its first character, and then verified in the
text, first as a substring.  The terms are broadcast when they are few; else both sides shuffle on the token, where Spark's
skew-join split deals with tokens that most texts hold.  Only row keys travel, and candidates' texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN = "[a-z0-9_]+"
LETTER = "\x00"  # before a character, so that it is no token
BROADCAST_TERMS = 1_000_000  # most terms that are broadcast


def term_pattern(term: Column) -> Column:
    """The pattern that finds ``term`` (lower-cased) as a whole token."""
    quoted = F.concat(F.lit(r"\Q"), F.replace(term, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    return F.concat(F.lit("(?<![a-z0-9_])"), quoted, F.lit("(?![a-z0-9_])"))


def keyword_semi_join(df: DataFrame, text_col: str, terms: DataFrame, key_cols: str | list[str], term_col: str = "term") -> DataFrame:
    """The rows of ``df`` whose text holds any of ``terms``; ``key_cols`` tell rows apart (no NULL).

    NULL and empty terms match nothing, as do NULL texts; a repeated term counts once.
    """
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    low = F.lower(F.col(text_col))
    wanted = terms.select(F.lower(F.col(term_col)).alias("__term")).filter("__term <> ''").dropDuplicates()
    sized = F.transform(F.regexp_extract_all("__term", F.lit(f"({TOKEN})"), F.lit(1)), lambda t: F.struct(F.length(t).alias("n"), t.alias("t")))
    wanted = wanted.withColumn("__longest", F.coalesce(F.array_max(sized)["t"], F.lit("")))
    longest = F.col("__longest")
    wanted = wanted.select(
        "__term", F.when(longest == "", F.concat(F.lit(LETTER), F.substring("__term", 1, 1))).otherwise(longest).alias("__token"),
        (longest != F.col("__term")).alias("__verify"), (longest == "").alias("__by_letter"),
    )
    by_letter = not wanted.filter("__by_letter").isEmpty()
    side = F.broadcast(wanted) if wanted.count() <= BROADCAST_TERMS else wanted
    found = F.regexp_extract_all(low, F.lit(f"({TOKEN})"), F.lit(1))
    if by_letter:  # some term has no token: its first character stands for it
        found = F.concat(found, F.transform(F.split(low, ""), lambda c: F.concat(F.lit(LETTER), c)))
    tokens = df.select(*keys, F.explode(F.array_distinct(found)).alias("__token"))
    hits = tokens.join(side, "__token")
    sure = hits.filter(~F.col("__verify")).select(*keys)
    perhaps = hits.filter("__verify").select(*keys, "__term")
    there = perhaps.join(df.select(*keys, low.alias("__low")), keys)
    whole = F.rlike(F.col("__low"), term_pattern(F.col("__term")))  # compiles a pattern a row, so for the few that hold the term
    held = there.filter(F.when(F.contains(F.col("__low"), F.col("__term")), whole).otherwise(F.lit(False)))
    return df.join(sure.unionByName(held.select(*keys)).dropDuplicates(keys), keys, "left_semi").select(*df.columns)
