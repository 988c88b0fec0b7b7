"""Bucketed versions without a shuffle of the base, and keyword filters over a table of terms."""

import random

import pytest

from ledgerline.functions.text import keyword_filter
from ledgerline.operators.keywords import keyword_semi_join
from ledgerline.operators.merge import merge_by_key
from ledgerline.plans.buckets import bucket_spec, merge_bucketed_version, merged_buckets, write_bucketed


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_bucketed_versions(spark, scratch):
    rnd = random.Random(3)
    name = "bucketed_" + scratch("n").rsplit("/", 1)[-1]
    table = lambda n, tag, kind="int": spark.createDataFrame([(rnd.choice([None, *range(200)]), f"{tag}{i}") for i in range(n)], f"k {kind}, v string")
    base, deltas, more = table(500, "b"), table(80, "d"), table(60, "e", "long").select("v", "k")
    write_bucketed(base, name, 4, ["k"], scratch("t"))
    assert bucket_spec(spark, name) == (4, ["k"])
    one = merge_bucketed_version(spark, name, deltas, "v1", scratch("t"))
    want = merge_by_key(base, deltas, "k")
    assert one == f"{name}_v1" and bucket_spec(spark, one) == (4, ["k"]) and _sorted(spark.table(one)) == _sorted(want)
    # the second merge: the base's buckets are read as they are, only the deltas are exchanged
    plan = merged_buckets(spark, one, more)._jdf.queryExecution().executedPlan().toString()
    base_side = plan.split("ShuffledHashJoin")[1].split("Exchange")[0]
    assert "LeftAnti" in base_side and "Bucketed: true" in base_side and "SelectedBucketsCount: 4 out of 4" in base_side
    two = merge_bucketed_version(spark, one, more, "v2", scratch("t"))
    assert _sorted(spark.table(two)) == _sorted(merge_by_key(want, more, "k"))
    assert len(spark.table(two).inputFiles()) <= 2 * 4
    with pytest.raises(ValueError):
        merged_buckets(spark, one, more.drop("v"))


def test_tables_without_buckets_are_refused(spark, scratch):
    name = "plain_" + scratch("n").rsplit("/", 1)[-1]
    spark.range(3).write.option("path", scratch("t")).saveAsTable(name)
    with pytest.raises(ValueError, match="not bucketed"):
        bucket_spec(spark, name)


TERMS = ["fox", "brown dog", "#tag", "c++", "é", "naïve", "日本", "!!", "a.b", "x_y", "END", "\\E", "$", "two  blanks", "the", "-lead", "trail-", "9"]


@pytest.mark.parametrize("broadcast", [True, False])
def test_term_table_equals_the_pattern(spark, monkeypatch, broadcast):
    from ledgerline.operators import keywords

    if not broadcast:
        monkeypatch.setattr(keywords, "BROADCAST_TERMS", 0)
    rnd = random.Random(8)
    pieces = [*TERMS, "foxes", "brown", "dog", "tag", "c", "+", "_", "x", "y", " ", " ", " ", "\n", ".", "E", "Fox", "endless", "99", "日", "lead"]
    texts = ["".join(rnd.choices(pieces, k=rnd.randint(1, 6))) for _ in range(400)] + ["", None, "FOX", "brown  dog", "The end", "\\e"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for some in (TERMS, TERMS[:1], TERMS[6:8]):
        terms = spark.createDataFrame([(t,) for t in [*some, *some, None, ""]], "term string")
        got = keyword_semi_join(df, "text", terms, "id")
        assert got.columns == df.columns and _sorted(got) == _sorted(keyword_filter(df, "text", some))
    assert keyword_semi_join(df, "text", spark.createDataFrame([], "term string"), "id").count() == 0
    assert keyword_semi_join(df.limit(0), "text", spark.createDataFrame([("a",)], "term string"), ["id"]).count() == 0


def test_terms_of_several_words_are_looked_for_before_patterns_are_compiled(spark):
    docs = spark.createDataFrame([(1, "the old zebra"), (2, "The, zebra"), (3, "the zebras"), (4, "a the zebra."), (5, "the the"), (6, None)], "doc_id long, text string")
    terms = spark.createDataFrame([("the zebra",), ("the, ze",), ("the  the",), ("",), (None,)], "term string")
    got = keyword_semi_join(docs, "text", terms, "doc_id")
    assert [r["doc_id"] for r in got.collect()] == [4]
    plan = got._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.index("contains(__low") < plan.index("rlike")
