"""The registered queries: SQL twins, the pipeline's stages, and that nothing else imports the subpackage."""

import os
import subprocess

import corpus_pipeline
import duckdb
import pytest

import __spark_entry__ as entry
from ledgerline.llm.common import staged, table
from ledgerline.llm.queries import ORACLE, QUERIES
from tests.llm import brute
from tools.check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_registered():
    names = set(entry.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    df, res = QUERIES[name](spark, SF), con.execute(ORACLE[name])
    columns = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted(rows_of(df.columns, df.collect())) == sorted(rows_of(columns, res.fetchall()))


def test_stages_keep_the_columns(spark):
    docs = table(spark, SF, "documents")
    sizes, before = [], docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF)
        assert after.columns == docs.columns and after.schema == docs.schema
        sizes.append(after.count())
        before = after
    assert sizes == sorted(sizes, reverse=True) and sizes[0] < docs.count()
    assert len(corpus_pipeline.STAGES) == 5


def _bench(spark):
    return [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]


def test_stages_against_brute_force(spark):
    """Each stage on all that the one before it kept."""
    stages, pairs = dict(corpus_pipeline.STAGES), lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]
    docs = table(spark, SF, "documents")
    good = staged(stages["quality"](spark, docs, SF), "good")
    scores = QUERIES["op9_quality"](spark, SF).where("predicted = 1")
    assert sorted(pairs(good)) == sorted(pairs(docs.join(scores, "doc_id", "left_semi")))
    cut = staged(stages["line_dedup"](spark, good, SF), "cut")
    left = {doc: words for doc, words in brute.dedup_words(pairs(good)).items() if words}
    assert {doc: text.split() for doc, text in pairs(cut) if text.split()} == left
    single = staged(stages["near_duplicates"](spark, cut, SF), "single")
    want = brute.one_of_each(pairs(cut))
    assert sorted(doc for doc, _ in pairs(single)) == sorted(doc for doc, _ in want)
    clean = staged(stages["decontaminate"](spark, single, SF), "clean")
    bad = {doc for doc, n, hit, _ in brute.contamination(pairs(single), _bench(spark)) if hit and 20 * hit >= n}
    assert sorted(pairs(clean)) == sorted(x for x in pairs(single) if x[0] not in bad)
    mixed, sizes = stages["mix_sources"](spark, clean, SF).collect(), {}
    for r in clean.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(brute.spaced(r["text"]))
    targets = brute.targets(sizes)
    assert len(mixed) == clean.count()
    for source, target in targets.items():
        mine = [r for r in mixed if r["source"] == source]
        assert all(r["source_size"] == sizes[source] and abs(r["target"] - target) < 1e-6 and 0 <= r["taken"] <= 3 * r["size"] for r in mine)
        assert abs(sum(r["taken"] for r in mine) - target) <= 32


def test_pipeline_odd_rows_and_empty_tables(spark, make_docs, odd_rows, tmp_path):
    """Nulls, repeated rows and ids, clashing columns, and tables without rows."""
    passage = _bench(spark)[0][1]
    rows = [*odd_rows, (1, "another text of the first id"), (None, odd_rows[0][1]), (40, passage), (None, None)]
    no_bench = spark.createDataFrame([], "item_id long, text string")
    for name, docs, bench in (("odd", make_docs(rows), table(spark, SF, "benchmark")), ("none", make_docs([]), no_bench)):
        folder = str(tmp_path / name)
        docs.write.parquet(f"{folder}/documents.parquet")
        bench.write.parquet(f"{folder}/benchmark.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        out = corpus_pipeline.run(spark, folder)
        assert out.columns == ["doc_id", "source", "size", "source_size", "target", "taken"]
        got = out.collect()
        if name == "none":
            assert got == []
            continue
        ids = [r["doc_id"] for r in got]
        assert 40 not in ids and 20 not in ids and ids.count(1) == 2 and 4 in ids
        assert sum(r["size"] for r in got if r["doc_id"] == 1) == len(odd_rows[0][1].split()) + 6
        assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)


def test_nothing_else_imports_the_subpackage():
    found = subprocess.run(["git", "grep", "-lE", r"(ledgerline\.llm|from \.*llm)", "--", "*.py"], cwd=ROOT, capture_output=True, text=True).stdout.split()
    assert {f for f in found if not f.startswith(("ledgerline/llm/", "tests/llm/"))} <= {"__spark_entry__.py", "corpus_pipeline.py"}
