"""Hard negatives, token counts and spelling variants against plain versions and the tokenizer library."""

import json
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm import hard_negatives, spelling, token_counts
from ledgerline.llm.common import table
from tests.llm import brute

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


# --- hard negatives

VECTORS = "vec_id long, embedding array<double>, label int, id int, vec int, score int, near int, rank int, row_block int"


def vectors(spark, rows, parts=3):
    full = [(*r, 1, 2, 3, 4, 5, 6) for r in rows]
    return spark.createDataFrame(full, VECTORS).repartition(parts)


def mined(df, every, **more):
    got = hard_negatives.mine_hard_negatives(df, F.col("id") % every == 0, **more)
    return {tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()}


@pytest.mark.parametrize("spread", [1.0, 0.02])
def test_hard_negatives_equal_brute(spark, spread):
    rnd = random.Random(5)
    rows = [(i, [rnd.gauss(0.1, spread) for _ in range(12)], rnd.randrange(4)) for i in range(300)]
    got = mined(vectors(spark, rows), 10, block_rows=64, block_anchors=16)
    assert got == brute.hard_negatives(rows, lambda i: i % 10 == 0) and got


def test_hard_negatives_odd_rows(spark):
    tie = [0.5, 0.25, 0.0]
    rows = [
        (0, tie, 1), (10, tie, 1), (20, tie, 2), (30, tie, 2), (40, tie, 3), (5, tie, 1), (5, [0.5, 0.5, 0.5], 0),  # ties, a repeated id
        (1, None, 1), (2, [None, 1.0, 1.0], 1), (3, [float("nan"), 1.0, 1.0], 2), (4, [float("inf"), 0.0, 0.0], 2), (6, tie, None),
        (None, tie, 1), (7, [], 1), (8, [1.0], 2), (9, [0.0, 0.0, 0.0], 2), (11, [-1.0, -1.0, -1.0], 1), (50, [0.0, 0.0, 0.0], 1),
    ]
    want = brute.hard_negatives(rows, lambda i: i % 10 == 0)
    assert mined(vectors(spark, rows), 10, block_rows=4, block_anchors=2) == want and len(want) > 20
    assert mined(vectors(spark, rows).limit(0), 10) == set()


def test_scores_beyond_the_fast_range_stay_exact(spark):
    rows = [(i, [float(2**22 + i), 3.0e6 * (-1) ** i, float(i)], i % 2) for i in range(12)]
    assert mined(vectors(spark, rows), 3, low_percent=50) == brute.hard_negatives(rows, lambda i: i % 3 == 0, low=50)


def test_scan_prunes_and_keeps_the_best():
    rnd = np.random.default_rng(3)
    import pyarrow as pa

    vecs = rnd.integers(-200, 200, (500, 32))
    block = hard_negatives.Block(pa.table({"id": np.arange(500), "label": np.zeros(500, int), "vec": vecs.tolist()}), 200)
    looked = []

    def top(partial, low, high):
        looked.append(len(partial))
        floor = hard_negatives.kth_best(partial, 5)
        return [(floor + low - high, partial.max())]

    rows, scores = block.scan(vecs[7], np.arange(500), top)
    exact = vecs @ vecs[7]
    assert set(rows) >= set(np.argsort(-exact)[:5]) and (scores == exact[rows]).all()
    assert looked[-1] < looked[0]


# --- token counts

def library(texts):
    return [len(e.ids) for e in Tokenizer.from_file(VOCABULARY).encode_batch(texts, add_special_tokens=False)]


def test_token_counts_equal_the_library(spark):
    docs = table(spark, SF, "documents")
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in token_counts.count_tokens(docs, VOCABULARY).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert got == {d: (len((t or "").encode()), n) for (d, t), n in zip(rows, library([t or "" for _, t in rows]), strict=True)}


def test_token_counts_of_odd_texts(spark, make_docs, odd_rows):
    rnd = random.Random(9)
    letters = lambda: chr(rnd.choice([rnd.randrange(1, 0x250), rnd.randrange(0x370, 0x1200), rnd.randrange(0x3000, 0xD7FF), rnd.randrange(0x1F300, 0x1FAFF)]))
    odd = [
        "a" * 999, "ab" * 500, " " * 50, "\n \n\n\t", "<|endoftext|>", "x<|endoftext|><|endoftext|>y <|endoftext", "it's WE'LL 'd", "\x1c\x1d\x85  z",
        "".join(rnd.choices("abcdefgh", k=5000)), "12345" * 300, *("".join(letters() for _ in range(80)) for _ in range(200)),
    ]
    rows = [*odd_rows, *((100 + i, t) for i, t in enumerate(odd)), (None, None), (None, "x")]
    got = token_counts.count_tokens(make_docs(rows), VOCABULARY)
    want = sorted(((r[0] is None, r[0] or 0, len((r[1] or "").encode()), n) for r, n in zip(rows, library([r[1] or "" for r in rows]), strict=True)))
    assert sorted((r[0] is None, r[0] or 0, r[1], r[2]) for r in got.collect()) == want
    assert token_counts.count_tokens(make_docs([]), VOCABULARY).collect() == []


def test_small_batches_and_memory_give_the_same(monkeypatch):
    texts = [f"some words {i} and others{i * 7}" * 5 for i in range(200)]
    want = library(texts)
    monkeypatch.setattr(token_counts, "REMEMBERED", 20)
    monkeypatch.setattr(token_counts, "BATCH_CHARS", 500)
    monkeypatch.setattr(token_counts, "PIECES", 7)
    assert token_counts.Counter(token_counts.Merges(VOCABULARY)).count(texts) == want


def test_unsupported_vocabularies_are_refused(tmp_path):
    with open(VOCABULARY, encoding="utf-8") as f:
        spec = json.load(f)
    spec["model"]["merges"] = spec["model"]["merges"][::-1]
    path = tmp_path / "turned.json"
    path.write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="merge"):
        token_counts.Merges(str(path))
    with pytest.raises(ValueError):
        token_counts.Merges(public_tokenizers.path("word_bpe_49k.json"))


# --- spelling variants

def grouped(docs, **more):
    got = spelling.group_variants(docs, **more).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len({r[0] for r in got}) == len(got)
    return {tuple(r) for r in got}


def test_spelling_equals_brute(spark):
    docs = table(spark, SF, "documents")
    want = brute.spelling([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert grouped(docs, typo_every=31) == want
    assert any(form and form != root for _, form, root, *_ in want) or any(form for _, form, *_ in want)


def variants(rnd, word, alphabet):
    at = rnd.randrange(len(word))
    return rnd.choice([word[:at] + word[at + 1 :], word[:at] + rnd.choice(alphabet) + word[at:], word[:at] + rnd.choice(alphabet) + word[at + 1 :]])


@pytest.mark.parametrize("sizes", [{}, {"tile_words": 5, "tile_visits": 7, "task_rows": 40, "classes": 3}, {"classes": 8, "task_rows": 100}])
def test_spelling_in_tiles_equals_brute(spark, make_docs, sizes):
    rnd = random.Random(4)
    alphabet = "abeé×÷"  # few letters: crowded blocks, many anagrams
    words = ["".join(rnd.choices(alphabet, k=rnd.randint(7, 10))) for _ in range(60)] + ["ab" * 75, "ab" * 74 + "a"]
    words += [variants(rnd, w, alphabet) for w in words for _ in range(3)]
    texts = [" ".join(rnd.choices(words, weights=[(i % 17) ** 2 + 1 for i in range(len(words))], k=150)) for _ in range(40)]
    docs = [*enumerate(texts), (None, None), (None, texts[0].upper()), (3, ""), (7, "x" * 300 + " " + "x" * 301 + " " + "x" * 300)]
    assert grouped(make_docs(docs), typo_every=31, **sizes) == brute.spelling(docs)


def test_chains_of_forms_end_at_their_root(spark, make_docs):
    chain = [("aaaaaaa", 2), ("aaaaaab", 20), ("aaaaabb", 200), ("aaaabbb", 2000), ("aaabbbb", 20000)]
    docs = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(chain)]
    got = grouped(make_docs(docs))
    assert got == brute.spelling(docs, typo_every=None)
    assert {root for _, _, root, *_ in got} == {"aaabbbb"}


def test_spelling_of_odd_rows(spark, make_docs, odd_rows):
    for typo in (None, 31):
        assert grouped(make_docs(odd_rows), typo_every=typo) == brute.spelling([r[:2] for r in odd_rows], typo_every=typo)
    assert grouped(make_docs([])) == set()
