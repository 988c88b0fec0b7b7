"""Operators on documents against their brute-force versions, odd rows included."""

import math

from tests.llm import brute
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import common, decontaminate, line_dedup, mixing, ngram_jaccard, ngram_lm, quality

SF = "/root/testdata/sf0.001"


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()), key=repr)


# --- mixing -----------------------------------------------------------------------------------

def test_apportion_equals_highest_quotients(spark):
    votes = {1: 900.0, 2: 37.5, 3: 37.5, 4: 1.0, 5: 411.0, 6: 3.0}
    for seats in (1, 2, 7, 40, 1000):
        df = spark.createDataFrame([(0, k, v, seats) for k, v in votes.items()], "g int, k int, votes double, seats long")
        got = {r["k"]: r["seats"] for r in mixing.apportion(df, ["g"], "k", F.col("seats")).collect()}
        assert got == brute.sainte_lague(votes, seats)


def test_targets_are_water_filled(spark):
    sizes = {"a": 10, "b": 5000, "c": 100, None: 7, "d": 800, "e": 0}
    df = spark.createDataFrame(list(sizes.items()), "source string, z long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df, (1, 2, 3), 3).collect()}
    want = brute.targets(sizes)
    assert all(math.isclose(got[s], want[s], abs_tol=1e-6) for s in sizes)


def test_mix(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    got = mixing.mix_sources(docs, block_words=4, shard_words=500).collect()
    again = mixing.mix_sources(docs.repartition(5), block_words=4, shard_words=500).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    assert len(got) == len(odd_rows)
    sizes = {}
    for _, text, source in odd_rows:
        sizes[source] = sizes.get(source, 0) + len(brute.spaced(text))
    want, taken = brute.targets(sizes), dict.fromkeys(sizes, 0)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], want[r["source"]], abs_tol=1e-6)
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    shards = lambda s: 1 + sizes[s] // 500
    assert all(abs(taken[s] - want[s]) <= 4 * shards(s) for s in sizes)


# --- decontamination --------------------------------------------------------------------------

@pytest.mark.parametrize("block_windows", [500_000, 7])
def test_decontamination(spark, make_docs, odd_rows, block_windows):
    base = odd_rows[0][1].split()
    bench = [(1, " ".join(base[20:50])), (2, " ".join(base[30:45]).upper()), (3, "Changed"), (4, None), (5, "-- !"), (None, " ".join(base[:13])), (12, "word")]
    tests = spark.createDataFrame([(*b, "x") for b in bench], "item_id long, text string, words string")
    got = decontaminate.find_contamination(make_docs(odd_rows), tests, block_windows=block_windows)
    want = brute.contamination([r[:2] for r in odd_rows], bench)
    assert rows(got, "doc_id", "n_words", "n_hit", "items") == sorted(want, key=repr)
    flagged = {(d, n) for d, n, hit, _ in want if hit and 20 * hit >= n}
    kept = decontaminate.remove_contaminated(make_docs(odd_rows), tests)
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in kept.collect()) == sorted(
        (d is not None, d or 0) for d, n, hit, _ in want if (d, n) not in flagged
    )
    assert kept.columns == make_docs(odd_rows).columns


def test_spans_are_cut(spark, make_docs):
    docs = make_docs([(1, "Keep this, One two THREE; four. Then go on"), (2, "none of it"), (3, None)])
    tests = spark.createDataFrame([(1, "one two three four")], "item_id long, text string")
    cut = {r["doc_id"]: r["text"] for r in decontaminate.remove_contaminated(docs, tests, mode="spans").collect()}
    assert cut == {1: "Keep this,   ; . Then go on", 2: "none of it", 3: None}


# --- near duplicates --------------------------------------------------------------------------

def test_jaccard_components(make_docs, odd_rows):
    got = ngram_jaccard.jaccard_components(make_docs(odd_rows))
    assert rows(got, "doc_id", "n_shingles", "component_id") == sorted(brute.jaccard_components([r[:2] for r in odd_rows]), key=repr)


def _chains():
    """Families of near copies that drift, a shared passage, and links only between far members."""
    import random

    rnd = random.Random(3)
    word = lambda: "".join(rnd.choices("abcdefghijklmnop", k=5))
    passage, out = [word() for _ in range(40)], []
    for family in range(12):
        text = [word() for _ in range(rnd.choice([25, 60, 150]))] + passage
        for _ in range(rnd.choice([1, 4, 15])):
            out.append((len(out) * 7 % 1009, " ".join(text)))
            text = list(text)
            for _ in range(rnd.choice([1, 2])):
                text[rnd.randrange(len(text))] = word()
    return out


@pytest.mark.parametrize("frequent", [4, 10_000])
def test_jaccard_chains(make_docs, monkeypatch, frequent):
    monkeypatch.setattr(ngram_jaccard, "FREQUENT_LEAST", frequent)
    monkeypatch.setattr(ngram_jaccard, "LOCAL_COUNT", 2)
    monkeypatch.setattr(ngram_jaccard, "MAX_FREQUENT", 300)
    docs = _chains()
    got = ngram_jaccard.jaccard_components(make_docs(docs))
    assert rows(got, "doc_id", "n_shingles", "component_id") == sorted(brute.jaccard_components(docs), key=repr)


@pytest.mark.parametrize(("bounds", "lead"), [((3, 10**6), 8), ((1024, 200), 1), ((1, 1), 2)])
def test_jaccard_tiles(make_docs, monkeypatch, bounds, lead):
    """Blocks cut into tiles by size class and hash give the same components, also where the common columns
    asked for grow with the size."""
    monkeypatch.setattr(ngram_jaccard, "TILE_ROWS", bounds[0])
    monkeypatch.setattr(ngram_jaccard, "TILE_CELLS", bounds[1])
    docs = _chains()
    got = ngram_jaccard.jaccard_components(make_docs(docs), lead=lead)
    assert rows(got, "doc_id", "n_shingles", "component_id") == sorted(brute.jaccard_components(docs), key=repr)


@pytest.mark.parametrize("rows_of_tile", [3, 1024])
def test_sets_go_where_they_may_link(make_docs, monkeypatch, rows_of_tile):
    """Rows that share a passage with each of many others are sent nowhere, and linked rows meet."""
    from collections import Counter
    from itertools import combinations

    monkeypatch.setattr(ngram_jaccard, "TILE_ROWS", rows_of_tile)
    passage = lambda i, j: " ".join(f"p{min(i, j)}x{max(i, j)}x{k}" for k in range(12))
    loose = [(5000 + i, " ".join(passage(i, j) for j in range(12) if j != i)) for i in range(12)]
    docs = _chains() + loose
    product = ngram_jaccard.Product(make_docs(docs), 5, 80, 8)
    tiles = common.staged(product.tiles(), "tiles")
    met = common.staged(product.met(tiles), "met")
    assert {r["row"] for r in tiles.where("row >= 5000").collect()} == {d for d, _ in loose}  # as whole sets did before
    assert met.where("row >= 5000").isEmpty()
    groups, own = {}, {(*r[:3], r["row"]): r["tile"] for r in tiles.collect()}
    for r in met.collect():
        groups.setdefault(tuple(r[:3]), []).append(r["row"])
    apart = lambda key, a, b: key[1] == key[2] or own[*key, a] != own[*key, b]
    times = Counter(tuple(sorted(p)) for key, found in groups.items() for p in combinations(found, 2) if apart(key, *p))
    sets = {d: {tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for d, t in docs}
    linked = [p for p in combinations(sorted(sets), 2) if 100 * len(sets[p[0]] & sets[p[1]]) >= 80 * len(sets[p[0]] | sets[p[1]])]
    assert linked and all(times[p] >= 1 for p in linked)
    assert len(groups) < len({tuple(r[:3]) for r in tiles.collect()})
    got = ngram_jaccard.jaccard_components(make_docs(docs))
    assert rows(got, "doc_id", "n_shingles", "component_id") == sorted(brute.jaccard_components(docs), key=repr)


def test_tasks_get_few_texts_at_a_time(spark, make_docs, monkeypatch):
    """Python tasks of near duplicates and line dedup never get a batch of Spark's full size."""
    def sizes(batches):
        for b in batches:
            yield b.from_pydict({"n": [b.num_rows]})

    before = spark.conf.get(common.BATCH)
    small = common.staged(spark.range(100).repartition(1).mapInArrow(sizes, "n long"), "sizes", 8)
    assert max(r["n"] for r in small.collect()) == 8 and spark.conf.get(common.BATCH) == before
    seen = []

    def spy(df, name="stage", batch_rows=None):
        if "MapInArrow" in df._jdf.queryExecution().analyzed().toString():
            seen.append((name, batch_rows))
        return common.staged(df, name, batch_rows)

    monkeypatch.setattr(ngram_jaccard, "staged", spy)
    monkeypatch.setattr(line_dedup, "staged", spy)
    docs = make_docs(_chains()[:20])
    ngram_jaccard.Product(docs, 5, 80, 8).links()
    line_dedup.repeated_windows(docs)
    assert len(seen) == 7 and all(rows is not None and rows <= 1000 for _, rows in seen)


def test_word_cache_is_small(monkeypatch):
    """A task's word cache stays small, and sets are the same however often it is emptied."""
    texts = [text for _, text in _chains()]
    assert ngram_jaccard.CACHE <= 100_000
    hashes = ngram_jaccard.WordHashes()
    whole = [ngram_jaccard.ngram_set(t, hashes).tolist() for t in texts]
    monkeypatch.setattr(ngram_jaccard, "CACHE", 5)
    hashes = ngram_jaccard.WordHashes()
    assert [ngram_jaccard.ngram_set(t, hashes).tolist() for t in texts] == whole and len(hashes) <= 6


def test_product_of_sets(monkeypatch):
    import numpy as np

    monkeypatch.setattr(ngram_jaccard, "STRIP", 50)  # strips of a few columns
    hashes = ngram_jaccard.WordHashes()
    sets = [ngram_jaccard.ngram_set(text, hashes) for _, text in _chains()]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]
    got = ngram_jaccard.overlaps(sets)
    off = ~np.eye(len(sets), dtype=bool)  # columns of one row alone are left out, which only the diagonal shows
    assert (got[off] == np.array(want)[off]).all()
    chain = [np.arange(i, i + 20, dtype=np.uint64) for i in (0, 2, 4, 40)]
    assert ngram_jaccard.forest(chain, 80).tolist() == [0, 0, 0, 3]
    assert ngram_jaccard.forest(chain[:2], 80).tolist() == [0, 0] and ngram_jaccard.forest(chain[2:], 80).tolist() == [0, 1]


def test_components(spark):
    links = [(9, 8), (8, 7), (7, 1), (1, 1), (20, 30), (30, 25), (41, 40), (40, 39), (39, 38), (38, 37), (37, 36), (36, 41)]
    got = ngram_jaccard.components(spark.createDataFrame(links, "a long, b long"))
    want = {9: 1, 8: 1, 7: 1, 1: 1, 20: 20, 30: 20, 25: 20} | {i: 36 for i in range(36, 42)}
    assert {r["node"]: r["component"] for r in got.collect()} == want


def _fits(kept, want):
    """Every kept (doc_id, text) row is one that may stay, and there is one for each group."""
    kept, want = list(kept), list(want)
    assert len(kept) == len(want)
    for doc, texts in want:
        row = next(r for r in kept if r[0] == doc and r[1] in texts)
        kept.remove(row)


def test_one_of_each(make_docs, odd_rows):
    near = " ".join(odd_rows[0][1].split()[:150])
    rows = [
        *odd_rows,
        (1, "some unrelated words under an id that is used twice"), (20, "other words under the id of a copy"),
        (None, near), (None, near), (None, near + " x"), (30, "a b c d e f"), (30, "a b c d e f"), (30, "g h i j k"), (None, None), (None, ""),
    ]
    docs = make_docs(rows)
    kept = ngram_jaccard.one_of_each(docs)
    assert kept.schema == docs.schema
    kept = [(r["doc_id"], r["text"]) for r in kept.collect()]
    _fits(kept, brute.one_of_each([r[:2] for r in rows]))
    assert [d for d, _ in kept].count(30) == 2 and (20, rows[17][1]) in kept and (1, rows[16][1]) in kept
    again = ngram_jaccard.one_of_each(make_docs(rows, 7)).collect()
    assert sorted(map(repr, kept)) == sorted(repr((r["doc_id"], r["text"])) for r in again)


# --- line dedup -------------------------------------------------------------------------------

def test_line_dedup(make_docs, odd_rows):
    run = "\n".join("line %d " % i + " ".join(f"w{i}x{j}" for j in range(12)) for i in range(6))
    short = "\n".join(run.split("\n")[:2])
    docs = [(1, "alone\n" + run + "\nafter"), (2, run), (3, "x\n" + short + "\ny"), (4, run + "\n" + run), (5, "  " + run.replace(" ", "  ")), (6, ""),
            (7, "\n".join(["same line here again"] * 60)), (8, odd_rows[11][1] + "\n" + run)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.drop_repeated_lines(make_docs(docs)).collect()}
    assert got == brute.dedup_lines(docs)
    assert got[2] == "" and got[3] == docs[2][1] and got[1] == docs[0][1]


def test_line_dedup_odd_rows(make_docs, odd_rows):
    got = line_dedup.drop_repeated_lines(make_docs(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    texts = [(r["doc_id"], r["text"]) for r in got]
    assert (4, None) in texts and (5, "") in texts and texts.count((2, "")) == 2


def test_texts_are_cut_once(spark, make_docs):
    """A filter on what went does not have every text cut a second time, by two more Python workers of a task."""
    import corpus_pipeline

    run = " ".join(f"w{i}" for i in range(60))
    docs = make_docs([(1, run), (2, "before\n" + run + "\nafter"), (3, "\n".join(run.split(" ")[:55])), (4, "few words"), (5, None)])
    cut = corpus_pipeline.without_repeated_lines(spark, docs, SF)
    assert cut._jdf.queryExecution().executedPlan().toString().count("EvalPython") == 1
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in cut.collect()} == {1: (run, len(run)), 2: ("before\nafter", 12), 4: ("few words", 9), 5: (None, 0)}


def test_word_hashes_tell_words_apart():
    texts = ["", " \n", "a", "ab ba\u00a0ab\u2003é \x1c x", "a" * 300_000 + " b " + "a" * 299_999 + " " + "a" * 299_998 + "ba", "w " * 200_000 + "end"]
    seen = {}
    for text in texts:
        words, hashes = text.split(), line_dedup.word_hashes(text).tolist()
        assert len(words) == len(hashes) and all(seen.setdefault(w, h) == h for w, h in zip(words, hashes, strict=True))
    assert len(set(seen.values())) == len(seen) == 11


def test_broadcasts_are_bounded_by_bytes(spark):
    df = spark.range(10).select("id", F.sequence(F.lit(0), F.col("id")).alias("a"), F.array(F.lit("xy")).alias("b"), F.array(F.struct("id")).alias("c"))
    joined = lambda **bound: spark.range(10).join(common.sized_broadcast(df, **bound), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in joined() and "strategy=broadcast" not in joined(max_bytes=500) and "strategy=broadcast" not in joined(max_rows=9)


def test_line_dedup_inside_lines(make_docs):
    """Passages that start or end inside a line, of which no whole lines hold 50 words, against every window in plain Python."""
    import random

    rnd = random.Random(5)
    word = lambda: "".join(rnd.choices("abcdefghij", k=6))
    words = lambda n: " ".join(word() for _ in range(n))
    a, b, c, seed = words(30), words(41), words(45), words(40)
    docs = [
        (1, words(20) + " " + a + "\n" + b + " " + words(9)), (2, "own " + a + "\n" + b + " more of it"), (3, a + " " + b + "\n\n"),
        (4, c + " " + words(4)), (5, c + " four other words here"),  # 45 words: too few
        (6, seed + " " + words(3)), (7, seed + " " + a), (8, "x " + seed + " " + a + " y"),  # the first place of the seed is not that of the match
        (9, "\n".join([words(60)] * 2)), (10, "a b " * 100), (11, a + "\n" + b), (None, a + "\n" + b),
    ]
    first, places = {}, []
    for doc, text in sorted(docs, key=lambda d: (d[0] is None, d[0])):
        w = text.split()
        for i in range(len(w) - 49):
            first.setdefault(tuple(w[i : i + 50]), (doc, i))
            places.append((doc, i, first[tuple(w[i : i + 50])]))
    gone = {(doc, i + k) for doc, i, (d, j) in places if d != doc or i >= j + 50 for k in range(50)}
    got = {r["doc_id"]: r for r in line_dedup.drop_repeated_lines(make_docs(docs)).collect()}
    for doc, text in docs:
        assert got[doc]["text"].split() == [x for i, x in enumerate(text.split()) if (doc, i) not in gone]
    assert got[2]["text"] == "own\nmore of it" and got[2]["__n_removed"] == 0
    assert got[3]["text"] == "" and got[3]["__n_removed"] == got[3]["__n_lines"] == 3
    assert got[8]["text"] == "x y" and [got[i]["text"] for i in (4, 5, 11, None)] == [docs[3][1], docs[4][1], "", ""]


# --- language model ---------------------------------------------------------------------------

@pytest.mark.parametrize("sizes", [(2_000_000, 4_000_000), (900, 2_500)])
def test_lm(make_docs, odd_rows, monkeypatch, sizes):
    monkeypatch.setattr(ngram_lm, "BLOCK_TOKENS", sizes[0])
    monkeypatch.setattr(ngram_lm, "SHARD_TOKENS", sizes[1])
    got = {}
    for r in ngram_lm.score_texts(make_docs(odd_rows)).collect():
        got.setdefault((r["doc_id"], r["n_tokens"]), []).append(r)
    docs = [r[:2] for r in odd_rows]
    for (doc, _), (n, known, total, base, score) in zip(docs, brute.lm_scores(docs, ngram_lm.MU), strict=True):
        r = got[doc, n].pop()
        assert (r["held_out"], r["n_known"], r["train_tokens"]) == (brute.held_out(doc, 10), known, total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert abs(r["score"] - score) <= 0.05 * n  # a gain's quantisation
    assert not any(got.values())


@pytest.mark.parametrize("key_bits", [62, 2])
def test_lm_words_that_share_hash_bits(make_docs, monkeypatch, key_bits):
    """Words whose hashes agree in 24 bits are still words of their own, as contexts and as successors."""
    import xxhash

    monkeypatch.setattr(ngram_lm, "KEY_BITS", key_bits)  # whole numbers, or ranks where they do not fit
    seen, pairs = [{}, {}], [None, None]
    for word in (f"w{i}" for i in range(40_000)):
        h = xxhash.xxh64_intdigest(word.encode())
        for k in (0, 1):
            bits = h >> 24 * k & 0xFFFFFF
            pairs[k] = pairs[k] or ((seen[k][bits], word) if bits in seen[k] else None)
            seen[k].setdefault(bits, word)
    (c1, c2), (s1, s2) = pairs
    trained = [i for i in range(200) if not brute.held_out(i, 10)]
    held = [i for i in range(200) if brute.held_out(i, 10)]
    docs = [(i, f"{c1} {s1}") for i in trained[:60]] + [(i, f"x {c2} y {s2} z") for i in trained[60:70]] + [(held[0], f"{c1} {s2}"), (held[1], f"{c2} {s1}")]
    got = {r["doc_id"]: r["score"] for r in ngram_lm.score_texts(make_docs(docs)).collect()}
    for (doc, _), want in zip(docs, brute.lm_scores(docs, ngram_lm.MU), strict=True):
        assert abs(got[doc] - want[4]) <= 0.05 * want[0]


def test_lm_large_gains_and_rare_words():
    import numpy as np

    keys = np.arange(1, 6, dtype=np.uint64) << np.uint64(24)
    gains = np.array([0.5, 7.96875, 8.5, 12.0, 20.0])  # a gain is at most about log10(N / 22)
    assert np.allclose(ngram_lm.Trie(keys, gains).gains(keys), gains)
    rare = np.array([1.0, 10.625, 11.0, 16.0])  # -log10 p of a word
    assert np.allclose(ngram_lm.quantise(rare, ngram_lm.BASE_STEP) * ngram_lm.BASE_STEP, rare, atol=ngram_lm.BASE_STEP)


def test_elias_fano_and_trie():
    import numpy as np

    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 9), (5000, 5001), (20_000, 1 << 40)):
        values = np.sort(rng.integers(0, top, n))
        coded = ngram_lm.EliasFano.of(values)
        assert (coded.all() == values).all()
        for _ in range(20):
            a, b = sorted(rng.integers(0, n + 1, 2))
            assert (coded.window(int(a), int(b)) == values[a:b]).all()
    keys = np.unique((rng.integers(0, 300, 40_000).astype(np.uint64) << np.uint64(24)) | rng.integers(0, 5000, 40_000).astype(np.uint64))
    gains = rng.integers(1, 200, len(keys)) * ngram_lm.STEP
    held = rng.random(len(keys)) < 0.5
    trie = ngram_lm.Trie(keys[held], gains[held])
    for chunk in (1 << 18, 100):
        assert np.allclose(trie.gains(keys, chunk), np.where(held, gains, 0))


# --- quality ----------------------------------------------------------------------------------

def test_quality_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.score_quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["quality"] for r in scored) / len(scored)
    assert right > 0.93 and all(0 <= r["score"] <= 1 for r in scored)


def test_every_word_has_a_vector():
    """Pooled vectors against plain sums, for words that the sample holds (also once) and for others."""
    import numpy as np

    vectors = quality.Vectors(["One two two, three.", "four one"])
    assert set(vectors.words) == {"one", "two", "three", "four"}
    pooler, dim = quality.Pooler(vectors), quality.WORD_DIM
    text = "Two never seen one words seen three three"
    want = np.zeros(dim)
    for word in text.lower().split():
        at = vectors.words.get(word)
        want += vectors.word_rows[at] if at else quality.index_rows([word], dim)[1]
        assert np.abs(quality.index_rows([word], dim)[1]).sum() > 0
    got = pooler.pool([text, "", None])
    assert np.allclose(got[0, :dim], want / 8, atol=1e-5) and np.isclose(got[0, -1], 4 / 8) and not got[1:].any()


def test_quality_sample_is_bounded(spark, make_docs):
    docs = make_docs([(i, "x" * 100) for i in range(40)] + [(3, "y"), (None, "z")])
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    held = {i for i in range(40) if brute.held_out(i, 5)}
    assert len(quality.labelled_sample(docs, labels)) == 40 - len(held)
    assert len(quality.labelled_sample(docs, labels, sample_rows=7)) == 7
    assert len(quality.labelled_sample(docs, labels, sample_bytes=1000)) == 10


def test_quality_odd_rows(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.score_quality(docs, none).collect()
    assert len(got) == len(odd_rows) and {r["score"] for r in got} == {0.5}
    some = spark.createDataFrame([(1, 1, None), (3, 0, 0), (2, None, 1), (None, 0, 0), (11, 0, 0), (11, 1, 0), (12, 1, 0), (9, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.score_quality(docs, some).collect()
    assert len(got) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in got)
    kept = quality.keep_quality(docs, some, threshold=0.0)
    assert kept.columns == docs.columns and kept.count() == len(odd_rows)


# --- empty tables -----------------------------------------------------------------------------

def test_empty_tables(spark, make_docs):
    empty, none = make_docs([]), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert mixing.mix_sources(empty).count() == 0
    assert decontaminate.find_contamination(empty, bench).count() == 0
    assert decontaminate.find_contamination(make_docs([(1, "a b")]), bench).first()["n_hit"] == 0
    assert ngram_jaccard.jaccard_components(empty).count() == 0
    assert line_dedup.drop_repeated_lines(empty).count() == 0
    assert ngram_lm.score_texts(empty).count() == 0
    assert quality.score_quality(empty, none).count() == 0


def test_repeated_columns_are_counted_where_they_are():
    import tracemalloc

    import numpy as np

    from ledgerline.llm import ngram_jaccard as nj

    for size, top in ((0, 5), (1, 5), (2, 1), (3, 1), (50, 9), (1000, 300), (1000, 2)):
        values = np.random.default_rng(size + top).integers(0, top, size).astype(np.uint64) * np.uint64(0xF000000000000001)
        want = {int(v): int(n) for v, n in zip(*np.unique(values.view(np.int64), return_counts=True)) if n >= nj.LOCAL_COUNT}
        got = nj.repeated(values.copy())
        assert dict(zip(got["token"].to_pylist(), got["n"].to_pylist())) == want
    values = np.random.default_rng(1).integers(0, 1 << 60, 1_000_000).astype(np.uint64)
    tracemalloc.start()
    nj.repeated(values)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < values.nbytes  # sorted in place, and only the frequent ones leave
