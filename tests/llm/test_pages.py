"""Operators on pages and embeddings against brute force, round trips and written cases."""

import base64
import hashlib
import random

from tests.llm import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import ann, html_extract, url_rules, warc
from ledgerline.session import scratch_path

SF = "/root/testdata/sf0.01"
PAGE_SCHEMA = "page_id long, url string, html string, key string, digest string, file string"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "k", "d", "f") for r in rows], PAGE_SCHEMA)


# --- nearest neighbours -----------------------------------------------------------------------

def _exact(vectors, queries, k=5):
    out = {}
    for q in queries:
        scores = [(-float(np.dot(vectors[q], v) / np.sqrt(np.dot(vectors[q], vectors[q]) * np.dot(v, v))), i) for i, v in vectors.items() if i != q]
        out[q] = sorted((round(s, 12), i) for s, i in scores)[:k]
    return out


def _odd_vectors():
    rng = np.random.default_rng(5)
    good = {i: rng.normal(size=8) for i in range(300)}
    for i in range(100, 180):
        good[i] = good[100].copy()  # ties
    rows = [(i, [float(x) for x in v]) for i, v in good.items()]
    rows += [(7, rows[7][1]), (1001, None), (1002, [0.0] * 8), (1003, [float("nan")] * 8), (1004, [None] + [1.0] * 7), (None, [1.0] * 8),
             (1005, [float("inf")] + [0.0] * 7), (1006, [1.0] * 3), (1050, None)]
    return {i: np.array(v) for i, v in good.items()}, rows


@pytest.mark.parametrize("blocks", [(16_384, 2_048), (20, 2)])
def test_ann_all_cells_is_exact(spark, blocks):
    good, rows = _odd_vectors()
    df = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "vec_id long, embedding array<double>, id int, score double").repartition(4)
    got = ann.nearest_neighbours(df, F.col("id") % 50 == 0, share=1.0, centroids=6, block_rows=blocks[0], block_queries=blocks[1])
    found = {}
    for r in got.orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((round(-r["score"], 12), r["vec_id"]))
    assert found == _exact(good, range(0, 300, 50))


def test_ann_recall(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    vectors = {r["vec_id"]: np.array(r["embedding"], float) for r in table.collect()}
    want = _exact(vectors, [i for i in vectors if i % 20 == 0])
    got = ann.nearest_neighbours(table, F.col("id") % 20 == 0, min_candidates=0).collect()
    hits = sum((r["vec_id"] in {i for _, i in want[r["query_id"]]}) for r in got)
    assert hits / sum(map(len, want.values())) >= 0.9


def test_ann_small_and_empty(spark):
    schema = "vec_id long, embedding array<float>"
    one = spark.createDataFrame([(0, [1.0, 0.0]), (3, [0.0, 2.0]), (4, [1.0, 1.0])], schema)
    assert [(r["rank"], r["vec_id"]) for r in ann.nearest_neighbours(one, F.col("id") % 50 == 0).orderBy("rank").collect()] == [(1, 4), (2, 3)]
    assert ann.nearest_neighbours(spark.createDataFrame([], schema), F.col("id") % 50 == 0).count() == 0


def test_walk_is_in_order_of_summed_distance():
    rng = np.random.default_rng(2)
    left, right = rng.random(7), rng.random(9)
    cells = ann.walk(left, right, np.ones((7, 9), int), 40)
    sums = [left[a] + right[b] for a, b in cells]
    assert len(cells) == 40 and sums == sorted(sums) and max(sums) <= sorted(np.add.outer(left, right).ravel())[39] + 1e-12


# --- urls -------------------------------------------------------------------------------------

URLS = [
    ("http://WWW.Example.ORG/es/1", "www.example.org", "/es/1", "example.org/es/", "block"),
    ("https://a.example.org/en/12?x#y", "a.example.org", "/en/12", "example.org/en/1", "block"),
    ("https://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    ("http://x.com/de/#/fr/", "x.com", "/de/", "com/de/", "block"),
    ("http://x.com/fr/", "x.com", "/fr/", "com/fr/", "allow"),
    ("http://xcom/fr/", "xcom", "/fr/", None, "allow"),
    ("http://notexample.org?/es/", "notexample.org", "", None, "allow"),
    ("nothing", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("a://b://c/d", "b:", "//c/d", None, "allow"),
    ("ÀÉ://HÔST.Org/\n/x", "hÔst.org", "/\n/x", "org/", "allow"),
    ("", "", "", None, "allow"),
]


def test_stated_rules(spark):
    df = pages_of(spark, [(i, u[0], None) for i, u in enumerate(URLS)] * 2)
    none = spark.createDataFrame([], "url string, bad boolean")
    got = url_rules.judge_urls(df, none).collect()
    assert len(got) == 2 * len(URLS)
    assert {(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got} == {(i, *u[1:]) for i, u in enumerate(URLS)}


def test_mined_rules(spark):
    rnd = random.Random(1)
    urls = []
    for i in range(400):
        shop, lang = i % 4 == 0, rnd.choice(["en", "fr"])
        urls.append((f"http://{'win-big' if shop else 'news'}{i % 3}.example.net/{lang}/{i}", shop and lang == "fr"))
    labelled = spark.createDataFrame([*urls, (None, True), ("x", False), ("http://a.b/", None)], "url string, bad boolean")
    mined = url_rules.mine_rules(labelled, min_confidence=0.9).collect()
    assert mined
    tokens = {r["url"]: set(r["t"]) for r in labelled.select("url", url_rules.url_tokens(F.col("url")).alias("t")).collect()}
    known = [(tokens[u], bad) for u, bad in urls]
    for r in mined:
        met = [bad for t, bad in known if set(r["tokens"]) <= t]
        assert sum(met) / len(met) >= 0.9 and r["key"] in r["tokens"]
    asked = pages_of(spark, [(i, u, None) for i, (u, _) in enumerate(urls)])
    verdicts = {r["page_id"]: r["verdict"] for r in url_rules.judge_urls(asked, labelled, rules=(), min_confidence=0.9).collect()}
    rules = [set(r["tokens"]) for r in mined]
    assert verdicts == {i: "block" if any(r <= tokens[u] for r in rules) else "allow" for i, (u, _) in enumerate(urls)}
    assert all((verdicts[i] == "block") == bad for i, (_, bad) in enumerate(urls))


def test_mined_rules_equal_brute_force(spark):
    """Rules before pruning are all token sets that imply "bad" often enough; pruned ones are implied by a part."""
    from collections import Counter
    from itertools import combinations

    rnd = random.Random(4)
    urls = []
    for i in range(600):
        host, word = rnd.choice(["a.net", "b.net", "c.info"]), rnd.choice(["win", "read", "shop"])
        urls.append((f"http://{host}/{word}/{rnd.choice('xy')}", rnd.random() < (0.8 if (host, word) == ("b.net", "win") else 0.5 if host == "c.info" else 0.1)))
    labelled = spark.createDataFrame(urls, "url string, bad boolean")
    tokens = {r["url"]: sorted(r["t"]) for r in labelled.select("url", url_rules.url_tokens(F.col("url")).alias("t")).distinct().collect()}
    count, bad = Counter(), Counter()
    for u, is_bad in urls:
        for size in range(1, len(tokens[u]) + 1):
            for part in combinations(tokens[u], size):
                count[part] += 1
                bad[part] += is_bad
    base = sum(b for _, b in urls) / len(urls)
    least = min(url_rules.MIN_LIFT * base, (1 + base) / 2)
    rules = {p: bad[p] / count[p] for p in count if bad[p] >= url_rules.MIN_COUNT and bad[p] / count[p] >= least}
    want = {p: c for p, c in rules.items() if not any(q in rules and rules[q] >= c for k in range(1, len(p)) for q in combinations(p, k))}
    got = {tuple(r["tokens"]): r["confidence"] for r in url_rules.mine_rules(labelled).collect()}
    assert got.keys() == want.keys() and len(want) > 2
    assert all(abs(got[p] - want[p]) < 1e-12 for p in want)


def test_rules_are_mined_from_the_given_tables(spark):
    pages, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("pages", "labels"))
    labelled = url_rules.labelled_pages(pages, labels)
    mined = url_rules.mine_rules(labelled).collect()
    base = labelled.agg(F.avg(F.col("bad").cast("int"))).first()[0]
    assert mined and all(r["confidence"] >= url_rules.MIN_LIFT * base - 1e-9 for r in mined)
    judged = url_rules.judge_urls(pages, labelled)
    assert judged.where("rule is null and verdict = 'block' and confidence is not null").count() > 0


# --- html -------------------------------------------------------------------------------------

WRITTEN = [
    ("<html><body><nav><a href=x>Menu</a></nav><main><h1>T</h1><p>A &lt;b&gt; c&nbsp;d<b>e</b>f<p>two\n  lines</main>"
     "<aside>side</aside><footer>foot</footer></body></html>", "T A <b> c def two lines"),
    ("<article><p>One.</p><div class='ad'>Buy</div><section class=\"comments\"><p>First!</p></section><p>Two &amp; three &#233;</p></article>",
     "One. Two & three é"),
    ("<body><div id=cookie-banner><p>We use cookies</p></div><article><header>By me</header><p>Text <a href='/x'>link</a> on.</p>"
     "<form><p>Name</p><button>Send</button></form><ul><li>one<li>two</ul></article><!-- no", "Text link on. one two"),
    ("<article><script>var t='</p>'; x<1</script><style>p{}</style><p>1 < 2 and 3 > 2</p><br>tail<br/>end", "1 < 2 and 3 > 2 tail end"),
    ("", ""),
    (None, ""),
    ("<nav>only a menu</nav>", ""),
]


def test_written_pages(spark):
    df = pages_of(spark, [(i, "u", p) for i, (p, _) in enumerate(WRITTEN)] + [(None, None, None)])
    got = {r["page_id"]: r["text"] for r in html_extract.extract_pages(df).collect()}
    assert got == {i: t for i, (_, t) in enumerate(WRITTEN)} | {None: ""}


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = {r["page_id"]: brute.article_text(r["html"]) for r in pages.collect()}
    got = html_extract.extract_pages(pages).collect()
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_messages_equal_enumeration():
    from itertools import product

    model = html_extract.train([])
    nodes, _ = html_extract.parse("<main><p>Some text here.</p><div class=ad><p>x</p></div><ul><li><a>q</a></li></ul></main>")
    sums, total = [0.0] * len(nodes), 0.0
    for states in product((0, 1), repeat=len(nodes) - 1):
        states = (0, *states)
        weight, kinds = 1.0, html_extract.kinds(nodes)
        for i, node in enumerate(nodes[1:], 1):
            weight *= model.steps[kinds[i]][states[node.parent]][states[i]] * (model.evidence(node) if states[i] else 1.0)
        total += weight
        sums = [s + weight * x for s, x in zip(sums, states, strict=True)]
    assert np.allclose(model.marginals(nodes)[1:], [s / total for s in sums[1:]])


def test_very_long_page(spark):
    page = "<article>" + "<p>word &amp; word</p>" * 60_000 + "</article>"
    row = html_extract.extract_pages(pages_of(spark, [(1, "u", page)])).first()
    assert row["n_chars"] == 60_000 * len("word & word ") - 1


# --- warc -------------------------------------------------------------------------------------

def _digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


PAGES = [
    (5, "http://b.org/x%20\r\ny", "<p>é\r\n\r\nWARC/1.0</p>"), (3, "http://b.org/x", "same"), (9, "http://a.b.org/z?q#f", "same"), (4, None, None),
    (2, "u", ""), (None, "http://b.org/x", "same"), (7, "v", "\x00\u2028 end\r\n"), (3, "http://b.org/x", "same"), (8, "w\tw\\w", "x" * 100_000),
]


@pytest.mark.parametrize("least", [0, 10])
def test_round_trip(spark, least):
    got = warc.archive_round_trip(pages_of(spark, PAGES), least).collect()
    first = {}
    for i, _, page in PAGES:
        if i is not None and len((page or "").encode()) >= least:
            first[page or ""] = min(i, first.get(page or "", i))
    want = []
    for i, url, page in PAGES:
        to = first.get(page or "")
        to = None if to == i else to
        want.append((i, url or "", len((page or "").encode()), _digest(page), "revisit" if to is not None else "response", to))
    keys = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[k] for k in keys) for r in got), key=repr) == sorted(want, key=repr)


def test_lookup_and_payloads(spark):
    path = scratch_path(spark, "tests", "warc")
    warc.write_archive(pages_of(spark, PAGES), path)
    index = warc.build_index(spark, path, block_lines=2)
    asked = spark.createDataFrame([("HTTP://B.ORG/x#part",), ("https://B.org/none",), ("w\tw\\w",)], "url string")
    found = warc.fetch(index.lookup(asked)).collect()
    assert sorted((r["page_id"] or 0, r["record_type"]) for r in found) == [(0, "revisit"), (3, "response"), (3, "response"), (8, "response")]
    assert {bytes(r["payload"]) for r in found if r["payload"]} == {b"same", b"x" * 100_000}
    keys = [r["key"] for r in index.captures().collect()]
    assert len(keys) == len(PAGES) and len(index.directory) >= 4


@pytest.mark.parametrize("header, read", [(4096, 4 << 20), (16, 300), (64, 1)])
def test_only_ranges_are_read(spark, tmp_path, monkeypatch, header, read):
    """The scan skips payloads, neighbours are read together, and both give what the whole file holds."""
    import pyarrow.fs

    monkeypatch.setattr(warc, "HEADER_BYTES", header)
    monkeypatch.setattr(warc, "READ_BYTES", read)
    path = str(tmp_path / "w")
    pages = [*PAGES, (100, "http://long.org/" + "u" * 9000, "y")]
    warc.write_archive(pages_of(spark, pages).coalesce(1), f"file://{path}")
    for file in tmp_path.glob("w/part-*"):
        whole = file.read_bytes()
        with pyarrow.fs.LocalFileSystem().open_input_file(str(file)) as source:
            found = list(warc._headers(source))
            ranges = [(at, length) for _, at, length in found]
            assert b"".join(whole[a : a + n] + warc.SEPARATOR.encode() for a, n in ranges) == whole
            assert [r for part in warc._ranges(source, ranges[::2]) for r in part] == [whole[a : a + n] for a, n in ranges[::2]]
            assert all(f["WARC-Type"] in ("response", "revisit") for f, _, _ in found)


def test_urls_of_empty_pages(spark):
    none, labels = pages_of(spark, []), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert url_rules.judge_urls(none, url_rules.labelled_pages(none, labels)).count() == 0


def test_empty_archive(spark):
    assert warc.archive_round_trip(pages_of(spark, [])).count() == 0


@pytest.mark.parametrize(
    "inside, want",
    [
        ("<p>Let <math><mi>x</mi>=1</math> hold.</p>", "Let x=1 hold."),
        ("<p>One <svg width=1><text>two</text> three.</p><p>Four, and more words.</p>", "One two three. Four, and more words."),
        ("<p>Here <object data=x>a fallback</p><p>goes on for some words.</p>", "Here a fallback goes on for some words."),
        ("<p>No <noscript>script</noscript>, no <video>film</video>.</p>", "No script, no film."),
        ("<p class=ad-hoc>An ad hoc text of words.</p><div id=comment-on-law>Of the law, some words.</div>", "An ad hoc text of words. Of the law, some words."),
        ("<p>Kept text of some words.</p><div class=cookie-notice><p>We use cookies.</p></div><div class='x ad'><p>Buy this.</p></div>", "Kept text of some words."),
        ("<p>Press it: <button class=x>Share</button> and go on.</p><select><option>1<option>2</select>", "Press it: and go on."),
        ("<p>All of this stays, and</p><script>var x = '<p>no</p>'</script><style>p {}", "All of this stays, and"),
    ],
)
def test_article_text_is_kept_whole(inside, want):
    model = html_extract.train([])
    page = f"<html><body><nav><a href=1>Home</a></nav><article><h1>A title of the page</h1>{inside}</article></body></html>"
    assert html_extract.extract(page, model) == "A title of the page " + want


def test_repeated_and_empty_pages(spark):
    page = "<body><article><p>Some words of an article.</p></article></body>"
    rows = [(1, "u", page), (1, "u", page), (None, None, page), (2, "v", None), (3, "", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((tuple(r) for r in html_extract.extract_pages(df).collect()), key=repr)
    text = "Some words of an article."
    assert got == sorted([(1, "u", text, 25), (1, "u", text, 25), (None, None, text, 25), (2, "v", "", 0), (3, "", "", 0)], key=repr)
    assert html_extract.extract_pages(df.limit(0)).collect() == []
