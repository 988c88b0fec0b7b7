"""Driver queries of the ten operators, each over its whole tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from ledgerline.llm import (
    ann,
    decontaminate,
    hard_negatives,
    html_extract,
    line_dedup,
    mixing,
    ngram_jaccard,
    ngram_lm,
    quality,
    spelling,
    token_counts,
    url_rules,
    warc,
)
from ledgerline.llm.common import table


def q_mix(spark, sf_dir):
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def q_decontaminate(spark, sf_dir):
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


def q_ann(spark, sf_dir):
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def q_line_dedup(spark, sf_dir):
    cut = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.withColumnsRenamed({"__n_lines": "n_lines", "__n_removed": "n_removed"})


def q_url_rules(spark, sf_dir):
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    return url_rules.judge_urls(pages, url_rules.labelled_pages(pages, labels))


def q_html(spark, sf_dir):
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def q_quality(spark, sf_dir):
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def q_warc(spark, sf_dir):
    read = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return read.select("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")


def q_lm(spark, sf_dir):
    return ngram_lm.score_texts(table(spark, sf_dir, "documents"))


def q_jaccard(spark, sf_dir):
    return ngram_jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def q_hard_negatives(spark, sf_dir):
    relabel = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, relabel=relabel)


TOKEN_LIMIT = 1024


def q_token_counts(spark, sf_dir):
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def q_spelling(spark, sf_dir):
    return spelling.group_variants(table(spark, sf_dir, "documents"), typo_every=31)


QUERIES = {
    "op1_mix_sources": q_mix,
    "op2_ann": q_ann,
    "op3_ngram_lm": q_lm,
    "op4_decontaminate": q_decontaminate,
    "op5_line_dedup": q_line_dedup,
    "op6_url_rules": q_url_rules,
    "op7_ngram_jaccard": q_jaccard,
    "op8_html_extract": q_html,
    "op9_quality": q_quality,
    "op10_warc": q_warc,
    "op11_hard_negatives": q_hard_negatives,
    "op12_token_counts": q_token_counts,
    "op13_spelling": q_spelling,
}


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WINDOW_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_SPACED_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+')"
_DIGIT = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(h, {at}, 5) AS BIGINT) >> {shift}) & 31 AS INTEGER), 1)"
_BASE32 = " || ".join(_DIGIT.format(at=5 * (k // 4) + 1, shift=15 - 5 * (k % 4)) for k in range(32))

ORACLE: dict[str, str] = {
    "op4_decontaminate": f"""
        WITH d AS (SELECT doc_id, {_WINDOW_WORDS} AS w FROM documents),
        b AS (SELECT item_id, {_WINDOW_WORDS} AS w, least(13, len({_WINDOW_WORDS})) AS width FROM benchmark),
        test AS (SELECT DISTINCT item_id, width, list_slice(w, i, i + width - 1) AS win
                 FROM (SELECT *, unnest(range(1, len(w) - width + 2)) AS i FROM b WHERE width > 0)),
        widths AS (SELECT DISTINCT width FROM test),
        hits AS (SELECT doc_id, i, width, item_id FROM
                 (SELECT doc_id, i, width, list_slice(w, i, i + width - 1) AS win FROM
                  (SELECT *, unnest(range(1, len(w) - width + 2)) AS i FROM d, widths WHERE len(w) >= width))
                 JOIN test USING (width, win)),
        words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM
                  (SELECT doc_id, unnest(range(i, i + width)) AS p FROM hits) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
                  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op7_ngram_jaccard": f"""
        WITH RECURSIVE d AS (SELECT doc_id, {_SPACED_WORDS} AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, list_slice(w, i, i + 4) AS g
              FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (g)
                  WHERE x.doc_id <> y.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
                  WHERE 100 * c >= 80 * (na.n + nb.n - c)),
        reach(doc_id, r) AS (SELECT doc_id, doc_id FROM d
                             UNION SELECT links.b, reach.r FROM reach JOIN links ON links.a = reach.doc_id)
        SELECT doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(r) AS component_id
        FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id""",
    "op10_warc": f"""
        WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
        f AS (SELECT h, min(page_id) AS first_id FROM p GROUP BY h)
        SELECT page_id, coalesce(url, '') AS url, CAST(strlen(html) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
               CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM p JOIN f USING (h)""",
    "op11_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
                   FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
                   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id,
                     CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
              FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id, positive_score, s.vec_id AS negative_id, score AS negative_score,
               CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, s.vec_id) AS INTEGER) AS rank
        FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
        QUALIFY rank <= 5""",
    "op13_spelling": """
        WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k:
            CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
        runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                        'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
        dist AS (SELECT run, concat(doc_id, ':', run) AS s, count(*) AS n FROM runs GROUP BY ALL),
        hashed AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295,
                   list_transform(range(strlen(s)), lambda i: CAST('0x' || substr(hex(s), 2 * i + 1, 2) AS BIGINT))),
                   lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h FROM dist, tab),
        g AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
                     CAST(sum(n) AS BIGINT) AS n FROM hashed GROUP BY 1),
        w AS (SELECT word, n FROM g WHERE length(word) >= 7 AND n >= 2),
        spot AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
        gap AS (SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS z FROM spot),
        near AS (SELECT x.word, y.word AS other, y.n AS o FROM gap x JOIN gap y USING (i, a, z) WHERE x.word <> y.word
                 UNION SELECT x.word, y.word, y.n FROM gap x JOIN w y ON y.word = x.a || x.z
                 UNION SELECT y.word, x.word, x.n FROM gap x JOIN w y ON y.word = x.a || x.z),
        top AS (SELECT word, count(*) AS n_near, max(o) AS m FROM near GROUP BY word),
        best AS (SELECT word, any_value(n_near) AS n_near, any_value(m) AS m, min(other) FILTER (o = m) AS f FROM near JOIN top USING (word) GROUP BY word),
        told AS (SELECT word, n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, CASE WHEN m >= 10 * n THEN f END AS form,
                        CASE WHEN m >= 10 * n THEN m END AS form_n FROM w LEFT JOIN best USING (word)),
        chain(word, root, d) AS (SELECT word, word, 0 FROM told
                                 UNION ALL SELECT chain.word, told.form, d + 1 FROM chain JOIN told ON told.word = chain.root WHERE form IS NOT NULL)
        SELECT word, form, arg_max(root, d) AS root, any_value(n) AS n, any_value(n_near) AS n_near, any_value(form_n) AS form_n
        FROM chain JOIN told USING (word) GROUP BY word, form""",
}
