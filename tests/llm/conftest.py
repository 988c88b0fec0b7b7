import pytest

#: Names that operators use inside; as further columns of a table they must not disturb.
CLASHING = ("size", "h", "th", "n", "words", "rank", "shard", "score", "row", "k", "rule", "key", "end", "token", "vec", "first", "spans", "label")
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in CLASHING)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, parts=3):
        """Rows (doc_id, text[, source]) as documents with clashing columns."""
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), *range(len(CLASHING))) for r in rows]
        return spark.createDataFrame(full, DOC_SCHEMA).repartition(parts) if full else spark.createDataFrame([], DOC_SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, blank, one word, repeated rows, ties, a very long text."""
    import random

    rnd = random.Random(7)
    vocabulary = ["".join(rnd.choices("abcdefghij", k=rnd.randint(2, 6))) for _ in range(300)]
    text = lambda n: " ".join(rnd.choices(vocabulary, k=n))
    base, other = text(200), text(120)
    near = base.split()
    near[50] = "changed"
    return [
        (1, base, "b"),
        (2, base, "a"),
        (2, base, "a"),
        (3, " ".join(near), None),
        (4, None, "a"),
        (5, "", "b"),
        (6, " \t\n", None),
        (7, "Word", "Z"),
        (8, "word", "z"),
        (None, other, "a"),
        (9, other + " end", "a"),
        (10, text(30_000), "long"),
        (11, "É Ünï " + text(60), "b"),
        (12, text(40) + "\n" + base + "\n" + text(10), None),
        (13, other.upper(), "a"),
        (20, base, None),
    ]
