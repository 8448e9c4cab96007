import pytest

#: Columns that operators use inside; extra ones in the input must not disturb them.
CLASHING = ("row_id", "found", "start", "size", "length", "rank", "doc", "text_hash", "key", "n", "node", "set_id")


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text, source) rows, with extra columns of clashing names."""

    def make(rows, parts=3):
        extra = ", ".join(f"{name} string" for name in CLASHING)
        data = [(d, t, "en", s, None if t is None else len(t), *["x"] * len(CLASHING)) for d, t, s in rows]
        df = spark.createDataFrame(data, f"doc_id long, text string, lang string, source string, n_chars long, {extra}")
        return df.repartition(parts)

    return make


@pytest.fixture(scope="session")
def hard_rows():
    """Nulls, empty and very long texts, repeated rows and ids, odd white space, other scripts."""
    base = " ".join(f"w{i}" for i in range(40))
    long = " ".join(f"v{i % 997}x{i // 997}" for i in range(30_000))
    texts = [
        (1, base, "a"), (1, base, "a"), (2, base, None), (3, "start " + base + " end", "b"), (4, None, "b"),
        (5, "", "b"), (6, " \t\n ", None), (7, "é ü 日本語 😀 " * 12, "c"), (8, long, "c"), (9, long[100:], "a"),
        (None, base + " tail", "a"), (None, None, None), (10, "one", "a"), (11, "one", "b"), (1, "other text", "a"),
        (12, "a\x0bb\x0cc\r\nd\x1ce\x85f\xa0g " * 9, "c"), (13, base.replace(" ", "\n"), "c"), (14, "x" * 3000, "a"),
    ]
    return texts
