import pytest

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").cache()


@pytest.fixture(scope="module", autouse=True)
def released(spark):
    """What a module's tests have cached ends with it: other tests assert that the shared session holds nothing."""
    yield
    spark.catalog.clearCache()


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and very long texts, ties, repeated rows and clashing extra columns."""
    long = " ".join(f"w{i * 7919 % 10007}" for i in range(60_000))
    line = "The quick brown fox jumps over the lazy dog near the old river bank today."
    rows = [(None, None, None), (1, None, "a"), (2, "", "a"), (3, "  \t ", None), (4, "one two", "b"),
            (5, long, "b"), (6, f"{line}\nother words here.", "a"), (7, f"{line}\nmore text there.", "a"),
            (7, f"{line}\nmore text there.", "a"), (None, f"{line}\nmore text there.", "a"),
            (8, "é ü 漢字 — “quoted” \n\n\n end", "c"), (9, line, "c"), (10, line, "c")]
    extra = ("n_words kept clean_text dropped n_lines _row _rank _all slot block position epoch score rank "
             "label text_key template leaf tokens line word words host path rule verdict t1 t2 group size shard").split()
    schema = "doc_id long, text string, source string, lang string, n_chars long, " + ", ".join(f"`{c}` string" for c in extra)
    data = [(d, t, s, "en", len(t or ""), *["x"] * len(extra)) for d, t, s in rows]
    return spark.createDataFrame(data, schema)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
