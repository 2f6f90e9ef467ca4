import pytest

ROWS = [
    (1, "One two three four five.\nSecond line here.\nThird line here."),
    (2, "ONE two three four five.\nsecond line here.\nthird line here."),
    (3, None),
    (4, ""),
    (None, "no id here"),
    (5, " \n\t  "),
    (6, "naïve café – 日本語 ½ don't we'll 'tis"),
    (6, "naïve café – 日本語 ½ don't we'll 'tis"),
    (7, "ab " * 3000),
    (8, "x" * 5000),
    (9, "word"),
]


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


@pytest.fixture(scope="session")
def edge_rows(spark, shared_folder, tmp_path_factory):
    """Nulls, empty, white, long, repeated and equal-but-for-case rows, with columns of clashing names."""
    path = str(tmp_path_factory.mktemp("edge") / "documents.parquet")
    rows = [(k, t, "en", "src", len(t or ""), 1, 2, b"x", 3) for k, t in ROWS]
    schema = "doc_id long, text string, lang string, source string, n_chars long, fp int, kh int, ids binary, n_words int"
    spark.createDataFrame(rows, schema).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_rows(edge_rows):
    return edge_rows.where("false")


@pytest.fixture(scope="session")
def small_documents():
    import duckdb

    found = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet' ORDER BY doc_id").fetchall()
    return {k: t or "" for k, t in found}
