import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, block int, word string, keys string, score double, fp string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and extra columns with clashing names."""
    prose = "The cat sat on the mat, and then the dog came in to see what was the matter with it.\nAll was well.\n"
    texts = [
        None, "", " ", "word", "a b", "one two three", prose, prose, prose * 2, prose * 40, "x" * 30000, "!" * 9000, "\n\n\n",
        "é" * 10 + " ñandú ünd 中文字 \U0001f600", "THE CAT " * 50, "<|endoftext|> a  <|endoftext|>b", "tab\tand\x0bmore\x0c\r\nend",
        prose + "tail", " ".join(f"w{k}" for k in range(6000)),
    ]
    rows = [(k, t, "en", "s", 0, 1, "w", "k", 0.5, "f") for k, t in enumerate(texts)]
    rows += [(6, prose, "en", "s", 0, 1, "w", "k", 0.5, "f")] * 2  # repeated rows
    rows += [(6, "another text under a known id", None, None, None, None, None, None, None, None)]
    rows += [(None, prose, None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark, odd):
    ids = [r.doc_id for r in odd.select("doc_id").distinct().collect()]
    rows = [(k, None if k == 3 else int(k or 0) % 2, int(k or 0) % 3 % 2) for k in ids] + [(999, 1, 1), (4, 0, 0)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
