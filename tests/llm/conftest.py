import pytest


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    """The documents of the smallest tables as Python rows."""
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


HARD_TEXTS = [None, "", " \n\t ", "one", "one two", "a b c " * 40, "Ünïcode … 日本語 テキスト 🙂 test " * 5, "same text here again",
              "same text here again", "x" * 30_000, "word " * 6000, "line one two three\n" * 30, "<|endoftext|> [INST] </s>\r\n\x0b\x0c end",
              "½ Ⅷ ② 12", "漢字" * 400]


@pytest.fixture(scope="module")
def hard_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, columns with clashing names."""
    rows = [(i, t, "en", "s", 1, "x", 7, 1.0, "k", 5) for i, t in enumerate(HARD_TEXTS)]
    rows += [rows[5], (5, "another text under a used id", *[None] * 8), (None, "a text without an id", "fr", "t", 3, "y", 8, 2.0, "l", 6)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, mark string, shard int, _score double, _key string, _share int")


@pytest.fixture(scope="module")
def no_docs(hard_docs):
    return hard_docs.where("false")
