import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (id, text) pairs or (id, text, lang) triples."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, repeated rows and equal texts, odd characters."""
    long = "the cat sat on the mat and looked at a dog. " * 3000
    return [(1, None), (2, ""), (3, "   \n\t "), (4, long), (5, long), (6, "x" * 90_000), (7, "One two three four five six seven."),
            (7, "One two three four five six seven."), (None, "One two three four five six seven."), (None, None),
            (8, "\x00é😀\n\n漢字 ß\r\nend"), (9, "-1"), (-3, "a"), (10, "Ein Wort und noch ein paar mehr davon.")]


@pytest.fixture(scope="session")
def written(tmp_path_factory):
    """A folder with the frames as tables."""
    def make(**frames):
        folder = str(tmp_path_factory.mktemp("tables"))
        for name, df in frames.items():
            df.write.parquet(f"{folder}/{name}.parquet")
        return folder
    return make
