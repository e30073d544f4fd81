import pytest
from pyspark.sql import types as T

LINE = "This line of forty or more characters comes back in many of the documents"
DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that the operators use themselves
        *[T.StructField(c, T.StringType()) for c in ("record", "kept", "row", "key", "id", "place", "print", "bucket")],
    ]
)


def odd_documents():
    """Nulls, empty and very long texts, ties, repeated rows; clashing extra columns."""
    texts = {
        None: "a text whose identifier is missing, " + LINE,
        1: None,
        2: "",
        3: " \t\n\x0b\x0c\r \n\n",
        4: "é́ ﬁ İ Σ's 12½ 中文 \U0001f642 \x00 <|endoftext|> can't x y",
        5: "long " * 30_000 + "\n" + LINE + "\n" + LINE.upper() + " \n" + "tail",
    }
    texts |= {i: f"Document number {i} says {'one two three ' * (i % 4)}\n\t{LINE} \n{i}" for i in range(6, 30)}
    texts |= {i: "word by word the same text in a few documents of the table, " * 3 for i in range(30, 36)}
    rows = [(i, t, None if i == 7 else "en", "s", None if t is None else len(t), *["x"] * 8) for i, t in texts.items()]
    return rows + [rows[8], rows[8], rows[0]]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_documents(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCS)
