"""Texts, odd rows and fixtures that the test modules of this folder import."""

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

SCHEMA = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
        StructField("kept", StringType()),
        StructField("ids", StringType()),
        StructField("Row", StringType()),
    ]
)


PROSE = (
    "The river turned north near the old mill and the wind came down from the hills in the evening. "
    "Nobody in the village could remember a colder spring, yet the farmers went out early each day. "
    "They talked about seed, about prices, about the bridge that had been closed since the last flood. "
    "A letter from the city lay unopened on the table while the children played behind the house."
)
SPANISH = (
    "El río giró hacia el norte cerca del viejo molino y el viento bajó de las colinas por la tarde. "
    "Nadie en el pueblo podía recordar una primavera más fría, pero los campesinos salían temprano cada día. "
    "Hablaban de semillas, de precios y del puente que estaba cerrado desde la última inundación del valle."
)


def odd_rows():
    """Nulls, empty and white texts, ties, repeated rows, one very long text, clashing extra columns."""
    rows = [
        (1, PROSE, "en", "a"),
        (1, PROSE, "en", "a"),
        (2, PROSE, "en", None),
        (3, SPANISH, "es", "b"),
        (4, None, "en", "a"),
        (5, "", None, "a"),
        (6, " \n\t\x0b ", "es", "a"),
        (None, "a b", "en", "a"),
        (None, None, None, None),
        (7, "one two", "en", "a"),
        (8, (PROSE + "\n" + SPANISH + "\n") * 300, "en", "a"),
        (9, "x" * 60_000, "en", "a"),
        (10, "日本語のテキスト 🙂 ǅ\r\n" + PROSE, "en", "a"),
    ]
    return [(*r, None if r[1] is None else len(r[1]), "k", "i", "r") for r in rows]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def tables(tmp_path):
    """A folder of tables for named queries: write(name=frame, ...) gives its path."""

    def write(**frames):
        for name, frame in frames.items():
            frame.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
