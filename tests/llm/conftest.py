import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use themselves
    *[T.StructField(c, T.StringType()) for c in ("score", "row", "key", "n", "h", "tokens", "copies", "id", "spans")]])
BASE = "The quick brown fox jumps over the lazy dog near the river bank while seven old friends watch from a hill"


def rows():
    near = [BASE.replace("fox", w) + " tail" * 3 for w in ("cat", "cow")]
    long = " ".join(f"word{i % 997}x{i % 13}" for i in range(30_000))
    texts = [BASE, BASE, "  " + BASE.replace(" ", "  "), None, "", " \t\n", "a", near[0], near[1],
             BASE + "\n" + BASE + "\nshort", "mail a.b@c.de.fg or +49 (30) 1234-567 at 10.0.0.256 and 10.0.0.255",
             "card 4111 1111 1111 1111 and 4111-1111-1111-1112 é 1.2.3.4.5", "9" * 40_000, long, "Ünï " * 50, "???"]
    out = [(i, t, "en" if i % 3 else None, f"src{i % 5}" if i % 4 else None, None if t is None else len(t))
           for i, t in enumerate(texts)]
    out += [out[1], (None, BASE, "en", "src0", 5), (None, None, None, None, None)]
    return [(*r, *["x"] * 9) for r in out]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
