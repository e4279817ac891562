import pytest

from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, ties, and extra columns whose names the operators use themselves."""
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    rows = [
        (1, None, None, "s"), (2, "", "en", None), (3, " \t\n", None, "s"), (4, "one two", "en", "s"), (5, LONG, "en", "s"), (6, base, "en", "s"), (7, base, "en", "t"), (7, base, "en", "t"),
        (8, f"{base} extra", None, "s"), (9, "Ünïcödé 日本語   text", "de", "s"), (10, LONG + " end", "en", "s"), (None, "no id here", "en", "s"), (11, "ONE TWO", "en", "s"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    return df.withColumns({c: F.lit(7) for c in ("score", "node", "id", "component_id", "group", "rank", "hash", "bytes", "piece", "length", "_gone", "a", "part")})


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
