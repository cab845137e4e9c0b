import pytest


def documents(spark, *texts, ids=None):
    ids = ids if ids is not None else range(len(texts))
    rows = [(i, t, "en", f"s{k % 3}" if k % 4 else None, len(t or "")) for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


#: Null, empty, blank, short, repeated, very long, other scripts, odd characters.
ODD = [None, "", " \t\n", "one", "one two three", "A b C d E f", "a B c D e F", "x" * 3000, "word " * 4000, "日本語のテキスト", "tab\tand\x1cfs\x00nul", "é" * 50, "one two three four five six seven eight nine ten", "one two three four five six seven eight nine ten"]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd texts with extra columns whose names clash with what operators use inside or return."""
    df = documents(spark, *ODD)
    for c in ("id", "score", "held_out", "predicted", "key", "range", "shard", "end", "node", "_id", "size"):
        df = df.selectExpr("*", f"'{c}' AS {c}")
    return df.cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
