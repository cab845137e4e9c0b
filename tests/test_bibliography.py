"""Bibliography functions on long texts."""

import sys

from pyspark.sql import functions as F

from folioforge.functions import bibliography as B
from folioforge.functions import text as X


def test_very_many_names_in_a_row(spark):
    """A run of 20,000 names is no recursion of the pattern engine, and what it finds is what it found."""
    rows = [(1, "[1] " + "Name " * 20_000 + "2011"), (2, "[1] small words then New York Times  2019 and"), (3, "[1] McDonald Duck 1999, no"), (4, "[1] nothing to be found in here")]
    df = spark.createDataFrame(rows, "id int, text string").select("id", F.explode(B.entries(F.col("text"))).alias("e"))
    out = {r["id"]: r["f"] for r in df.select("id", B.fields(F.col("e.raw")).alias("f")).collect()}
    assert out[1]["venue"] == ("Name " * 20_000).strip() and out[1]["year"] == 2011
    assert (out[2]["venue"], out[3]["venue"], out[4]["venue"]) == ("New York Times", "Donald Duck", None)
    assert (out[2]["confidence"], out[4]["confidence"]) == (0.5, 0.3)


def test_strip_of_every_white_space(spark):
    spaces = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())
    assert sorted(X.SPACES) == sorted(spaces)
    values = [f"{spaces}a{spaces}é\u200b{spaces}", spaces, "", None, "\na\n\n", "日\u3000"]
    out = spark.createDataFrame(list(enumerate(values)), "id int, t string").select("id", X.strip(F.col("t"))).collect()
    assert dict(map(tuple, out)) == {i: v.strip() if v is not None else None for i, v in enumerate(values)}
