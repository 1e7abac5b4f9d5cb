import pandas as pd
from pyspark.sql import functions as F

from textgate.operators import score as S


def test_a_function_gets_parts_of_bounded_size(spark):
    """A batch of Spark's has up to 10,000 rows of any length; what a function makes of them in one go must not grow so."""
    def sizes(batches):
        seen = 0
        for b in batches:
            assert list(b.index) == list(range(len(b)))
            seen += 1
            yield pd.DataFrame({"id": b["id"], "rows": len(b), "chars": int(b["text"].fillna("").str.len().sum()), "part": seen})

    text = F.when(F.col("id") % 7 == 0, F.lit(None)).when(F.col("id") == 3001, F.repeat(F.lit("x"), S.PART_CHARS + 5)).otherwise(F.repeat(F.lit("é "), 1500))
    df = spark.range(0, 6000, 1, 1).withColumn("text", text)
    got = S.map_batches(df, sizes, "id long, rows long, chars long, part long").collect()
    assert sorted(r.id for r in got) == list(range(6000))
    assert max(r.rows for r in got) <= S.PART_ROWS
    assert all(r.chars <= S.PART_CHARS or r.rows == 1 for r in got)
    assert [r.part for r in got] == sorted(r.part for r in got) and max(r.part for r in got) > 5  # one call for the whole partition
    assert S.map_batches(df.limit(0), sizes, "id long, rows long, chars long, part long").count() == 0
