"""Randomised check of the per-group row number against pandas."""

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cadenza.operators.positions import rank_within

events = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 6),
                            st.integers(0, 3)), min_size=1, max_size=60)


@settings(max_examples=6, deadline=None)
@given(events, st.integers(1, 6))
def test_rank_within_random(spark, data, parts):
    df = spark.createDataFrame(data, "g long, t long, v long")
    got = rank_within(df, ["g"], [F.col("t").asc(), F.col("v").desc()], "rn", "n",
                      num_partitions=parts).toPandas()
    pdf = pd.DataFrame(data, columns=["g", "t", "v"])
    pdf["gk"] = pdf["g"].astype("float64").fillna(-1)
    pdf = pdf.sort_values(["gk", "t", "v"], ascending=[True, True, False])
    pdf["rn"] = pdf.groupby("gk").cumcount() + 1
    pdf["n"] = pdf.groupby("gk")["t"].transform("size")
    key = ["g", "t", "v", "rn", "n"]
    def norm(d):
        return sorted(tuple(-1 if pd.isna(x) else int(x) for x in r) for r in d[key].values)
    assert norm(got) == norm(pdf)
