"""Sources and sinks: Parquet modes, CSV interchange with an explicit schema."""

import tempfile

import pytest

from cadenza import schemas
from cadenza.sources import read_csv, read_parquet, write_csv, write_parquet
from conftest import rows


def test_parquet_modes(spark):
    out = tempfile.mkdtemp(prefix="cz-io-") + "/t.parquet"
    df = spark.createDataFrame([(1, "a", 2)], "user_id long, recording_mbid string, count long")
    write_parquet(df, out)
    with pytest.raises(Exception):
        write_parquet(df, out)  # default mode fails when the target exists
    write_parquet(df.union(df), out, mode="overwrite")
    assert read_parquet(spark, out).count() == 2
    typed = read_parquet(spark, out, schemas.COUNTS)
    assert typed.columns == ["user_id", "recording_mbid", "count"]
    with pytest.raises(ValueError):
        write_parquet(df, out, mode="bogus")


def test_csv_round_trip(spark):
    out = tempfile.mkdtemp(prefix="cz-io-") + "/r.csv"
    df = spark.createDataFrame([(1, 0, 1.0986122886681098), (2, 5, 0.5)],
                               schemas.RATINGS_CSV)
    write_csv(df, out)
    back = read_csv(spark, out, schemas.RATINGS_CSV)
    assert back.schema == schemas.RATINGS_CSV
    assert rows(back) == rows(df)
