"""Readers and writers (Parquet, CSV) and the mapping of the shared test tables."""

from cadenza.sources.files import (
    read_parquet,
    read_csv,
    write_parquet,
    write_csv,
)
from cadenza.sources.testtables import (
    load_interactions,
    load_tracks,
    load_users,
    load_events,
    table_path,
)

__all__ = [
    "read_parquet",
    "read_csv",
    "write_parquet",
    "write_csv",
    "load_interactions",
    "load_tracks",
    "load_users",
    "load_events",
    "table_path",
]
