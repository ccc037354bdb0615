"""Helpers shared by the operators: table access, stored results, code points."""

from __future__ import annotations

import threading
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.session import ensure_checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ARROW_ROWS = 2_000  # of a batch sent to a Python worker while a table is stored
_ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once and written to the shared checkpoint folder.

    Rows with texts are long, so Arrow batches are kept small meanwhile; the
    session's own setting is put back.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    before = spark.conf.get(_ROWS_KEY)
    small = int(before) if 0 < int(before) < ARROW_ROWS else ARROW_ROWS
    spark.conf.set(_ROWS_KEY, str(small))
    try:
        return df.checkpoint(eager=True)
    finally:
        spark.conf.set(_ROWS_KEY, before)


METRICS_WAIT_S = 60  # for figures of a finished job; after that the table is read for them


def stored_counted(df: DataFrame, **figures) -> tuple[DataFrame, dict[str, int]]:
    """``stored(df)`` with its number of ``rows`` and other aggregates ``figures``.

    They are observed while the table is written, without a job of their own.
    """
    figures = {"rows": F.count(F.lit(1)), **figures}
    wanted = [made.alias(name) for name, made in figures.items()]
    seen = Observation()
    out = stored(df.observe(seen, *wanted))
    got: dict[str, int] = {}
    wait = threading.Thread(target=lambda: got.update(seen.get), daemon=True)
    wait.start()
    wait.join(METRICS_WAIT_S)
    if set(got) < set(figures):  # the event that carries them was lost
        return out, out.agg(*wanted).first().asDict()
    return out, got


def broadcast_up_to(df: DataFrame, rows: int, max_rows: int) -> DataFrame:
    """Hint a broadcast of ``df``, known to have ``rows`` rows, up to ``max_rows``."""
    return F.broadcast(df) if rows <= max_rows else df


def sized_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast when ``df`` (stored) has at most ``max_rows`` rows.

    Beyond the bound the table is returned unhinted and the join shuffles.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


SLICE_BYTES = 8 << 20  # of an Arrow batch worked on at once in a Python worker


def slices(batches, size: int = SLICE_BYTES):
    """The rows of ``batches`` in pieces of about ``size`` bytes, one row at least.

    At the end Arrow's free memory is given back: workers outlive their tasks.
    """
    for batch in batches:
        if batch.num_rows:
            step = max(1, int(size * batch.num_rows // max(1, batch.nbytes)))
            for start in range(0, batch.num_rows, step):
                yield batch.slice(start, step)
    pa.default_memory_pool().release_unused()


def add_columns(df: DataFrame, inputs, fields: str, prepare: Callable[[], Callable],
                drop=(), size: int = SLICE_BYTES, done: Callable[[], None] | None = None) -> DataFrame:
    """``df`` without ``drop`` plus ``fields``, computed per slice of an Arrow batch.

    ``prepare()`` runs once per task and returns a function from the lists of
    values of ``inputs`` to one sequence per field; ``done()`` runs when the task
    ends. Columns named like a field, in any case, are replaced; the others pass
    through untouched, whatever their types and nulls.
    """
    added = T._parse_datatype_string(fields).fields
    names = {f.name.lower() for f in added}
    kept = [c for c in df.columns if c.lower() not in names and c not in drop]
    source = df.select(*kept, *(F.col(c).alias(f"__in{i}") for i, c in enumerate(inputs)))
    schema = T.StructType(source.schema.fields[:len(kept)] + added)
    width = len(kept)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(f.dataType) for f in added]
        compute = prepare()
        try:
            for batch in slices(batches, size):
                made = compute(*(batch.column(width + i).to_pylist() for i in range(len(inputs))))
                yield pa.RecordBatch.from_arrays(
                    batch.columns[:width] + [pa.array(m, k) for m, k in zip(made, kinds)],
                    names=schema.names)
        finally:
            if done is not None:
                done()

    return source.mapInArrow(run, schema)


def map_groups(df: DataFrame, keys: list[str], fields: str, handle: Callable) -> DataFrame:
    """Apply ``handle`` to the rows of each combination of the integer ``keys``.

    ``handle`` takes one Arrow table and returns one sequence per field. Groups
    must be bounded by the caller; one task sees its groups one after another.
    """
    laid = df.repartition(*keys).sortWithinPartitions(*keys)
    schema = T._parse_datatype_string(fields)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        layout = to_arrow_schema(schema)
        held: list[pa.RecordBatch] = []
        last = None

        def close():
            made = handle(pa.Table.from_batches(held))
            return pa.RecordBatch.from_arrays(
                [pa.array(m, f.type) for m, f in zip(made, layout)], schema=layout)

        for batch in batches:
            if not batch.num_rows:
                continue
            own = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys])
            cuts = [0, *(np.flatnonzero((own[:, 1:] != own[:, :-1]).any(axis=0)) + 1).tolist(),
                    batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                key = own[:, a].tolist()
                if held and key != last:
                    yield close()
                    held = []
                held.append(batch.slice(a, b - a))
                last = key
        if held:
            yield close()

    return laid.mapInArrow(run, schema)


def code_points(texts) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated UTF-32 code points of ``texts`` and their n + 1 bounds."""
    bounds = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    joined = "".join(texts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, dtype=np.uint32), bounds


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift, multiply) over an unsigned array."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_slices(texts, max_chars: int):
    """Index ranges of consecutive texts holding about ``max_chars`` characters.

    A text longer than the bound makes a slice of its own, whole.
    """
    start, held = 0, 0
    for i, t in enumerate(texts):
        if i > start and held + len(t) > max_chars:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)
