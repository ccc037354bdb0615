"""Reproducible random sample of a fixed fraction of rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BIN_DIGITS = 4  # leading hex digits of the key: 65,536 bins


def sample_key(keys: Sequence[str], seed: int) -> F.Column:
    """md5 of the '|'-joined key values and the seed: a deterministic shuffle order."""
    parts = [F.col(k).cast("string") for k in keys] + [F.lit(str(seed))]
    return F.md5(F.concat_ws("|", *parts))


def sample_fraction(df: DataFrame, fraction: float = 0.1, seed: int = 42,
                    keys: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Rows of ``df`` kept with probability ``fraction``.

    ``exact=True``: exactly m = round-half-even(fraction * n) rows - the first m
    in the order of ``sample_key(keys, seed)`` (then the keys). Keys default to
    all columns and must identify rows deterministically; the result does not
    depend on partitioning or retries.

    No global sort of all rows: one pass counts rows by the leading 16 bits of the
    key (65,536 counts reach the driver), which gives n and the bin that holds the
    m-th row. Rows of lower bins are taken by a filter, and only that bin - about
    n / 65,536 rows - is ordered. ``df`` is read twice, so it must be
    deterministic; pass a stored table if it is not or if it is expensive.

    ``exact=False``: every row whose ``sample_key``, read as a fraction of its range by
    its leading 32 bits, lies below ``fraction`` (the size varies around fraction * n).
    One pass without a shuffle; whether a row is kept depends on its keys and the seed
    alone, not on partitioning, and rows with equal keys stay or go together.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    keys = list(keys or df.columns)
    if not exact:
        leading = F.conv(F.substring(sample_key(keys, seed), 1, 8), 16, 10).cast("bigint")
        return df.where(leading < F.lit(math.ceil(fraction * 2**32)))
    cols = [F.col(c) for c in df.columns]
    keyed = (df.withColumn("_cz_h", sample_key(keys, seed))
             .withColumn("_cz_bin", F.substring("_cz_h", 1, _BIN_DIGITS)))
    counts = sorted(tuple(r) for r in keyed.groupBy("_cz_bin").count().collect())
    n = sum(c for _, c in counts)
    m = round(fraction * n)  # half-even on the same double as bround(fraction * n)
    if m == 0:
        return df.limit(0)
    taken = 0
    for name, count in counts:
        if taken + count >= m:
            break
        taken += count
    below = keyed.where(F.col("_cz_bin") < F.lit(name)).select(*cols)
    order = [F.col("_cz_h").asc()] + [F.col(k).asc_nulls_first() for k in keys]
    border = keyed.where(F.col("_cz_bin") == F.lit(name)).orderBy(*order).limit(m - taken)
    return below.unionByName(border.select(*cols))
