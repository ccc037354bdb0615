"""Mixing sources to target weights by Poisson replication, in DataFrame operations.

A source with target share w of the output and n of all N characters gets the
mean repetition rate w * N / n. Each document draws its number of copies from a
Poisson distribution with its source's rate: a uniform number hashed from seed
and id is inverted through the cumulative distribution. Large rates are split
into equal parts of at most ``PART_RATE``, each drawn by its own hash, so the
table of cumulative values stays short; the sum of the parts is Poisson again.
Copies are exploded and put in the global order of a hash of seed, id and copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import sized_broadcast, stored

SEED = "mix-1"
PART_RATE = 8.0
LAST_COUNT = 60  # P(more) < 1e-30 for a rate of 8, below the step of the hashes
HASH_DIGITS = 12  # hex digits of a uniform number
BROADCAST_SOURCES = 100_000


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the leading digits of an MD5 of ``parts``."""
    digest = F.md5(F.concat_ws("|", *parts))
    return (F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("double")
            / F.lit(float(16 ** HASH_DIGITS)))


def source_rates(df: DataFrame, weights: dict[str, float] | None = None, text_col: str = "text",
                 source_col: str = "source") -> DataFrame:
    """Per source its size, rate, number of parts and cumulative distribution.

    ``weights`` gives target shares (normalised; a source not named gets none);
    without it all sources weigh the same. Sizes are code points; a source
    without any text has rate 0.
    """
    sizes = df.groupBy(F.col(source_col).alias("mix_source")).agg(
        F.sum(F.length(F.coalesce(F.col(text_col), F.lit("")))).alias("size"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.when(F.col("size") > 0, 1.0).otherwise(0.0))
    else:
        named = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
        sizes = sizes.withColumn("weight", F.when(F.col("size") > 0, F.coalesce(
            F.element_at(named, F.col("mix_source")).cast("double"), F.lit(0.0))).otherwise(0.0))
    total = sizes.agg(F.sum("size").alias("n"), F.sum("weight").alias("w")).first()
    share = F.col("weight") / F.lit(float(total["w"] or 1.0) or 1.0)
    sizes = sizes.withColumn("rate", F.when(F.col("size") > 0, F.round(
        share * F.lit(float(total["n"] or 0)) / F.col("size"), 9)).otherwise(0.0))
    sizes = sizes.withColumn("parts", F.greatest(
        F.lit(1), F.ceil(F.col("rate") / PART_RATE)).cast("int"))
    mean = F.col("rate") / F.col("parts")
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("total"),
                     F.array(F.round(F.exp(-mean), 12)).alias("below"))

    def step(acc, k):
        p = acc["p"] * mean / k
        return F.struct(p.alias("p"), (acc["total"] + p).alias("total"),
                        F.concat(acc["below"], F.array(F.round(acc["total"] + p, 12))).alias("below"))

    return sizes.withColumn("cumulative", F.aggregate(
        F.sequence(F.lit(1), F.lit(LAST_COUNT)), start, step, lambda acc: acc["below"]))


def poisson_mix(df: DataFrame, weights: dict[str, float] | None = None, seed: str = SEED,
                id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source") -> DataFrame:
    """Replicate documents so that each source reaches its share of characters.

    Returns the columns of ``df`` (extra ones included) with ``copy_no`` (1, 2,
    ...) and ``mix_key`` (columns of these names, in any case, are replaced), rows
    in the global order of ``mix_key``. Equal ids draw
    equal counts (repeated rows repeat together), a null id draws like the empty
    string, a null source is a source of its own with the share of one (no
    weight when ``weights`` is given), and a document without copies leaves.

    The per-source table is stored and broadcast only if it has at most
    ``BROADCAST_SOURCES`` rows; beyond that Spark joins by its own size checks.
    The one shuffle of texts is the final range partitioning by hash, so a hot
    source is spread evenly.
    """
    rates = stored(source_rates(df, weights, text_col, source_col))
    rates = sized_broadcast(rates.select(
        F.col("mix_source").alias("__source"), F.col("parts").alias("__parts"),
        F.col("cumulative").alias("__below")), BROADCAST_SOURCES)
    id_text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    draws = F.transform(F.sequence(F.lit(1), F.col("__parts")), lambda part: F.size(F.filter(
        F.col("__below"),
        lambda c: c <= _uniform(F.lit(seed), id_text, part.cast("string")))))
    count = F.aggregate(draws, F.lit(0), lambda a, b: a + b)
    kept = [c for c in df.columns if c.lower() not in ("copy_no", "mix_key")]
    copies = (df.select(*kept).join(rates, F.col(source_col).eqNullSafe(F.col("__source")))
              .withColumn("__n", count).where("__n > 0")
              .withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("__n")))))
    key = F.md5(F.concat_ws("|", F.lit(seed), F.lit("order"), id_text, F.col("copy_no").cast("string")))
    return (copies.withColumn("mix_key", key).select(*kept, "copy_no", "mix_key")
            .repartitionByRange("mix_key").sortWithinPartitions("mix_key"))


def oracle_sql(table: str = "documents", seed: str = SEED) -> str:
    """The same rows as DuckDB SQL (equal weights)."""
    return f"""
WITH RECURSIVE sizes AS (
  SELECT source AS mix_source, sum(length(coalesce(text, ''))) AS size FROM {table} GROUP BY 1
), totals AS (
  SELECT sum(size) AS n, sum(CASE WHEN size > 0 THEN 1.0 ELSE 0.0 END)::DOUBLE AS w FROM sizes
), rates AS (
  SELECT mix_source, CASE WHEN size > 0 THEN
           round((1.0::DOUBLE / w) * n::DOUBLE / size::DOUBLE, 9) ELSE 0.0 END AS rate
  FROM sizes, totals
), parts AS (
  SELECT mix_source, rate, greatest(1, ceil(rate / {PART_RATE}::DOUBLE))::INTEGER AS parts FROM rates
), steps AS (
  SELECT mix_source, parts, rate / parts AS mean, 0 AS k, exp(-(rate / parts)) AS p,
         exp(-(rate / parts)) AS total FROM parts
  UNION ALL
  SELECT mix_source, parts, mean, k + 1, p * mean / (k + 1), total + p * mean / (k + 1)
  FROM steps WHERE k < {LAST_COUNT}
), cumulative AS (
  SELECT mix_source, any_value(parts) AS parts, list(round(total, 12)) AS below
  FROM steps GROUP BY mix_source
), counts AS (
  SELECT d.*, list_sum(list_transform(range(1, parts + 1), lambda part: len(list_filter(below,
           lambda c: c <= ('0x' || substr(md5('{seed}|' || coalesce(doc_id::VARCHAR, '') || '|' || part), 1,
             {HASH_DIGITS}))::BIGINT::DOUBLE / {float(16 ** HASH_DIGITS)!r}::DOUBLE)))) AS n
  FROM {table} d JOIN cumulative ON d.source IS NOT DISTINCT FROM mix_source
), copies AS (
  SELECT *, unnest(range(1, n::BIGINT + 1))::INTEGER AS copy_no FROM counts WHERE n > 0
)
SELECT * EXCLUDE (n), md5('{seed}|order|' || coalesce(doc_id::VARCHAR, '') || '|' || copy_no) AS mix_key
FROM copies"""
