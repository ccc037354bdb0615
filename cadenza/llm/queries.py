"""The operators applied to the shared tables, one query each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.common import read_table, stored
from cadenza.llm import byte_codec, centroid_clusters, html_extract, hyperminhash, lang_bayes, poisson_mix, quality_rank, scaled_sketch, secret_markov, segment_resampling, subspace_join, toxic_viterbi
from cadenza.llm.piece_codec import encode_decode


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op3_subspace_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subspace_join.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op4_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op5_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaled_sketch.fingerprint_edits(read_table(spark, sf_dir, "documents"))


def _has_kind(kind: int):
    return lambda span: span["kind"] == kind


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_markov.scan(documents, secret_markov.fit(documents))
    n_kind = [F.size(F.filter("base", _has_kind(k))).cast("long").alias(f"n_{name}")
              for k, name in enumerate(secret_markov.KINDS[:3])]
    return found.select(
        "doc_id", *n_kind, F.sha2(secret_markov.span_text(F.col("base")), 256).alias("base_sha256"),
        secret_markov.span_text(F.col("spans")).alias("spans"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rows = documents.withColumn("held_out", lang_bayes.held_out(4, 2))
    model = lang_bayes.fit(rows.where(~F.col("held_out")))
    return lang_bayes.predict(rows.drop("lang"), model, drop=["text"])


def op8_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poisson_mix.poisson_mix(read_table(spark, sf_dir, "documents"))


def op9_toxic_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").where(~lang_bayes.held_out(4, 2))
    language = toxic_viterbi.fit_language(documents)
    lexicon = toxic_viterbi.fit_lexicon(documents, labels, language)
    rows = documents.withColumn("held_out", lang_bayes.held_out(4, 2))
    return (toxic_viterbi.score(rows, language, lexicon, drop=["text"])
            .withColumn("predicted", (F.col("score") >= 0.3).cast("int")))


def op10_quality_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").where(~lang_bayes.held_out(3, 1))
    rows = stored(quality_rank.featured(documents, drop=["text"]))
    ranking = quality_rank.fit(rows, labels)
    return (quality_rank.score(rows.withColumn("held_out", lang_bayes.held_out(3, 1)), ranking)
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def op11_segment_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_resampling.resample(read_table(spark, sf_dir, "documents"),
                                       read_table(spark, sf_dir, "benchmark"))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters.summary_columns(
        centroid_clusters.cluster(read_table(spark, sf_dir, "embeddings")))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_codec.encode_decode(read_table(spark, sf_dir, "documents"),
                                    tokenizer_path("byte_bpe_50k.tiktoken"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_suffix_array": op1_html_suffix_array,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_subspace_join": op3_subspace_join,
    "op4_hyperminhash": op4_hyperminhash,
    "op5_scaled_sketch": op5_scaled_sketch,
    "op6_secret_scan": op6_secret_scan,
    "op7_language_id": op7_language_id,
    "op8_poisson_mix": op8_poisson_mix,
    "op9_toxic_viterbi": op9_toxic_viterbi,
    "op10_quality_rank": op10_quality_rank,
    "op11_segment_resampling": op11_segment_resampling,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_byte_bpe": op13_byte_bpe,
}

ORACLE_SQL: dict[str, str] = {
    "op8_poisson_mix": poisson_mix.oracle_sql(),
    "op11_segment_resampling": segment_resampling.oracle_sql(),
    "op12_centroid_clusters": centroid_clusters.oracle_sql(),
}
