"""Corpus pipeline: documents through five of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``; all but the last return
the columns of ``documents``. Tables go to the shared folder that
``spark.checkpoint.dir`` names, the last result is returned unwritten.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import hyperminhash, lang_bayes, poisson_mix, secret_markov
from cadenza.llm.common import read_table, sized_broadcast, stored
from cadenza.llm.piece_codec import encode_decode
from cadenza.llm.queries import tokenizer_path
from cadenza.session import ensure_checkpoint_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
MIN_LANGUAGE_SCORE = 0.5
BROADCAST_IDS = 1_000_000


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is recognised.

    The model learns from ``lang`` of the same three quarters as the query of
    the operator. A document goes if its text is null or has no letter (``und``)
    or if its best language has a score below ``MIN_LANGUAGE_SCORE``; when no
    language can be learned, documents with a letter stay.
    """
    model = lang_bayes.fit(docs.where(~lang_bayes.held_out(4, 2)))
    if model is None:
        return docs.where(F.regexp_like("text", F.lit(r"\p{L}"))).select(COLUMNS)
    judged = lang_bayes.predict(docs.select(COLUMNS), model)
    return judged.where((F.col("lang_pred") != lang_bayes.UNKNOWN)
                        & (F.col("score") >= MIN_LANGUAGE_SCORE)).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, the one with the smallest id, of each near-copy group.

    Documents without words or without an id are groups of their own; rows with
    the same id are one document and stay or go together.
    """
    judged = hyperminhash.near_duplicates(docs)
    gone = stored(judged.where("not kept").select("doc_id").distinct())
    return docs.join(sized_broadcast(gone, BROADCAST_IDS), "doc_id", "left_anti").select(COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret found by a mark; all documents stay.

    ``n_chars`` is the length of the new text (null for a null text).
    """
    found = secret_markov.scan(docs.select(COLUMNS), secret_markov.fit(docs))
    clean = secret_markov.redact(found)
    return clean.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast("long"))
                            .otherwise(F.col("n_chars"))).select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replicate documents so that every source has the same share of characters."""
    return poisson_mix.poisson_mix(docs.select(COLUMNS)).select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The encoded corpus: token ids of every document, their number, and SHA-256
    digests of the ids and of the text they decode to. The copies that mixing made
    of a document are equal rows.
    """
    return encode_decode(docs, tokenizer_path(), keep=("doc_id", "lang", "source"), with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

# language identification, the Markov chains and the tokenizer have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; the last one's result is not written.

    The tables between the stages stay in the shared folder: the result reads the
    last of them, and the others let a later run start in the middle.
    """
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
