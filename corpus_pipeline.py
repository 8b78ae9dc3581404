"""The corpus pipeline: documents in, packed training sequences out.

Each stage works on all that its predecessor kept. ``run`` writes every stage's result
as Parquet below the shared checkpoint folder and reads it again for the next.

Defined results: documents whose text is null, empty, blank or without a letter have no
language and go in the first stage, and so does every document if none has a language to
learn from; of rows that repeat an id or a text one stays after the third stage (of rows
that repeat the smallest id of a component one row); a null id is kept where its
component has no other; texts count whole, however long; an empty table gives an empty
result. All stages but the last return the columns of the documents, also such whose names
are used inside the operators; the last returns the columns of ``packing.pack``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridpanel.llm import decontaminate, jaccard, language, packing, toxicity
from gridpanel.llm.common import written
from gridpanel.session import ensure_checkpoint_dir, table

#: A document goes if its language is undetermined, or hardly likelier than by chance.
LEAST_LANGUAGE_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go."""
    ensure_checkpoint_dir(spark)
    return language.keep_identified(docs, language.fit(docs), least=LEAST_LANGUAGE_SCORE)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more for toxicity go."""
    ensure_checkpoint_dir(spark)
    return toxicity.remove_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the n-gram Jaccard join stays."""
    ensure_checkpoint_dir(spark)
    return jaccard.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more is benchmark text go."""
    ensure_checkpoint_dir(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that stayed, with their sequences."""
    import public_tokenizers

    ensure_checkpoint_dir(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Trained networks and tokenizers have no SQL form; the tests hold each stage against
#: a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
