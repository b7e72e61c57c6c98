"""The corpus pipeline: five stages over ``documents``, each one operator of ``retentio.llm``.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps,
with the columns of ``documents`` (the last adds ``copies``).  Between stages
the documents may be written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from retentio.llm import decontam, jaccard, linededup, mixing, toxicity
from retentio.llm.queries import learnable
from retentio.sources.tables import read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the lexicon is learnt from the
    labelled documents among ``docs``."""
    lexicon = toxicity.fit(toxicity.training_sample(docs, learnable(read_table(spark, sf_dir, "labels"))))
    return toxicity.drop_toxic(docs, lexicon)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that repeat others; documents of such lines alone go."""
    return linededup.dedup(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 80 % equal five-word shingles."""
    return jaccard.keep_one(docs, shingle=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontam.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix uses, and how often (``copies``)."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix_sources),
]

#: SQL cannot express the learnt lexicon and SimHash; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
