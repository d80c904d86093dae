"""From raw documents to packed training sequences, in five stages.

Every stage is a function (spark, docs, sf_dir) -> DataFrame that works on
all rows its predecessor kept. Stages run one by one: each result is written
as Parquet to the shared checkpoint folder and read again as the next one's
``docs``, so a lost executor costs a re-read of one stage at most. All but
the last return the columns of ``docs``, whatever they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from smartmaint.llm.common import materialize, table
from smartmaint.llm.decontamination import remove_contaminated
from smartmaint.llm.line_dedup import dedup_lines
from smartmaint.llm.packing import pack_documents
from smartmaint.llm.simhash import keep_representatives
from smartmaint.llm.tokens import default_path
from smartmaint.llm.toxicity import remove_toxic, trained_model


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that the classifier calls toxic go (null texts score as empty ones)."""
    return remove_toxic(docs, trained_model(spark, docs, sf_dir))


def dedup_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: repeated and nearly repeated lines go, the earliest stays; every document stays.

    ``n_chars``, if there is such a column, is brought up to date.
    """
    out = dedup_lines(docs)
    length = F.length("text").cast("long")
    return out.select(*[F.when(F.size(out.columns[-1]) > 0, length).otherwise(F.col(c)).alias(c) if c == "n_chars" else F.col(c)
                        for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of each group of near-duplicate documents one stays, that with the smallest id."""
    return keep_representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents with enough benchmark passages go."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: tokenised pieces in near-equal sequences."""
    return pack_documents(docs, default_path())


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", dedup_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("packing", pack),
]

# Token ids and a trained classifier are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
