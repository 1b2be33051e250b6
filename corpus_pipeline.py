"""The training-data pipeline: documents in, packed training sequences out.

Each stage takes all rows its predecessor kept and its decisions take effect:

1. ``quality_rules``: documents that the base rules or the line field reject go;
2. ``near_copies``: one document of each group of near copies stays (shingles of
   five words, similarity 0.8);
3. ``secret_scans``: secrets in the texts, encoded ones too, are blacked out;
4. ``best_fit_packing``: the texts are placed in training sequences.

All but the last return the columns of ``documents``. ``run`` applies the stages in
order, each over the written rows of the one before.

Defined cases are those of the operators. Null and empty texts fail the base rules;
repeated rows are near copies of each other; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.jaccard import drop_near_copies
from farelake.llm.packing import byte_tokens, pack
from farelake.llm.quality import keep_quality
from farelake.llm.secrets import redact_secrets
from farelake.llm.tables import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_quality(docs, table(spark, sf_dir, "labels", ("doc_id", "quality")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs, 5, 80, clashing=True)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    redacted = redact_secrets(docs)
    if "n_chars" not in docs.columns:
        return redacted
    return redacted.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, "doc_id", byte_tokens(F.col("text")))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_copies),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]

#: Viterbi labels and best-fit packing have no SQL; the tests hold the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
