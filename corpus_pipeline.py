"""The corpus pipeline: five stages, each written as Parquet and read again by the next.

Each stage maps (spark, docs, folder of tables) to a DataFrame; all but the last keep the columns
of documents. Nulls, empty texts, repeated rows and empty tables are treated as the operators say;
a stage never drops a document for another reason than its own decision.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnkeep.llm import decontaminate, language, packing, secrets, simhash
from tarnkeep.llm.common import materialize, prepare, table


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that op3's model judges `und` go: null texts and those without a letter.

    Every document is predicted; where nothing could be learned (no labels in the training folds)
    the model judges all `und`, and then only null or letterless texts go, labelled or not.
    """
    prepare(spark)
    row = "__language_row"
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()))
    asked = numbered if "lang" in docs.columns else numbered.withColumn("lang", F.lit(None).cast("string"))
    judged = language.report(asked, key=row).select(
        F.col("key").alias(row), F.col("lang_pred").alias("__lang_pred"), F.col("learned_any").alias("__learned")
    )
    kept = (F.col("__lang_pred") != language.UNKNOWN) | (
        ~F.col("__learned") & language.recognisable(F.col("text"))
    )
    return numbered.join(judged, row).filter(kept).select(*docs.columns)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    prepare(spark)
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more are benchmark windows go; others stay as they are."""
    prepare(spark)
    blocks = decontaminate.automata(table(spark, sf_dir, "benchmark"))
    return decontaminate.kept_documents(docs, blocks)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark, and n_chars follows where it is a column."""
    prepare(spark)
    out = docs.withColumn("text", secrets.redacted(secrets.learn(docs)))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", keep_languages),
    ("near_duplicates", one_of_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

#: Learned models and tokenizers are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
