"""Cleaning and packing a corpus in stages.

Each stage takes (spark, docs, sf_dir), gets all that its predecessor kept as a
Parquet table, and returns a DataFrame. Toxic documents go, one document of each
group of near duplicates stays (that of the smallest id), secrets are masked in
the texts, and what is left is packed into sequences. All but the last return
the columns of ``documents``.

Defined results, of every stage: a null or empty text is not toxic, links with
nothing, holds no secret and packs as an end id; a very long text is worked on whole;
a row with a null id passes all filters; rows given twice are near duplicates if
their ids differ, and stay or go together if they are equal; of equal texts the
smallest id stays; an empty table passes through empty; further columns, whatever
their names, pass through all stages but the last. ``n_chars`` follows the masked
text where the table has that column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from termflow.llm import jaccard, packing, secrets, toxicity
from termflow.llm.common import drop_written, prepare, source, written

#: SQL for the rows of run(): none, the stages learn and search.
ORACLE_SQL = None


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under the threshold; all columns stay."""
    labels = source(spark, sf_dir, "labels", "doc_id", "toxic").where(~toxicity.held_out(F.col("doc_id")))
    return toxicity.reject_toxic(docs, labels)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones."""
    prepare(spark)
    return jaccard.drop_near_duplicates(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mask in place of each secret."""
    prepare(spark)
    ratios = secrets.fit(secrets.samples(docs))
    masked = secrets.redact(docs, ratios)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens."""
    import public_tokenizers

    prepare(spark)
    return packing.pack_documents(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", remove_toxic),
    ("n-gram Jaccard join", remove_near_duplicates),
    ("secret scans", mask_secrets),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs, last = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), None
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs, path = written(docs, f"stage-{i}")
            if last is not None:  # nothing reads the table before this one any more
                drop_written(spark, last)
            last = path
    return docs


PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_ORACLE = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
