"""Cleaning a corpus: toxic documents, exact copies, near copies, source weights, packing.

Each stage reads what the last one wrote. All but the last return the columns of the documents; the last
returns the pieces of the packed sequences.

In every stage a null text counts as empty, a null id or source as a value of its own, and columns beyond doc_id, text and source go along
unread. Repeated rows: the copies stage keeps one. Ties go to the smallest id. Empty documents give no rows, and without labels no
document is rejected.
"""

from pyspark.sql import DataFrame, SparkSession

from bidlake.llm import cuckoo, mixing, oddsketch, packing, toxicity
from bidlake.llm.common import table
from bidlake.llm.queries import vocabulary
from bidlake.sources.writers import shared_dir


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model of the labelled ones does not reject (op 6); all of them without labels."""
    return toxicity.keep_civil(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts equal but for white space (op 5); empty and null texts are one group."""
    return cuckoo.deduplicate(docs)


def distinct_contents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, on five-word shingles at 0.8 (op 4)."""
    return oddsketch.deduplicate(docs, shingle=5, percent=80)


def weighted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them (op 2), whole; texts without words stay once."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2,048 tokens (op 3); an empty text is its end id alone."""
    return packing.pack(docs, vocabulary())


STAGES = [
    ("toxicity", civil), ("exact_dedup", distinct_texts), ("near_dedup", distinct_contents), ("mixing", weighted), ("packing", packed),
]
#: No SQL states the toxicity model or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over documents; each earlier stage is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = stage(spark, docs, sf_dir)
        if name == STAGES[-1][0]:
            return rows
        folder = shared_dir(spark, name)
        rows.write.parquet(folder)
        docs = spark.read.schema(rows.schema).parquet(folder)
