"""From raw documents to packed training sequences: filter, two kinds of de-duplication, mixing, packing."""

from pyspark.sql import DataFrame, SparkSession

from matchlive.llm import classifier, mixing, packing, simhash, substring
from matchlive.llm.common import saved, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    return classifier.fit_for_training(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.survivors(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut from the text; every document stays."""
    return substring.removed_repeats(docs)


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of the documents' pieces in training sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing sources to target weights", mixing_to_weights),
    ("best-fit packing", best_fit_packing),
]

#: SQL can express neither the classifier nor the fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
