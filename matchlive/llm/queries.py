"""Registered queries: each applies one operator, with its production settings, to a whole table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlive.llm import (
    chat,
    classifier,
    clustering,
    decontamination,
    divergence,
    embeddings,
    mixing,
    oracles,
    packing,
    quality,
    sharding,
    simhash,
    substring,
    warc,
)
from matchlive.llm.common import table, text_of


def op1_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judged(table(spark, sf_dir, "documents"))
    return found.withColumns({name: F.round(name, 6) for name in ("class_distance", "word_distance")})


def op2_subspace_pigeonhole_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_subset_sum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", taken)


def op6_index_first_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.read_records(warc.write_archives(table(spark, sf_dir, "pages")))
    stored = F.col("record_type") == "response"
    return read.select(
        "page_id",
        F.when(stored, F.octet_length("payload")).otherwise(F.col("payload_bytes")).cast("long").alias("payload_bytes"),
        F.when(stored, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op7_generalised_pigeonhole_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", digits, "component_id")


def op8_histogram_sort_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.write_shards(table(spark, sf_dir, "documents")).select(
        "doc_id",
        sharding.size_of().alias("size"),
        F.crc32(text_of("text")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_typed_parts_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    return chat.conversation_digests(chat.format_turns(turns.unionByName(probe)))


def op10_fixed_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring.without_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_frequent_pattern_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audited(table(spark, sf_dir, "documents"))


def op12_bisector_tournament(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.clustered(table(spark, sf_dir, "embeddings")).drop("centroid")


def op13_prefix_filtered_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


QUERIES = {
    "op1_distribution_divergence": op1_distribution_divergence,
    "op2_subspace_pigeonhole_join": op2_subspace_pigeonhole_join,
    "op3_best_two_fit": op3_best_two_fit,
    "op4_co_training": op4_co_training,
    "op5_subset_sum_mix": op5_subset_sum_mix,
    "op6_index_first_warc": op6_index_first_warc,
    "op7_generalised_pigeonhole_simhash": op7_generalised_pigeonhole_simhash,
    "op8_histogram_sort_shards": op8_histogram_sort_shards,
    "op9_typed_parts_chat": op9_typed_parts_chat,
    "op10_fixed_block_anchors": op10_fixed_block_anchors,
    "op11_frequent_pattern_audit": op11_frequent_pattern_audit,
    "op12_bisector_tournament": op12_bisector_tournament,
    "op13_prefix_filtered_join": op13_prefix_filtered_join,
}

ORACLES = {
    "op1_distribution_divergence": oracles.OP1,
    "op2_subspace_pigeonhole_join": oracles.OP2,
    "op6_index_first_warc": oracles.OP6,
    "op9_typed_parts_chat": oracles.OP9,
    "op10_fixed_block_anchors": oracles.OP10,
    "op11_frequent_pattern_audit": oracles.OP11,
    "op12_bisector_tournament": oracles.OP12,
    "op13_prefix_filtered_join": oracles.OP13,
}
