"""The registered ``opN_<name>`` queries of this package and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import (chat_format, conversation_repair, decontaminate, language_id, license_scan, lm_scoring, oracle_sql,
               packing, prefix_trie, quality_rules, sharding, simhash_dedup, token_counts, warc)
from .common import crc_mod, documents

SHARDS = 16
SEQUENCE_TOKENS = 2048


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), capacity=SEQUENCE_TOKENS, closing_id=0)


def derived_edits(doc_id: Column, text: Column) -> Column:
    """Three edits a document, placed by its id's hash: a replacement, an insertion and a deletion."""
    n = F.coalesce(F.length(text), F.lit(0)).cast("long")
    place = lambda seed: F.pmod(F.xxhash64(doc_id, F.lit(seed)), n + 1)
    edit = lambda at, size, new: F.struct(
        at.alias("start"), (at + size).alias("stop"), F.lit(new).alias("replacement"))
    return F.array(edit(place(1), 12, "revised wording"), edit(place(2), 0, " An added sentence."),
                   edit(place(3), 40, ""))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("edits", derived_edits(F.col("doc_id"), F.col("text")))
    edited = token_counts.apply_edits(token_counts.build_trees(docs, carry=("edits",)))
    return edited.select("doc_id", F.crc32(F.col("text").cast("binary")).alias("text_crc32"), "n_tokens_before",
                         "n_tokens", "n_segments", "encoded_segments", "encoded_chars")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(documents(spark, sf_dir), SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(documents(spark, sf_dir), crc_mod(F.col("doc_id"), 5) == 1)


def two_sides(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected conversations: the table, and the same with the reply before in each reply's
    place from a turn on that the id gives.  One in ten has only one of them, one in ten the other."""
    turns = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    reply = F.coalesce("role", F.lit("user")) == "assistant"
    said = F.when(reply, F.coalesce("text", F.lit("")))
    earlier = F.last(said, ignorenulls=True).over(turns.rowsBetween(Window.unboundedPreceding, -1))
    place = 1 + (F.col("conv_id") % 1_000_003 * 7919 + 17) % F.count("*").over(Window.partitionBy("conv_id"))
    worse = table.select("conv_id", "turn", "role", F.when(reply & (F.row_number().over(turns) >= place), F.coalesce(
        earlier, F.lit(""))).otherwise(F.col("text")).alias("text"))
    return table.where("conv_id % 10 <> 1"), worse.where("conv_id % 10 <> 2")


def op6_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = chat_format.format_preferences(*two_sides(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    spans = lambda c: F.concat_ws(",", F.transform(
        c, lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["stop"].cast("string")))).alias(c)
    return pairs.select("conv_id", "n_prompt_turns", "prompt", "chosen", "rejected",
                        spans("chosen_mask"), spans("rejected_mask"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.groups(documents(spark, sf_dir))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.evaluate(documents(spark, sf_dir))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    remainder = crc_mod(F.col("doc_id"), 4)
    model = language_id.fit(docs.where(remainder != 2))
    return language_id.predict(docs, model).select(
        "doc_id", F.coalesce(remainder == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def with_shared_heads(own: DataFrame) -> DataFrame:
    """Numbered turns with the first h of conversation c replaced by those of c - c % 20, h = crc32(c) % 4."""
    h = crc_mod(F.col("conv_id"), 4)
    heads = own.where("conv_id % 20 = 0 and place <= 3").withColumnRenamed("conv_id", "base")
    convs = own.where("place = 1").select("conv_id", F.expr("conv_id - conv_id % 20").alias("base"))
    given = convs.join(heads, "base").where(F.col("place") <= h).drop("base")
    return own.where(F.col("place") > h).unionByName(given)


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = prefix_trie.numbered_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return prefix_trie.build(with_shared_heads(own), own.where("place = 1").select("conv_id"))


FIRST_CAPTURE, YEAR = 1_704_067_200, 31_536_000  # 2024-01-01, seconds of a year


def op12_warc_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages have no time: one is captured in the second of a year that its id gives."""
    at = F.lit(FIRST_CAPTURE) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(YEAR))
    return warc.capture_history(spark.read.parquet(f"{sf_dir}/pages.parquet"), at=at).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured_at", "index_row")


def damaged(table: DataFrame) -> DataFrame:
    """Conversations with turns dropped, emptied, cut off, repeated or given to the user, by a hash of id and turn."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    rows = table.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"),
                        kind.alias("kind")).where("kind <> 0")
    text = (F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    times = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), times.alias("again")).drop("again")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    fixed = conversation_repair.repair(damaged(table)).withColumnRenamed("conv_id", "id")
    said = F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    # Conversations that lost all turns are in the table, but not among the repaired.
    return table.select("conv_id").distinct().join(fixed, F.col("conv_id").eqNullSafe(F.col("id")), "left").select(
        "conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in conversation_repair.FIGURES),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.sha2(F.coalesce(F.concat_ws("\n", said), F.lit("")).cast("binary"), 256).alias("repaired_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_benchmark_decontamination, op2_best_fit_packing, op3_token_counts, op4_sharding, op5_lm_scoring,
    op6_preference_format, op7_simhash_near_dedup, op8_quality_rules, op9_license_scan, op10_language_id,
    op11_conversation_prefix_trie, op12_warc_capture_index, op13_conversation_repair)}

# The others can't be told in SQL (hash functions, a tokenizer, trained models); tests hold them
# against brute force.
ORACLE_SQL = {
    "op6_preference_format": oracle_sql.CHAT,
    "op8_quality_rules": oracle_sql.QUALITY,
    "op9_license_scan": oracle_sql.LICENSE,
    "op12_warc_capture_index": oracle_sql.WARC,
}
