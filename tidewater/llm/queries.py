"""Registered queries of this subpackage, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import chat, grid_join, license_scan, markov_lm, mixing, near_dup, packing, phrases, prefix_trie, quality, repeats, secret_scan, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    d = mixing.mix(_table(spark, sf_dir, "documents"))
    return d.select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "taken")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every formatted conversation, read back from its string."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = f"{chat.END}{chat.START}assistant ok"
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields]
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], ", ".join(kinds))
    records = chat.records_of(rows.unionByName(more))
    return chat.read_back(chat.format_chats(records, "id", "json")).withColumnRenamed("id", "conv_id")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    d = toxicity.score_documents(docs, model)
    return d.select(
        F.col("id").alias("doc_id"), toxicity.held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "threshold", "flagged",
    )


def op4_minhash_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op5_markov_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model score of every document."""
    return markov_lm.score_documents(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    d = secret_scan.find_secrets(_table(spark, sf_dir, "documents"))
    base = [r.kind for r in secret_scan.RULES if r.base]
    kinds = F.transform("spans", lambda s: s.kind)
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in base]
    of_base = F.filter("spans", lambda s: s.kind.isin(base))
    return d.select(
        F.col("id").alias("doc_id"), *counts, F.sha2(secret_scan.listing(of_base), 256).alias("base_sha256"),
        secret_scan.listing(F.col("spans")).alias("spans"),
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences in every document."""
    d = license_scan.find_licenses(_table(spark, sf_dir, "documents"))
    starts = F.transform("base", lambda b: b.start)
    base = F.array_distinct(F.transform("base", lambda b: b.label))
    own = F.transform("found", lambda f: f.label)
    return d.select(
        F.col("id").alias("doc_id"), "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.sort_array(base), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(base, own)), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda f: f.score)), F.lit(0.0)).alias("score"),
    )


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document."""
    return packing.pack(_table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    d = quality.judge(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "n_lines", "n_shouts", "n_stop_words", "base_failed", "kept",
    )


def op10_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every vector."""
    return grid_join.near_vectors(_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first phrases by score."""
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op12_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What long repeats leave of every document."""
    return repeats.remove_repeats(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of rebuilt conversations."""
    return prefix_trie.prefix_trie(prefix_trie.rebuild(prefix_trie.sequences(_table(spark, sf_dir, "conversations"))))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline.py over documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_chat_format": op2_chat_format,
    "op3_toxicity": op3_toxicity,
    "op4_minhash_near_dups": op4_minhash_near_dups,
    "op5_markov_scores": op5_markov_scores,
    "op6_secret_scan": op6_secret_scan,
    "op7_license_scan": op7_license_scan,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_quality_rules": op9_quality_rules,
    "op10_grid_join": op10_grid_join,
    "op11_phrase_mining": op11_phrase_mining,
    "op12_remove_repeats": op12_remove_repeats,
    "op13_prefix_trie": op13_prefix_trie,
    "pipeline": pipeline,
}
