"""The registered queries opN_<name>: each applies its operator to its whole
table and derives the digest columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartwise.llm import bpe, decontaminate, fingerprint, langid, lines, lm, phrases, search, sharding, simhash, substrings, tokenfile, toxicity
from chartwise.llm.common import held_out, id_and_text, table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, distance=3)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = decontaminate.find_hits(docs, table(spark, sf_dir, "benchmark"), n=13)
    return hits.select("doc_id", F.col("hit_words").alias("n_words"), decontaminate.n_hit().alias("n_hit"),
                       F.size("hit_items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
                       decontaminate.is_contaminated().alias("contaminated"))


def op3_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = id_and_text(table(spark, sf_dir, "documents"))
    out = held_out("doc_id", 5, 1)
    return lm.score(docs, docs.filter(~out)).select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    done = bpe.encode(docs, tokenizer_path("word_bpe_49k.json"), decoded=True)
    return done.select("doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    said = langid.predict(docs, langid.train(langid.learning_rows(docs, 3, 1)))
    return said.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = id_and_text(table(spark, sf_dir, "documents"))
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), 5, 0)
    said = toxicity.predict(docs, model)
    return said.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.with_next(table(spark, sf_dir, "documents"))


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = id_and_text(table(spark, sf_dir, "documents"))
    return lines.dedup(docs, report=True).select("doc_id", "n_lines", "n_removed", "text")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = sharding.balance(table(spark, sf_dir, "documents"), shards=40)
    return done.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = tokenfile.write(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenfile.new_folder(spark), end_id=0)
    return tokenfile.read(spark, manifest, ids=False)


def op11_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = substrings.find_repeats(id_and_text(table(spark, sf_dir, "documents")), n=13)
    return docs.select("doc_id", F.col("repeat_words").alias("n_words"), substrings.n_removed().alias("n_removed"),
                       F.sha2("repeat_kept", 256).alias("kept_sha256"))


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(search.build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"), k=10)


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), least=30, most=4, cover=80, top=2000)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_simhash, op2_decontaminate, op3_lm, op4_bpe, op5_language, op6_fingerprint, op7_toxicity, op8_lines, op9_sharding,
             op10_token_files, op11_substrings, op12_search, op13_phrases)
    return {f.__name__: f for f in found}
