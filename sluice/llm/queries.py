"""One query per operator, over its whole table, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import chat, lines, mixing, packing, phrases, quality, rules, search, secrets, simhash, spelling, toxicity, urls
from sluice.llm.common import held_out

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pack_documents(docs: DataFrame) -> DataFrame:
    import public_tokenizers  # where the vocabulary files are on this machine

    return packing.packed(
        docs,
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op1_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs.select("doc_id", "text"), model, "score").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.CUT).cast("int").alias("predicted"),
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair(table(spark, sf_dir, "conversations"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"), secrets.forest(spark))


def op9_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    judged = toxicity.judge(docs.select("doc_id", "text"), model)
    found = F.col("toxicity")
    return judged.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        found["score"].alias("score"),
        (found["score"] >= toxicity.CUT).cast("int").alias("predicted"),
        F.size(found["passages"]).alias("passages"),
    )


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.vocabulary(table(spark, sf_dir, "documents"), thinned=spelling.THINNED)
    return spelling.variants(words)


def op13_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = lines.with_bitmaps(table(spark, sf_dir, "documents").select("doc_id", "text"))
    bits = F.col("line_bits")
    return marked.select(
        "doc_id",
        bits["n_lines"].alias("n_lines"),
        bits["n_dropped"].alias("n_dropped"),
        F.sha2(lines.kept_lines("text", bits["keep"]).cast("binary"), 256).alias("kept_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_search": op1_search,
    "op2_urls": op2_urls,
    "op3_packing": op3_packing,
    "op4_quality": op4_quality,
    "op5_mixing": op5_mixing,
    "op6_simhash": op6_simhash,
    "op7_chat": op7_chat,
    "op8_secrets": op8_secrets,
    "op9_rules": op9_rules,
    "op10_toxicity": op10_toxicity,
    "op11_phrases": op11_phrases,
    "op12_spelling": op12_spelling,
    "op13_lines": op13_lines,
}
ORACLE: dict[str, str] = {
    "op1_search": search.SQL,
    "op2_urls": urls.sql(),
    "op5_mixing": mixing.SQL,
    "op11_phrases": phrases.SQL,
    "op12_spelling": spelling.SQL,
    "op13_lines": lines.SQL,
}
