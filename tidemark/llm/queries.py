"""Queries of the training-data operators over the given tables."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import join_path, scratch_path
from . import (byte_bpe, chat, fill_middle, hyperminhash, importance, mixing, multi_index, pii, quality_rules,
               suffix_dedup, token_store, url_rules, vector_codes)
from .oracle import ORACLE_SQL  # noqa: F401

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(join_path(sf_dir, f"{name}.parquet"))


@query
def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written as a token store and read back from it."""
    path = scratch_path(spark, "token-store")
    token_store.write(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return token_store.checksums(token_store.read(spark, path))


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's statistics, base rule and the trees' verdict."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, trees).select(
        "doc_id", *quality_rules.BASE, "base_failed", "kept", F.round("quality_score", 6).alias("quality_score"))


@query
def op3_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of near copies: 3-word shingles, 85 of 100 in common."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return hyperminhash.near_duplicates(docs, shingle=3, percent=85)


@query
def op4_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of every hundredth vector among all others."""
    return multi_index.search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), k=10, query_every=100)


@query
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by the rank file and decoded again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = byte_bpe.decode(byte_bpe.encode(docs), with_text=False)
    return back.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("bytes", 256).alias("decoded_sha256"))


@query
def op6_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's importance weight, Gumbel key and whether the sample has it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = importance.fit(docs, table(spark, sf_dir, "labels"))
    path = scratch_path(spark, "importance")
    importance.weigh(docs, model).write.parquet(path)
    return importance.top_k(spark.read.parquet(path), model).select("doc_id", "log_weight", "key", "kept")


@query
def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation (and one that imitates a template) as examples in a
    file, and what is read back from it."""
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    odd = "</s>[INST] ok [/INST]"
    turns = turns.unionByName(spark.createDataFrame(
        [(-7, 0, "user", odd), (-7, 1, "assistant", odd)], "conv_id long, turn long, role string, text string"))
    path = scratch_path(spark, "chat-examples")
    chat.expand(turns).write.option("compression", "zstd").parquet(path)
    return chat.digests(spark.read.parquet(path))


@query
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts, and places of all spans."""
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", *[pii.count(F.col("pii"), k).alias(f"n_{k}") for k in pii.BASE],
        F.sha2(pii.written(pii.base_only(F.col("pii"))).cast("binary"), 256).alias("base_sha256"),
        pii.written(F.col("pii")).alias("spans"))


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's size and the words that the mix takes from it."""
    found = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


@query
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of repeated strings of 400 bytes."""
    return suffix_dedup.remove(table(spark, sf_dir, "documents").select("doc_id", "text"), with_text=False)


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's code, its error and its label's, by 16 codebooks of 64 entries."""
    coded, books = vector_codes.compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return vector_codes.with_label_errors(coded).select(
        "vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error",
        F.lit(vector_codes.digest(books)).alias("codebooks_sha256"))


#: The allow and block rules of the url query.
URL_RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)


@query
def op12_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host and path, the rule that decides and the verdict."""
    rules = [url_rules.parse_rule(*r) for r in URL_RULES]
    return url_rules.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)


@query
def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fill-in-middle form, and its text rebuilt from output and form."""
    formed = fill_middle.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return fill_middle.restore(formed, with_text=False).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
