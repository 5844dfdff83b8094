"""From raw documents to token ids: five stages over the ``documents`` table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's documents; so lineage is cut
between stages and a lost executor costs no earlier stage. All stages but the
last return the columns of documents.

1. quality  documents that importance resampling leaves out go
2. dedup    of each group of near copies (five-word shingles, 80 of 100 in
            common) one document with the smallest doc_id stays
3. pii      personal data in texts is replaced by its kind, as [EMAIL]
4. mix      documents are repeated or left out so that sources come near their
            target weights
5. encode   texts become byte-level BPE ids, checked by decoding them
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import byte_bpe, hyperminhash, importance, mixing, pii
from tidemark.session import join_path, scratch_path

#: No stage but the mix can be expressed in SQL; tests compare with plain Python.
ORACLE_SQL = None

SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(join_path(sf_dir, "labels.parquet"))
    model = importance.fit(docs, labels)
    # Scores replace columns of their name, so the documents' own get another one meanwhile.
    aside = {c: c + "_" * max(map(len, docs.columns)) for c in docs.columns if c.lower() in importance.OUTPUTS}
    scored = importance.resample(docs.withColumnsRenamed(aside), model)
    return scored.where("kept").select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component; rows without words or doc_id all stay."""
    path = scratch_path(spark, "near-duplicates")
    hyperminhash.judge(docs, SHINGLE_WORDS, SIMILAR_PERCENT).where("doc_id is not null").groupBy("doc_id", "text_key") \
        .agg(F.max("first").alias("kept"), F.max("n_shingles").alias("words"), F.count("*").alias("rows")).write.parquet(path)
    verdict = spark.read.parquet(path)
    # One struct, under a name that no column of the documents has.
    name = "verdict" + "_" * max(map(len, docs.columns))
    verdict = verdict.select(F.struct(*verdict.columns).alias(name))
    repeats = (F.col(f"{name}.rows") > 1) & (F.col(f"{name}.words") > 0)
    # A verdict for each text of a doc_id is never small: sorted on both sides, whatever the size.
    joined = docs.join(verdict.hint("merge"), (F.col("doc_id") == F.col(f"{name}.doc_id"))
                       & (F.xxhash64("text") == F.col(f"{name}.text_key")), "left")
    joined = joined.where(F.coalesce(F.col(f"{name}.kept"), F.lit(True)))
    if verdict.where(f"{name}.kept").where(repeats).limit(1).count():
        single = joined.where(~F.coalesce(repeats, F.lit(False)))
        joined = single.unionByName(joined.where(repeats).dropDuplicates([name]))
    return joined.select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.redact(docs)
    return clean.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeat(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids, ids_sha256 and whether decoding gives the text again."""
    back = byte_bpe.decode(byte_bpe.encode(docs.select("doc_id", "source", "text")), with_text=False)
    return back.select("doc_id", "source", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
                       (F.col("bytes") == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"))


STAGES = [("quality", quality), ("dedup", dedup), ("pii", personal_data), ("mix", mix), ("encode", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the whole documents table."""
    docs = spark.read.parquet(join_path(sf_dir, "documents.parquet"))
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
