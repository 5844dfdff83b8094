"""Mixing sources to target weights without sorting documents.

Each document has a 60-bit hash of its doc_id; a source's part of the mix is
the documents below a threshold on that hash, beside whole passes over the
source when its target passes its size. Thresholds come from histograms: sum
the words by source and leading bits of the hash, find the bucket in which the
running sum passes the budget, and refine only that bucket by the next bits,
until a single hash value is left. So every level is one aggregate over a part
of the rows that shrinks by the number of buckets, and no documents are sorted.

Budgets are shares of all words; several may be asked for at once. They use the
same hash, so the mix of a smaller budget is nested in that of a larger one as
long as no more whole passes are needed.

Targets: sources in code point order (null last) weigh 3, 1, 2, repeating, of
the budget; a target stops at ``CAP`` times its source's size and the excess is
shared by weight among the rest until none is above. That is one water level:
target = least(cap, weight * level).

Defined results: a null text has size 0, a null source is a source of its own,
a null doc_id hashes like an empty one. Rows with the same doc_id share their
hash, so they are taken together. Sources without words have target 0. An empty
table gives an empty mix. Input columns named like an output are replaced.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import scratch_path

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
CAP = 2
#: Leading bits of each histogram level; together 60.
LEVELS = (12, 16, 16, 16)
#: Copies of a source's threshold, so that rows of a hot source meet in many tasks.
SALTS = 16
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash60(doc_id: Column) -> Column:
    """The first 15 hex digits of the md5 of the id's decimal digits, as a number."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, budgets: tuple[float, ...] = (BUDGET,), weights: tuple[int, ...] = WEIGHTS,
            cap: float = CAP) -> DataFrame:
    """(budget, source, source_size, target) from one row for each source."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    w = F.get(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") - 1) % len(weights))
    s = sizes.select("source", "source_size", rank.alias("rank"))
    s = s.select("*", w.alias("w"), (F.col("source_size") * F.lit(float(cap))).alias("most"),
                 F.explode(F.array(*[F.lit(float(b)) for b in budgets])).alias("budget"))
    all_of = Window.partitionBy("budget")
    by = all_of.orderBy(F.col("most") / F.col("w"), "rank")
    s = s.select("*", (F.col("budget") * F.sum("source_size").over(all_of)).alias("whole"),
                 F.coalesce(F.sum("most").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("full"),
                 F.sum("w").over(by.rowsBetween(0, Window.unboundedFollowing)).alias("open"))
    # The level if this source is the first that stays below its cap.
    level = (F.col("whole") - F.col("full")) / F.col("open")
    s = s.select("*", F.when(level <= F.col("most") / F.col("w"), level).alias("level"))
    level = F.coalesce(F.max("level").over(all_of), F.max(F.col("most") / F.col("w")).over(all_of))
    return s.select("budget", "source", "source_size", F.least(F.col("most"), F.col("w") * level).alias("target"))


def _boundary(hist: DataFrame, keys: list[str]) -> DataFrame:
    """The bucket of each key in which the running sum passes ``rest``."""
    upto = Window.partitionBy(*keys).orderBy("bucket")
    cum = hist.select("*", F.sum("words").over(upto).alias("cum"))
    past = F.struct("bucket", (F.col("cum") - F.col("words")).alias("before"), "words")
    return cum.where("cum + done > rest").groupBy(*keys).agg(F.min(past).alias("b"))


def thresholds(staged: DataFrame, goals: DataFrame) -> DataFrame:
    """For each (budget, source): passes (whole ones) and the hash below which
    a document is taken once more.

    The running sum ends at the document in which it passes the rest of the
    budget; that one is taken if the sum with it is nearer to the rest.
    """
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    goals = goals.select("budget", "source", "source_size", "target", passes.cast("long").alias("passes"))
    goals = goals.select("*", (F.col("target") - F.col("passes") * F.col("source_size")).alias("rest"))
    open_ = goals.where("rest > 0").select("budget", "source", "rest", F.lit(0).cast("long").alias("prefix"),
                                          F.lit(0).cast("long").alias("done"))
    left = sum(LEVELS)
    for level, bits in enumerate(LEVELS):
        above = left
        left -= bits
        bucket = F.shiftright(F.col("hash"), left)
        hist = staged.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
        o = open_.select("budget", F.col("source").alias("of"), "rest", "prefix", "done")
        hit = hist["source"].eqNullSafe(o["of"])
        if level:
            # Only documents of the boundary bucket are read on; the filter acts before the sums.
            inner = staged.join(o.select("of", "prefix").distinct(),
                                staged["source"].eqNullSafe(F.col("of"))
                                & (F.shiftright(F.col("hash"), above) == F.col("prefix")), "left_semi")
            hist = inner.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
            hit = hist["source"].eqNullSafe(o["of"]) & (F.shiftright(F.col("bucket"), bits) == F.col("prefix"))
        hist = hist.join(o, hit).select("budget", "source", "rest", "done", "bucket", "words")
        found = _boundary(hist, ["budget", "source", "rest", "done"])
        open_ = found.select("budget", "source", "rest", F.col("b.bucket").alias("prefix"),
                             (F.col("done") + F.col("b.before")).alias("done"), F.col("b.words").alias("words"))
        # A row for each source: written, so that no level computes the ones before it again.
        path = scratch_path(staged.sparkSession, f"mix-level{level}")
        open_.write.parquet(path)
        open_ = staged.sparkSession.read.parquet(path)
    nearer = (F.col("done") + F.col("words") - F.col("rest")) < (F.col("rest") - F.col("done"))
    cut = open_.select(F.col("budget").alias("ob"), F.col("source").alias("os"),
                       (F.col("prefix") + nearer.cast("long")).alias("cut"))
    joined = goals.join(cut, (F.col("budget") == F.col("ob")) & F.col("source").eqNullSafe(F.col("os")), "left")
    # No bucket passes the rest: rounding left nothing open, so the whole source is taken.
    whole = F.when(F.col("rest") > 0, F.lit(1 << sum(LEVELS))).otherwise(F.lit(0)).cast("long")
    return joined.select("budget", "source", "source_size", "target", "passes",
                         F.coalesce("cut", whole).alias("cut"))


def mix(docs: DataFrame, budgets: tuple[float, ...] = (BUDGET,), weights: tuple[int, ...] = WEIGHTS,
        cap: float = CAP) -> DataFrame:
    """(budget, doc_id, source, hash, size, source_size, target, copies, taken)
    for every document and budget; copies is how often the mix has it."""
    spark = docs.sparkSession
    staged_at = scratch_path(spark, "mix-sizes")
    (docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), hash60(F.col("doc_id")).alias("hash"))
     .write.parquet(staged_at))
    staged = spark.read.parquet(staged_at)
    goals_at = scratch_path(spark, "mix-targets")
    targets(staged.groupBy("source").agg(F.sum("size").alias("source_size")), budgets, weights, cap) \
        .coalesce(1).write.parquet(goals_at)
    cuts = thresholds(staged, spark.read.parquet(goals_at)).withColumnRenamed("source", "of")
    cuts = cuts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = staged.join(cuts, staged["source"].eqNullSafe(F.col("of"))
                        & (F.pmod(F.xxhash64("doc_id", "hash"), F.lit(SALTS)) == F.col("salt")))
    copies = F.col("passes") + F.when(F.col("hash") < F.col("cut"), 1).otherwise(0)
    return found.select("budget", "doc_id", "source", "hash", "size", "source_size", "target",
                        copies.cast("long").alias("copies"), (F.col("size") * copies).cast("long").alias("taken"))


def repeat(docs: DataFrame, budget: float = BUDGET, weights: tuple[int, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """``docs`` as the mix has them: each row as often as its document is taken.

    Whether a row stays follows from its source and its own hash, so the texts
    meet only the thresholds (a row for each source), never other documents.
    """
    spark = docs.sparkSession
    columns = docs.columns
    staged_at = scratch_path(spark, "mix-sizes")
    (docs.select("source", word_count(F.col("text")).alias("size"), hash60(F.col("doc_id")).alias("hash"))
     .write.parquet(staged_at))
    staged = spark.read.parquet(staged_at)
    goals_at = scratch_path(spark, "mix-targets")
    targets(staged.groupBy("source").agg(F.sum("size").alias("source_size")), (budget,), weights, cap) \
        .coalesce(1).write.parquet(goals_at)
    cuts = thresholds(staged, spark.read.parquet(goals_at))
    cuts = cuts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    name = "mix" + "_" * max(map(len, columns))  # no column of the documents is as long
    cuts = cuts.select(F.struct("source", "passes", "cut", "salt").alias(name))
    h = hash60(F.col("doc_id"))
    hit = F.col("source").eqNullSafe(F.col(f"{name}.source")) & (F.pmod(h, F.lit(SALTS)) == F.col(f"{name}.salt"))
    copies = F.col(f"{name}.passes") + F.when(h < F.col(f"{name}.cut"), 1).otherwise(0)
    found = docs.join(cuts, hit).withColumn(name, F.array_repeat(F.lit(0), copies.cast("int")))
    return found.withColumn(name, F.explode(name)).select(*columns)
