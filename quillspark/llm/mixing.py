"""Mixing sources to target weights, with DataFrame functions only.

Word counts are summed per source (partial sums before the shuffle).  Targets
share the total by weight under a cap of ``limit`` times each source's size:
they are min(limit * size, level * weight), and the level that makes them add up
comes from one pass over the sources in order of cap / weight.  A source's
repetition rate is target / size; each document is emitted floor(rate) times,
and once more if a uniform hash of (seed, doc_id) is under the fraction.

Sources are ranked in one task, a small row each; up to 100,000 are broadcast.

Defined cases: null or empty text has size 0 and takes nothing; texts of any length
count whole; a null source is a source of its own, last in order; a source of size 0
has target 0; sources that reach their cap at the same level do so in order of name; a
null doc_id hashes as null; equal rows and rows of one id get equal draws; an empty
table gives an empty mix.  Only doc_id, source and text are read to decide; ``mixed`` returns
every other column as it is, whatever its name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm import common

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)


def source_rates(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: float = 3.0) -> DataFrame:
    """(source, source_size, target, rate) of ``sized`` (source, size)."""
    sizes = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    ranked = sizes.withColumn("at", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("at") % len(weights) + 1).cast("int"))
    capped = ranked.withColumn("weight", w).withColumn("cap", limit * F.col("source_size"))
    everything = Window.partitionBy()
    rising = Window.orderBy(F.col("cap") / F.col("weight"), "at").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(rising), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(rising), F.lit(0.0))
    )
    filled = capped.withColumn("level", level).withColumn("full", F.col("cap") <= F.col("level") * F.col("weight"))
    shared = F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("weight"), "at", "level"))).over(everything)["level"]
    target = F.when(F.col("full"), F.col("cap")).otherwise(shared * F.col("weight"))
    out = filled.withColumn("target", F.least(target, F.col("cap")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return out.select("source", "source_size", "target", F.least(rate, F.lit(limit)).alias("rate"))


def draw(doc_id: Column, seed: int) -> Column:
    """A uniform number in [0, 1) from a document's id: 52 bits of an MD5, as any engine can make them."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") * F.lit(2.0**-52)


def copies(doc_id: Column, rate: Column, seed: int) -> Column:
    whole = F.floor(rate)
    return (whole + F.when(draw(doc_id, seed) < rate - whole, 1).otherwise(0)).cast("long")


def _small(rates: DataFrame, most: int = 100_000) -> DataFrame:
    """``rates``, to be broadcast if there are few enough sources to prove it small."""
    rates = common.checkpointed(rates, 0)
    return F.broadcast(rates) if rates.count() <= most else rates


def mixture(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: float = 3.0, seed: int = 17) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies) of each row of ``docs``."""
    sized = common.checkpointed(docs.select("doc_id", "source", common.word_count(F.col("text")).alias("size")))
    rates = _small(source_rates(sized, weights, limit).withColumnRenamed("source", "of"))
    out = sized.join(rates, F.col("source").eqNullSafe(F.col("of")), "left").withColumn("copies", copies(F.col("doc_id"), F.col("rate"), seed))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: float = 3.0, seed: int = 17) -> DataFrame:
    """The rows of ``docs``, each as many times as the mix takes it, in the same columns."""
    sized = docs.select("source", common.word_count(F.col("text")).alias("size"))
    own = common.fresh(docs, "mix")
    rates = _small(source_rates(sized, weights, limit).select(F.struct("source", "rate").alias(own)))
    times = copies(F.col("doc_id"), F.coalesce(F.col(f"{own}.rate"), F.lit(0.0)), seed)
    joined = docs.join(rates, F.col("source").eqNullSafe(F.col(f"{own}.source")), "left")
    return joined.withColumn(own, F.explode(F.array_repeat(F.lit(1), times.cast("int")))).select(*[F.col(f"`{c}`") for c in docs.columns])
