"""Mixing sources to target weights by capped water-filling.

A source's target is its weight's part of the words wanted, at most its size
times the greatest number of epochs; what a clamped source can't take is dealt
to the others by weight, round by round, until no target is above its cap.
Every document is then taken as often as its source's target has whole epochs,
and the epoch that is left is a seeded sample of the source: its documents in
the order of a hash, up to the words that are missing, the last of them in part.

Only sums pass through the driver.  The order of a source is found by sums over
4,096 ranges of the hash; only the one range in which the sample ends is sorted.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.explore import ranks
from .common import shared_folder, stored
from .rollups import word_count

#: Parts in which a source's plan meets its documents, so that a hot source is joined by many tasks.
SALTS = 64


def cycled_weights(sources: DataFrame, weights: Iterable[float] = (3, 1, 2)) -> DataFrame:
    """Sources (source, ...), one row each, with weights that repeat in the order of their code points, null last."""
    values = F.array(*[F.lit(float(w)) for w in weights])
    keyed = sources.withColumn("place", F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name")))
    return ranks(keyed, "place", "place_rank", 0).withColumn("weight", F.get(values, F.col("place_rank") % F.size(values))).drop("place", "place_rank")


def targets(sources: DataFrame, wanted: float, epochs: float) -> DataFrame:
    """Sources (source, size, weight), stored, with target: at most ``epochs`` times the size, together ``wanted`` if that can be had.

    Water-filling: each round clamps the sources whose part is above their cap
    and deals the rest anew, until none is.  A round is one sum over the
    sources; a part only grows from round to round, so a clamped source stays
    so.  A source without weight or size gets nothing.
    """
    cap = F.lit(float(epochs)) * F.col("size")
    amount, weight, clamped = float(wanted), sources.agg(F.coalesce(F.sum("weight"), F.lit(0.0))).first()[0], 0
    while weight > 0:
        above = cap * F.lit(weight) <= F.lit(amount) * F.col("weight")
        found = sources.agg(F.count_if(above).alias("n"), F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)).alias("cap"), F.coalesce(F.sum(F.when(above, 0.0).otherwise(F.col("weight"))), F.lit(0.0)).alias("weight")).first()
        if found["n"] == clamped:
            break
        amount, weight, clamped = float(wanted) - found["cap"], found["weight"], found["n"]
    part = F.lit(amount) * F.col("weight") / F.lit(weight) if weight > 0 else F.when(F.col("weight") > 0, cap).otherwise(0.0)
    return sources.withColumn("target", F.least(cap, part))


def planned(docs: DataFrame, weights: DataFrame | None = None, share: float = 1.5, epochs: float = 2.0, seed: int = 7, keep: Iterable[str] = ()) -> DataFrame:
    """(doc_id, *keep, source, size, source_size, target, taken) of all documents (doc_id, source, text, ...).

    size: words between ASCII white space (null text: none).  The mix wants
    ``share`` times all words; ``weights`` has (source, weight), without it
    weights 3, 1, 2 repeat.  taken: the words of the document that the mix
    takes, repeats counted; of a source they add up to its target, rounded.
    Null is a source of its own, null ids are ids; rows that agree in id and
    size are interchangeable, and repeated rows each count.  Sources of
    ``weights`` without documents, and those without a weight, get nothing.  No
    documents: no rows.  Columns other than these and ``keep`` are not read.
    """
    keep = list(keep)
    folder = shared_folder(docs.sparkSession, "mix")
    source = F.col("source").cast("string")
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    size = word_count(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = docs.select("doc_id", *[F.col(f"`{c}`").alias(f"keep{i}") for i, c in enumerate(keep)], source.alias("source"), size.alias("size"), F.substring(key, 1, 16).alias("mark"))
    rows = stored(rows.withColumn("bucket", F.conv(F.substring("mark", 1, 3), 16, 10).cast("int")), f"{folder}/sizes")
    buckets = stored(rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")), f"{folder}/buckets")
    sizes = buckets.groupBy("source").agg(F.sum("words").alias("size"))
    weighed = cycled_weights(stored(sizes, f"{folder}/sources")) if weights is None else sizes.join(weights.select(F.col("source").alias("known"), F.col("weight").cast("double").alias("weight")), F.col("source").eqNullSafe(F.col("known")), "left").select("source", "size", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    weighed = stored(weighed, f"{folder}/weights")
    total = weighed.agg(F.sum("size")).first()[0] or 0
    words = F.floor(F.col("target") + 0.5).cast("long")
    whole = F.when(F.col("size") > 0, F.floor(words / F.col("size"))).otherwise(0).cast("long")
    plan = targets(weighed, share * total, epochs).withColumn("whole", whole).withColumn("extra", words - F.col("whole") * F.col("size"))
    # the range of the hash in which a source's sample ends, and the words before it
    before = F.sum("words").over(Window.partitionBy("source").orderBy("bucket")) - F.col("words")
    places = buckets.withColumn("before", before).select(F.col("source").alias("of"), F.col("bucket").alias("edge"), "before", "words")
    ends = F.col("source").eqNullSafe(F.col("of")) & (F.col("before") <= F.col("extra")) & (F.col("extra") < F.col("before") + F.col("words"))
    plan = plan.join(places, ends, "left").select(F.col("source").alias("of"), F.col("size").alias("source_size"), "target", "whole", "edge", (F.col("extra") - F.coalesce("before", F.lit(0))).alias("left"))
    plan = stored(plan, f"{folder}/plan").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") % SALTS == F.col("salt")))
    at_edge = F.col("bucket").eqNullSafe(F.col("edge"))
    in_order = Window.partitionBy("source").orderBy("mark", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    extra: Column = F.when(F.col("bucket") < F.col("edge"), F.col("size")).otherwise(0)
    some = F.least(F.col("size"), F.greatest(F.lit(0), F.col("left") - F.coalesce(F.sum("size").over(in_order), F.lit(0))))
    named = [F.col(f"keep{i}").alias(c) for i, c in enumerate(keep)]
    out = lambda df, more: df.select("doc_id", *named, "source", "size", "source_size", "target", (F.col("whole") * F.col("size") + more).cast("long").alias("taken"))
    return out(joined.filter(~at_edge), extra).unionByName(out(joined.filter(at_edge), some))


def repeated(plan: DataFrame, text: str = "text") -> DataFrame:
    """One row for each time that a document of ``planned`` is taken, with ``repetition`` from 0; the last may have the first words of the text only."""
    size, taken = F.col("size"), F.col("taken")
    times = plan.filter((taken > 0) & (size > 0)).withColumn("repetition", F.explode(F.sequence(F.lit(0), (F.ceil(taken / size) - 1).cast("int"))))
    missing = taken - F.col("repetition") * size
    first = F.concat(F.lit(r"\A(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++){"), missing, F.lit("}+"))
    cut = F.when(missing < size, F.regexp_substr(F.col(f"`{text}`"), first)).otherwise(F.col(f"`{text}`"))
    return times.withColumn(text, cut)


SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5('7:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:16] AS mark FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM d GROUP BY source),
r AS (SELECT *, 2.0::DOUBLE * source_size AS cap, row_number() OVER (ORDER BY source_size / w, source NULLS LAST) AS k, 1.5::DOUBLE * sum(source_size) OVER () AS wanted FROM s),
l AS (SELECT *, wanted - (sum(cap) OVER (ORDER BY k) - cap) AS amount, CAST(sum(w) OVER () - (sum(w) OVER (ORDER BY k) - w) AS DOUBLE) AS weight FROM r),
f AS (SELECT arg_min(amount, k) AS amount, arg_min(weight, k) AS weight FROM l WHERE cap * weight > amount * w),
t AS (SELECT source, source_size, coalesce(least(cap, f.amount * w / f.weight), cap) AS target FROM l, f),
p AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS words, CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) // source_size ELSE 0 END AS whole FROM t),
o AS (SELECT d.*, p.source_size, p.target, p.whole, p.words - p.whole * p.source_size AS extra,
  coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY mark, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, CAST(whole * size + least(size, greatest(0, extra - before)) AS BIGINT) AS taken FROM o
"""
