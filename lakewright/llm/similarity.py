"""Exact links between similar sets and their components, without a quadratic join.

Sets are rows (key, n, tokens): ``tokens`` holds the set's ``n`` tokens as sorted
little-endian 64-bit hashes.  Two sets are linked if their Jaccard similarity is
at least num/den.  Candidates come from postings (token, key) such that linked
sets share a posting token.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

STAR_ROUNDS = 6


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common values of two sorted arrays without repeats."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that are linked.

    ``b`` may hold a hub of very many pairs: its sets come in last, when the
    rows are wide enough for an adaptive join to split the hub's partition.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            keep = [
                (den + num) * overlap(np.frombuffer(ta, np.uint64), np.frombuffer(tb, np.uint64)) >= num * (na + nb)
                for ta, na, tb, nb in zip(df["ta"], df["na"], df["tb"], df["nb"], strict=True)
            ]
            yield df.loc[keep, ["a", "b"]]

    left = sets.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "na", "ta", "nb", "tb").mapInPandas(run, "a long, b long")


def agreeing(pairs: DataFrame, orders: DataFrame) -> DataFrame:
    """The pairs (a, b) that share a prefix token under every other order, too.

    ``orders`` (key, others) holds each set's prefixes, one array of tokens an
    order.  They are about a fifth of the set; the sets themselves stay where
    they are.
    """
    left, right = orders.select(F.col("key").alias("a"), F.col("others").alias("x")), orders.select(F.col("key").alias("b"), F.col("others").alias("y"))
    shares = F.forall(F.zip_with("x", "y", lambda x, y: F.arrays_overlap(x, y)), lambda ok: ok)
    return pairs.join(left, "a").join(right, "b").filter(shares).select("a", "b")


def salt(key: Column, salts: Column) -> Column:
    """The part of a token's postings that a set's row falls in."""
    return F.pmod(F.xxhash64(key), salts).cast("int")


def to_all_salts(rows: DataFrame) -> DataFrame:
    """Each row once for each part of its token's postings, so that a frequent token is joined in many tasks."""
    return rows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(key, label) of all keys in ``edges`` (a, b); the label is the smallest key of the component.

    Large-star and small-star steps in turn: each edge list is written before
    the next step, and the number of steps grows with the logarithm of the
    longest path.
    """
    both = lambda e: e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    now, step, before = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{folder}/edges-0"), 0, None
    while True:
        step += 1
        near = both(now)
        least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = near.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.filter("a <> b").distinct(), f"{folder}/large-{step}")
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_least, "a").select(F.explode(F.array("a", "b")).alias("a"), "m").filter("a <> m").select("a", F.col("m").alias("b"))
        now = stored(small.distinct(), f"{folder}/small-{step}")
        state = now.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if state == before:
            break
        before = state
    # every key now points at its component's smallest
    return now.select(F.col("a").alias("key"), F.col("b").alias("label")).union(now.select(F.col("b").alias("key"), F.col("b").alias("label")).distinct())


def linked_components(postings: DataFrame, orders: DataFrame, sets: DataFrame, folder: str, num: int, den: int, star_rounds: int = STAR_ROUNDS) -> DataFrame:
    """(key, label) of all sets that are linked to another one.

    ``postings`` (token, salts, key, n, most, weight) are the candidates' filter
    tokens; ``most`` is the number of tokens from this one on in the global
    order.  A linked pair has all it has in common from its first common token
    on, so at some token both bounds are enough for both sizes (the length and
    positional filters); only such pairs are possible, and of these only those
    that agree under all other ``orders`` are compared.  A star round compares
    every set with one partner of another component that shares most filter
    tokens with it: in the first round the one of most weight (of a group of
    near copies the one that the others were made from), then one at random, as
    long as at least half of the pairs of a round are links.  So a large group
    falls together after few comparisons a set.  Then all remaining possible
    pairs that lie in different components are compared; a link inside a
    component can't change it.
    """
    found: list[DataFrame] = []
    labels = None
    possible = ((den + num) * F.least("most", "other.most") >= num * (F.col("n") + F.col("other.n"))) & (den * F.least("n", "other.n") >= num * F.greatest("n", "other.n")) & (F.col("label") != F.col("other.label"))
    postings = postings.withColumn("salt", salt(F.col("key"), F.col("salts")))
    on = ["token", "salt"]

    def labelled(name: str) -> DataFrame:
        rows = postings.withColumn("label", F.col("key")) if labels is None else postings.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
        split = rows.groupBy("token").agg(F.first("salts").alias("salts"), F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("token", "salts")
        return stored(rows.join(to_all_salts(split), on, "left_semi").withColumn("other", F.struct("key", "n", "most", "label")), f"{folder}/labelled-{name}")

    def compared(pairs: DataFrame, name: str) -> tuple[int, int]:
        pairs = stored(pairs, f"{folder}/pairs-{name}")
        pairs = stored(agreeing(pairs, orders), f"{folder}/agreeing-{name}")
        links = stored(verified(pairs, sets, num, den), f"{folder}/links-{name}")
        found.append(links)
        return pairs.count(), links.count()

    for round_ in range(star_rounds):
        rows = labelled(str(round_))
        plain = rows.drop("other", "salts")
        order = F.struct(F.col("weight") if not round_ else F.xxhash64("key", F.lit(round_)), "key")
        first = rows.groupBy("token").agg(F.first("salts").alias("salts"), F.max_by("other", order).alias("first"))
        second = rows.drop("salts").join(to_all_salts(first), on).filter(F.col("label") != F.col("first.label")).groupBy("token").agg(F.max_by("other", order).alias("second"))
        hubs = stored(first.join(second, "token"), f"{folder}/hubs-{round_}")
        near = plain.join(to_all_salts(hubs), on).withColumn("other", F.when(F.col("first.label") != F.col("label"), F.col("first")).otherwise(F.col("second")))
        shared = near.filter(possible).groupBy("key", F.col("other.key").alias("hub")).count()
        pairs = shared.groupBy("key").agg(F.max_by("hub", F.struct("count", F.xxhash64("hub"))).alias("hub")).select(F.col("key").alias("a"), F.col("hub").alias("b"))
        tried, linked = compared(pairs, str(round_))
        if 2 * linked < tried or not linked:
            break  # stars have done what they can
        labels = components(reduce(DataFrame.union, found), f"{folder}/components-{round_}")
    rows = labelled("rest")
    major = rows.groupBy("token", "label").agg(F.first("salts").alias("salts"), F.count("*").alias("c")).groupBy("token").agg(F.first("salts").alias("salts"), F.max_by("label", F.struct("c", "label")).alias("major"))
    others = rows.join(to_all_salts(major), on).filter("label <> major").select("token", "salts", "other")
    pairs = to_all_salts(others).join(rows.drop("other", "salts"), on).filter(possible).select(F.least("key", "other.key").alias("a"), F.greatest("key", "other.key").alias("b")).distinct()
    compared(pairs, "rest")
    return components(reduce(DataFrame.union, found), f"{folder}/components")
