"""The Jaccard join against brute force over all pairs."""

import itertools
import random
import re

from lakewright.llm import shingles

SCHEMA = "doc_id long, text string, n_shingles string, key string"


def reference(rows):
    sets = {}
    for doc, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    parent = {d: d for d in sets}

    def top(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a, b in itertools.combinations(sets, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    return {(d, len(s), top(d)) for d, s in sets.items()}


def run(spark, rows):
    df = spark.createDataFrame([(d, t, "clash", None) for d, t in rows], SCHEMA)
    return {tuple(r) for r in shingles.jaccard_components(df).collect()}


def edited(rng, words, share):
    return [rng.choice("abcdefghijkl") * 3 + str(rng.randrange(999)) if rng.random() < share else w for w in words]


def test_components_equal_brute_force(spark):
    rng = random.Random(5)
    fresh = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    rows, passage = [], fresh(60)
    base = fresh(90)
    rows += [" ".join(edited(rng, base, share)) for share in (0, 0, 0.01, 0.01, 0.02, 0.02, 0.03, 0.03, 0.05) * 5]
    rows += [" ".join(fresh(rng.randrange(3, 60)) + passage + fresh(rng.randrange(3, 60))) for _ in range(40)]
    chain = fresh(200)
    for _ in range(12):
        rows.append(" ".join(chain))
        at = rng.randrange(190)
        chain[at : at + 5] = fresh(5)
    rows += ["", None, " \n\t", "one", "One", "one two three four", "ONE two three four", "one two three four five", "\x1cone two", "é É"]
    rows += [" ".join(["same"] * k) for k in (3, 5, 50, 5000)]
    rows = [(i * 7 % 1009, t) for i, t in enumerate(rows)]
    assert run(spark, rows) == reference(rows)


def test_empty_table_and_null_or_repeated_ids(spark):
    assert run(spark, []) == set()
    df = spark.createDataFrame([(None, "a b c d e f", "", ""), (4, "a b c d e f", "", ""), (4, "a b c d e f", "", "")], SCHEMA)
    assert sorted(map(str, map(tuple, shingles.jaccard_components(df).collect()))) == sorted(map(str, [(4, 2, 4), (4, 2, 4), (None, 2, 4)]))


def test_one_of_each_group_keeps_the_columns(spark):
    text = "one two three four five six seven"
    df = spark.createDataFrame([(3, text, "x", "y"), (2, text, "x", "z"), (9, "other words here", None, None), (2, text, "x", "z"), (None, text, None, None)], SCHEMA)
    out = shingles.one_of_each_group(df)
    assert out.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in out.collect()) == ["2", "9", "None"]


def test_small_table_equals_brute_force(spark):
    from tests.conftest import SMALL

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert {tuple(r) for r in shingles.jaccard_components(docs).collect()} == reference([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
