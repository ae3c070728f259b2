"""Mixing against exact water levels and a plain walk through each source."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

from lakewright.llm import mixing as M

SCHEMA = "doc_id long, text string, source string, size string, mark string, bucket string, weight string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash", "clash") for r in rows], SCHEMA)


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def levels(sizes, weights, wanted, epochs):
    """Exact targets: clamp what is above its cap and deal the rest again."""
    target, clamped = {}, {}
    while True:
        rest = {s for s in sizes if s not in clamped}
        weight = sum(weights[s] for s in rest)
        left = wanted - sum(clamped.values())
        target = {**clamped, **{s: left * weights[s] / weight if weight else Fraction(0) for s in rest}}
        above = {s for s in rest if target[s] >= epochs * sizes[s]}
        if not above:
            return target
        clamped.update({s: epochs * sizes[s] for s in above})


def brute(rows, weights=None, share=Fraction(3, 2), epochs=2, seed=7):
    by = defaultdict(list)
    for doc, text, source in rows:
        mark = hashlib.md5(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:16]
        by[source].append((mark, doc is not None, doc or 0, words(text)))
    sizes = {s: sum(d[3] for d in docs) for s, docs in by.items()}
    order = sorted(by, key=lambda s: (s is None, (s or "").encode()))
    weights = weights or {s: Fraction((3, 1, 2)[i % 3]) for i, s in enumerate(order)}
    target = levels(sizes, {s: weights.get(s, Fraction(0)) for s in by}, share * sum(sizes.values()), epochs)
    out = []
    for s, docs in by.items():
        wanted = int(target[s] + Fraction(1, 2))
        whole = wanted // sizes[s] if sizes[s] else 0
        left = wanted - whole * sizes[s]
        for _, known, doc, size in sorted(docs):
            some = min(size, left)
            left -= some
            out.append((doc if known else None, size, sizes[s], round(float(target[s]), 6), whole * size + some))
    return Counter(out)


def got(df):
    return Counter((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in df.collect())


def made(seed, n=400):
    rng = random.Random(seed)
    names = ["é", "a", "B", "zz", None, "tiny", "blank", ""]
    rows = []
    for i in range(n):
        source = rng.choices(names, [120, 3, 5, 9, 7, 1, 2, 4])[0]
        text = rng.choice([None, "", " \n"]) if source == "blank" or rng.random() < 0.05 else "\t".join(["wörd\u00a0x"] * int(rng.paretovariate(0.8)))
        rows.append((rng.choice([i, i, i, None, 3]), text, source))
    return [*rows, rows[0], rows[0], (10**9, "long " * 300_000, "zz")]


def test_sizes_targets_and_samples(spark):
    for seed in (1, 2):
        rows = made(seed)
        assert got(M.planned(table(spark, rows))) == brute(rows)


def test_given_weights_shares_and_caps(spark):
    rows = made(3)
    weights = {"é": Fraction(1), "a": Fraction(50), None: Fraction(4), "gone": Fraction(9), "zz": Fraction(0)}
    given = spark.createDataFrame([(s, float(w)) for s, w in weights.items()], "source string, weight double")
    for share, epochs in ((Fraction(1, 2), 3), (Fraction(1), 1), (Fraction(40), 2), (Fraction(0), 2)):
        df = M.planned(table(spark, rows), given, float(share), float(epochs))
        assert got(df) == brute(rows, weights, share, epochs)


def test_sums_meet_targets_and_reruns_agree(spark):
    rows = made(4)
    first, again = (M.planned(table(spark, r)).collect() for r in (rows, rows[::-1]))
    assert Counter(first) == Counter(again)
    taken, target = Counter(), {}
    for r in first:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 2 * r["size"]
    assert all(abs(taken[s] - t) <= 0.5 for s, t in target.items())


def test_repeated_texts_have_the_words_taken(spark):
    rows = [(d, t, s) for d, t, s in made(5) if d is not None]
    plan = M.planned(table(spark, rows), keep=["text"])
    taken = sum(r["taken"] for r in plan.collect())
    out = M.repeated(plan).collect()
    assert sum(words(r["text"]) for r in out) == taken
    texts = {t for _, t, _ in rows if t}
    assert all(r["text"] in texts or any(t.startswith(r["text"]) for t in texts) for r in out)


def test_no_documents_and_no_words(spark):
    assert M.planned(table(spark, [])).collect() == []
    rows = [(1, None, None), (2, "", "a")]
    assert got(M.planned(table(spark, rows))) == Counter([(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)])
