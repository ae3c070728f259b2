"""Quality rules as weak supervision, in DataFrame functions only.

Six rules vote good, vote bad or abstain on every document.  Expectation
maximisation over the counts of vote patterns (at most 3^6 = 729) estimates how
often each rule votes each way on good and on bad documents, and from that each
pattern's probability of being good.  A document is kept if that probability is
at least one half and it passes the two base rules.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, shared_folder, stored

BLANK = r"[\x20\x09-\x0D]+"
#: Rule votes are 0 (bad), 1 (abstain) and 2 (good).
RULES = ("symbols", "word_length", "duplicate_lines", "repeated_words", "line_ends", "capitals")
ITERATIONS = 20
#: Start values and, times WEIGHT, pseudo-counts: shares of bad, abstaining and good votes on bad and on good documents.
START_BAD, START_GOOD, START_PRIOR, WEIGHT = (0.45, 0.15, 0.40), (0.02, 0.18, 0.80), 0.8, 5.0


def _covered(hashes: Column) -> Column:
    """Word positions in 3-word windows that occur twice or more, given all windows' hashes."""

    def sorted_places(places: Column) -> Column:
        last = F.size(places) - 1

        def place(e: Column, i: Column) -> Column:
            twin = ((i > 0) & (places[F.greatest(i - 1, F.lit(0))]["h"] == e["h"])) | ((i < last) & (places[F.least(i + 1, last)]["h"] == e["h"]))
            return F.when(twin, e["p"])

        return let(F.sort_array(F.filter(F.transform(places, place), lambda p: p.isNotNull())), spread)

    def spread(starts: Column) -> Column:
        new = F.transform(starts, lambda p, i: F.when(i == 0, 3).otherwise(F.least(F.lit(3), p - starts[F.greatest(i - 1, F.lit(0))])))
        return F.aggregate(new, F.lit(0), lambda a, x: a + x)

    places = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(let(places, sorted_places))


def _word_figures(words: Column) -> Column:
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))
    repeated = F.when(n < 3, 0).otherwise(let(hashes, _covered))
    return F.struct(n.cast("long").alias("n_words"), repeated.cast("long").alias("n_repeat_words"))


def _line_figures(lines: Column) -> Column:
    ends = F.size(F.filter(lines, lambda x: x.rlike(r"[.!?][\x20\x09-\x0D]*$")))
    return F.struct(F.size(lines).alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"), ends.alias("n_ends"))


def figures(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and what else the rules need.

    A null text counts as empty.
    """
    text = F.coalesce(text.cast("string"), F.lit(""))

    def of(t: Column) -> Column:
        removed = lambda pattern: F.length(F.regexp_replace(t, pattern, ""))
        return F.struct(
            let(F.filter(F.split(t, BLANK), lambda w: w != ""), _word_figures).alias("w"),
            let(F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), _line_figures).alias("l"),
            removed(BLANK).cast("long").alias("word_chars"),
            (F.length(t) - removed(r"[#*$%&|<>]+")).cast("long").alias("n_symbols"),
            (F.length(t) - removed("[A-Z]+")).alias("n_capitals"),
        )

    return let(text, of)


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, 0).when(good, 2).otherwise(1)


def votes(f: Column) -> Column:
    """Number of a document's vote pattern: one base-3 digit a rule, in the order of RULES."""
    words, chars, lines = f["w"]["n_words"], f["word_chars"], f["l"]["n_lines"]
    rules = (
        _vote(10 * f["n_symbols"] > words, 50 * f["n_symbols"] <= words),
        _vote((chars < 3 * words) | (chars > 9 * words), (2 * chars >= 7 * words) & (2 * chars <= 15 * words)),
        _vote(10 * f["l"]["n_dup_lines"] > 3 * lines, (f["l"]["n_dup_lines"] == 0) & (lines >= 2)),
        _vote(10 * f["w"]["n_repeat_words"] > 3 * words, 20 * f["w"]["n_repeat_words"] <= words),
        _vote(2 * f["l"]["n_ends"] < lines, 10 * f["l"]["n_ends"] >= 9 * lines),
        _vote(5 * f["n_capitals"] > chars, 20 * f["n_capitals"] <= chars),
    )
    code = rules[0]
    for rule in rules[1:]:
        code = 3 * code + rule
    return F.when(words == 0, (3 ** len(RULES) - 1) // 2).otherwise(code)


def pattern_probabilities(patterns: DataFrame, iterations: int = ITERATIONS) -> DataFrame:
    """(pattern, p_good) of every vote pattern in ``patterns``, one row per document.

    Class-conditional vote shares and the share of good documents, by
    expectation maximisation with pseudo-counts, all in one row of at most 729
    counts.  No documents: no rows.
    """
    m = len(RULES)
    digits = F.array(*[(F.floor(F.col("pattern") / 3 ** (m - 1 - j)) % 3).cast("int") for j in range(m)])
    counts = patterns.groupBy("pattern").count().select(F.struct(F.col("pattern"), F.col("count").cast("double").alias("n"), digits.alias("v")).alias("x"))
    row = counts.agg(F.array_sort(F.collect_list("x")).alias("xs"))
    indexes = F.sequence(F.lit(0), F.lit(3 * m - 1))
    start = lambda shares: F.array(*[F.lit(float(s)) for s in shares] * m)

    def likelihood(x: Column, shares: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(0), F.lit(m - 1)), F.lit(1.0), lambda a, j: a * shares[3 * j + x["v"][j]])

    def probability(state: Column) -> Callable[[Column], Column]:
        def of(x: Column) -> Column:
            good, bad = state["prior"] * likelihood(x, state["good"]), (1 - state["prior"]) * likelihood(x, state["bad"])
            return good / (good + bad)

        return of

    def step(state: Column, xs: Column) -> Column:
        def maximise(ys: Column) -> Column:
            total = lambda f: F.aggregate(ys, F.lit(0.0), lambda a, y: a + f(y))

            def shares(weight: Callable[[Column], Column], prior: tuple[float, ...]) -> Column:
                pseudo = F.array(*[F.lit(float(s * WEIGHT)) for s in prior] * m)
                return let(total(weight), lambda whole: F.transform(indexes, lambda k: (pseudo[k] + total(lambda y: F.when(y["v"][F.floor(k / 3).cast("int")] == k % 3, weight(y)).otherwise(0.0))) / (WEIGHT + whole)))

            good, bad = (lambda y: y["n"] * y["q"]), (lambda y: y["n"] * (1 - y["q"]))
            prior = (total(good) + WEIGHT * START_PRIOR) / (total(lambda y: y["n"]) + WEIGHT)
            return F.struct(prior.alias("prior"), shares(good, START_GOOD).alias("good"), shares(bad, START_BAD).alias("bad"))

        return let(F.transform(xs, lambda x: F.struct(x["n"].alias("n"), x["v"].alias("v"), probability(state)(x).alias("q"))), maximise)

    def learned(xs: Column) -> Column:
        first = F.struct(F.lit(START_PRIOR).alias("prior"), start(START_GOOD).alias("good"), start(START_BAD).alias("bad"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(iterations)), first, lambda state, _: step(state, xs))

    rated = let(F.col("xs"), lambda xs: let(learned(xs), lambda state: F.transform(xs, lambda x: F.struct(x["pattern"].alias("pattern"), probability(state)(x).alias("p_good")))))
    return row.filter(F.size("xs") > 0).select(F.inline(rated))


def _judged(rows: DataFrame) -> DataFrame:
    """Adds p_good and kept to stored rows with pattern and base_failed; at most 729 rows are broadcast."""
    rates = pattern_probabilities(rows.select("pattern"))
    return rows.join(F.broadcast(rates), "pattern", "left").withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= 0.5))


def _scored(docs: DataFrame, keep: list[Column]) -> DataFrame:
    f = F.col("f")
    base = (f["w"]["n_words"] < 50) | (100 * f["w"]["n_repeat_words"] > 50 * f["w"]["n_words"])
    rows = docs.select(*keep, figures(F.col("text")).alias("f"))
    return rows.select(
        *[F.col(c) for c in rows.columns if c != "f"],
        f["w"]["n_words"].alias("n_words"),
        f["word_chars"].alias("word_chars"),
        f["n_symbols"].alias("n_symbols"),
        f["l"]["n_dup_lines"].alias("n_dup_lines"),
        f["w"]["n_repeat_words"].alias("n_repeat_words"),
        base.alias("base_failed"),
        votes(f).alias("pattern"),
    )


def rate(docs: DataFrame) -> DataFrame:
    """Figures, vote pattern, p_good and kept of every document, with its doc_id.

    Null texts have no words and fail the base rules.  Null or repeated ids and
    repeated rows each get their row.  An empty table gives no rows.
    """
    return _judged(stored(_scored(docs, [F.col("doc_id")]), shared_folder(docs.sparkSession, "quality")))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with their own columns only (whatever their names)."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return _judged(stored(_scored(docs, [row]), shared_folder(docs.sparkSession, "quality"))).filter("kept").select("row.*")


def _sql() -> str:
    m = len(RULES)
    like = lambda name: " * ".join(f"s.{name}[{3 * j + 1} + v[{j + 1}]]" for j in range(m))
    shares = lambda weight, prior: "[" + ", ".join(f"({prior[k % 3] * WEIGHT!r} + sum(CASE WHEN v[{k // 3 + 1}] = {k % 3} THEN {weight} ELSE 0 END)) / ({WEIGHT!r} + sum({weight}))" for k in range(3 * m)) + "]"
    literal = lambda prior: "[" + ", ".join(f"{prior[k % 3]!r}::DOUBLE" for k in range(3 * m)) + "]"
    digits = ", ".join(f"(pattern // {3 ** (m - 1 - j)}) % 3" for j in range(m))
    q = f"s.prior * {like('good')} / (s.prior * {like('good')} + (1 - s.prior) * {like('bad')})"
    return rf"""
WITH RECURSIVE t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
a AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
win AS (SELECT doc_id, p, struct_pack(a := w[p], b := w[p + 1], c := w[p + 2]) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM a WHERE len(w) >= 3)),
rep AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS k FROM win) WHERE k > 1) GROUP BY 1),
f AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
        len(ls) AS n_lines, len(list_filter(ls, lambda x: regexp_matches(x, '[.!?][\x20\x09-\x0D]*$'))) AS n_ends, length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_capitals
      FROM a LEFT JOIN rep USING (doc_id)),
r AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, CASE WHEN n_words = 0 THEN {(3**m - 1) // 2} ELSE
        243 * (CASE WHEN 10 * n_symbols > n_words THEN 0 WHEN 50 * n_symbols <= n_words THEN 2 ELSE 1 END)
      + 81 * (CASE WHEN word_chars < 3 * n_words OR word_chars > 9 * n_words THEN 0 WHEN 2 * word_chars >= 7 * n_words AND 2 * word_chars <= 15 * n_words THEN 2 ELSE 1 END)
      + 27 * (CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN 0 WHEN n_dup_lines = 0 AND n_lines >= 2 THEN 2 ELSE 1 END)
      + 9 * (CASE WHEN 10 * n_repeat_words > 3 * n_words THEN 0 WHEN 20 * n_repeat_words <= n_words THEN 2 ELSE 1 END)
      + 3 * (CASE WHEN 2 * n_ends < n_lines THEN 0 WHEN 10 * n_ends >= 9 * n_lines THEN 2 ELSE 1 END)
      + (CASE WHEN 5 * n_capitals > word_chars THEN 0 WHEN 20 * n_capitals <= word_chars THEN 2 ELSE 1 END) END AS pattern FROM f),
c AS MATERIALIZED (SELECT pattern, CAST(count(*) AS DOUBLE) AS n, [{digits}] AS v FROM r GROUP BY 1),
em AS (
  SELECT 0 AS k, {START_PRIOR!r}::DOUBLE AS prior, {literal(START_GOOD)} AS good, {literal(START_BAD)} AS bad
  UNION ALL
  SELECT k + 1, (sum(n * q) + {WEIGHT * START_PRIOR!r}) / (sum(n) + {WEIGHT!r}), {shares("n * q", START_GOOD)}, {shares("n * (1 - q)", START_BAD)}
  FROM (SELECT s.k, n, v, {q} AS q FROM em s, c WHERE s.k < {ITERATIONS}) GROUP BY k),
rates AS (SELECT pattern, {q} AS p_good FROM c, (SELECT * FROM em WHERE k = {ITERATIONS}) s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND p_good >= 0.5 AS kept FROM r JOIN rates USING (pattern)
"""


SQL = _sql()
