"""Removal of lines that repeat an earlier line, exactly or nearly.

An exact set-similarity join.  A line's tokens are its 5-word shingles (a
shorter line is one token).  Tokens are ordered by rarity; two lines with a
Jaccard similarity of 0.8 or more share a token of their prefixes.  Candidates
pass a length filter and a positional filter before the sets are compared.  A
line goes if any earlier line matches it, whether that one stays or not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, shared_folder, stored
from .shingles import DEN, NUM, Similar, posted, text_version
from .similarity import salt, to_all_salts, verified


def _near_repeats(similar: Similar, folder: str) -> DataFrame:
    """Keys (a) of line sets that match a set whose first line is earlier.

    First every set meets the earliest set that shares a prefix token with it;
    in a large group of near copies that settles most of them.  Then the rest
    meet all earlier candidates.
    """
    postings = posted(similar.found.join(similar.firsts.select("key", "first"), "key"), "key", "first")
    postings = stored(postings.withColumn("salt", salt(F.col("key"), F.col("salts"))), f"{folder}/postings")
    on = ["token", "salt"]
    hubs = postings.groupBy("token").agg(F.first("salts").alias("salts"), F.min_by("key", "first").alias("b"), F.min("first").alias("b_first"))
    met = postings.drop("salts").join(to_all_salts(hubs), on).filter("b_first < first").groupBy(F.col("key").alias("a"), "b").count()
    star = stored(met.groupBy("a").agg(F.max_by("b", F.struct("count", "b")).alias("b")), f"{folder}/star")
    settled = stored(verified(star, similar.sets, NUM, DEN).select("a").distinct(), f"{folder}/settled")
    open_ = to_all_salts(postings.drop("salt").join(settled, postings["key"] == settled["a"], "left_anti"))
    earlier = postings.select("token", "salt", F.col("key").alias("b"), F.col("n").alias("nb"), F.col("first").alias("b_first"), F.col("at").alias("b_at"))
    # from the first common token on, no more can be common than what is left of either set
    most = F.least(F.col("n") - F.col("at"), F.col("nb") - F.col("b_at"))
    alike = (F.col("b_first") < F.col("first")) & (DEN * F.least("n", "nb") >= NUM * F.greatest("n", "nb")) & ((DEN + NUM) * most >= NUM * (F.col("n") + F.col("nb")))
    pairs = open_.join(earlier, on).filter(alike).select(F.col("key").alias("a"), "b").distinct().join(star, ["a", "b"], "left_anti")
    rest = verified(stored(pairs, f"{folder}/pairs"), similar.sets, NUM, DEN).select("a").distinct()
    return settled.union(stored(rest, f"{folder}/rest")).distinct()


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, version, lines) of all documents with lines to remove; line numbers are from 0.

    ``version`` is the hash of the text that ``text_version`` gives.  Lines are
    in order of ids (null last), then of the versions of one id, then of their
    numbers.  Rows with the same id and text are one document.  Lines without
    words never repeat.
    """
    folder = shared_folder(docs.sparkSession, "lines")
    similar = Similar(docs, folder, lines=True)
    near = _near_repeats(similar, folder)
    # only keys that lose a line: those with a later place, and those that match an earlier key
    marks = similar.firsts.join(near.withColumn("near", F.lit(True)).withColumnRenamed("a", "key"), "key", "left").filter("near OR last > first").select("key", F.when(F.col("near").isNull(), F.col("first")).alias("stays"))
    gone = similar.places.join(stored(marks, f"{folder}/marks"), "key").filter("stays IS NULL OR place > stays")
    lost = gone.groupBy(F.col("place.doc_id").alias("doc_id"), F.col("place.version").alias("version")).agg(F.collect_set("place.line").alias("lines"))
    return stored(lost, f"{folder}/lost")


def _marked(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` as a struct ``row``, with the numbers of its lines to remove in ``lost``; null where none are."""
    lost = repeated_lines(docs).select(F.col("doc_id").alias("lost_id"), F.col("version").alias("lost_version"), F.col("lines").alias("lost"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(whole.alias("row"), F.col("doc_id").cast("long").alias("id"), text_version(F.col("text").cast("string")).alias("version"))
    return keyed.join(lost, F.col("id").eqNullSafe(F.col("lost_id")) & (F.col("version") == F.col("lost_version")), "left").select("row", "lost")


def _remaining(text: Column, lost: Column) -> Column:
    stay = F.array_except(F.sequence(F.lit(0), F.size(F.split(text, "\n")) - 1), lost)
    return F.when(lost.isNull(), text).otherwise(let(F.split(text, "\n"), lambda lines: F.array_join(F.transform(F.array_sort(stay), lambda i: lines[i]), "\n")))


def without_repeats(docs: DataFrame, drop_emptied: bool = False) -> DataFrame:
    """``docs`` without repeated lines in ``text``; the columns stay, whatever their names, and so does their order.

    With ``drop_emptied`` documents go of which no line with words is left.
    Null and empty texts stay as they are.  An empty table gives no rows.
    """
    out = _marked(docs).select("row", "lost", _remaining(F.col("row.text").cast("string"), F.col("lost")).alias("left"))
    if drop_emptied:
        out = out.filter(F.col("lost").isNull() | F.col("left").rlike(r"[^\x20\x09-\x0D]"))
    return out.select(*[F.col("left").alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_removed, text_sha256) of every row; a null text has no lines and the digest of an empty text.

    Null ids and repeated rows keep their rows.  Other columns are not read.
    An empty table gives no rows.
    """
    text, lost = F.col("row.text").cast("string"), F.col("lost")
    return _marked(docs.select("doc_id", "text")).select(
        F.col("row.doc_id").alias("doc_id"),
        F.coalesce(F.size(F.split(text, "\n")).cast("long"), F.lit(0)).alias("n_lines"),
        F.coalesce(F.size(lost).cast("long"), F.lit(0)).alias("n_removed"),
        F.sha2(F.encode(F.coalesce(_remaining(text, lost), F.lit("")), "UTF-8"), 256).alias("text_sha256"),
    )


SQL = r"""
WITH l AS (SELECT doc_id, unnest(range(len(ls))) AS i, unnest(ls) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)),
w AS (SELECT doc_id, i, line, regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM l),
s AS (SELECT doc_id, i, row_number() OVER (ORDER BY doc_id, i) AS pos, list_sort(list_distinct(list_transform(range(1, greatest(2, len(w) - 3)), lambda p: array_to_string(w[p:p + 4], ' ')))) AS s FROM w WHERE len(w) > 0),
k AS (SELECT s, min(pos) AS first FROM s GROUP BY s),
t AS (SELECT first, len(s) AS n, unnest(s) AS token FROM k),
near AS (SELECT DISTINCT a FROM (SELECT x.first AS a, y.first AS b, x.n AS nx, y.n AS ny, count(*) AS c FROM t x JOIN t y ON x.token = y.token AND y.first < x.first GROUP BY ALL) WHERE 100 * c >= 80 * (nx + ny - c)),
gone AS (SELECT doc_id, i FROM s JOIN k USING (s) LEFT JOIN near ON near.a = k.first WHERE near.a IS NOT NULL OR pos > first),
kept AS (SELECT l.doc_id, count(*) AS n_lines, count(gone.i) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (WHERE gone.i IS NULL), '') AS text FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.i = gone.i GROUP BY l.doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS text_sha256 FROM documents LEFT JOIN kept USING (doc_id)
"""
