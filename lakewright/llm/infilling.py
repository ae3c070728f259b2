"""Fill-in-middle transformation: texts cut at line ends into prefix, middle and suffix, and put in another order.

A text is n units, each a line with its end or an unfinished last line.  A
pattern made for each row counts them: its possessive groups take the first a
units, the next b - a and the rest, so one match both cuts a text and puts it
together again.  All is done in DataFrame functions, row by row, without a
shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = r"[^\n]*\n|[^\n]+"
#: The same, without a way back into a unit once it is taken.
TAKEN_UNIT = r"(?:[^\n]*+\n|[^\n]++)"
MARKERS = ("<P>", "<S>", "<M>")
#: Where the groups of the match go, by form.
ORDERS = {"psm": "<P>$1<S>$3<M>$2", "spm": "<S>$3<P>$1<M>$2"}


def transformed(docs: DataFrame, seed: int = 7, rate: int = 100, spm_rate: int = 50) -> DataFrame:
    """(doc_id, text, n, form, output) of all documents (doc_id, text, ...).

    Of 100 texts, ``rate`` are cut, and ``spm_rate`` of 100 of those have the
    suffix first.  Numbers come from the SHA-256 of seed and id, so reruns
    agree; repeated rows and rows of one id are cut alike as far as their texts
    allow.  A null id counts as no digits.  Null texts are empty; empty texts
    and texts that hold a marker stay plain.  Other columns are not read.
    """
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), key.alias("key")).withColumn("n", F.regexp_count("text", F.lit(UNIT)).cast("long"))
    h = [F.conv(F.substring("key", 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    marked = F.contains("text", F.lit(MARKERS[0])) | F.contains("text", F.lit(MARKERS[1])) | F.contains("text", F.lit(MARKERS[2]))
    plain = (F.col("text") == "") | marked | (h[2] % 100 >= rate)
    form = F.when(plain, "plain").when(h[3] % 100 < spm_rate, "spm").otherwise("psm")
    cuts = rows.select("doc_id", "text", "n", form.alias("form"), (h[0] % (F.col("n") + 1)).alias("x"), (h[1] % (F.col("n") + 1)).alias("y"))
    a, b = F.least("x", "y"), F.greatest("x", "y")
    pattern = F.concat(F.lit(rf"\A({TAKEN_UNIT}{{"), a, F.lit(rf"}}+)({TAKEN_UNIT}{{"), b - a, F.lit(r"}+)((?s:.*+))\z"))
    order = F.when(F.col("form") == "spm", ORDERS["spm"]).otherwise(ORDERS["psm"])
    output = F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", pattern, order))
    return cuts.select("doc_id", "text", "n", "form", output.alias("output"))


def parts(output: Column, form: Column) -> Column:
    """Struct (prefix, middle, suffix) of an output; null for a plain one.

    A marker starts with ``<`` and no cut text holds one, so a marker's first
    place is where it was put, whatever stands before it.
    """
    pieces = F.split(output, "<[PSM]>")
    at = lambda psm, spm: F.when(form == "spm", F.get(pieces, F.lit(spm))).otherwise(F.get(pieces, F.lit(psm)))
    return F.when(form != "plain", F.struct(at(1, 2).alias("prefix"), at(3, 3).alias("middle"), at(2, 1).alias("suffix")))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    p = parts(output, form)
    return F.when(form == "plain", output).otherwise(F.concat(p["prefix"], p["middle"], p["suffix"]))


def digests(rows: DataFrame) -> DataFrame:
    """Sizes and digests of ``transformed`` documents; the text is rebuilt from output and form alone."""
    cut = rows.select("doc_id", "n", "form", "output", parts(F.col("output"), F.col("form")).alias("p"))
    text = F.when(F.col("form") == "plain", F.col("output")).otherwise(F.concat("p.prefix", "p.middle", "p.suffix"))
    return cut.select(
        "doc_id",
        "n",
        "form",
        F.length("p.prefix").cast("long").alias("prefix_chars"),
        F.length("p.middle").cast("long").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(text, 256).alias("restored_sha256"),
    )


SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS u, [CAST('0x' || h[8 * i + 1 : 8 * i + 8] AS BIGINT) for i in range(4)] AS h FROM t),
c AS (SELECT *, CAST(len(u) AS BIGINT) AS n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a, greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 100 THEN 'plain' WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN concat('<P>', prefix, '<S>', suffix, '<M>', middle) ELSE concat('<S>', suffix, '<P>', prefix, '<M>', middle) END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM p
"""
