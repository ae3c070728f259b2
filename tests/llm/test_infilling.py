"""Fill-in-middle against string slices."""

import hashlib
import re

from lakewright.llm import infilling as I

SCHEMA = "doc_id long, text string, n long, form string, key string, output string"
SHA = lambda s: hashlib.sha256(s.encode()).hexdigest()
ODD = [None, "", "\n", "\n\n\n", "a", "a\n", "\na", "a\r\nb\u2028c\n\n", "x <P> y\n", "<S", "ends with <\n<", "<M>", ">\nS>\n<P", "𝒳é\n𝒳", "$1 \\2\n\\E{3}\nx", "\x00\n\x00"]


def table(spark, rows):
    return spark.createDataFrame([(d, t, 9, "clash", "clash", "clash") for d, t in rows], SCHEMA)


def brute(doc, text, seed=7, rate=100, spm_rate=50):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(h[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc, len(units), "plain", None, None, SHA(text), SHA(text), text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    spm = h[3] % 100 < spm_rate
    out = f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"
    return doc, len(units), "spm" if spm else "psm", len(p), len(m), SHA(out), SHA(text), out


def test_texts_against_slices(spark):
    rows = [*[(i, t) for i in range(40) for t in ODD], (None, "no\nid\nat all"), (3, "twice\nhere"), (3, "twice\nhere"), (7, "line\n" * 200_000), (8, "x" * 3_000_000), (9, ("é" * 50 + "\n") * 30_000 + "end"), (-5, "a\nb\nc\n")]
    done = I.transformed(table(spark, rows))
    outputs = done.select("doc_id", "output").collect()
    wanted = [brute(*r) for r in rows]
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r) for r in outputs), key=key) == sorted(((w[0], w[7]) for w in wanted), key=key)
    assert sorted((tuple(r) for r in I.digests(done).collect()), key=key) == sorted((w[:7] for w in wanted), key=key)


def test_rates_and_seeds(spark):
    rows = [(i, f"a{i}\nb\nc\nd") for i in range(300)]
    for seed, rate, spm in ((1, 40, 10), (2, 0, 50), (3, 100, 100)):
        got = {tuple(r) for r in I.transformed(table(spark, rows), seed, rate, spm).select("doc_id", "form", "output").collect()}
        assert got == {(w[0], w[2], w[7]) for w in (brute(*r, seed, rate, spm) for r in rows)}


def test_restored_and_empty(spark):
    from pyspark.sql import functions as F

    done = I.transformed(table(spark, [(i, t) for i in range(30) for t in ODD]))
    assert done.filter(~I.restored(F.col("output"), F.col("form")).eqNullSafe(F.col("text"))).count() == 0
    assert I.digests(I.transformed(table(spark, []))).collect() == []
