"""The pipeline's stages on the small table, each on its own input against brute force."""

import pytest

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.test_shingles import reference
from tests.llm.test_small import contaminated, figures, lines_left


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    now = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SMALL)
        assert out.columns == columns
        rows = out.collect()
        after = {r["doc_id"]: r["text"] for r in rows}
        assert len(after) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in rows)
        if name == "quality rules":
            assert set(after) <= set(now) and not any(figures(t)[5] for t in after.values())
        elif name == "line dedup":
            left = lines_left(list(now.items()))
            assert after == {d: t for d, t in left.items() if t.strip()}
        elif name == "n-gram Jaccard join":
            assert set(after) == {top for _, _, top in reference(list(now.items()))}
        else:
            assert set(after) == {d for d, t in now.items() if not contaminated(t, bench)[4]}
        docs, now = spark.createDataFrame(rows, out.schema), after
    packed = corpus_pipeline.STAGES[4][1](spark, docs, SMALL).collect()
    assert {r["doc_id"] for r in packed} == set(now)
    assert {(r["doc_id"], r["piece"]) for r in packed} == {(r["doc_id"], r["piece"]) for r in corpus_pipeline.run(spark, SMALL).collect()}


PROSE = "The old harbour town had a long history of trade, and its people were proud of the ships that they had built for many years. Every spring the market square was filled with visitors from the villages around, who came to buy cloth and salt and to hear the news of the sea. Nobody knew when the first house was built."
CLASHING = "doc_id long, text string, lang string, source string, n_chars long, row string, lost string, verdict string, version string, line__key string, contamination__verdict string, kept__id string, turn string, label string, key string"


@pytest.fixture(scope="module")
def odd(spark):
    other = PROSE.replace("harbour", "mountain").replace("ships", "mills").replace("sea", "hills").replace("spring", "autumn").replace("first", "last").replace("cloth", "bread").replace("years", "ages")
    texts = [(1, PROSE), (1, PROSE), (1, other), (2, PROSE + "\n" + PROSE), (None, PROSE), (None, None), (3, None), (4, ""), (5, " \n\t"), (6, "one"), (7, "word " * 60_000), (8, other)]
    return spark.createDataFrame([(d, t, "en", "s", len(t or ""), *[f"x{i}"] * 10) for i, (d, t) in enumerate(texts)], CLASHING)


WANTED = {
    "line dedup": lambda rows: {(1, PROSE): 2, (1, "other"): 1, (None, None): 1, (3, None): 1, (4, ""): 1, (5, " \n\t"): 1, (6, "one"): 1, (7, "words"): 1},
    "n-gram Jaccard join": lambda rows: {(1, PROSE): 1, (1, "other"): 1, (None, PROSE): 1, (None, None): 1, (3, None): 1, (4, ""): 1, (5, " \n\t"): 1, (6, "one"): 1, (7, "words"): 1},
    "benchmark decontamination": lambda rows: rows,
}


@pytest.mark.parametrize("name", ["quality rules", "line dedup", "n-gram Jaccard join", "benchmark decontamination"])
def test_stages_on_odd_tables(spark, odd, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, odd, SMALL)
    assert out.columns == odd.columns
    rows = out.collect()
    given = {(r["doc_id"], r["turn"]): r for r in odd.collect()}
    for r in rows:  # all other columns are those of one given row
        assert r.asDict() | {"text": None, "n_chars": None} in [g.asDict() | {"text": None, "n_chars": None} for g in given.values()]
    brief = lambda t: t if t is None or t == PROSE or len(t) < 9 else PROSE + "\n" + PROSE if t == PROSE + "\n" + PROSE else "words" if t.startswith("word ") else "other"
    count = lambda some: {k: sum(1 for r in some if (r["doc_id"], brief(r["text"])) == k) for k in {(r["doc_id"], brief(r["text"])) for r in some}}
    if name in WANTED:
        assert count(rows) == WANTED[name](count(odd.collect()))
    else:
        # of 50 words and more, without repeated ones: the prose, whatever its id and however often
        assert count(rows) == {k: n for k, n in count(odd.collect()).items() if k[1] in (PROSE, "other")}
    assert stage(spark, odd.limit(0), SMALL).collect() == []


def test_packing_of_odd_tables(spark, odd):
    packed = corpus_pipeline.STAGES[4][1](spark, odd, SMALL).collect()
    assert sum(r["doc_id"] == 1 and r["piece"] == 0 for r in packed) == 3 and sum(r["doc_id"] is None for r in packed) == 2
    assert {r["doc_id"] for r in packed} == {None, *range(1, 9)}
    assert corpus_pipeline.STAGES[4][1](spark, odd.limit(0), SMALL).collect() == []
