"""Operators on small tables against brute force, round trips and edge cases: null and clashing columns, ties, repeats, no rows."""

import functools
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakewright.llm import common, compaction, decontamination, line_dedup, packing, quality, registry, rollups, token_files
from lakewright.plans.manifests import ConcurrentCommit, Manifests

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fill long, pattern string"
ODD = ["", None, " ", "\n", "a", " a", "a  b", "a\n\nb", "a\n\n\nb", "x\n", "\tx", "é é  c", "don't 's", "12 345", "a b  c", "<|endoftext|> x", "word " * 3000, "\x00\x01"]


def table(spark, texts):
    return spark.createDataFrame([(d, t, "en", "s", 0, 7, "clash") for d, t in texts], SCHEMA)


def documents(seed=1, n=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    return [(i, "\n".join(" ".join(rng.choices(words, k=rng.randrange(1, 60))) for _ in range(rng.randrange(1, 6)))) for i in range(n)]


@functools.cache
def tokenizer_of(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def ids_of(name, text, end):
    return np.asarray([*tokenizer_of(name).encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_pieces_and_places(spark):
    rows = [*enumerate(ODD), (None, "null id"), (3, "again"), (3, "again"), *[(100 + i, t) for i, t in documents()]]
    out = packing.pack_documents(table(spark, rows), capacity=64).collect()
    got = sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out)
    wanted = []
    for doc, text in rows:
        ids = ids_of("byte_bpe_50k.json", text, 0)
        start, piece = 0, 0
        while start < len(ids):
            n = (len(ids) % 64 or 64) if not piece else 64
            wanted.append((str(doc), piece, start, n, zlib.crc32(ids[start : start + n].tobytes())))
            start, piece = start + n, piece + 1
    assert got == sorted(wanted)
    bins = defaultdict(list)
    for r in out:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(n for *_, n, _ in wanted)
    assert len(bins) <= 1.1 * total / 64 + 2
    assert packing.pack_documents(table(spark, [])).collect() == []


def test_best_fit_takes_the_fullest_bin():
    bins, offsets = packing.best_fit(np.asarray([5, 6, 3, 4, 2]), 10)
    assert bins.tolist() == [1, 0, 1, 0, 1] and offsets.tolist() == [0, 0, 5, 6, 8]


def test_underfull_bins_merge_over_many_partitions(spark, monkeypatch):
    pieces = spark.range(0, 4000, 1, 40).selectExpr("id AS doc_id", "0 AS piece", "0L AS start", "10L AS length", "0L AS ids_crc32")
    monkeypatch.setattr(packing, "TASK_PIECES", 100)
    out = packing.pack(pieces, capacity=1000, fan_in=4)
    assert out.count() == 4000 and out.select("sequence_id").distinct().count() == 40


def test_the_cut_of_a_table_hardly_matters(spark):
    """Pieces like those of documents, in one partition and in 256."""
    rng = random.Random(8)
    lengths = [min(2048, int(rng.lognormvariate(6.2, 1.1)) + 1) for _ in range(11_500)]
    rows = [(i, 0, 0, n, 0) for i, n in enumerate(lengths)]
    pieces = spark.createDataFrame(rows, packing.PIECE_SCHEMA)
    sequences = [packing.pack(pieces.repartition(k)).select("sequence_id").distinct().count() for k in (1, 256)]
    assert sequences[1] <= 1.005 * sequences[0] and sequences[0] <= 1.002 * sum(lengths) / 2048 + 1


def test_token_files_round_trip(spark):
    rows = [*enumerate(ODD), (None, "null id"), (3, "again"), (3, "again"), *[(100 + i, t) for i, t in documents(2)]]
    out = token_files.token_files(table(spark, rows)).collect()
    start, wanted = 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = ids_of("word_bpe_49k.json", text, 2)
        wanted.append((str(doc), start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted((str(r["doc_id"]), r["start"], r["n_tokens"], r["ids_crc32"]) for r in out) == sorted(wanted)
    assert token_files.token_files(table(spark, [])).collect() == []


def test_unknown_keys_are_not_found(spark):
    folder = common.shared_folder(spark, "test")
    entries = common.stored(token_files.write_shards(table(spark, documents(3)), folder), f"{folder}/entries")
    index = common.stored(token_files.build_index(entries, folder, 3), f"{folder}/index")
    keys = spark.range(-50, 120).selectExpr("id AS doc_id", "0 AS occurrence")
    assert sorted(r["doc_id"] for r in token_files.lookup(keys, index, 3).collect()) == list(range(60))


def test_perfect_hash_is_minimal():
    keys = common.mixed(np.arange(20_000, dtype=np.uint64))
    table_ = token_files.PerfectHash.build(keys)
    assert sorted(table_.slots(keys).tolist()) == list(range(20_000))
    assert sum(len(b) * 64 for b in table_.bits) < 5 * 20_000


def figures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), n < 50 or 100 * len(hit) > 50 * n


def test_quality_figures(spark):
    rows = [*enumerate(ODD), (50, "a b c a b c a b c d"), (51, "a b c x a b c"), (52, "l l l l"), (53, "x | y # <b>\nx\nx\n \ny"), (None, "a b"), (50, "twice"), *[(100 + i, t + "." + t[:80]) for i, t in documents(4)]]
    out = quality.rate(table(spark, rows)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted((str(r["doc_id"]), *[r[c] for c in names]) for r in out) == sorted((str(d), *figures(t)) for d, t in rows)
    assert not any(r["kept"] and r["base_failed"] for r in out)
    assert quality.rate(table(spark, [])).collect() == []


def test_quality_agrees_with_the_labels(spark):
    from tests.conftest import DATA

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rated = quality.rate(docs).join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").filter("n_words >= 50").collect()
    right = sum(r["kept"] == (r["quality"] == 1) for r in rated)
    good = [r for r in rated if r["quality"] == 1]
    assert right >= 0.97 * len(rated)
    assert sum(r["kept"] for r in good) >= 0.98 * len(good)
    kept = quality.kept_documents(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in quality.rate(docs).collect())


def contaminated(text, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, found = split(text), set(), set()
    for name, item in items:
        own = split(item)
        k = min(13, len(own))
        windows = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)} if k else set()
        for p in range(len(words) - k + 1):
            if k and tuple(words[p : p + k]) in windows:
                hit |= set(range(p, p + k))
                found.add(str(name))
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)


@pytest.mark.parametrize("block", [5_000_000, 40])
def test_contamination_equals_brute_force(spark, block):
    rng = random.Random(9)
    words = lambda n, k=40: " ".join(f"v{rng.randrange(k)}" for _ in range(n))
    items = [(1, words(30)), (2, words(13)), (3, words(12)), (4, "alone"), (5, words(20, 2)), (6, ""), (7, None), (1, words(14)), (10, "A-b_c")]
    texts = [words(rng.randrange(1, 80)) for _ in range(30)]
    for _ in range(30):
        part = (rng.choice(items)[1] or "").split()
        a, b = sorted((rng.randrange(len(part) + 1), rng.randrange(len(part) + 1)))
        texts.append(" ".join([words(rng.randrange(60)), *part[a:b], words(rng.randrange(60))]))
    texts += [items[0][1].upper(), items[4][1] * 3, "alone ALONE", "a b-c", *[t or "" for t in ODD]]
    rows = [*enumerate(texts), (None, items[0][1]), (0, "alone")]
    bench = spark.createDataFrame(items + items[:2], "item_id long, text string")
    out = decontamination.contamination(table(spark, rows), bench, "verdict", block)
    assert sorted((str(r["doc_id"]), *r["verdict"]) for r in out.collect()) == sorted((str(d), *contaminated(t, items)) for d, t in rows)
    clean = decontamination.decontaminated(table(spark, rows), bench)
    assert clean.columns == table(spark, []).columns
    assert clean.count() == sum(not contaminated(t, items)[4] for _, t in rows)


def test_contamination_without_benchmark_or_documents(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.decontaminated(table(spark, [(1, "a b")]), bench).count() == 1
    assert decontamination.decontaminated(table(spark, []), bench).count() == 0


def lines_left(rows):
    def shingles(line):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), line))
        return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None

    seen, out = [], {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        left = []
        for line in text.split("\n"):
            s = shingles(line)
            if s is None or not any(100 * len(s & x) >= 80 * len(s | x) for x in seen):
                left.append(line)
            if s is not None:
                seen.append(s)
        out[doc] = "\n".join(left)
    return out


def test_lines_equal_brute_force(spark):
    rng = random.Random(3)
    words = lambda n: [f"u{rng.randrange(900)}" for _ in range(n)]
    base = words(60)
    rows = []
    for i in range(40):
        lines = [" ".join(words(rng.randrange(1, 40))) for _ in range(3)]
        lines.append(" ".join(w if rng.random() > 0.015 else "other" + str(rng.randrange(50)) for w in base))
        lines += rng.sample(["", " ", "Read more", "read  MORE", "one two three four", "all rights are reserved by us"], 3)
        rows.append((i * 37 % 101, "\n".join(lines)))
    rows += [(500, "\n\n"), (501, "solo"), (502, rows[0][1]), (None, "solo\nlast line")]
    out = line_dedup.without_repeats(table(spark, [*rows, (600, None)]))
    assert out.columns == table(spark, []).columns
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got.pop(600) is None and got == lines_left(rows)
    fewer = line_dedup.without_repeats(table(spark, rows), drop_emptied=True)
    assert {r["doc_id"] for r in fewer.collect()} == {d for d, t in lines_left(rows).items() if t.strip() or t == dict(rows)[d]}
    assert line_dedup.without_repeats(table(spark, [])).collect() == []


def test_shuffled_removal_equals_broadcast_removal(spark):
    rows = [(i, "same line here again\n" + t) for i, t in documents(8, 20)]
    one = sorted(map(tuple, line_dedup.without_repeats(table(spark, rows)).collect()))
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, -1)
    try:
        assert sorted(map(tuple, line_dedup.without_repeats(table(spark, rows)).collect())) == one
    finally:
        spark.conf.set(name, before)


def test_store_keeps_rows_through_compaction(spark):
    store = compaction.ShardStore(spark, common.shared_folder(spark, "store"))
    rows = [*enumerate(ODD), (None, None), (1, "a"), (1, "a")]
    for part in (rows[:5], rows[5:], [], rows[:2]):
        store.append(table(spark, part).repartition(3))
    wanted = Counter(map(tuple, table(spark, rows + rows[:2]).collect()))
    assert Counter(map(tuple, store.read().collect())) == wanted
    before = store.version()
    newest = store.compact(target=1 << 20, fan_in=2)
    assert newest > before and len(store.read_manifest()[2]) < len(store.read_manifest(before)[2])
    assert Counter(map(tuple, store.read().collect())) == wanted and store.compact(target=1 << 20, fan_in=2) == newest
    assert Counter(map(tuple, store.read(before).collect())) == wanted  # until it expires
    assert store.expire() > 0 and Counter(map(tuple, store.read().collect())) == wanted
    with pytest.raises(ValueError):
        store.append(spark.range(1))


def test_small_commits_list_their_changes_only(spark, monkeypatch):
    monkeypatch.setattr(compaction, "DELTAS", 6)
    store = compaction.ShardStore(spark, common.shared_folder(spark, "store"))
    store.append(table(spark, documents(1, 400)).repartition(20))
    for i in range(9):
        store.append(table(spark, [(i, "new")]).coalesce(1))
    held = store.manifests.read_all(store.manifests.versions())
    assert [len(m["added"]) for m in held] == [20, 1, 1, 1, 1, 1, 1, 27, 1, 1]
    assert [len(store.read_manifest(v)[2]) for v in range(1, 11)] == list(range(20, 30))
    assert store.expire(keep=2) == 0 and store.manifests.versions() == [8, 9, 10] and store.read().count() == 409
    newest = store.compact(target=1 << 20, fan_in=2)
    assert len(store.read_manifest()[2]) == 1 and store.read(10).count() == store.read().count() == 409
    assert store.expire() == 29 and store.manifests.versions() == [newest] and store.read().count() == 409
    assert store.expire() == 0 and compaction.ShardStore(spark, common.shared_folder(spark, "store")).expire() == 0


def test_appends_that_start_from_one_version_don_t_both_commit(spark, monkeypatch):
    store = compaction.ShardStore(spark, common.shared_folder(spark, "store"))
    store.append(table(spark, [(1, "a")]))
    monkeypatch.setattr(store, "read_manifest", lambda held=store.read_manifest(): held)
    store.append(table(spark, [(2, "b")]))
    with pytest.raises(ConcurrentCommit):
        store.append(table(spark, [(3, "c")]))
    monkeypatch.undo()
    assert sorted(r["doc_id"] for r in store.read().collect()) == [1, 2]


def test_tiers_merge_similar_sizes():
    store = compaction.ShardStore.__new__(compaction.ShardStore)
    shard = lambda name, size: compaction.Shard(name, size, 1)
    shards = [shard(f"s{i}", 10) for i in range(9)] + [shard("m", 50), shard("big", 80)]
    groups = store.plan(shards, target=100, fan_in=4, floor=10)
    assert [[s.name for s in g] for g in groups] == [[f"s{i}" for i in range(9)]]


def test_manifests_commit_once(spark):
    manifests = Manifests(spark, common.shared_folder(spark, "manifests"))
    assert manifests.commit(0, {"x": 1}) == 1
    with pytest.raises(ConcurrentCommit):
        manifests.commit(0, {"x": 2})
    assert manifests.newest() == 1 and manifests.read(1)["x"] == 1


def test_totals_follow_changes_once(spark):
    store = rollups.TokenTotals(spark, common.shared_folder(spark, "totals"))
    kind = "source string, lang string, tokenizer string, change string, tokens long, old_tokens long"
    batch = lambda *rows: spark.createDataFrame(list(rows), kind)
    assert store.totals().collect() == []
    first = batch(("a", "en", "t", "insert", 5, None), ("a", "en", "t", "insert", 7, None), (None, None, "t", "insert", None, None), ("b", "en", "t", "insert", 1, None))
    assert store.commit("w", 1, first) and not store.commit("w", 1, first)
    assert store.commit("v", 1, batch(("a", "en", "t", "revise", 3, 5), ("b", "en", "t", "delete", 1, None)))
    assert store.commit("w", 3, batch()) and store.manifests.read(store.manifests.newest())["writers"]["w"] == [[1, 1], [3, 3]]
    assert sorted(map(tuple, store.totals().collect()), key=str) == sorted([("a", "en", "t", 2, 10), (None, None, "t", 1, 0)], key=str)
    late = batch(("c", "en", "t", "insert", 7, None))
    assert store.commit("w", 2, late) and not store.commit("w", 2, late)
    assert ("c", "en", "t", 1, 7) in set(map(tuple, store.totals().collect()))
    with pytest.raises(Exception, match="unknown change"):
        store.commit("w", 4, batch(("a", "en", "t", "moved", 1, None)))
    assert not store.commit("v", 1, first)
    assert store.manifests.read(store.manifests.newest())["writers"] == {"w": [[1, 3]], "v": [[1, 1]]}


def test_writers_that_start_from_one_version_don_t_both_commit(spark, monkeypatch):
    store = rollups.TokenTotals(spark, common.shared_folder(spark, "totals"))
    batch = spark.createDataFrame([("a", "en", "t", "insert", 5, None)], rollups.CHANGE_SCHEMA)
    monkeypatch.setattr(store, "_state", lambda held=store._state(): held)
    assert store.commit("w", 1, batch)
    with pytest.raises(ConcurrentCommit):
        store.commit("v", 1, batch)
    monkeypatch.undo()
    assert store.commit("v", 1, batch) and [r["tokens"] for r in store.totals().collect()] == [10]


VERSIONS = {"byte_bpe_50k-1": "byte_bpe_50k.json", "word_bpe_49k-1": "word_bpe_49k.json"}


def token_count(vocabulary, text):
    return len(ids_of(vocabulary, text, 0)) - 1


def test_counted_changes_are_the_tokenizers_counts(spark):
    rows = [*enumerate(ODD), (1, "a"), (None, "x y"), *documents(4, 20)]
    texts = table(spark, rows)
    ledger = rollups.counted(texts, texts["text"], ["doc_id", "fill"], entries=40)
    assert Counter(map(tuple, ledger.collect())) == Counter(("s", "en", version, token_count(name, t), d, 7) for d, t in rows for version, name in VERSIONS.items())
    signs = {"insert": (1, 1), "delete": (-1, -1), "revise": (0, 0)}
    for change, made in (("insert", rollups.inserted(ledger)), ("delete", rollups.deleted(ledger)), ("revise", rollups.revised(ledger, ledger))):
        count, sign = signs[change]
        wanted = {("s", "en", version, count * len(rows), sign * sum(token_count(name, t) for _, t in rows)) for version, name in VERSIONS.items()}
        assert set(map(tuple, rollups.signed(made).collect())) == wanted
    assert rollups.counted(table(spark, []), F.col("text")).collect() == []


def test_counts_of_all_vocabularies_at_once():
    names = list(VERSIONS.values())
    counter = common.TokenCounter([(names[0], True), (names[1], False)], entries=50)
    texts = [t or "" for t in ODD] + [t for _, t in documents(7)] + ["a\nb", "\na", "a \nb", "a\n \nb\n", "don't,\n\nx."]
    for some in (texts, texts[:3], [], texts):
        assert counter.count_all(some) == [[token_count(name, t) for t in some] for name in names]


def test_rollups_of_the_given_documents_by_brute_force(spark):
    totals = defaultdict(lambda: [0, 0])
    for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        text = row["text"] or ""
        if len(re.findall(r"[^\x20\x09-\x0D]+", text)) >= 50:
            for version, name in VERSIONS.items():
                total = totals[row["source"], row["lang"], version]
                total[0] += 1
                total[1] += token_count(name, re.sub(r"[#*$%&|<>]", "", text))
    assert sorted(map(tuple, registry.op8_token_rollups(spark, SMALL).collect()), key=str) == sorted(((*k, *v) for k, v in totals.items()), key=str)


@pytest.mark.parametrize("spaces", [True, False])
def test_chunks_give_the_tokenizer_s_own_ids(spaces):
    name = "byte_bpe_50k.json" if spaces else "word_bpe_49k.json"
    encode = common.ChunkTokenizer(public_tokenizers.path(name), spaces, entries=50)
    texts = [t or "" for t in ODD] + [t for _, t in documents(6)]
    for some in (texts, texts[:3], texts):
        wanted = [ids_of(name, t, 0)[:-1].tolist() for t in some]
        assert [np.frombuffer(x, "<u4").tolist() for x in encode.encode_all(some)] == wanted


@pytest.mark.parametrize("spaces", [True, False])
def test_chunks_of_odd_texts_give_the_tokenizer_s_own_ids(spaces):
    name = "byte_bpe_50k.json" if spaces else "word_bpe_49k.json"
    encode = common.ChunkTokenizer(public_tokenizers.path(name), spaces, entries=3000)
    rng = random.Random(11)
    parts = [*"ab  \n\n\t '.,!Z\u00e9\u00df1 9\u6f22\u0301\u0130\u017f\u01c5\u0149\u00b5\u00ba\u2028\u00a0\x1c-%&\r", "<|endoftext|>", "'s", "the", "don't", "<|startoftext|>", "\u212a", "\ufb01"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(15))) for _ in range(8000)]
    for some in (texts[i : i + 500] for i in range(0, len(texts), 500)):
        wanted = [ids_of(name, t, 0)[:-1].tolist() for t in some]
        assert [np.frombuffer(x, "<u4").tolist() for x in encode.encode_all(some)] == wanted


def test_added_tokens_in_texts_are_their_ids(spark):
    texts = ["end <|endoftext|> of", "<|endoftext|>", "a b<|endoftext|>c\n<|startoftext|> d", "plain  text", "x <|ENDOFTEXT|> <|endoftext| > y", "after it"]
    rows = list(enumerate(texts))
    wanted = {}
    for name, spaces, end in (("byte_bpe_50k.json", True, 0), ("word_bpe_49k.json", False, 2)):
        tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        ids = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        encode = common.ChunkTokenizer(public_tokenizers.path(name), spaces)
        assert [np.frombuffer(x, "<u4").tolist() for x in encode.encode_all(texts)] == ids
        wanted[end] = [np.asarray([*x, end], "<u4") for x in ids]
    assert 50256 in wanted[0][0] and 49407 in wanted[2][0]
    packed = packing.pack_documents(table(spark, rows)).collect()
    assert sorted((r["doc_id"], r["length"], r["ids_crc32"]) for r in packed) == [(i, len(x), zlib.crc32(x.tobytes())) for i, x in enumerate(wanted[0])]
    starts = np.cumsum([0, *map(len, wanted[2])]).tolist()
    filed = token_files.token_files(table(spark, rows)).collect()
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in filed) == [(i, starts[i], len(x), zlib.crc32(x.tobytes())) for i, x in enumerate(wanted[2])]


def test_lines_with_tokens_that_agree_in_40_bits_stay(spark):
    """Words found by search: their lines' last tokens have the same low 40 bits and the same bucket of two."""
    seven = "one two three four five six seven"
    rows = [(i, t) for i, t in enumerate(["k3584975", "k792291", "k2414552", "k47124", f"{seven} k1836260", f"{seven} k883337", f"{seven} k345385", f"{seven} k747055"])]
    assert lines_left(rows) == dict(rows)
    assert {r["doc_id"]: r["text"] for r in line_dedup.without_repeats(table(spark, rows)).collect()} == dict(rows)


def test_bins_that_fit_with_none_do_not_meet_in_one_task(spark, monkeypatch):
    monkeypatch.setattr(packing, "TASK_PIECES", 500)
    counts, one_round = [], packing._pack_round
    monkeypatch.setattr(packing, "_pack_round", lambda rows, *a: (counts.append(rows.count()), one_round(rows, *a))[1])
    length = "CASE WHEN id % 400 = 0 THEN 500L WHEN id % 2 = 0 THEN 1300L ELSE 1200L END AS length"
    pieces = spark.range(0, 4000, 1, 8).selectExpr("id AS doc_id", "0 AS piece", "0L AS start", length, "0L AS ids_crc32")
    out = packing.pack(pieces, fan_in=2).groupBy("sequence_id").agg({"length": "sum", "doc_id": "count"}).collect()
    assert sum(r["count(doc_id)"] for r in out) == 4000 and len(out) == 3990 and max(r["sum(length)"] for r in out) <= 2048
    assert counts[0] == 4000 and max([0, *counts[1:]]) <= 400
    # pieces of just over half that find no partner, and one small one in each partition
    small = spark.range(0, 4000, 1, 8).selectExpr("id AS doc_id", "0 AS piece", "0L AS start", "CASE WHEN id % 500 = 0 THEN 900L ELSE 1300L END AS length", "0L AS ids_crc32")
    counts.clear()
    out = packing.pack(small, fan_in=2)
    assert out.count() == 4000 and out.select("sequence_id").distinct().count() == 3996
    assert counts[0] == 4000 and max(counts[1:]) <= 400
