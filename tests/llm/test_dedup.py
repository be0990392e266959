"""Repeated windows and near copies against brute force."""

import hashlib
import pathlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticketlake.llm import common, components, ngram_join, repeats, rlz_dedup, suffix_dedup

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, n_symbols long, kept string"


def corpus(seed, size=40):
    """Random words with shared passages, copies, short, empty, null and periodic texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdéß") for _ in range(rng.randint(1, 6)))
    prose = lambda n: rng.choice([" ", "  ", "\n"]).join(word() for _ in range(n))
    shared = [prose(rng.randint(20, 90)) for _ in range(4)]
    rows = []
    for i in range(size):
        parts = [prose(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            passage = rng.choice(shared)
            cut = rng.randint(0, len(passage) // 2)
            parts += [passage[cut:], prose(rng.randint(0, 40))]
        rows.append((i, " ".join(parts)))
    rows += [(100, None), (101, ""), (102, " \n "), (103, "word"), (104, "ab " * 300), (105, "x" * 700), (106, rows[3][1])]
    rows += [rows[5], rows[5], (None, rows[7][1]), (None, None), (7, "another text for the id " * 12)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(a, b, 5, "clash") for a, b in rows], SCHEMA).repartition(3)


def removed(sequences, depth):
    """Per sequence the set of covered places."""
    starts = Counter(tuple(s[i : i + depth]) for s in sequences for i in range(len(s) - depth + 1))
    out = []
    for s in sequences:
        gone = set()
        for i in range(len(s) - depth + 1):
            if starts[tuple(s[i : i + depth])] > 1:
                gone.update(range(i, i + depth))
        out.append(gone)
    return out


def spans(gone):
    return sum(1 for i in gone if i - 1 not in gone)


@pytest.mark.parametrize("seed, hot", [(1, 4096), (2, 2)])
def test_words_like_brute_force(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = corpus(seed)
    words = [WORD.findall((t or "").encode()) for _, t in rows]
    expected = []
    for (i, _), w, gone in zip(rows, words, removed(words, 9)):
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        expected.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    got = [tuple(r) for r in rlz_dedup.remove_repeats(frame(spark, rows), 9).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert any(r[2] for r in got) and any(r[1] and not r[2] for r in got)


@pytest.mark.parametrize("seed, hot", [(3, 4096), (4, 2)])
def test_bytes_like_brute_force(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = corpus(seed)
    texts = [(t or "").encode() for _, t in rows]
    expected = []
    for (i, _), t, gone in zip(rows, texts, removed(texts, 50)):
        kept = bytes(x for j, x in enumerate(t) if j not in gone)
        expected.append((i, len(t), len(gone), spans(gone), hashlib.sha256(kept).hexdigest()))
    got = [tuple(r) for r in suffix_dedup.remove_repeats(frame(spark, rows), 50).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_removed_ranges_and_text(spark):
    same = " ".join(f"w{i}" for i in range(12))
    out = rlz_dedup.remove_repeats(frame(spark, [(1, "a b " + same + " c"), (2, same)]), 12, digest=False)
    one, two = sorted(out.collect(), key=lambda r: r.doc_id)
    assert one.kept == "a b c" and [tuple(r) for r in one.removed] == [(2, 14)] and one.n_words == 15
    assert two.kept == "" and out.columns == ["doc_id", "text", "n_words", "kept", "removed"]


def test_pieces_of_a_long_text(spark, monkeypatch):
    """Anchors of a text cut into pieces are those of the whole: every window belongs to one row."""
    import numpy as np

    values = np.random.default_rng(5).integers(0, 2**60, 5000).astype(np.uint64)
    _, _, start, n = repeats.anchors(values, np.array([0, 2000, 2000, 5000]), 8, 35)
    assert n.sum() == (2000 - 34) + (3000 - 34)


def test_suffix_array_orders_all_suffixes():
    import numpy as np

    rng = random.Random(6)
    for _ in range(30):
        text = np.frombuffer(bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 200))) + b"\xff", np.uint8)
        eight = suffix_dedup._eight(text)
        wanted = np.ones(len(text), bool)
        wanted[-1] = False
        order = suffix_dedup.suffix_array(text, wanted, 250, eight)
        raw = text.tobytes()
        order = [int(i) for i in order if i < len(raw) - 1]
        assert order == sorted(range(len(raw) - 1), key=lambda i: raw[i:])


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert rlz_dedup.remove_repeats(none).count() == 0
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert ngram_join.components(none).count() == 0


# --- near copies -------------------------------------------------------------------


def near(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(12):
        base = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(rng.choice([2, 5, 30, 120]))]
        for _ in range(rng.randint(1, 7)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 30))):
                copy[rng.randrange(len(copy))] = "new" + str(rng.random())[2:6]
            rows.append((len(rows), rng.choice([" ", "\n", "  "]).join(copy).swapcase()))
    return rows + [(500, None), (501, ""), (502, " \t"), (503, "One"), (504, "one"), rows[2], rows[2], (None, rows[4][1])]


def graph(rows, shingle, percent):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + shingle]) for i in range(len(w) - shingle + 1)} or ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return [(d, len(s), low.get(root(i), d)) for i, ((d, _), s) in enumerate(zip(rows, sets))]


@pytest.mark.parametrize("seed, shingle, percent", [(1, 4, 85), (2, 5, 80), (3, 2, 60)])
def test_components_like_brute_force(spark, seed, shingle, percent):
    rows = near(seed)
    got = ngram_join.components(frame(spark, rows), shingle, percent).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=str) == sorted(graph(rows, shingle, percent), key=str)


def test_bands_hold_every_pair_that_may_link():
    for percent in (50, 80, 85, 100):
        bands = ngram_join.Bands(percent)
        for a in range(1, 120):
            for b in range(a, 200):
                if 100 * a >= percent * b:
                    both = set(bands.domains(a)) & set(bands.domains(b))
                    assert bands.band(a) in both and bands.largest(bands.band(a)) >= b
                    assert bands.differing(a, b) < bands.parts(bands.band(a))


def test_one_of_each_group_stays(spark):
    rows = [r for r in near(4) if r[0] is not None]
    kept = {r.doc_id for r in ngram_join.keep_first(frame(spark, rows), 5, 80).collect()}
    assert kept == {component for _, _, component in graph(rows, 5, 80)}


def test_no_text_moves_for_the_keys_of_copies(spark, monkeypatch):
    """Keys go to the corpus, also where Spark's own limit for that is smaller; with very many of them Spark joins as before."""
    rows = [r for r in near(4) if r[0] is not None]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for sent, joins in ((common.SENT_KEYS, 0), (0, 2)):
            monkeypatch.setattr(common, "SENT_KEYS", sent)
            kept = ngram_join.keep_first(frame(spark, rows), 5, 80)
            plan = kept._jdf.queryExecution().executedPlan().toString()
            assert (plan.count("SortMergeJoin") > 0) == (joins > 0)
            assert {r.doc_id for r in kept.collect()} == {component for _, _, component in graph(rows, 5, 80)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_few_rows_are_few_tasks(spark, monkeypatch, folder):
    """Steps on few shared buckets are not dealt to as many tasks as shuffles have."""
    rows, parts = near(5), {}

    def counted(df, purpose, *args, **named):
        table = common.written(df, purpose, *args, **named)
        parts.setdefault(purpose, []).append(len(list(pathlib.Path(table._scratch.removeprefix("file:")).glob("part-*"))))
        return table

    for module in (ngram_join, components):
        monkeypatch.setattr(module, "written", counted)
    monkeypatch.setattr(ngram_join, "LEAST_TASKS", 3)
    held = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        got = ngram_join.components(frame(spark, rows), 4, 85).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=str) == sorted(graph(rows, 4, 85), key=str)
    for purpose in ("similar", "texts", "links", "least", "large-star", "small-star", "close", "nearest", "labels", "between", "groups"):
        assert parts[purpose] and max(parts[purpose]) <= 3


def test_one_row_of_each_group_stays(spark):
    one, other, third = ("".join(f"{w}{i} " for i in range(40)) for w in "abc")
    rows = [(1, one)] * 50 + [(2, one)] * 3 + [(3, one + "end")]  # the leading row repeats
    rows += [(4, one + "too"), (4, other), (5, other)]  # one id, two texts: a copy and a leader
    rows += [(6, third), (6, third + "x"), (7, third)]  # one id leads with two texts
    rows += [(8, "")] * 2 + [(9, None), (None, other), (10, "quite alone")]
    kept = ngram_join.keep_first(frame(spark, rows), 5, 80)
    assert kept.columns == frame(spark, []).columns
    kept = [(r.doc_id, r.text) for r in kept.collect()]
    sixes = [t for i, t in kept if i == 6]
    assert len(sixes) == 1 and sixes[0] in (third, third + "x")
    rest = [r for r in kept if r[0] != 6]
    assert sorted(rest, key=str) == sorted([(1, one), (4, other), (8, ""), (8, ""), (9, None), (None, other), (10, "quite alone")], key=str)


def test_large_buckets_go_to_bounded_blocks(spark):
    """A bucket of one component and a few strangers: no pair of blocks is large, and each pair meets once."""
    n, strangers = 4000, 3
    labels = [7] * (n - strangers) + [1000 + i for i in range(strangers)]
    rows = [(5, i, labels[i], bytes(64), n, 7, n - strangers) for i in range(n)]
    df = spark.createDataFrame(rows, "k long, cls long, label long, sketch binary, members long, top long, topped long")
    dealt = ngram_join._blocks(df, 256 << 10).drop("sketch").collect()
    groups = {}
    for r in dealt:
        groups.setdefault((r.p, r.q), []).append((r.cls, r.side))
    assert len(groups) > 10 and max(map(len, groups.values())) < 400  # all 4,000 in one before
    assert len(dealt) < n + strangers * (len(groups) + 1)
    met = [(a, b) for g in groups.values() for a, s in g if s & 1 for b, t in g if t & 2 and a != b]
    assert len(met) == len(set(met)) and set(met) == {(a, b) for a in range(n - strangers, n) for b in range(n) if a != b}


@pytest.mark.parametrize("block", [1 << 10, 5 << 10, 4 << 20])
def test_components_from_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "FEW", 1)
    monkeypatch.setattr(ngram_join, "BLOCK_BYTES", block)
    monkeypatch.setattr(ngram_join, "_HELD_ROWS", 3)
    rows = near(2)
    got = ngram_join.components(frame(spark, rows), 5, 80).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=str) == sorted(graph(rows, 5, 80), key=str)


def test_linked_sets_share_enough_keys():
    rng = np.random.default_rng(7)
    for percent in (50, 80, 85, 100):
        bands = ngram_join.Bands(percent)
        for size in [1, 2, 3, 5, 8, 13, 20, 30, 40, 60, 90, 140, 300] * 6:
            x = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
            gone = int(rng.integers(0, size + 1))
            y = np.unique(np.concatenate((x[gone:], rng.integers(0, 2**63, int(rng.integers(0, size + 1))).astype(np.uint64))))
            both = len(np.intersect1d(x, y))
            if not len(y) or 100 * both < percent * (len(x) + len(y) - both):
                y = x[: max(1, -(-size * percent // 100))]  # as few as are linked
            domains = set(bands.domains(len(x))) & set(bands.domains(len(y)))
            assert domains
            for d in domains:
                sides = [(ngram_join.part_keys(s, d, bands.parts(d), bands.spare(d)), ngram_join.keys_shared(s, bands.parts(d), bands.spare(d))) for s in (x, y)]
                assert len(np.intersect1d(sides[0][0], sides[1][0])) >= min(sides[0][1], sides[1][1])


@pytest.mark.parametrize("text", ["x" * 200_000, "= " * 100_000, ("-" * 300 + "\n" + "key: value, " * 60) * 200])
def test_runs_are_shipped_once(text):
    """Runs of one byte, of a short period, and rules in records: at most four bytes go out for each."""
    data = np.frombuffer(text.encode(), np.uint8)
    hashes, _, start, n, places = repeats.anchors(repeats.byte_values(data), np.array([0, len(data)]), 32, 200)
    assert (n + 199).sum() <= 4 * len(data) and n.max() <= repeats.LONGEST
    # all windows are there, each once
    assert n.sum() == len(data) - 199 and (np.sort(start)[1:] > np.sort(start)[:-1]).all()
    assert all(places[hashes == h].sum() > 1 for h in np.unique(hashes)[:50])


@pytest.mark.parametrize("hot", [1 << 20, 5000])
def test_long_runs_like_brute_force(spark, monkeypatch, hot):
    """Runs of 100,000 bytes and words, alone and in several texts, among texts that share nothing."""
    monkeypatch.setattr(repeats, "HOT_SYMBOLS", hot)
    rng = random.Random(3)
    alone = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    texts = ["x" * 100_000, "q" * 199, "= " * 50_000, "y" * 300 + alone, alone[:1500] + "y" * 250, "z" * 200, "z" * 201]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(2)
    for remove, sequences, depth, join in (
        (suffix_dedup.remove_repeats, [list(t.encode()) for t in texts], 200, bytes),
        (rlz_dedup.remove_repeats, [WORD.findall(t.encode()) for t in texts], 35, b" ".join),
    ):
        got = {r.doc_id: (r[2], r.kept_sha256) for r in remove(docs).collect()}
        for i, gone in enumerate(removed(sequences, depth)):
            kept = join([s for j, s in enumerate(sequences[i]) if j not in gone])
            assert got[i] == (len(gone), hashlib.sha256(kept).hexdigest())


def test_factors_decide_what_is_looked_up(monkeypatch):
    """Windows inside long factors are not looked up; with factors of one word all others are. The classes are the same."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abc") for _ in range(3))
    shared = [word() for _ in range(200)]
    texts = [" ".join([word() for _ in range(30)] + shared[10 * i : 10 * i + 120] + [word() for _ in range(40)]) for i in range(6)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    bounds = np.cumsum([0, *[len(t) for t in texts]])
    windows = np.array([len(t.split()) - 34 for t in texts])
    looked, given = [], rlz_dedup.inside_factors
    monkeypatch.setattr(rlz_dedup, "inside_factors", lambda *a: looked.append(given(*a)[1].sum()) or given(*a))

    def partition(classes):
        return [np.flatnonzero(classes == c).tolist() for c in dict.fromkeys(classes.tolist())]

    one = partition(rlz_dedup.solver(35)(data, bounds, windows))
    monkeypatch.setattr(rlz_dedup, "parse", lambda best, same, other, firsts, windows, depth: (firsts, np.ones(len(firsts), np.int64)))
    two = partition(rlz_dedup.solver(35)(data, bounds, windows))
    assert one == two and any(len(c) > 1 for c in one)
    assert looked[0] < looked[1] - 300 and looked[1] == windows.sum() - len(windows)


def test_join_keys_are_dealt_to_as_many_tasks_as_there_are_keys_for(spark):
    """A task sorts a bounded number of keys, also where shuffles have few partitions; few keys are not dealt to more tasks."""
    bands = ngram_join.Bands(80)
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(10 + i))) for i in range(40)], "key long, text string")
    rows = docs.selectExpr("key", "text", "key as doc_id")
    sets = rows.mapInArrow(ngram_join._sets(5, 0, bands), ngram_join._SETS)
    signs = rows.mapInArrow(ngram_join._signatures(5, 0, bands), "k long, cls long, domain int").localCheckpoint()
    dealt = ngram_join._dealt_keys(signs, sets, bands, most=30)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert sum(sizes) == signs.count() and len(sizes) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(sizes) < 3 * 30
    assert dealt.select("k", F.spark_partition_id().alias("task")).distinct().groupBy("k").count().where("count > 1").isEmpty()
    few = ngram_join._dealt_keys(signs, sets, bands)
    assert few.rdd.getNumPartitions() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
