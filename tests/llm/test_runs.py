"""Periodic runs against brute force."""

import random
import re
import zlib

import numpy as np
import pytest

from ticketlake.llm import periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words, shortest, times):
    """Maximal stretches of every distance, smallest period first."""
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(shortest, times * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts(seed):
    rng = random.Random(seed)
    out = []
    for _ in range(40):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += rng.choices("ab" if rng.random() < 0.5 else "abcdefghé", k=rng.randint(0, 12))
            words += rng.choices("abcd", k=rng.randint(1, 9)) * rng.randint(1, 12)
            if rng.random() < 0.4:
                words += words[-rng.randint(1, 30) :] * rng.randint(1, 4)
        out.append(rng.choice([" ", "\n ", "\t"]).join(words))
    fib = ["a", "ab"]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    return [*out, " ".join(fib[-1]), "x " * 500, " ".join("abcabcab" * 40), " y" * 23, "y " * 24, "", " \n ", "one", None]


@pytest.mark.parametrize("seed, shortest, times", [(1, 24, 3), (2, 6, 3), (3, 24, 3), (4, 1, 4)])
def test_runs_like_brute_force(spark, seed, shortest, times):
    rows = [(i, t, "clash") for i, t in enumerate(texts(seed))]
    rows += [(None, rows[3][1], "clash"), rows[5], rows[5]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string").repartition(3)
    got = periodic_runs.collapse_runs(docs, shortest, times).collect()
    expected = []
    for i, text, _ in rows:
        words = WORD.findall(text or "")
        runs = brute_runs(words, shortest, times)
        expected.append((i, len(words), runs, collapsed(words, runs)))
    key = lambda r: (str(r[0]), r[3])
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.text) for r in got), key=key) == sorted(expected, key=key)


def test_enhanced_suffix_array():
    rng = random.Random(5)
    for _ in range(30):
        s = [rng.randint(0, 2) for _ in range(rng.randint(1, 60))] + [9]
        order, place, shared = periodic_runs.suffix_array(np.array(s))
        assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
        assert all(order[place[i]] == i for i in range(len(s)))
        for k in range(1, len(s)):
            a, b = s[order[k - 1] :], s[order[k] :]
            assert shared[k] == next(i for i in range(len(s)) if a[i] != b[i])


def test_a_place_is_tested_in_few_intervals():
    s = np.append(np.random.default_rng(1).integers(0, 2, 4000), 7)
    begin, end, *_ = periodic_runs.smaller_children(periodic_runs.suffix_array(s)[2])
    assert (end - begin + 1).sum() <= len(s) * 12


def test_long_runs(spark):
    """300,000 equal words, and blocks of 70,000 words: one run each."""
    block = [f"w{i}" for i in range(70_000)]
    docs = spark.createDataFrame([(1, "x " * 300_000), (2, " ".join(block * 4))], "doc_id long, text string")
    got = {r.doc_id: r for r in periodic_runs.collapse_runs(docs).collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, 300_000, 1)] and got[1].text == "x"
    assert [tuple(x) for x in got[2].runs] == [(0, 280_000, 70_000)] and got[2].text == " ".join(block)


def test_planted_texts(spark):
    rows = [(i, " ".join(f"w{i}-{j}" for j in range(i % 37))) for i in range(300)] + [(7, None), (None, "a b"), (10, "")]
    got = sorted(map(tuple, periodic_runs.with_planted_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    expected = []
    for i, text in rows:
        words = WORD.findall(text or "")
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text = " ".join(words[j if j < a else a + (j - a) % p] for j in range(n))
        expected.append((i, text))
    assert got == sorted(expected, key=str)


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert periodic_runs.digests(periodic_runs.collapse_runs(docs)).collect() == []
