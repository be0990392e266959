"""Language, toxicity, personal data, benchmark leaks and the pipeline."""

import os
import re
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from ticketlake.llm import decontamination, language_id, pii, toxicity
from ticketlake.llm.common import fold

SF = os.path.join(os.path.dirname(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")), "sf0.01")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, spans string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 1, "clash", "clash") for i, t, lang in rows], DOCS)


# --- language ----------------------------------------------------------------------


def test_language_held_out(spark):
    found = entry.queries()["op7_language_id"](spark, SF)
    rows = found.join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and len(held) > 150
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows) and sum(not r.accepted for r in rows) <= 5


def test_language_edges(spark):
    rows = [(i, "the cat and the dog of the house " * 3, "en") for i in range(20)]
    rows += [(100 + i, "der hund und die katze aus dem haus " * 3, "de") for i in range(20)]
    rows += [(200, None, "en"), (201, "", "de"), (202, "12 %% 3", None), (None, "und der hund", None), (204, "the dog " * 40000, None), rows[0]]
    df = frame(spark, rows)
    model = language_id.train(df)
    got = {r.doc_id: r for r in language_id.identify(df, model).collect()}
    assert [got[i].lang_pred for i in (200, 201, 202)] == ["und"] * 3 and not got[202].accepted and got[202].score == 0
    assert got[None].lang_pred == "de" and got[204].lang_pred == "en" and got[0].accepted
    assert language_id.identify(df, model).count() == len(rows)
    assert language_id.train(df.limit(0)) is None
    assert {r.lang_pred for r in language_id.identify(df, None).collect()} == {"und"}
    assert language_id.identify(df.limit(0), model).count() == 0


def test_scoring_takes_little_memory(spark):
    """A batch of 4 MB of text needs less than 40 MB besides itself, and a text goes to Python once."""
    import tracemalloc

    import pyarrow as pa

    counts = {f"{a}{b}": 3 for a in "abcd" for b in "abcd"} | {a: 9 for a in "abcd"}
    model = language_id._build({lang: counts for lang in "uvwx"}, 2)
    docs = frame(spark, [(1, "ab cd", "u")])
    asked = language_id.identify(docs, model)
    assert "_text" not in asked._jdf.queryExecution().analyzed().toString()
    assert asked.first().text == "ab cd"
    batch = pa.RecordBatch.from_arrays([pa.array(["abcd dcba " * 200] * 2000), pa.array(range(2000))], ["text", "doc_id"])
    tracemalloc.start()
    rows = sum(x.num_rows for x in language_id._predict(model, 0, 2)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 2000 and peak < 40e6


def test_scores_do_not_hang_on_parts(monkeypatch):
    """Texts that are scored one by one get what they get together."""
    import pyarrow as pa

    counts = {f"{a}{b}": 1 + i for i, a in enumerate("abcd") for b in "abcd"} | {a: 9 for a in "abcd"}
    model = language_id._build({"u": counts, "v": {"\0": 3, "\0a": 2, "a": 2, "b": 1}}, 2)
    batch = pa.RecordBatch.from_arrays([pa.array(["abc dab", None, "", "dcba", " b a", "7", "aab"])], ["text"])
    together = pa.Table.from_batches(list(language_id._predict(model, 0, 1)(iter([batch])))).to_pylist()
    monkeypatch.setattr(language_id, "_PART", 1)
    assert pa.Table.from_batches(list(language_id._predict(model, 0, 1)(iter([batch])))).to_pylist() == together


def test_kneser_ney_sums_to_one():
    texts = ["\0abab\0", "\0abc\0", "\0bbca\0"]
    counts = {}
    for t in texts:
        for n in range(1, 4):
            for i in range(len(t) - n + 1):
                counts[t[i : i + n]] = counts.get(t[i : i + n], 0) + 1
    probs, weights = language_id._kneser_ney(counts, 3, 4)
    model = language_id._build({"x": counts}, 3)
    for context in weights[2]:
        total = 0.0
        for c in "\0abc":
            p = probs[2].get(context + c)
            if p is None:
                low = probs[1].get(context[1:] + c)
                if low is None:
                    low = weights[1].get(context[1:], 1.0) * probs[0].get(c, weights[0][""] / 4)
                p = weights[2][context] * low
            total += p
        assert total == pytest.approx(1.0)
    assert model.languages == ["x"]


# --- toxicity ----------------------------------------------------------------------


def test_toxicity_held_out(spark):
    rows = entry.queries()["op5_toxicity"](spark, SF).collect()
    marks = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(r.score, marks[r.doc_id]) for r in rows if r.held_out and r.doc_id in marks]
    bad, good = [s for s, y in held if y], [s for s, y in held if not y]
    wins = sum((b > g) + 0.5 * (b == g) for b in bad for g in good)
    assert wins / (len(bad) * len(good)) > 0.85
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_toxicity_edges(spark):
    rows = [(i, f"you idiot number {i} go away" if i % 3 == 0 else f"a fine day number {i} it is", "en") for i in range(300)]
    rows += [(1000, None, None), (1001, "", None), (None, "you id10t", None), rows[0], (1002, "nice " * 50000, None)]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)] + [(None, 1), (5000, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert got[0] > 0.5 > got[1] and got[1000] == got[1001] and got[1002] < 0.5
    assert toxicity.score(docs, model).count() == len(rows)
    one = toxicity.train(docs, labels.where("toxic = 0"))
    assert {r.score for r in toxicity.score(docs, one).collect()} == {0.0}
    assert toxicity.score(docs, toxicity.train(docs, labels.limit(0))).count() == len(rows)


# --- personal data -----------------------------------------------------------------


def plain_spans(text):
    """The contract's patterns as they stand."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((0, m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((1, m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 12 <= len(d) <= 19 and pii.luhn(d):
            out.append((2, m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((3, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], s[0]))


def test_rules_like_the_patterns(spark):
    import random

    rng = random.Random(1)
    pieces = ["a@b.cc", "@", "x", ".", "-", " ", "+", "1", "4111 1111 1111 1111", "4111-1111-1111-1112", "10.0.0.1", "256.1.1.1", "1.2.3.4.5", "é", "+1 (606) 555-8093", "9" * 30, "a.b+c%@d.e-f", "(", ")"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert pii.base_spans(text) == plain_spans(text), text
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect():
        assert pii.base_spans(r.text) == plain_spans(r.text)


def test_field_carries_an_entity_through_the_document(spark):
    rows = [(i, f"call +1 (606) 555-{8000 + i} or mail u{i}@x.org from 10.0.{i}.7 today {i}", "en") for i in range(200)]
    rows += [(500, None, None), (501, "", None), (502, "nothing here", None), rows[1], (503, "7 " * 30000, None)]
    df = frame(spark, rows)
    field = pii.train(df)
    got = {r.doc_id: r for r in pii.find_pii(df, field, mask=True).collect()}
    assert (got[0].n_email, got[0].n_ip, got[0].n_card, got[0].n_phone) == (1, 1, 0, 1)
    assert got[0].text.startswith("call <phone> or mail <email> from <ip> today") and got[500].text is None
    assert got[501].spans == "" and got[502].n_added == 0 and got[503].n_added == 0
    # a shortened repeat is labelled through its skip link, and only through it
    text = "+1 (606) 555-8093 was called; 555-8093 was busy, 606-555-8093 too, 555-8094 is an order"
    base, every = pii.detect([text, text.replace("+1 (606)", "no")], field)
    added = [[text[a:b] for k, a, b in every[0] if (k, a, b) not in base[0]]]
    assert added == [["555-8093", "606-555-8093"]] and set(base[0]) < set(every[0]) and every[1] == base[1] == []
    without = pii.Field(field.unary, field.chain, np.zeros_like(field.skip))
    base, every = pii.detect([text], without)
    assert every == base
    assert pii.find_pii(df.limit(0), field).count() == 0
    assert not pii.train(df.limit(0)).unary.any()


def test_samples_are_bounded(spark):
    """Rows without an id, or with one id, or copies of one row, are no larger a sample."""
    rows = [(None, f"call +1 (606) 555-{8000 + i % 50}", "en") for i in range(3000)] + [(7, "same text here", "en")] * 2000
    texts = frame(spark, rows)
    pii_rows = texts.where("doc_id is null")
    assert pii.train(pii_rows, sample=40).unary.any()
    picked = language_id.pick(texts.selectExpr("lang", "text", "xxhash64(doc_id, 11) k"), 30, 256, 1 << 20)
    assert picked.count() == 30 and picked.select("text").distinct().count() == 30
    assert language_id.pick(texts.selectExpr("lang", "text", "xxhash64(doc_id, 11) k"), 30, 256, 100).count() < 10
    many = spark.range(3000).selectExpr("concat('l', id) lang", "concat('text ', id) text", "id k")
    assert language_id.pick(many, 5, 20, 1 << 20).select("lang").distinct().count() == 20
    plan = language_id.pick(texts.selectExpr("lang", "text", "xxhash64(doc_id, 11) k"), 30, 256, 1 << 20)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan  # texts are filtered by what was found on hashes


def test_messages_agree_with_enumeration():
    """On a graph without loops the messages are exact."""
    import itertools

    import numpy as np

    rng = np.random.default_rng(3)
    graph = pii.Graph([(0, 0, 1)] * 3, rng.normal(size=(3, pii._FORM)), np.array([[0, 1]]), np.array([[1, 2]]))
    skip = rng.normal(size=(5, 5))
    field = pii.Field(rng.normal(size=(pii._FORM, 5)) * 0.3, rng.normal(size=(5, 5)), skip + skip.T)
    unary, exact = graph.form @ field.unary, np.zeros((3, 5))
    for states in itertools.product(range(5), repeat=3):
        weight = np.exp(sum(unary[i, s] for i, s in enumerate(states)) + field.chain[states[0], states[1]] + field.skip[states[1], states[2]])
        for i, s in enumerate(states):
            exact[i, s] += weight
    assert np.allclose(pii.marginals(graph, field, 60), exact / exact.sum(axis=1, keepdims=True), atol=1e-6)


# --- benchmark ---------------------------------------------------------------------

ITEM = "A train leaves Paris with 120 people and Anna counts 35 bags in 7 hours before the train from Paris meets Anna again"


def test_leaks(spark):
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "Two words"), (5, "some quite ordinary short question about trees and birds"), (5, "x")], "item_id long, text string")
    other = ITEM.replace("Paris", "Rome").replace("Anna", "Tom").replace("120", "90").replace("35", "12")
    broken = ITEM.replace("Paris", "Rome", 1).replace("Anna", "Tom", 1)
    rows = [
        (1, "Well then.\n" + ITEM + " and so on", "en"), (2, other, "en"), (3, ITEM.upper() + "!!", "en"), (4, "an unrelated text of several words " * 5, "en"),
        (5, broken, "en"), (6, None, None), (7, "", None), (8, "so two words here", None), (None, ITEM, None), (1, "a second text", None),
        (9, "Some quite, ordinary short question about trees and birds?", None), (10, "word " * 40000 + ITEM, None),
    ]
    got = {r.doc_id: r for r in decontamination.contamination(frame(spark, rows), items).collect()}
    assert len(got) == 11
    assert (got[1].leaked, got[1].item_id, got[1].kind) == (True, 1, "copy")
    assert (got[2].leaked, got[2].kind) == (True, "reparameterised")
    assert got[3].item_id == 1 and got[10].item_id == 1 and got[9].item_id == 5 and got[8].item_id == 4
    assert not any(got[i].leaked for i in (4, 5, 6, 7, None))
    kept = decontamination.decontaminate(frame(spark, rows), items)
    assert sorted((r.doc_id or -1) for r in kept.select("doc_id").collect()) == [-1, 4, 5, 6, 7]
    assert decontamination.leaks(frame(spark, rows), items.limit(0)).count() == 0
    assert decontamination.contamination(frame(spark, rows).limit(0), items).count() == 0


def test_short_and_slotted_copies_inside_sentences(spark):
    copies = {
        1: "Which planet is known as the red planet", 2: "Who wrote the first novel", 3: "Name two oceans", 4: "12 + 7 = 19",
        5: "Anna, Boris, Carla, Dana, Egon and Frida", 6: "3 5 8 13 21 34 55", 7: "Which city did Anna visit before 1999 with Boris", 8: "Add 3 and 4 and 5 and 6 and 7 and 8 and 9",
    }
    items = spark.createDataFrame(list(copies.items()), "item_id long, text string")
    rows = []
    for i, t in copies.items():
        rows += [(10 * i, f"he said, {t}, and left", "en"), (10 * i + 1, f'the quiz has "{t}" in it', "en"), (10 * i + 2, t.replace(" ", "\n"), "en"), (10 * i + 3, f"so {t.upper()} it is", "en")]
    rows += [(200, "so 12 + 7 = 18 holds", "en"), (201, "and Anna, Boris, Carla, Erik, Gerd and Hanna", "en"), (202, "ask, Where planet is known as the red planet", "en"), (203, "the 3 5 8 13 21 34 56", "en")]
    rows += [(204, "they ask, Which city did Clara visit before 2001 with David", "en")]
    found = {(r.doc_id, r.item_id): (r.share, r.equal) for r in decontamination.leaks(frame(spark, rows), items).collect()}
    for i in copies:
        assert all(found[10 * i + n, i] == (1.0, True) for n in range(4)), i
    assert found.pop((204, 7)) == (1.0, False)
    assert not any(doc >= 200 for doc, _ in found)


def test_copy_behind_many_look_alikes(spark):
    item = "Add 12 to 30 then take 12 from the sum and add 30 once more before you write 12 down"
    alike = [f"Add {i} to {i + 1} then take {i + 2} from the sum and add {i + 3} once more before you write {i + 4} down" for i in range(1000, 1200, 2)]
    copy = item.replace("12 down", "12 neatly down")
    rows = [(1, "\n".join(alike), "en"), (2, "\n".join([*alike, copy]), "en"), (3, "\n".join([*alike[:70], item, *alike[70:]]), "en")]
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = {r.doc_id: r.equal for r in decontamination.leaks(frame(spark, rows), items).collect()}
    assert found == {2: True, 3: True}


def test_leaks_like_brute_force(spark):
    """Items whose words stand in a document in order are found, and no others."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    known = {}
    for item in items:
        w = words(item.text)
        for i in range(len(w) - 4):
            known.setdefault(tuple(w[i : i + 5]), set()).add((item.item_id, i))
    need = {item.item_id: max(1, len(words(item.text)) - 4) for item in items}
    bad = set()
    for d in docs:
        w, hits = words(d.text), {}
        for i in range(len(w) - 4):
            for item, j in known.get(tuple(w[i : i + 5]), ()):
                hits.setdefault(item, set()).add(j)
        if any(len(j) >= 0.9 * need[item] for item, j in hits.items()):
            bad.add(d.doc_id)
    found = entry.queries()["op9_decontamination"](spark, SF)
    assert {r.doc_id for r in found.where("leaked").collect()} == bad and len(bad) > 5


# --- pipeline ----------------------------------------------------------------------


def test_pipeline_stage_by_stage(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, corpus_pipeline.written(stage(spark, kept, sf), f"test-{name}")
        assert kept.columns == docs.columns
        assert kept.join(before, "doc_id", "left_anti").count() == 0
        if name == "near_copies":
            from tests.llm.test_dedup import graph

            rows = [(r.doc_id, r.text) for r in before.collect()]
            assert {r.doc_id for r in kept.collect()} == {c for _, _, c in graph(rows, 5, 80)}
        if name == "personal_data":
            assert kept.count() == before.count()
            assert all(not plain_spans(r.text) and r.n_chars == len(r.text) for r in kept.collect())
    mixed = corpus_pipeline.STAGES[-1][1](spark, kept, sf)
    assert mixed.join(kept, "doc_id", "left_anti").count() == 0 and mixed.count() > 0.5 * kept.count()


def test_pipeline_on_nothing(spark, sf):
    none = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf).count() == 0


def test_folds(spark):
    rows = spark.createDataFrame([(0,), (17,), (None,)], "doc_id long").select(fold(F.col("doc_id"), 5).alias("f")).collect()
    import zlib

    assert [r.f for r in rows] == [zlib.crc32(b"0") % 5, zlib.crc32(b"17") % 5, 0]


def test_entry_without_this_folder():
    code = "import sys; sys.modules['ticketlake.llm'] = None\nimport __spark_entry__ as e\nassert 'gold_category' in e.queries() and 'pipeline' not in e.queries() and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.abspath(entry.__file__)))
