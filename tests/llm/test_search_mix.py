"""Exact search, source mixing and licence scans."""

import math
from collections import Counter

import numpy as np
import pytest

from ticketlake.llm import exact_search, license_scan, mixing

VECTORS = "vec_id long, embedding array<float>, score double, rank string"


def test_topk_like_brute_force(spark):
    import random

    rng = random.Random(1)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.1, 1.0]) for _ in range(3)]) for i in range(400)]
    rows += [(400, None), (401, [1.0, None, 2.0]), (402, [float("nan"), 1.0, 1.0]), (403, [float("inf"), 1.0, 1.0])]
    rows += [(404, [1.0, 2.0]), (450, [3.0, 1.0]), (500, []), (None, [1.0, 1.0, 1.0]), (10, [1.0, 1.0, 1.0]), (7, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(i, v, 0.0, "x") for i, v in rows], VECTORS).repartition(5)
    fine = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    # float components are doubled exactly; 0.1 as a float is a little more than 0.1
    expected, asked = [], {}
    for i, q in fine:
        if i % 50 == 0:
            asked.setdefault(i, q)
    for i, q in asked.items():
        best = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in fine if j != i and len(v) == len(q))[:5]
        expected += [(i, n, j, -s) for n, (s, j) in enumerate(best, 1)]
    got = exact_search.exact_topk(df, df.where("vec_id % 50 = 0"), 5)
    assert sorted(map(tuple, got.collect())) == sorted(expected)
    assert exact_search.exact_topk(df.limit(0), df.limit(0), 5).count() == 0


def test_large_components_stay_exact(spark):
    rows = [(0, [2.0**17, 1.0]), (1, [2.0**17, 0.0]), (2, [2.0**17, 1.0]), (3, [1e30, -1e30])]
    df = spark.createDataFrame([(i, v, 0.0, "x") for i, v in rows], VECTORS)
    got = exact_search.exact_topk(df, df.where("vec_id = 0"), 3).collect()
    assert [(r.vec_id, r.score) for r in got if r.vec_id != 3] == [(2, 2**50 + 65536), (1, 2**50)]


def test_components_are_not_cut(spark):
    rows = [(0, [2.0**20, 3.0]), (1, [2.0**21, 1.0]), (2, [-(2.0**21), 1.0]), (3, [1e300, 1e300]), (4, [-1e308, 0.0]), (5, [2.0**30, -(2.0**50)]), (6, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r.score for r in exact_search.exact_topk(df, df.where("vec_id = 0"), 9).collect()}
    most = 2**63 - 1
    assert got == {1: 2**57 + 3 * 2**16, 2: -(2**57) + 3 * 2**16, 3: most, 4: -most, 5: -most, 6: 0}


DOCS = "doc_id long, text string, source string, copy string, licenses string"


def test_mixing(spark):
    rows = [(i, f"t{i}", "big" if i % 10 else "small", "c", "l") for i in range(4000)] + [(None, None, None, "c", "l"), (5, "again", "big", "c", "l")]
    df = spark.createDataFrame(rows, DOCS)
    got = mixing.mix_sources(df, total=6000)
    again = mixing.mix_sources(df.repartition(7), total=6000)
    assert sorted(map(str, got.collect())) == sorted(map(str, again.collect()))
    number = Counter(r.source for r in got.collect())
    # three sources, 2,000 wanted of each; one null document is a source of its own
    assert abs(number["big"] - 2000) < 250 and abs(number["small"] - 2000) < 250 and abs(number[None] - 2000) < 250
    assert got.columns == ["doc_id", "text", "source", "licenses", "copy", "shuffle_key"]
    some = mixing.mix_sources(df, {"small": 1.0}, total=400)
    assert {r.source for r in some.select("source").distinct().collect()} == {"small"} and abs(some.count() - 400) < 100
    assert mixing.mix_sources(df.limit(0)).count() == 0


def test_rates_are_poisson(spark):
    rows = [(i, "t", "s", "c", "l") for i in range(20000)]
    got = mixing.mix_sources(spark.createDataFrame(rows, DOCS), total=30000).groupBy("doc_id").count().groupBy("count").count()
    seen = {r[0]: r[1] for r in got.collect()}
    for k in range(1, 5):
        expected = 20000 * math.exp(-1.5) * 1.5**k / math.factorial(k)
        assert abs(seen[k] - expected) < 5 * math.sqrt(expected)


@pytest.mark.parametrize("kind", ["no id", "one id", "equal rows"])
def test_rows_without_own_ids_draw_apart(spark, kind):
    """30,000 rows without an id, with one id, and with one text too are as many Poisson numbers, whatever the tasks."""
    rows = [(None if kind == "no id" else 7, "t" if kind == "equal rows" else f"t{i // 2}", "s", "c", str(i)) for i in range(30_000)]
    df = spark.createDataFrame(rows, DOCS)
    one = mixing.mix_sources(df.repartition(8), total=30_000)
    seen = {r[0]: r[1] for r in one.groupBy("licenses").count().groupBy("count").count().collect()}
    for k in range(1, 5):
        expected = 30_000 * math.exp(-1) / math.factorial(k)
        assert abs(seen[k] - expected) < 5 * math.sqrt(expected)
    assert one.select("shuffle_key").distinct().count() == one.count()
    two = mixing.mix_sources(df.repartition(3), total=30_000)
    pairs = [sorted(map(tuple, x.groupBy("doc_id", "text", "copy").count().collect()), key=str) for x in (one, two)]
    assert pairs[0] == pairs[1]


def test_null_and_empty_sources_are_two(spark):
    rows = [(i, "t", None if i % 2 else "", "c", "l") for i in range(2000)]
    df = spark.createDataFrame(rows, DOCS)
    assert {r.source for r in mixing.mix_sources(df, {None: 1.0}).select("source").distinct().collect()} == {None}
    assert {r.source for r in mixing.mix_sources(df, {"": 1.0}).select("source").distinct().collect()} == {""}


def test_mixing_moves_the_corpus_once(spark, monkeypatch):
    """The rates are broadcast, however the corpus is dealt: no exchange by source."""
    rows = [(i, f"t{i}", f"s{i % 3}", "c", "l") for i in range(2000)]
    plan = mixing.mix_sources(spark.createDataFrame(rows, DOCS))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_licenses(spark):
    cases = {
        "": (0, "", "", 0),
        None: (0, "", "", 0),
        "Hello there. Released under the MIT License.\nBye": (3, "mit-grant", "MIT", 0),
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n"
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.":
            (3, "bsd-use,bsd-source,bsd-binary", "BSD-2-Clause", 0),
        "You may obtain a copy of the License at\nLicensed under the Apache License, Version 2.0.": (2, "apache-copy,apache-grant", "Apache-2.0", 1),
        "ALL RIGHTS RESERVED!! " + "x y. " * 20000: (20001, "reserved", "all-rights-reserved", 0),
    }
    rows = [(i, t, "s", "c", "clash") for i, t in enumerate(cases)] * 2
    got = license_scan.scan_licenses(spark.createDataFrame(rows, DOCS))
    assert got.count() == 2 * len(cases)
    for r in got.collect():
        assert (r.n_sentences, r.sentence_ids, r.licenses, r.n_unmatched) == cases[r.text]
    assert license_scan.scan_licenses(spark.createDataFrame([], DOCS)).count() == 0


MIT = """MIT License

Copyright (c) 2020 Jo Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD_2 = """Copyright (c) 2020, Jo Doe

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_3 = BSD_2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
APACHE = """Copyright 2020 Jo Doe

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
GPL_3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
GPL_2 = GPL_3.replace("software: you", "software; you").replace("Foundation, either version 3", "Foundation; either version 2")


def test_whole_wrapped_licenses(spark):
    cases = {
        MIT: "MIT", BSD_2 + BSD_END: "BSD-2-Clause", BSD_3 + BSD_END: "BSD-3-Clause", APACHE: "Apache-2.0", GPL_3: "GPL-3.0-or-later", GPL_2: "GPL-2.0-or-later",
        "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0.": "MPL-2.0", "Just\nwrapped text. No notice": "",
    }
    texts = {style(t): name for t, name in cases.items() for style in (str, lambda t: t.replace("\n", "\r\n"), lambda t: "# " + t.rstrip().replace("\n", "\n# "))}
    rows = [(i, t, "s", "c", "clash") for i, t in enumerate(texts)] + [(-1, None, "s", "c", "clash"), (-2, " \n\n\t", "s", "c", "clash")]
    got = license_scan.scan_licenses(spark.createDataFrame(rows, DOCS), wrapped=True)
    assert not any(word in got._jdf.queryExecution().executedPlan().toString() for word in ("Python", "Arrow", "Pandas"))
    for r in got.collect():
        assert r.licenses == texts.get(r.text, ""), r.text
        assert r.doc_id >= 0 or (r.n_sentences, r.sentence_ids, r.n_unmatched) == (0, "", 0)
    parts = {r.licenses: r.sentence_ids for r in got.collect()}
    assert parts["Apache-2.0"] == "apache-grant,apache-compliance,apache-copy" and parts["MIT"].endswith("mit-permission,mit-notice,as-is")


def test_native_plans(spark, sf):
    """No Python on the main path."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for df in (license_scan.scan_licenses(docs), mixing.mix_sources(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_search_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, [float(v) for v in rng.random(4)]) for i in range(300)], "vec_id long, embedding array<double>")
    asked = df.where("vec_id % 20 = 0")
    whole = sorted(map(tuple, exact_search.exact_topk(df, asked, 4).collect()))
    monkeypatch.setattr(exact_search, "BLOCK_BYTES", 300)  # three queries each
    assert sorted(map(tuple, exact_search.exact_topk(df, asked, 4).collect())) == whole
    assert len(whole) == 15 * 4
