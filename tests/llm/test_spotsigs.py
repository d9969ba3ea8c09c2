import hashlib
import re

import pytest
from pyspark.sql import functions as F

from llm_fixtures import docs, empty, prepared, texts  # noqa: F401
from quarry.llm import licenses, spotsigs

ANCHORS = set(spotsigs.ANCHORS.split())


def spots(text):
    """The spots of a text, by hand."""
    words = [w for w in re.split(r"[^\w]|_", text.lower()) if w]
    content = [(words[i - 1] if i and words[i - 1] in ANCHORS else None, w)
               for i, w in enumerate(words) if w not in ANCHORS]
    bare = [w for _, w in content]
    chains = [(a, *bare[i:i + spotsigs.CHAIN]) for i, (a, _) in enumerate(content)]
    return {c for c in chains if c[0]} or set(chains)


def test_spots_of_a_text(spark):
    rows = [(0, "At a rally to kick off a weeklong campaign for the South Carolina primary, the end"),
            (1, "no anchors: plain words only"), (2, ""), (3, None), (4, "the of and"), (5, "word"),
            (6, "the  Cat sat, THE cat! sat the cat sat")]
    df = spark.createDataFrame(rows, "id long, text string")
    got = spotsigs.with_signatures(df, "text", "sigs").collect()
    assert [len(r.sigs or []) for r in got] == [len(spots(t or "")) for _, t in rows]


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("parts", ["1", "7"])
def test_against_plain_python(spark, docs, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = spotsigs.compare_edits(docs.withColumn("id", F.lit("clash")).withColumn("sigs", F.lit(0))).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    want = []
    for (doc, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        cut = len(text) // 4
        edited = text[:len(text) - cut] + following[:cut]
        want.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(),
                     round(jaccard(spots(text), spots(edited)), 9), round(jaccard(spots(text), spots(following)), 9)))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9))
                   for r in got), key=str) == sorted(want, key=str)
    by_text = {}
    for r, in zip(sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id or 0))):
        by_text.setdefault((r.doc_id,), set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())


def test_few_documents(spark, empty, docs):
    assert spotsigs.compare_edits(empty).count() == 0
    one = spotsigs.compare_edits(docs.where("doc_id = 9")).first()
    assert one.near_next == 1.0


def test_near_duplicates_against_all_pairs(spark):
    import random
    rng = random.Random(1)
    base = [rng.randrange(10**9) for _ in range(60)]
    sets = [sorted(set(base) - set(rng.sample(base, k)) | {rng.randrange(10**9) for _ in range(k)})
            for k in (0, 0, 1, 2, 3, 5, 8, 12)]
    sets += [sorted(base[:k]) for k in (47, 48, 49, 59)] + [[], [], [1], [1], [1, 2], [5], [2, 3]]
    sets += [sorted({rng.randrange(200) for _ in range(rng.randint(1, 40))}) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(sets)), "id long, sigs array<long>")
    links, members = spotsigs.near_duplicates(df)
    rep = {r.id: r.rep for r in members.collect()}
    low = {}
    for i, s in enumerate(sets):
        if s:
            low.setdefault(tuple(s), i)
    assert rep == {i: low[tuple(s)] for i, s in enumerate(sets) if s}
    want = {(a, b) for x, a in low.items() for y, b in low.items()
            if a < b and jaccard(set(x), set(y)) >= 0.8}
    assert {(min(r.a, r.b), max(r.a, r.b)) for r in links.collect()} == want and len(want) > 5
    assert links.count() == len(want)


def test_next_row_across_ranges_of_hot_ids(spark):
    """A third of the ids are null and a third are one id: their rows are cut
    by the beginnings of their texts, and the next row is that of one sorted list."""
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i * 13 % 400 - 150, f"{i * 7919 % 1000:04d} the text é{i}")
            for i in range(600)] + [(None, ""), (7, ""), (7, ""), (None, "a")]
    df = spark.createDataFrame(rows, "id long, text string").repartition(5)
    cuts = spotsigs._cuts(df, 600)
    sizes = [r["count"] for r in df.groupBy(spotsigs._bucket(cuts).alias("b")).count().collect()]
    assert len(cuts) > 20 and max(sizes) < 40
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    follows = sorted((repr(r), n[1]) for r, n in zip(want, want[1:] + want[:1]))
    got = spotsigs.with_next(df, range_bytes=600)
    assert sorted((repr((r.id, r.text)), r.next_text) for r in got.collect()) == follows
    assert spotsigs._cuts(df.where("id is null"), 600) and spotsigs._cuts(df.limit(0), 600) == []


def test_pruned_by_length(spark):
    df = spark.createDataFrame([([1, 2, 3, 4], [1]), ([1, 2], [1, 2, 3]), ([], [])], "a array<long>, b array<long>")
    got = [r[0] for r in df.select(spotsigs.likeness(F.col("a"), F.col("b"), 0.5)).collect()]
    assert got == [None, pytest.approx(2 / 3), 1.0]


# --- licences

def test_license_sequences(spark, docs, empty):
    rows = [
        (0, "Licensed under the Apache License, Version 2.0.\nSome words. You may not use this file except in "
            "compliance with the License."),
        (1, "released under the MIT license"), (2, None), (3, ""),
        (4, "Licensed under CC BY-NC 4.0.\nReleased under the MIT License."),
        (5, "Not licensed under the Apache License, Version 2.0."),
        (6, "Released under the MIT License. Released under the MIT License."),
        (7, "You may not use this file except in compliance with the License."),
    ]
    got = {r.doc_id: (r.sentence_ids, r.n_rules, r.licenses)
           for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: ("1,2", 1, "Apache-2.0"), 1: ("4", 1, "MIT"), 2: ("", 0, ""), 3: ("", 0, ""),
                   4: ("10,4", 2, "MIT,CC-BY-NC-4.0"), 5: ("", 0, ""), 6: ("4,4", 1, "MIT"), 7: ("2", 0, "")}
    assert licenses.scan(docs.withColumn("ids", F.lit(1)).withColumn("left0", F.lit(1))).count() == docs.count()
    assert licenses.scan(empty).count() == 0


def test_longer_rules_take_their_sentences(spark):
    rules = (("both", (1, 4)), ("a", (1,)), ("m", (4,)))
    df = spark.createDataFrame([(1, "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License.")],
                               "doc_id long, text string")
    assert licenses.scan(df, rules=rules).first().licenses == "both"

WHOLE = {
    "MIT": ("MIT License\n\nCopyright (c) 2011-2024 Jane Q. Example and others\n\nPermission is hereby granted, free of "
            "charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), "
            "to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, "
            "merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the "
            "Software is\nfurnished to do so, subject to the following conditions:\n\nThe above copyright notice and this "
            "permission notice shall be included in all\ncopies or substantial portions of the Software.\n\nTHE SOFTWARE IS "
            "PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO THE "
            "WARRANTIES OF MERCHANTABILITY,\nFITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE\n"
            "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER\nLIABILITY, WHETHER IN AN ACTION OF "
            "CONTRACT, TORT OR OTHERWISE, ARISING FROM,\nOUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
            "DEALINGS IN THE\nSOFTWARE.\n"),
    "BSD-3-Clause": ("// Copyright (c) 1998, Some Lab\n// All rights reserved.\n//\n// Redistribution and use in source and "
                     "binary forms, with or without\n// modification, are permitted provided that the following conditions "
                     "are met:\n//\n// 1. Redistributions of source code must retain the above copyright notice, this\n// list "
                     "of conditions and the following disclaimer.\n// 2. Redistributions in binary form must reproduce the "
                     "above copyright notice,\n// this list of conditions and the following disclaimer in the "
                     "documentation\n// and/or other materials provided with the distribution.\n// 3. Neither the name of the "
                     "University of\n// Somewhere nor the names of its contributors may be used to endorse or promote\n// "
                     "products derived from this software without specific prior written permission.\n//\n// THIS SOFTWARE "
                     "IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\"\n// AND ANY EXPRESS OR IMPLIED "
                     "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE\n// IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS "
                     "FOR A PARTICULAR PURPOSE ARE\n// DISCLAIMED.\nint main() {}\n"),
    "Apache-2.0": ("# Licensed under the Apache License, Version 2.0 (the \"License\");\n# you may not use this file except in "
                   "compliance with the License.\n# You may obtain a copy of the License at\n#\n#     "
                   "http://www.apache.org/licenses/LICENSE-2.0\n#\n# Unless required by applicable law or agreed to in "
                   "writing, software\n# distributed under the License is distributed on an \"AS IS\" BASIS,\n# WITHOUT "
                   "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\n# See the License for the specific "
                   "language governing permissions and\n# limitations under the License.\n\nimport os\n"),
    "MPL-2.0": ("/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the "
                "MPL was not distributed with this\n * file, You can obtain one at http://mozilla.org/MPL/2.0/. */\n"),
    "GPL-3.0-or-later": ("    This program is free software: you can redistribute it and/or modify\n    it under the terms of "
                         "the GNU General Public License as published by\n    the Free Software Foundation, either version 3 "
                         "of the License, or\n    (at your option) any later version.\n\n    This program is distributed in "
                         "the hope that it will be useful,\n"),
    "ISC": "/* SPDX-License-Identifier: ISC */\n",
    "GPL-3.0": "# SPDX-License-Identifier: GPL-3.0\nthe end",
}


def test_whole_licence_texts_in_any_wrapping(spark):
    """Names, years, comment marks and line lengths do not matter; one rule takes the whole text."""
    rows = []
    for k, (name, text) in enumerate(WHOLE.items()):
        words = text.split(" ")
        rows += [(10 * k, name, text), (10 * k + 1, name, "Intro words.\n\n" + text + "\nmore words here."),
                 (10 * k + 2, name, " ".join(text.replace("\n//", "\n").replace("\n#", "\n").split()))
                 if name in ("MIT", "MPL-2.0", "GPL-3.0-or-later") else (10 * k + 2, name, text.upper())]
        assert words
    df = spark.createDataFrame(rows, "doc_id long, name string, text string")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert {i: (got[i].licenses, got[i].n_rules) for i, _, _ in rows if i % 10 != 2} == {
        i: (name, 1) for i, name, _ in rows if i % 10 != 2}
    for i, name, _ in rows:
        assert got[i].licenses == name or (name == "MIT" and i % 10 == 2), got[i]


def test_wrapped_sentences_that_come_to_nothing(spark):
    long = "x" * 600
    rows = [
        (0, "Licensed under the\nApache License,\nVersion 2.0"), (1, "Licensed under the\n\nnothing. All rights\nreserved."),
        (2, "Licensed under\nLicensed under CC BY 4.0"), (3, "Neither the name of " + long + "\nAll rights reserved"),
        (4, "Copyright (c)\n2020 Someone\nAll rights reserved."), (5, "Copyright (c) 2020 Someone. MIT License"),
        (6, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software\nAll rights "
            "reserved"),
    ]
    got = {r.doc_id: r.sentence_ids for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: "1", 1: "12", 2: "11", 3: "12", 4: "52,12", 5: "52,23", 6: "5,12"}


def test_scan_against_its_sql(spark, docs):
    import duckdb
    rows = [(i, t) for i, t in enumerate([*WHOLE.values(), "\n".join(WHOLE.values()), None, "",
                                          *[t[k:] for t in WHOLE.values() for k in (40, 90)]])]
    df = spark.createDataFrame(rows, "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    got = sorted((tuple(r) for r in licenses.scan(df).collect()), key=str)
    documents = df.toPandas()  # noqa: F841
    documents["doc_id"] = documents["doc_id"].astype("Int64")
    want = duckdb.sql(licenses.oracle()).fetchall()
    assert got == sorted(want, key=str)


def test_a_sentence_cannot_begin_with_a_name(spark):
    with pytest.raises(ValueError):
        licenses.sentence_ids(F.lit(""), ("* is free",))
