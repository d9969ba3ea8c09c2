"""License scan by sentence rules, in DataFrame functions only.

A text is cut into fragments (at line ends, and at ``.``, ``!`` or ``?``
followed by white space); a fragment is normalised to lower-case ASCII words.
Known sentences have identifiers, so a document becomes the sequence of the
identifiers it holds, in order (other sentences do not interrupt it).  A sentence may
be wrapped over any number of lines: fragments are joined for as long as a known
sentence begins with them, and the longest known one counts; a known sentence that
starts inside a joined run which came to nothing is not looked for again.  A
sentence may hold one ``*`` after its first word, which stands for a name or years of at most ``NAME``
characters (at its end, for the rest of the fragment).

The rules are ordered: each is a sequence of identifiers and names a licence; a rule
matches where its whole sequence stands in the document's, and takes those
sentences, so that shorter rules after it do not match them again.  All rules are
one constant array that a single expression folds over, for texts that hold a
known sentence only.

Defined results: null and empty texts have no sentences and no licence;
repeated rows give a row each; rows without an id are scanned; other columns
are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import read

# Known licence sentences as they are printed; the position is the
# sentence's identifier, counted from 1.
SENTENCES = (
    "Licensed under the Apache License, Version 2.0",
    "you may not use this file except in compliance with the License",
    "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "Released under the MIT License",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "The above copyright notice and this permission notice shall be included in all copies",
    "The software is provided \"as is\", without warranty of any kind",
    "This work is licensed under the GNU General Public License, version 3",
    "This program is free software; you can redistribute it and/or modify it under the terms of the "
    "GNU General Public License",
    "Licensed under CC BY-NC 4.0",
    "Licensed under CC BY 4.0",
    "All rights reserved",
    # 13: Apache
    "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
    "compliance with the License",
    "The ASF licenses this file to you under the Apache License, Version 2.0 (the \"License\")",
    "Unless required by applicable law or agreed to in writing, software distributed under the License is "
    "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "See the License for the specific language governing permissions and limitations under the License",
    "Apache License Version 2.0, January 2004",
    # 19: MIT
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
    "of the Software",
    "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited "
    "to the warranties of merchantability, fitness for a particular purpose and noninfringement",
    "In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether "
    "in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use "
    "or other dealings in the software",
    "MIT License",
    "The MIT License (MIT)",
    # 25: BSD
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution",
    "Neither the name of * nor the names of its contributors may be used to endorse or promote products derived "
    "from this software without specific prior written permission",
    "This software is provided by * \"as is\" and any express or implied warranties, including, but not limited to, "
    "the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    # 30: ISC, 0BSD
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted",
    "The software is provided \"as is\" and the author disclaims all warranties with regard to this software "
    "including all implied warranties of merchantability and fitness",
    # 33: zlib, Unlicense, Boost
    "This software is provided 'as-is', without any express or implied warranty",
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
    "alter it and redistribute it freely, subject to the following restrictions",
    "This is free and unencumbered software released into the public domain",
    "Distributed under the Boost Software License, Version 1.0",
    # 37: Mozilla
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
    # 39: GNU
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
    "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
    "version",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
    "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
    "version",
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
    "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
    "any later version",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
    "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
    "later version",
    "GNU General Public License Version 3, 29 June 2007",
    "GNU General Public License Version 2, June 1991",
    "GNU Lesser General Public License Version 2.1, February 1999",
    "GNU Lesser General Public License Version 3, 29 June 2007",
    "GNU Affero General Public License Version 3, 19 November 2007",
    # 48: Creative Commons, copyright lines
    "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "CC0 1.0 Universal",
    "Copyright (c) *",
)

# The rules, in the order in which they are tried.
RULES = (
    ("Apache-2.0", (13, 2, 3, 16, 17)),
    ("Apache-2.0", (14, 3, 16, 17)),
    ("Apache-2.0", (15, 2, 3, 16, 17)),
    ("MIT", (23, 52, 19, 20, 21, 22)),
    ("MIT", (24, 52, 19, 20, 21, 22)),
    ("MIT", (19, 20, 21, 22)),
    ("BSD-3-Clause", (12, 25, 26, 27, 28, 29)),
    ("BSD-3-Clause", (25, 26, 27, 28, 29)),
    ("BSD-2-Clause", (12, 25, 26, 27, 29)),
    ("BSD-2-Clause", (25, 26, 27, 29)),
    ("Apache-2.0", (1, 2, 3)),
    ("Apache-2.0", (1, 2)),
    ("MIT", (5, 6, 7)),
    ("MIT", (4, 7)),
    ("ISC", (30, 32)),
    ("0BSD", (31, 32)),
    ("Zlib", (33, 34)),
    ("MPL-2.0", (37, 38)),
    ("Apache-2.0", (1,)),
    ("MIT", (4,)),
    ("MIT", (5,)),
    ("GPL-3.0", (8,)),
    ("GPL", (9,)),
    ("CC-BY-NC-4.0", (10,)),
    ("CC-BY-4.0", (11,)),
    ("Apache-2.0", (13,)),
    ("Apache-2.0", (14,)),
    ("Apache-2.0", (15,)),
    ("Apache-2.0", (18,)),
    ("MIT", (19,)),
    ("MIT", (23,)),
    ("MIT", (24,)),
    ("ISC", (30,)),
    ("0BSD", (31,)),
    ("Zlib", (34,)),
    ("Unlicense", (35,)),
    ("BSL-1.0", (36,)),
    ("MPL-2.0", (37,)),
    ("GPL-3.0-or-later", (39,)),
    ("GPL-2.0-or-later", (40,)),
    ("LGPL-2.1-or-later", (41,)),
    ("AGPL-3.0-or-later", (42,)),
    ("GPL-3.0", (43,)),
    ("GPL-2.0", (44,)),
    ("LGPL-2.1", (45,)),
    ("LGPL-3.0", (46,)),
    ("AGPL-3.0", (47,)),
    ("CC-BY-4.0", (48,)),
    ("CC-BY-SA-4.0", (49,)),
    ("CC-BY-NC-4.0", (50,)),
    ("CC0-1.0", (51,)),
    ("Proprietary", (12,)),
)

# every licence that a rule names may be stated by its short name
_STATED = tuple(dict.fromkeys(name for name, _ in RULES if name not in ("GPL", "Proprietary")))
RULES += tuple((name, (len(SENTENCES) + k,)) for k, name in enumerate(_STATED, 1))
SENTENCES += tuple(f"SPDX-License-Identifier: {name}" for name in _STATED)

CUT = r"\n|[.!?]+[ \t\r\n]+"
#: Characters that a ``*`` inside a sentence stands for, at most (while the rest of the
#: sentence is still to come, its length is allowed as well).
NAME = 200


def normal(sentence: str) -> str:
    """Lower-case ASCII words, as the scan makes them of a text."""
    return re.sub("[^A-Za-z0-9]+", " ", sentence).strip().lower()


def _known(sentences: tuple[str, ...]) -> tuple[list[str], list[tuple[int, str, str]], str]:
    """The plain sentences, each at its identifier; (identifier, beginning, end) of
    those with a ``*``; and what a joined run of fragments has to begin."""
    plain = ["" if "*" in s else normal(s) for s in sentences]
    wild = [(i, *map(normal, s.split("*"))) for i, s in enumerate(sentences, 1) if "*" in s]
    if not all(begin for _, begin, _ in wild):
        raise ValueError("a sentence cannot begin with *")
    return plain, wild, "".join(f"|{s}" for s in plain if s) + "".join(f"|{b} " for _, b, _ in wild) + "|"


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value made once."""
    return F.transform(F.array(value), use)[0]


def sentence_ids(text: Column, sentences: tuple[str, ...] = SENTENCES) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    plain, wild, begins = _known(sentences)
    cut = F.split(F.coalesce(text, F.lit("")), CUT)
    fragments = F.filter(F.transform(
        cut, lambda s: F.lower(F.trim(F.regexp_replace(s, "[^A-Za-z0-9]+", " ")))), lambda s: s != "")

    def looked_up(run: Column) -> Column:
        """The run, its identifier (0: none), and whether a longer one may be known."""
        found = F.array_position(F.array(*[F.lit(s) for s in plain]), run).cast("int")
        more = F.contains(F.lit(begins), F.concat(F.lit("|"), run, F.lit(" ")))
        for i, begin, end in wild:
            inside = F.startswith(run, F.lit(begin + " ")) & (F.length(run) <= len(begin) + len(end) + NAME)
            found = F.when(inside & F.endswith(run, F.lit(" " + end)) if end
                           else F.startswith(run, F.lit(begin + " ")), F.lit(i)).otherwise(found)
            if end:
                more = more | inside & ~F.endswith(run, F.lit(" " + end))
        return F.struct(run.alias("run"), found.alias("id"), more.alias("more"))

    def step(state: Column, fragment: Column) -> Column:
        fresh = state["run"] == ""
        joined = looked_up(F.when(fresh, fragment).otherwise(F.concat(state["run"], F.lit(" "), fragment)))
        none = F.array().cast("array<int>")

        def after(long: Column) -> Column:
            goes_on = ~fresh & ((long["id"] > 0) | long["more"])
            own = F.when(fresh | goes_on, long).otherwise(looked_up(fragment))
            # a run that ends here leaves the longest sentence it has held
            ids = F.when(~goes_on & (state["held"] > 0), F.concat(state["ids"], F.array(state["held"]))
                         ).otherwise(state["ids"])
            held = F.when(goes_on, state["held"]).otherwise(F.lit(0))
            return _bound(own, lambda o: F.struct(
                F.concat(ids, F.when(~o["more"] & (o["id"] > 0), F.array(o["id"])).otherwise(none)).alias("ids"),
                F.when(~o["more"], F.lit(0)).when(o["id"] > 0, o["id"]).otherwise(held).alias("held"),
                F.when(o["more"], o["run"]).otherwise(F.lit("")).alias("run")))
        return _bound(joined, after)

    start = F.struct(F.array().cast("array<int>").alias("ids"), F.lit(0).alias("held"), F.lit("").alias("run"))
    return F.aggregate(fragments, start, step, lambda s: F.when(
        s["held"] > 0, F.concat(s["ids"], F.array(s["held"]))).otherwise(s["ids"]))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
         sentences: tuple[str, ...] = SENTENCES,
         rules: tuple[tuple[str, tuple[int, ...]], ...] = RULES) -> DataFrame:
    """Per row: doc_id, the sentence identifiers (joined by commas), the number
    of matched rules, and the licences found, each once, in the order of the rules."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), sentence_ids(F.col(text), sentences).alias("ids"))
    # a generator of one element: the identifiers are found once, whoever uses them
    rows = rows.select("doc_id", F.explode(F.array("ids")).alias("ids"))
    # the sequence as text, every identifier between bars of its own
    left = F.array_join(F.transform("ids", lambda i: F.concat(F.lit("|"), i.cast("string"), F.lit("|"))), "")
    tried = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("".join(f"|{i}|" for i in sequence)).alias("wanted"))
                      for name, sequence in rules])
    nothing = F.array().cast("array<string>")
    found = F.aggregate(
        tried, F.struct(left.alias("left"), nothing.alias("found")),
        lambda s, r: F.when(F.contains(s["left"], r["wanted"]), F.struct(
            F.replace(s["left"], r["wanted"], F.lit("#")).alias("left"),
            F.concat(s["found"], F.array(r["name"])).alias("found"))).otherwise(s), lambda s: s["found"])
    rows = rows.select("doc_id", "ids", F.when(F.size("ids") > 0, found).otherwise(nothing).alias("found"))
    return rows.select("doc_id", F.array_join(F.col("ids").cast("array<string>"), ",").alias("sentence_ids"),
                       F.size("found").cast("long").alias("n_rules"),
                       F.array_join(F.array_distinct("found"), ",").alias("licenses"))


def oracle(sentences: tuple[str, ...] = SENTENCES,
           rules: tuple[tuple[str, tuple[int, ...]], ...] = RULES) -> str:
    """The scan of table documents as DuckDB SQL: fragment after fragment by a
    recursive query, then rule after rule."""
    rows = ", ".join(
        f"({i}, '{normal(s.split('*')[0])}', {repr(normal(s.split('*')[1])) if '*' in s else 'NULL'})"
        for i, s in enumerate(sentences, 1))

    def looked_up(run: str) -> str:
        """(id, more) of a run"""
        short = f"length({run}) <= length(a) + length(z) + {NAME}"
        return f"""(SELECT {{'id': coalesce(max(i) FILTER (CASE WHEN z IS NULL THEN {run} = a
              WHEN z = '' THEN starts_with({run}, a || ' ')
              ELSE starts_with({run}, a || ' ') AND ends_with({run}, ' ' || z) AND {short} END), 0),
            'more': coalesce(bool_or(starts_with(CASE WHEN z IS NULL THEN a ELSE a || ' ' END, {run} || ' ')
              OR (coalesce(z, '') <> '' AND starts_with({run}, a || ' ') AND NOT ends_with({run}, ' ' || z)
                  AND {short})), false)}} FROM known)"""

    steps = []
    for k, (_, sequence) in enumerate(rules):
        wanted = "".join(f"|{i}|" for i in sequence)
        steps.append(f"s{k + 1} AS (SELECT *, replace(left{k}, '{wanted}', '#') AS left{k + 1}, "
                     f"contains(left{k}, '{wanted}') AS hit{k} FROM s{k})")
    hits = ", ".join(f"CASE WHEN hit{k} THEN '{name}' END" for k, (name, _) in enumerate(rules))
    return f"""WITH RECURSIVE known(i, a, z) AS (VALUES {rows}),
      cut AS (SELECT row_number() OVER () AS d, doc_id, list_filter(list_transform(
          string_split_regex(coalesce(text, ''), '{CUT}'),
          lambda s: lower(trim(regexp_replace(s, '[^A-Za-z0-9]+', ' ', 'g')))), lambda s: s <> '') AS f FROM documents),
      part AS MATERIALIZED (SELECT d, unnest(f) AS x, generate_subscripts(f, 1) AS n FROM cut),
      -- runs of fragments that begin a known sentence, and what they hold
      walk(d, n, ids, held, run) AS (
        SELECT d, 0, '', 0, '' FROM cut
        UNION ALL
        SELECT d, n, base || CASE WHEN NOT own.more AND own.id > 0 THEN '|' || own.id || '|' ELSE '' END,
               CASE WHEN NOT own.more THEN 0 WHEN own.id > 0 THEN own.id WHEN goes_on THEN held ELSE 0 END,
               CASE WHEN own.more THEN own_run ELSE '' END
        FROM (SELECT *, CASE WHEN goes_on OR held = 0 THEN ids ELSE ids || '|' || held || '|' END AS base,
                     CASE WHEN fresh OR goes_on THEN long ELSE alone END AS own,
                     CASE WHEN fresh OR goes_on THEN j ELSE x END AS own_run
              FROM (SELECT *, NOT fresh AND (long.id > 0 OR long.more) AS goes_on
                    FROM (SELECT *, {looked_up('j')} AS long, {looked_up('x')} AS alone
                          FROM (SELECT w.d, p.n, w.ids, w.held, w.run = '' AS fresh, p.x,
                                       CASE WHEN w.run = '' THEN p.x ELSE w.run || ' ' || p.x END AS j
                                FROM walk w JOIN part p ON p.d = w.d AND p.n = w.n + 1))))),
      ends AS (SELECT d, arg_max(CASE WHEN held > 0 THEN ids || '|' || held || '|' ELSE ids END, n) AS left0
               FROM walk GROUP BY d),
      s0 AS (SELECT doc_id, left0 FROM cut JOIN ends USING (d)),
      """ + ",\n".join(steps) + f"""
      , found AS (SELECT doc_id, left0, list_filter([{hits}], lambda x: x IS NOT NULL) AS f FROM s{len(rules)})
      SELECT doc_id, trim(replace(replace(left0, '||', ','), '|', '')) AS sentence_ids, len(f) AS n_rules,
        array_to_string(list_filter(f, lambda x, i: list_position(f, x) = i), ',') AS licenses FROM found"""


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents"))
