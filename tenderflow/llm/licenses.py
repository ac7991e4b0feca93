"""Operator 2: licence recognition by sentence sequences (native).

1. Texts are cut into pieces at line breaks and at . ! ? ; : before white space; texts without a licence trigger
   word are dropped at once (every known wording holds one).
2. Pieces are normalised (lower case, letters and digits only, single spaces). A run of pieces that
   follow each other without a blank one between them is a known sentence if, put together, it equals one of the known
   wordings: a one-line notice is a run of one piece, a hard-wrapped sentence or one with a colon in it a run of
   several. Only pieces that a known wording can begin with are tried, and of several wordings that begin at
   one piece the longest counts. Comment signs at the start of lines vanish with the other symbols.
3. Per document the identifiers in text order form a sequence. A rule is an ordered list of
   identifiers; it matches where its identifiers come in this order, each within ``MAX_GAP`` pieces
   of the end of the one before (texts are interleaved with lines of their own). Rules that start with a known
   sentence inside another rule's match of more sentences give way to the longer match.

All steps are built-in functions: higher-order functions over the pieces of a document with the fixed wordings as
literals, and one group-by on the document. Only recognised sentences are shuffled. A sentence form that a third
of all documents share adds one small row per document to groups that are spread by document, never by sentence.

``ORACLE_SQL`` knows notices of one piece only (``SENTENCES``, ``RULES``); on texts without wrapped ones both agree.

Defined results: null, empty and licence-free texts give no row. Rows are keyed by doc_id; repeated
rows of one doc_id and null doc_ids (each row on its own) are told apart by a row number of the scan,
so each row is recognised by itself. Ties (two rules of the same length at one sentence) all count.
Other input columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_GAP = 3

# ---- fixed values: known licence sentences, identifier -> wording -------------------
SENTENCES = {
    "apache-line": "Licensed under the Apache License, Version 2.0",
    "apache-not-use": "you may not use this file except in compliance with the License",
    "apache-obtain": "You may obtain a copy of the License at",
    "apache-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                    "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "mit-line": "Released under the MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 "documentation files (the \"Software\"), to deal in the Software without restriction",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial "
                  "portions of the Software",
    "as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED",
    "gpl3-line": "This work is licensed under the GNU General Public License, version 3",
    "gpl-redistribute": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                        "General Public License as published by the Free Software Foundation",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "bsd-redistribute": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                        "provided that the following conditions are met",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                   "promote products derived from this software without specific prior written permission",
    "cc-by-nc-line": "Licensed under CC BY-NC 4.0",
    "cc-by-line": "Licensed under CC BY 4.0",
    "cc0-line": "To the extent possible under law, the author has waived all copyright",
    "reserved": "All rights reserved",
}
#: ordered rules: licence -> identifiers in order
RULES = {
    "Apache-2.0": [["apache-line"], ["apache-line", "apache-not-use", "apache-obtain", "apache-as-is"]],
    "MIT": [["mit-line"], ["mit-grant", "mit-notice", "as-is"], ["mit-line", "mit-grant", "mit-notice", "as-is"]],
    "GPL-3.0": [["gpl3-line"], ["gpl-redistribute", "gpl-hope"]],
    "BSD-2-Clause": [["bsd-redistribute", "as-is"]],
    "BSD-3-Clause": [["bsd-redistribute", "bsd-endorse", "as-is"]],
    "CC-BY-NC-4.0": [["cc-by-nc-line"]],
    "CC-BY-4.0": [["cc-by-line"]],
    "CC0-1.0": [["cc0-line"]],
    "proprietary": [["reserved"]],
}
_BSD = ("AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED")
_MIT_NOTICE = "shall be included in all copies or substantial portions of the Software"
_GPL = "you can redistribute it and/or modify it under the terms of the GNU General Public License"
_FSF = "as published by the Free Software Foundation"
#: further wordings of the sentences above and sentences of their own, as they stand in the licences' texts
FULL_SENTENCES = {
    "apache-line": ["Licensed under the Apache License, Version 2.0 (the \"License\")"],
    "apache-obtain": [f"You may obtain a copy of the License at {http}://www.apache.org/licenses/LICENSE-2.0" for http in ("http", "https")],
    "mit-grant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                  "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
                  "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
                  "permit persons to whom the Software is furnished to do so, subject to the following conditions"],
    "mit-notice": [f"The above copyright notice and this permission notice (including the next paragraph) {_MIT_NOTICE}"],
    "as-is": [f"THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
              f"THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND {n}" for n in ("NONINFRINGEMENT", "NON-INFRINGEMENT")],
    "gpl-redistribute": [f"This program is free software: {_GPL} {_FSF}, either version 3 of the License, or (at your option) any later version",
                         f"This program is free software: {_GPL} {_FSF}, version 3 of the License",
                         f"This program is free software: {_GPL} {_FSF}, version 3"],
    "gpl2-redistribute": [f"This program is free software; {_GPL} {_FSF}; either version 2 of the License, or (at your option) any later version",
                          f"This program is free software; {_GPL} {_FSF}; version 2 of the License",
                          f"This program is free software; {_GPL} version 2 {_FSF}"],
    "gpl-hope": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
                 "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                   "following disclaimer"],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                   "following disclaimer in the documentation and/or other materials provided with the distribution"],
    "bsd-as-is": [f"THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" {_BSD}",
                  f"THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDER AND CONTRIBUTORS \"AS IS\" {_BSD}"],
    "cc-by-nc-line": [f"This work is licensed under {a} Creative Commons Attribution-NonCommercial 4.0 International License" for a in ("a", "the")],
    "cc-by-line": [f"This work is licensed under {a} Creative Commons Attribution 4.0 International License" for a in ("a", "the")],
    "cc0-line": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
                 "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to "
                 "this software to the public domain worldwide"],
}
#: every wording, identifier -> wordings
KNOWN = {k: [*([SENTENCES[k]] if k in SENTENCES else []), *FULL_SENTENCES.get(k, [])] for k in {**SENTENCES, **FULL_SENTENCES}}
#: rules that need the sentences of the licences' own texts
FULL_RULES = {
    "GPL-2.0": [["gpl2-redistribute", "gpl-hope"]],
    "BSD-2-Clause": [["bsd-redistribute", "bsd-source", "bsd-binary", "bsd-as-is"]],
    "BSD-3-Clause": [["bsd-redistribute", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is"]],
}
ALL_RULES = {k: RULES.get(k, []) + FULL_RULES.get(k, []) for k in {**RULES, **FULL_RULES}}
#: every known wording holds one of these words
TRIGGERS = r"(?i)licen[sc]e|permission|warrant|copyright|redistribut|rights|distributed"
CUT = r"\n|(?<=[.!?;:])[ \t\r]+"


def normalised(s: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(s), r"[^a-z0-9]+", " "))


def _normal(s: str) -> str:
    import re
    return re.sub(r"[^a-z0-9]+", " ", s.lower()).strip()


def identifiers(docs: DataFrame, sentences: dict[str, str | list[str]] = KNOWN, doc_id: str = "doc_id",
                text: str = "text") -> DataFrame:
    """(row, doc_id, pos, last, id): known sentences in text order, with their first and last piece."""
    forms = {_normal(v): k for k, many in sentences.items() for v in ([many] if isinstance(many, str) else many)}
    # whole words from the start of a wording; a run has at most one piece for each of its words
    starts = sorted({" ".join(f.split()[:n + 1]) for f in forms for n in range(len(f.split()))})
    longest = max(len(f.split()) for f in forms)
    known = F.create_map(*[F.lit(x) for kv in forms.items() for x in kv])
    numbered = docs.where(F.col(text).rlike(TRIGGERS)).select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"),
        F.transform(F.split(F.col(text), CUT), normalised).alias("norms"))

    def run(x: Column) -> Column:
        """The longest known sentence that starts at a piece, else null."""
        piece = lambda k: F.slice("norms", x["pos"] + 1, k)
        whole = F.filter(F.sequence(F.lit(1), F.least(F.size("norms") - x["pos"], F.lit(longest))),
                         lambda k: ~F.array_contains(piece(k), ""))
        said = F.transform(whole, lambda k: F.struct((x["pos"] + k - 1).alias("last"),
                                                     F.try_element_at(known, F.array_join(piece(k), " ")).alias("id")))
        best = F.array_max(F.filter(said, lambda r: r["id"].isNotNull()))
        return F.struct(x["pos"].alias("pos"), best["last"].alias("last"), best["id"].alias("id"))
    at = F.filter(F.transform("norms", lambda s, i: F.struct(i.alias("pos"), s.alias("s"))), lambda x: x["s"].isin(starts))
    said = F.filter(F.transform(at, run), lambda r: r["id"].isNotNull())
    return numbered.select("row", "doc_id", F.explode(said).alias("x")).select("row", "doc_id", "x.*")


def _next(seq: Column, ident: str, at: Column, max_gap: int) -> Column:
    """Last piece of the first ``ident`` that starts within ``max_gap`` pieces after piece ``at``, else null."""
    near = F.filter(seq, lambda x: (x["id"] == ident) & (x["pos"] > at) & (x["pos"] <= at + 1 + max_gap))
    return F.array_min(F.transform(near, lambda x: x["last"]))


def _matches(licence: str, rule: list[str], max_gap: int) -> Column:
    """Every place of ``seq`` (array of (pos, last, id)) where the rule starts, with the place where it ends (null: nowhere)."""
    def match(x: Column) -> Column:
        end = x["last"]
        for ident in rule[1:]:
            end = _next(F.col("seq"), ident, end, max_gap)
        return F.struct(F.lit(licence).alias("licence"), x["pos"].alias("a"), end.alias("z"), F.lit(len(rule)).alias("n"))
    return F.transform(F.filter("seq", lambda x: x["id"] == rule[0]), match)


def licences(docs: DataFrame, sentences: dict[str, str | list[str]] = KNOWN, rules: dict[str, list[list[str]]] = ALL_RULES,
             max_gap: int = MAX_GAP, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, licence, first_sentence, last_sentence, n_sentences): recognised licences, longest matches only."""
    seq = identifiers(docs, sentences, doc_id, text).groupBy("row", "doc_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "last", "id"))).alias("seq"))
    found = [_matches(licence, rule, max_gap) for licence, many in rules.items() for rule in many]
    full = F.filter(F.flatten(F.array(*found)), lambda m: m["z"].isNotNull())
    longest = F.filter("m", lambda m: ~F.exists("m", lambda o: (o["a"] <= m["a"]) & (o["z"] >= m["z"]) & (o["n"] > m["n"])))
    return seq.select("row", "doc_id", full.alias("m")).select("doc_id", F.explode(longest).alias("m")).select(
        "doc_id", F.col("m.licence").alias("licence"), F.col("m.a").alias("first_sentence"),
        F.col("m.z").alias("last_sentence"), F.col("m.n").alias("n_sentences"))


def query(spark, sf_dir: str) -> DataFrame:
    return licences(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _oracle() -> str:
    known = ",\n  ".join(f"('{_normal(v)}', '{k}')" for k, v in SENTENCES.items())
    parts = []
    for lic, many in RULES.items():
        for r in many:
            joins = "".join(
                f" join lateral (select min(pos) as p from k where k.doc_id = m0.doc_id and k.id = '{x}'"
                f" and k.pos > m{i}.p and k.pos <= m{i}.p + {1 + MAX_GAP}) m{i + 1} on m{i + 1}.p is not null"
                for i, x in enumerate(r[1:]))
            parts.append(f"select m0.doc_id, '{lic}' as licence, m0.p as a, m{len(r) - 1}.p as z, {len(r)} as n"
                         f" from (select doc_id, pos as p from k where id = '{r[0]}') m0{joins}")
    return f"""
with marked as (select doc_id, regexp_replace(text, '([.!?;:])[ \\t\\r]+', '\\1' || chr(10), 'g') as t from documents),
s as (select doc_id, unnest(string_split(t, chr(10))) as s, unnest(range(0, len(string_split(t, chr(10))))) as pos
      from marked),
known(norm, id) as (values
  {known}),
k as (select s.doc_id, s.pos, known.id from s join known
      on trim(regexp_replace(lower(s.s), '[^a-z0-9]+', ' ', 'g')) = known.norm),
m as ({' union all '.join(parts)})
select doc_id, licence, a as first_sentence, z as last_sentence, n as n_sentences from m
where not exists (select 1 from m o where o.doc_id = m.doc_id and o.a <= m.a and o.z >= m.z and o.n > m.n)
"""


ORACLE_SQL = _oracle()
