"""License scans by sentence rules, in DataFrame functions only.

A text is cut into sentences at stops and line ends; a sentence is normalised to
lower-case words of a-z and 0-9.  Known sentences have identifiers.  The identifiers of
a text, in order, are matched against rules: a rule applies where its sentences
follow one another, with nothing between them but sentences that are not known.
Of the rules of one licence that apply, the one of most sentences is reported.  A rule whose
sentences are the beginning or another part of a longer one that applies is not: the text of
one licence may contain that of another.  "All rights reserved" counts where no licence is named.

Licence texts are wrapped, often behind comment marks.  So the rules are matched twice:
against the sentences as cut at every line end, and against those that may go on over a
line end (see :func:`wrapped_ids`); whatever applies in one of the two ways counts.

Everything happens within the row, without a shuffle.

Defined results: null and empty texts match nothing.  Repeated rows are reported each
for itself.  Of equally long rules the alphabetically first is reported.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licence texts and notices.
RULES = {
    "apache-2.0-short": ("Apache-2.0", ["Licensed under the Apache License, Version 2.0"]),
    "apache-2.0-header": (
        "Apache-2.0",
        [
            'Licensed under the Apache License, Version 2.0 (the "License")',
            "you may not use this file except in compliance with the License",
            "You may obtain a copy of the License at",
            'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied',
            "See the License for the specific language governing permissions and limitations under the License",
        ],
    ),
    "mit-short": ("MIT", ["Released under the MIT License"]),
    "mit-notice": ("MIT", ["This project is licensed under the MIT License"]),
    "mit-text": (
        "MIT",
        [
            'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
        ],
    ),
    "gpl-3.0-short": ("GPL-3.0", ["This work is licensed under the GNU General Public License, version 3"]),
    "gpl-3.0-header": (
        "GPL-3.0-or-later",
        [
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
            "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
            "See the GNU General Public License for more details",
        ],
    ),
    "bsd-clauses": (
        "BSD-2-Clause",
        [
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
        ],
    ),
    "bsd-3-clauses": (
        "BSD-3-Clause",
        [
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
            "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        ],
    ),
    "gpl-2.0-header": (
        "GPL-2.0-or-later",
        [
            "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
            "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
            "See the GNU General Public License for more details",
        ],
    ),
    "lgpl-2.1-header": (
        "LGPL-2.1-or-later",
        [
            "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
            "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
            "See the GNU Lesser General Public License for more details",
        ],
    ),
    "mpl-2.0-notice": ("MPL-2.0", ["This Source Code Form is subject to the terms of the Mozilla Public License, v"]),
    "cc-by-4.0-short": ("CC-BY-4.0", ["Licensed under CC BY 4.0"]),
    "cc-by-sa-4.0-short": ("CC-BY-SA-4.0", ["Licensed under CC BY-SA 4.0"]),
    "cc-by-nc-4.0-short": ("CC-BY-NC-4.0", ["Licensed under CC BY-NC 4.0"]),
    "all-rights-reserved": ("proprietary", ["All rights reserved"]),
}
# Identifiers of licence lines.
SPDX = [
    "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "GPL-2.0-only", "GPL-2.0-or-later",
    "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "MIT", "MPL-2.0",
]
RULES |= {f"spdx-{name.lower()}": (name, [f"SPDX-License-Identifier: {name}"]) for name in SPDX}
#: a notice that stands beside most licences; it counts where nothing else is named
WEAK = "proprietary"

_CUT = r"[.!?;]+(?:\s|$)|\n"
_URL = r"[a-z]+://\S+"
_LINE = r"\n[^a-z0-9\n]*(?:(?:dnl|rem)[ \t]+)?(?:[0-9a-z]{1,2}\)[ \t]+)?"


def normalised(sentence: str) -> str:
    kept = "".join(c if "a" <= c <= "z" or "0" <= c <= "9" else " " for c in sentence.lower())
    return " ".join(kept.split())


def known_sentences(rules=RULES) -> dict[str, int]:
    """Normalised sentence to its identifier."""
    return {s: i for i, s in enumerate(sorted({normalised(p) for _, own in rules.values() for x in own for p in x.split("; ")}))}


def rule_sequences(rules=RULES) -> list[tuple[str, str, str, int]]:
    """(rule, licence, identifiers as text, number of sentences)."""
    known = known_sentences(rules)
    out = []
    for rule, (licence, own) in sorted(rules.items()):
        ids = [known[normalised(p)] for x in own for p in x.split("; ")]
        out.append((rule, licence, "," + "".join(f"{i}," for i in ids), len(ids)))
    return out


def sentence_ids(text: Column, rules=RULES) -> Column:
    """The identifiers of the known sentences of a text in order, as text between commas."""
    known = known_sentences(rules)
    table = F.create_map(*[F.lit(x) for s, i in known.items() for x in (s, str(i))])
    sentences = F.split(F.coalesce(text, F.lit("")), _CUT)
    plain = lambda s: F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " "))
    # a set decides which sentences are known; only those are looked up in the map, which is a list
    found = F.filter(F.transform(sentences, plain), lambda s: s.isin(list(known)))
    return _joined(F.transform(found, lambda s: F.try_element_at(table, s)))


def _joined(found: Column) -> Column:
    return F.concat(F.lit(","), F.array_join(F.transform(found, lambda i: F.concat(i, F.lit(","))), ""))


def wrapped_ids(text: Column, rules=RULES) -> Column:
    """As :func:`sentence_ids`, of sentences that may go on over single line ends.

    A known sentence counts if it begins and ends at a line end, stop, URL or end of the text.
    Marks before the first word of a line (comments, list numbers) are part of the line end;
    a blank line is two of them and so ends a sentence, as do stops and URLs.
    """
    known = known_sentences(rules)
    line, stop = "\x01", "\x02"
    plain = F.translate(F.lower(F.concat(F.lit("\n"), F.coalesce(text, F.lit("")))), line + stop, "  ")
    for pattern, mark in ((_URL, stop), (_LINE, line), (r"[.!?;]+(?=\s|$)", stop)):
        plain = F.regexp_replace(plain, pattern, f" {mark} ")
    plain = F.trim(F.regexp_replace(plain, f"[^a-z0-9{line}{stop}]+", " "))
    # of two sentences that begin alike the longer one is tried first
    sentences = "|".join(s.replace(" ", f" (?:{line} )?") for s in sorted(known, key=lambda s: (-len(s), s)))
    found = F.regexp_extract_all(plain, F.lit(f"[{line}{stop}] ({sentences})(?= [{line}{stop}]|$)"), F.lit(1))
    table = F.create_map(*[F.lit(x) for s, i in known.items() for x in (s, str(i))])
    return _joined(F.transform(found, lambda s: F.try_element_at(table, F.regexp_replace(s, f" {line} ", " "))))


def _first_words(rules=RULES) -> str:
    """A pattern of few words, of which every known sentence has one."""
    left, out = set(known_sentences(rules)), []
    while left:
        words = {w for s in left for w in s.split()}
        best = max(sorted(words), key=lambda w: (sum(w in s.split() for s in left) if len(w) > 5 else 0, len(w)))
        out.append(best)
        left = {s for s in left if best not in s.split()}
    return "|".join(out)


def license_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules=RULES) -> DataFrame:
    """(doc_id, license, rule, n_sentences) of every licence that a row's text names."""
    own = F.col(text)
    # what holds no part of any known sentence needs no look at its line ends
    wrapped = F.when(F.lower(own).rlike(_first_words(rules)), wrapped_ids(own, rules)).otherwise(",")
    rows = docs.select(F.col(doc_id).alias("doc_id"), sentence_ids(own, rules).alias("ids"), wrapped.alias("wrapped")).filter("ids <> ',' OR wrapped <> ','")
    table = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(rule).alias("rule"), F.lit(licence).alias("license"), F.lit(ids).alias("ids")) for rule, licence, ids, n in rule_sequences(rules)])
    hits = rows.withColumn("hits", F.filter(table, lambda r: F.contains(F.col("ids"), r["ids"]) | F.contains(F.col("wrapped"), r["ids"])))


    def better(r, o):
        same = (o["license"] == r["license"]) & ((o["n"] > r["n"]) | ((o["n"] == r["n"]) & (o["rule"] < r["rule"])))
        inside = (o["n"] > r["n"]) & F.contains(o["ids"], r["ids"])
        return same | inside | ((r["license"] == WEAK) & (o["license"] != WEAK))

    best = hits.select("doc_id", F.explode(F.filter("hits", lambda r: ~F.exists(F.col("hits"), lambda o: better(r, o)))).alias("r"))
    return best.select("doc_id", F.col("r.license").alias("license"), F.col("r.rule").alias("rule"), F.col("r.n").alias("n_sentences"))


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _oracle() -> str:
    known = ", ".join(f"({_quoted(s)}, {i})" for s, i in known_sentences().items())
    rules = ", ".join(f"({_quoted(r)}, {_quoted(x)}, '{ids}', {n})" for r, x, ids, n in rule_sequences())
    return f"""
WITH known(sentence, id) AS (VALUES {known}), rules(rule, license, ids, n) AS (VALUES {rules}),
parts AS (SELECT doc_id, unnest(string_split_regex(text, '[.!?;]+(?:\\s|$)|\\n')) AS part,
                 generate_subscripts(string_split_regex(text, '[.!?;]+(?:\\s|$)|\\n'), 1) AS pos FROM documents),
plain AS (SELECT doc_id, pos, trim(regexp_replace(lower(part), '[^a-z0-9]+', ' ', 'g')) AS sentence FROM parts),
seqs AS (SELECT doc_id, ',' || string_agg(CAST(id AS VARCHAR), ',' ORDER BY pos) || ',' AS ids FROM plain JOIN known USING (sentence) GROUP BY doc_id),
hits AS (SELECT doc_id, license, rule, n, rules.ids FROM seqs JOIN rules ON contains(seqs.ids, rules.ids))
SELECT doc_id, license, rule, CAST(n AS INTEGER) AS n_sentences FROM hits r WHERE NOT EXISTS (
  SELECT 1 FROM hits o WHERE o.doc_id = r.doc_id AND ((o.license = r.license AND (o.n > r.n OR (o.n = r.n AND o.rule < r.rule)))
    OR (o.n > r.n AND contains(o.ids, r.ids)) OR (r.license = '{WEAK}' AND o.license <> '{WEAK}')))"""


ORACLE_SQL = _oracle()
