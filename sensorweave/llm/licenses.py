"""Licences recognised by their sentences.

A text becomes a sequence of known licence sentences, found also inside longer ones and across
the line breaks and comment marks of wrapped texts; ordered rules over that sequence name the
licences. All of it happens within a row, without a shuffle or Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Licence sentences, normalised (ASCII letters and digits, lower case, single spaces).
SENTENCES = {
    "apache-line": "licensed under the apache license version 2 0",
    "apache-may-not": "you may not use this file except in compliance with the license",
    "apache-obtain": "you may obtain a copy of the license at",
    "apache-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "mit-line": "released under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "gpl3-line": "this work is licensed under the gnu general public license version 3",
    "gpl-grant": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-no-warranty": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "ccbync4-line": "licensed under cc by nc 4 0",
    "ccby4-line": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc0-line": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "all-rights": "all rights reserved",
}

# Rules in order of precedence. All sentences of a rule must follow each other in this
# order, others may stand between; a rule is void where one that it yields to has matched.
RULES = [
    ("Apache-2.0", ["apache-line"], []),
    ("Apache-2.0", ["apache-may-not", "apache-obtain", "apache-as-is"], []),
    ("MIT", ["mit-grant", "mit-notice", "mit-as-is"], []),
    ("MIT", ["mit-line"], []),
    ("ISC", ["isc-grant"], []),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"], []),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"], ["BSD-3-Clause"]),
    ("GPL-3.0", ["gpl3-line"], []),
    ("GPL-3.0", ["gpl-grant", "gpl-no-warranty"], []),
    ("CC-BY-NC-4.0", ["ccbync4-line"], []),
    ("CC-BY-4.0", ["ccby4-line"], []),
    ("CC0-1.0", ["cc0-line"], []),
    ("Unlicense", ["unlicense"], []),
    ("proprietary", ["all-rights"], ["Apache-2.0", "MIT", "ISC", "BSD-3-Clause", "BSD-2-Clause", "GPL-3.0"]),
]

# Sentences end at a line end, or at marks followed by white space or the end of the text.
BREAK = r"[.!?;:]+[\x20\x09-\x0D]+|[.!?;:]+\z|\n"


def sentences(text: Column) -> Column:
    """Normalised sentences of a text that have a letter or digit."""
    plain = lambda s: F.trim(F.lower(F.regexp_replace(s, "[^A-Za-z0-9]+", " ")))
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), BREAK, -1), plain), lambda s: s != "")


# What comment marks, boxes and quotes put before a line.
MARKS = r"(?m)^[\x20\x09#/*;%!<>|'\"-]*+(?:(?:\.\\\"|(?i:rem|dnl)(?=[\x20\x09]|$))[\x20\x09#/*;%!<>|'\"-]*+)?"

# In running text a line break is a blank; sentences end at empty lines and at marks. A colon or
# semicolon ends none, as a known sentence may have one inside ("free software: you can").
END = r"[.!?]+(?=[\x20\x09-\x0D]|\z)|\n[\x20\x09]*(?=\n)"


def running(text: Column) -> Column:
    """The text without comment marks and line breaks, normalised, ``|`` at the ends of sentences."""
    lines = F.regexp_replace(F.coalesce(text, F.lit("")), r"\r+\n", "\n")
    ended = F.regexp_replace(F.regexp_replace(lines, MARKS, ""), r"\|", " ")
    return F.lower(F.regexp_replace(F.regexp_replace(ended, END, "|"), "[^A-Za-z0-9|]+", " "))


def sentence_ids(text: Column) -> Column:
    """Ids of the known sentences in a text, in order, each wherever it stands inside a sentence."""
    known = F.create_map(*[F.lit(x) for name, words in SENTENCES.items() for x in (words, name)])
    any_of = "(?<![a-z0-9])(?=(" + "|".join(SENTENCES.values()) + ")(?![a-z0-9]))"
    return F.transform(F.regexp_extract_all(running(text), F.lit(any_of), F.lit(1)), lambda s: F.element_at(known, s))


def pattern(ids: list[str]) -> str:
    """What the ids of a text, with a blank around each, look like if a rule's ids occur in order."""
    return " " + " (?:.* )?".join(ids) + " "


def licenses(ids: Column) -> Column:
    """Names of the licences whose rules match a sequence of sentence ids, by precedence, each once."""
    line = F.concat(F.lit(" "), F.array_join(ids, " "), F.lit(" "))
    hit = lambda rules: _any([line.rlike(pattern(rule)) for rule in rules])
    by_name: dict[str, list[list[str]]] = {}
    for name, rule, _ in RULES:
        by_name.setdefault(name, []).append(rule)
    found = []
    for name, rules in by_name.items():
        yields = [x for n, _, others in RULES if n == name for x in others]
        void = _any([hit(by_name[other]) for other in yields]) if yields else F.lit(False)
        found.append(F.when(hit(rules) & ~void, F.lit(name)))
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def _any(conditions: list[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result | condition
    return result


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_sentences``, ``sentence_ids`` and ``licenses`` (arrays of names).

    ``n_sentences`` counts a line end as the end of a sentence; known sentences are found in
    wrapped texts and inside longer sentences, too. Null and empty texts have no sentences and
    no licences. Rows are scanned one by one.
    """
    counted = F.size(sentences(F.col(text_col))).cast("long")
    return docs.select(
        F.col(id_col), counted.alias("n_sentences"), sentence_ids(F.col(text_col)).alias("sentence_ids")
    ).select(id_col, "n_sentences", "sentence_ids", licenses(F.col("sentence_ids")).alias("licenses"))


def oracle() -> str:
    """The query over ``documents`` in DuckDB, made of the same sentences and rules."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    known = " ".join(f"WHEN {quoted(words)} THEN {quoted(name)}" for name, words in SENTENCES.items())
    by_name: dict[str, list[list[str]]] = {}
    for name, rule, _ in RULES:
        by_name.setdefault(name, []).append(rule)
    hit = lambda name: "(" + " OR ".join(f"regexp_matches(line, {quoted(pattern(r))})" for r in by_name[name]) + ")"
    cases = []
    for name in by_name:
        yields = [x for n, _, others in RULES if n == name for x in others]
        void = "".join(f" AND NOT {hit(other)}" for other in yields)
        cases.append(f"CASE WHEN {hit(name)}{void} THEN {quoted(name)} END")
    return f"""
        WITH s AS (
            SELECT doc_id, list_filter(list_transform(string_split_regex(coalesce(text, ''), '{BREAK}'),
                lambda x: trim(lower(regexp_replace(x, '[^A-Za-z0-9]+', ' ', 'g')))), lambda x: x <> '') AS found FROM documents
        ), k AS (
            SELECT doc_id, len(found) AS n_sentences,
                   list_filter(list_transform(found, lambda x: CASE x {known} END), lambda x: x IS NOT NULL) AS ids FROM s
        ), l AS (SELECT *, ' ' || array_to_string(ids, ' ') || ' ' AS line FROM k)
        SELECT doc_id, n_sentences, array_to_string(ids, ' ') AS sentence_ids,
               array_to_string(list_filter([{", ".join(cases)}], lambda x: x IS NOT NULL), ',') AS licenses
        FROM l
    """
