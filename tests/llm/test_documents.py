"""WARC derivatives, licence scans, chat repair and the pipeline."""

import hashlib
import itertools
import random
import re

import public_tokenizers
import pytest
from compare import connect, difference
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from sensorweave.llm import catalog, chat, licenses, quality, toxicity, warc

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op5_warc_derivatives", "op9_license_scan"])
def test_query_matches_sql(spark, name):
    assert difference(catalog.QUERIES[name](spark, FOLDER), connect(FOLDER), catalog.SQL[name]) is None


HTML = "<html><head><title>A &amp; B</title><style>p{}</style></head><body><!-- no --><p>One <b>two</b></p><p>x &lt; y</p></body></html>"


def test_derived_records(spark):
    rows = [(1, "http://a/", HTML, "x"), (2, None, None, "x"), (None, "http://b/", "", "x"), (3, "u", "plain", "x"), (3, "u", "plain", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, block string")
    found = warc.responses(pages, "2020-01-01T00:00:00Z")
    records = warc.derive(found).collect()
    assert len(records) == 10
    by = {(r["page_id"], r["warc_type"]): r for r in records}
    source = {r["page_id"]: r for r in found.collect()}
    for (page, kind), record in by.items():
        assert record["refers_to"] == source[page]["record_id"]
        assert record["source_digest"] == source[page]["payload_digest"]
        assert record["content_length"] == len(record["block"].encode())
        if kind == "metadata":
            assert by[page, "conversion"]["record_id"] in record["block"]
    assert by[1, "conversion"]["block"] == "A & B\nOne two\nx < y"
    assert "title: A & B\r\n" in by[1, "metadata"]["block"] and by[2, "conversion"]["block"] == ""
    assert warc.derive(warc.responses(pages.limit(0), "d")).count() == 0


def test_character_references(spark):
    """Each against the character that HTML gives it, in text and title."""
    cases = {
        "&copy; 2024 &middot; x": "\u00a9 2024 \u00b7 x",
        "caf&eacute; &mdash; it&#8217;s &#x2019;&#X2019;": "caf\u00e9 \u2014 it\u2019s \u2019\u2019",
        "&amp;lt; &amp;amp;copy; &lt;b&gt;": "&lt; &amp;copy; <b>",
        "a&nbsp;b&#160;&#10;&Tab;&NewLine;&nbspc": "a b c",
        "&euro;&#128; &#0;&#xD800;&#x110000; &copy x": "\u20ac\u20ac \ufffd\ufffd\ufffd \u00a9 x",
        "AT&T & co &unknown; &;&#;&#x;": "AT&T & co &unknown; &;&#;&#x;",
        "&#x1F600;&NotEqualTilde;&#39;&quot;": "\U0001f600\u2242\u0338'\"",
    }
    rows = [(k, "u", f"<title>{t}</title><p>{t}</p>") for k, t in enumerate(cases)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for record in warc.derive(warc.responses(pages, "2020-01-01T00:00:00Z")).collect():
        text = list(cases.values())[record["page_id"]]
        if record["warc_type"] == "conversion":
            assert record["block"] == f"{text}\n{text}"
            assert record["block_digest"] == "sha256:" + hashlib.sha256(record["block"].encode()).hexdigest()
            assert record["content_length"] == len(record["block"].encode())
        else:
            assert f"title: {text}\r\n" in record["block"] and f"text-characters: {2 * len(text) + 1}\r\n" in record["block"]


ODD_PAGES = [
    "<p>3 < 4 and 5 > 2</p><a title=\"a > b\" href='x>y'>link</a> end",
    "<p class=it's>open</p> <b title=\"never closed>bold</b> tail",
    "<title lang='a>b'>T &eacute;&nbsp;&#8217;</title><P>x&copy;y&copy z&notit;&notanentity; &amp;lt; & &# &#x; &#x110000; &#0; &#128; &#xD800; &#99999999999999999999;</P>",
    "a<!-- <p> > -->b<!DOCTYPE html>c<?php echo ?>d <1 <_ </ <",
    "<" * 300 + " " + "<p " * 300 + "'\"" * 300,
    "&CounterClockwiseContourIntegral; &fjlig; &lt &ltx &Aacute &tab;&Tab;&NewLine;x",
    "<br/>one<BR>two<hr />three<div\n class='q'>four</div\n>",
    "",
    None,
]


def test_odd_tags_and_references_match_sql(spark):
    """The visible text and the records, against DuckDB and, for the first ones, by hand."""
    import duckdb

    rows = [(k, "http://a/", html) for k, html in enumerate(ODD_PAGES)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {r["page_id"]: r["block"] for r in warc.derive(warc.responses(pages, "d")).where("warc_type = 'conversion'").collect()}
    assert texts[0] == "3 < 4 and 5 > 2\nlink end"
    assert texts[1] == "open\nbold tail"
    assert texts[2].startswith("T é ’\nx©y© z¬it;¬anentity; &lt; & &# &#x; \ufffd \ufffd €")
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    assert difference(warc.derive(warc.responses(pages, "d")), con, warc.oracle("d")) is None


def test_addresses_cannot_add_header_lines(spark):
    pages = spark.createDataFrame([(1, "http://a/\r\nWARC-Type: forged\r\n\r\nbody", "<p>x")], "page_id long, url string, html string")
    rendered = warc.render(warc.derive(warc.responses(pages, "d")))
    for r in warc.parse(rendered).collect():
        assert r["header"]["WARC-Type"] in ("metadata", "conversion") and "forged" in r["header"]["WARC-Target-URI"]
    many = "WARC/1.1\r\n" + "\r\n".join(f"X-{k}: {k}" for k in range(1500)) + "\r\n\r\nblock\r\n\r\n"
    parsed = warc.parse(spark.createDataFrame([(many,)], "record string")).first()
    assert len(parsed["header"]) == 1500 and parsed["header"]["X-1499"] == "1499" and parsed["block"] == "block"


def test_rendered_records_can_be_read(spark):
    pages = spark.createDataFrame([(1, "http://a/", HTML), (2, "http://b/", None)], "page_id long, url string, html string")
    records = warc.derive(warc.responses(pages, "2020-01-01T00:00:00Z"))
    back = {r["header"]["WARC-Record-ID"]: r for r in warc.parse(warc.render(records)).collect()}
    for record in records.collect():
        read = back[record["record_id"]]
        assert read["block"] == record["block"] and read["header"]["WARC-Refers-To"] == record["refers_to"]
        assert read["header"]["Content-Length"] == str(record["content_length"])


@pytest.mark.parametrize(
    "text, names",
    [
        (None, []),
        ("", []),
        ("Released under the MIT License.", ["MIT"]),
        ("prose. Licensed under the Apache License, Version 2.0.\nmore", ["Apache-2.0"]),
        ("released under the mit licence", []),
        ("All rights reserved.", ["proprietary"]),
        ("All rights reserved. Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0", "proprietary"]),
        ("All rights reserved.\nReleased under the MIT license", ["MIT"]),
    ],
)
def test_licenses(spark, text, names):
    docs = spark.createDataFrame([(1, text, "x")], "doc_id long, text string, licenses string")
    assert licenses.scan(docs).first()["licenses"] == names
    assert licenses.scan(docs.limit(0)).count() == 0


WRAPPED = {
    "MIT": """\
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
LIABILITY.""",
    "ISC": """\
Copyright (c) 2020, A Person

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
    "BSD-3-Clause": """\
Copyright (c) 2020, A Person
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.""",
    "GPL-3.0": """\
This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.""",
    "Apache-2.0": """\
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
}


def test_wrapped_licences_behind_comment_marks(spark):
    marks = ["", "# ", "// ", " * ", "-- ", "; ", "! ", "% ", "rem ", "dnl ", "> ", '.\\" ']
    cases = [(name, m, end) for name in WRAPPED for m in marks for end in ("\n", "\r\n")]
    texts = [end.join(m + line for line in WRAPPED[name].split("\n")) for name, m, end in cases]
    found = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    by = {r["doc_id"]: r["licenses"] for r in found.collect()}
    assert {case: by[k] for k, case in enumerate(cases)} == {case: [case[0]] for case in cases}


def test_known_sentences_inside_longer_ones(spark):
    cases = {
        "This project is licensed under the Apache License, Version 2.0": ["Apache-2.0"],
        "The tool is released under the\nMIT License; see the file": ["MIT"],
        "It is unreleased under the MIT License": [],
        "It was released.\nUnder the MIT License, or": [],
        "It was released under\n\nthe MIT License": [],
        "#" * 100_000 + "\n" + "/" * 100_000 + " released under the MIT License": ["MIT"],
    }
    rows = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    found = {r["doc_id"]: r["licenses"] for r in licenses.scan(rows).collect()}
    assert [found[i] for i in range(len(cases))] == list(cases.values())
    for a, b in itertools.permutations(licenses.SENTENCES.values(), 2):
        assert not f"{a} ".startswith(f"{b} ")  # at most one starts at a place


def test_rules_need_their_order(spark):
    grant, source, binary, names = (licenses.SENTENCES[f"bsd-{k}"] for k in ("grant", "source", "binary", "names"))
    cases = {
        ". ".join([grant, "other words", source, binary]): ["BSD-2-Clause"],
        "\n".join([grant, source, binary, names]): ["BSD-3-Clause"],
        ". ".join([source, grant, binary]): [],
    }
    rows = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    found = {r["doc_id"]: r["licenses"] for r in licenses.scan(rows).collect()}
    assert [found[i] for i in range(len(cases))] == list(cases.values())


def cheapest(roles, costs):
    """The least cost over all repairs, by search over states."""
    states = {"": 0}
    for role in roles:
        after = {}
        for state, cost in states.items():
            for steps in range(4):
                for way in itertools.product(chat.ROLES[1:], repeat=steps):
                    at, legal = state, True
                    for r in way:
                        legal &= r in chat.FOLLOWS[at]
                        at = r
                    if legal:
                        for new in chat.FOLLOWS[at]:
                            total = cost + costs.insert * steps + costs.relabel * (new != role)
                            after[new] = min(after.get(new, total), total)
            if state:
                total = cost + costs.merge + costs.relabel * (state != role)
                after[state] = min(after.get(state, total), total)
        states = after
    tail = {"system": 2, "user": 1, "assistant": 0}
    return min(cost + costs.insert * tail[state] for state, cost in states.items())


def legal(rendered, costs):
    parts = rendered.split(costs.close_turn)
    assert parts[-1] == ""
    at = ""
    for part in parts[:-1]:
        role = part[2 : part.index("|>")]
        assert role in chat.FOLLOWS[at]
        at = role
    return at in chat.LAST


@pytest.mark.parametrize("partitions", [1, 7])
def test_repairs_are_cheapest_and_legal(spark, partitions):
    rng, costs = random.Random(partitions), chat.Costs()
    talks = {k: [rng.choice(["system", "user", "assistant", "user", "assistant", None, "tool"]) for _ in range(rng.randint(1, 9))] for k in range(40)}
    talks[40] = [rng.choice(["user", "assistant"]) for _ in range(300)]
    rows = [(k, n, r, f"t{n}", "x") for k, roles in talks.items() for n, r in enumerate(roles)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = chat.repair(frame).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(found) == len(rows)
    for k, roles in talks.items():
        own = sorted((r for r in found if r["conv_id"] == k), key=lambda r: r["position"])
        assert [r["turn"] for r in own] == list(range(len(roles)))
        assert {r["cost"] for r in own} == {cheapest(roles, costs)}
        paid = sum(len(r["inserted"]) * costs.insert + ("merge" in r["action"]) * costs.merge + ("relabel" in r["action"]) * costs.relabel for r in own)
        assert paid == own[0]["cost"]
        assert legal("".join(r["rendered"] for r in own), costs)
        if partitions > 1 and k == 40:
            assert len({r["position"] >> 40 for r in own}) > 1  # one conversation in several tasks


def test_odd_conversations(spark):
    rows = [(None, None, None, None), (None, 1, "user", "a"), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, 5, "assistant", "")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = chat.repair(frame).collect()
    assert len(found) == 5
    assert legal("".join(r["rendered"] for r in sorted(found, key=lambda r: r["position"]) if r["conv_id"] is None), chat.Costs())
    assert [r["action"] for r in sorted(found, key=lambda r: r["position"]) if r["conv_id"] == 1] == ["keep", "merge"]
    assert chat.repair(frame.limit(0)).count() == 0


def test_chat_query(spark):
    found = catalog.op8_chat_repair(spark, FOLDER).collect()
    turns = catalog.table(spark, FOLDER, "conversations")
    assert len(found) == turns.count()
    talks = {}
    for r in turns.orderBy("conv_id", "turn", "role").collect():
        talks.setdefault(r["conv_id"], []).append(r["role"])
    costs = {r["conv_id"]: r["cost"] for r in found}
    assert all(costs[k] == cheapest(roles, chat.Costs()) for k, roles in talks.items())


def test_pipeline(spark):
    """Each stage against brute force over what its predecessor kept."""
    from test_copies import linked
    from test_classifiers import measures

    docs, labels = catalog.table(spark, FOLDER, "documents"), catalog.table(spark, FOLDER, "labels")
    kept, number = docs, 0
    for name, step in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in kept.collect()}
        kept = step(spark, kept, FOLDER)
        assert kept.columns == docs.columns
        path = spark.conf.get("spark.checkpoint.dir") + f"/test-pipeline-{number}"
        kept.write.mode("overwrite").parquet(path)
        kept, number = spark.read.parquet(path), number + 1
        after = {r["doc_id"]: r["text"] for r in kept.collect()}
        assert after.items() <= before.items() and len(after) > 0.5 * len(before)
        if name == "quality rules":
            verdict = {r["doc_id"]: r["kept"] for r in quality.score(docs, quality.fit(docs, labels)).collect()}
            assert set(after) == {i for i, t in before.items() if verdict[i]}
            assert not any(measures(t)[-1] for t in after.values())
        if name == "toxicity":
            was = spark.createDataFrame(list(before.items()), "doc_id long, text string")
            verdict = {r["doc_id"]: r["predicted"] for r in toxicity.score(was, toxicity.fit(was, labels)).collect()}
            assert set(after) == {i for i in before if not verdict[i]}
        if name == "exact dedup":
            first = {}
            for i, t in sorted(before.items()):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), i)
            assert set(after) == set(first.values())
        if name == "n-gram Jaccard join":
            rows = sorted(before.items())
            assert sorted(after) == sorted({least for _, _, least in linked(rows, 5, 80)})
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, FOLDER).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokens = {i: len(library.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in after.items()}
    lengths, sequences = {}, {}
    for r in sorted(packed, key=lambda r: (r["sequence_id"], r["offset"])):
        lengths[r["doc_id"]] = lengths.get(r["doc_id"], 0) + r["length"]
        assert r["offset"] == sequences.get(r["sequence_id"], 0)
        sequences[r["sequence_id"]] = r["offset"] + r["length"]
    assert lengths == tokens and max(sequences.values()) <= 2048
    whole = corpus_pipeline.run(spark, FOLDER).select("doc_id", "piece", "length").collect()
    assert sorted(map(tuple, whole)) == sorted((r["doc_id"], r["piece"], r["length"]) for r in packed)


def test_quick_expressions_cut_the_same(spark):
    """Those for Spark take and leave what the plain ones do, and do not replace a space by a space."""
    rnd = random.Random(5)
    bits = ["<", ">", "</", "<!--", "-->", "<script", "</script >", "<p>", " ", "  ", "\t", "\n", "\r\n", "\x0b", "a", "'", '"', "=", "!", "<style>", "</STYLE>", "<!", "<?", "/"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").repartition(4)
    blanks = r"[\x20\x09\x0B-\x0D]+"
    for plain, quick, by in [(warc.HIDDEN, warc.QUICK_HIDDEN, ""), (warc.ANY_TAG, warc.QUICK_TAG, ""), (blanks, warc.BLANK_RUN, " ")]:
        same = F.regexp_replace("t", plain, by) == F.regexp_replace("t", quick, by)
        assert rows.where(~same).count() == 0
    assert re.findall(warc.BLANK_RUN, "one two  three\tfour five") == ["  ", "\t"]
