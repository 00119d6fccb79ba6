"""Licence scan against a loop over sentences and against its SQL."""

import re

import duckdb

from placeweave.llm import licenses

BSD3 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
{}. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer.
{}. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.
Neither the name of the copyright holder nor the names of its contributors may be used to endorse
or promote products derived from this software without specific prior written permission."""


def brute(text):
    cut = re.sub(r"[.!?]+([\x20\x09-\x0d]|\Z)", "\x01\\1", text or "")
    cut = re.sub(r"\n([^a-z]|\Z)", "\x01\\1", cut)
    found = [re.sub("[^A-Za-z0-9]+", " ", s).lower().strip() for s in cut.split("\x01")]
    found = [s for s in found if s]
    by = {s: i for i, s in licenses.SENTENCES.items()}
    ids = [by[s] for s in found if s in by]
    names = set()
    for name, rule in licenses.RULES:
        for at in range(len(ids) - len(rule) + 1):
            if tuple(ids[at : at + len(rule)]) == rule:
                names.add((name, rule))
    return len(found), len(ids), ids, names


def run(spark, documents, rows):
    docs = documents(rows)
    got = licenses.scan_licenses(docs).collect()
    table = docs.toPandas()
    con = duckdb.connect()
    con.register("documents", table)
    want = con.execute(licenses.oracle_sql()).fetchall()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    norm = lambda r: (None if r[0] is None or r[0] != r[0] else int(r[0]), *r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(map(norm, want), key=key)
    return got


def test_against_brute_force_and_sql(spark, documents, odd_rows):
    rows = [
        *odd_rows,
        (20, "Text.\nReleased under the MIT License.\nMore text.", "en", "s"),
        (21, "Licensed under CC BY-NC 4.0. Licensed under the Apache License, Version 2.0.", "en", "s"),
        (22, "this work is licensed under the GNU General Public License, version 3", "en", "s"),
        (23, BSD3.format("\n", "\n"), "en", "s"),
        (24, BSD3.split("Neither")[0].format("-", "-"), "en", "s"),
        (25, "A licence is mentioned. MIT is a school.\x01 Licensed under!", "en", "s"),
        (26, "SPDX-License-Identifier: MIT\n\n\nSPDX-License-Identifier: Apache-2.0\nPlain", "en", "s"),
    ]
    got = {(r.doc_id, r.n_sentences): r for r in run(spark, documents, rows)}
    for doc, text, _, _ in rows:
        n, known, ids, names = brute(text)
        r = got[(doc, n)]
        assert (r.n_known, r.sequence) == (known, "|" + "".join(i + "|" for i in ids))
        assert set(filter(None, r.licences.split(","))) <= {name for name, _ in names}
    by = {r.doc_id: r.licences for r in got.values()}
    assert by[20] == "MIT" and by[21] == "Apache-2.0,CC-BY-NC-4.0" and by[22] == "GPL-3.0"
    assert by[23] == "BSD-3-Clause" and by[24] == "BSD-2-Clause" and by[25] == ""
    assert by[26] == "Apache-2.0,MIT"


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
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
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM."""
APACHE = """Copyright 2020 Someone

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
ASF = """Licensed to the Apache Software Foundation (ASF) under one or more
contributor license agreements.  See the NOTICE file distributed with
this work for additional information regarding copyright ownership.
The ASF licenses this file to You under the Apache License, Version 2.0
(the "License"); you may not use this file except in compliance with
""" + APACHE.split("compliance with ")[1].replace("http:", "https:")
BSD2_TEXT = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3_TEXT = BSD2_TEXT + """
3. Neither the name of the University of Somewhere nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version {} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""


def test_published_texts_in_every_layout(documents):
    texts = {
        "MIT": MIT,
        "Apache-2.0": APACHE,
        "Apache-2.0 ": ASF,
        "BSD-2-Clause": BSD2_TEXT,
        "BSD-3-Clause": BSD3_TEXT,
        "GPL-3.0-or-later": GPL.format(3),
        "GPL-2.0-or-later": GPL.format(2).replace("software:", "software;"),
        "MIT,Apache-2.0": MIT + "\n\n" + APACHE,
        "BSD-2-Clause,BSD-3-Clause": BSD3_TEXT + "\n\n" + BSD2_TEXT,
    }
    layouts = [
        lambda t: t,
        lambda t: t.replace("\n", "\r\n"),
        lambda t: re.sub("(?<!\n)\n(?!\n)", " ", t),
        lambda t: "\n".join("    " + line for line in t.split("\n")),
        lambda t: "#!/bin/sh\n" + "\n".join("# " + line for line in t.split("\n")) + "\nexit 0",
        lambda t: "\n".join("// " + line for line in t.split("\n")),
        lambda t: "/*\n" + "\n".join(" * " + line for line in t.split("\n")) + "\n */\nint x;",
        lambda t: "\n".join("dnl " + line for line in t.split("\n")),
    ]
    rows, want = [], {}
    for name, text in texts.items():
        for layout in layouts:
            want[len(rows)] = sorted(name.strip().split(","))
            rows.append((len(rows), layout(text), "en", "s"))
    want[len(rows)] = ["MIT"]
    rows.append((len(rows), "MIT License\n\nCopyright (c) 2020 Someone", "en", "s"))
    want[len(rows)] = []
    rows.append((len(rows), "Permission is hereby granted to read. The MIT License is short; so is BSD.", "en", "s"))
    got = {r.doc_id: r.licences for r in licenses.scan_licenses(documents(rows)).collect()}
    assert {k: v for k, v in got.items() if v != ",".join(want[k])} == {}


def test_empty_table(documents):
    assert licenses.scan_licenses(documents([])).collect() == []
