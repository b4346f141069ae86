"""Licence texts and notices as projects carry them: wrapped, unwrapped and in comment marks."""

from __future__ import annotations

import textwrap

import duckdb
import pytest

from loadlake.llm import licenses
from loadlake.llm.queries import license_sql

# Texts of licences and notices.
MIT = [
    "MIT License",
    "Copyright (c) 2021 Jo Doe",
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
]
BSD_2 = [
    "Copyright (c) 2019, Jo Doe. All rights reserved.",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
]
BSD_3 = [
    *BSD_2,
    "3. Neither the name of Acme, Inc. nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
]
DISCLAIMER = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.'
APACHE = [
    "Copyright 2020 Jo Doe",
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at',
    "http://www.apache.org/licenses/LICENSE-2.0",
    'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
]
GPL_3 = [
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
]
GPL_2 = [
    "Foo is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
]
LGPL = [
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
]
AGPL = [GPL_3[0].replace("General", "Affero General")]
MPL = [
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
]
ISC = [
    'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.',
]
APACHE_TEXT = ["Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/", "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"]
GPL_3_TEXT = ["GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007", "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."]
TEXTS = {
    "MIT": MIT, "BSD-2-Clause": [*BSD_2, DISCLAIMER], "BSD-3-Clause": [*BSD_3, DISCLAIMER], "Apache-2.0": APACHE, "GPL-3.0-or-later": GPL_3,
    "GPL-2.0-or-later": GPL_2, "LGPL-2.1-or-later": LGPL, "AGPL-3.0-or-later": AGPL, "MPL-2.0": MPL, "ISC": ISC, "GPL-3.0": GPL_3_TEXT,
}
CLEAN = [
    "Permission was granted to the driver, free of charge. The above notice stays.\nRedistribution of income is a topic of the day.",
    "The licence of the driver was taken away.\n\n# Heading\n- one\n- two; three",
    "Software is provided as is.",
]


def block(lines: list[str], mark: str) -> str:
    body = "\n".join((mark + line).rstrip() for line in lines)
    return f"/*\n{body}\n */\nint main() {{}}" if mark == " * " else f"{body}\ncode"


def forms(parts: list[str]) -> dict[str, str]:
    paragraphs = [part if "\n" in part else textwrap.fill(part, 74) for part in parts]
    wrapped = "\n\n".join(paragraphs)
    lines = wrapped.split("\n")
    return {
        "unwrapped": "\n\n".join(parts),
        "a line each": "\n".join(parts),
        "wrapped": wrapped,
        "carriage returns": wrapped.replace("\n", "\r\n"),
        **{mark: block(lines, mark) for mark in (" * ", "// ", "# ", "-- ", ";; ", "% ")},
    }


@pytest.fixture(scope="module")
def table(spark):
    named = [(licence, form, text) for licence, parts in TEXTS.items() for form, text in forms(parts).items()]
    named += [("Apache-2.0", *form) for form in forms(APACHE_TEXT).items()]
    named += [("", "clean", text) for text in CLEAN]
    named += [("", "blank", t) for t in ("", " ", "\n\n")]
    named += [("", "NULL", None)]
    return [(i, *row) for i, row in enumerate(named)]


def test_real_texts_are_found_and_clean_ones_are_not(spark, table):
    docs = spark.createDataFrame([(i, text) for i, _, _, text in table], "doc_id long, text string")
    got = {r["doc_id"]: r["licenses"] for r in licenses.scanned(docs).collect()}
    assert [(licence, form, got[i]) for i, licence, form, _ in table if got[i] != licence] == []


def test_the_same_in_sql(spark, table):
    rows = [(i, text) for i, _, _, text in table]
    got = licenses.scanned(spark.createDataFrame(rows, "doc_id long, text string"))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = con.execute(license_sql())
    columns = [c[0] for c in want.description]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want.fetchall())


@pytest.mark.parametrize("unit", ["\n", " ", ".", "; ", "# \n", "copyright ", "a\n", "1. ", "is free software "])
def test_very_long_texts(spark, unit):
    text = unit * (1_000_000 // len(unit)) + "\n\nReleased under the MIT License."
    docs = spark.createDataFrame([(1, text, "x"), (1, text, "x"), (None, None, "y")], "doc_id long, text string, licenses string")
    assert sorted(r["licenses"] for r in licenses.scanned(docs).collect()) == ["", "MIT", "MIT"]
