"""Licence scans."""

import re
import warnings

import pytest
from pyspark.sql import functions as F

from rolodeck.llm import licences as L


def form(template):
    """A sentence that a template stands for: each option left out, each choice the first, each variable part two words."""
    out = template.replace("[^|~]+", "mit").replace("[^|~]*", " some words ")
    while (new := re.sub(r"\((\?:)?([^()|]*)(\|[^()]*)?\)([?*])?", lambda m: "" if m[4] else m[2], out)) != out:
        out = new
    return L.normalised(re.sub(r".\?", lambda m: "" if m[0] != " ?" else " ", out).replace("<>", "jo doe"))


def test_every_sentence_with_a_licence_has_an_anchor():
    """Of each rule the first sentence that it must have, and all references."""
    named = {next(x for x in seq.split() if not x.endswith("?")) for _, seq, _ in [*L.RULES, *L.LONE]}
    for name, template in L.SENTENCES:
        said = form(template)
        assert re.fullmatch(L._pattern(template, " "), said), (template, said)
        if name.startswith("Ref:") or name in named:
            assert re.search(L.ANCHORS, said), said


def test_rules_use_known_identifiers():
    known = {k for k, _ in L.SENTENCES}
    assert all({x.rstrip("?") for x in seq.split()} | set(bad.split()) <= known for _, seq, bad in [*L.RULES, *L.LONE])


def plain(text):
    """The scan, with Python's patterns and lists."""
    warnings.simplefilter("ignore", FutureWarning)  # of brackets in patterns
    low = (text or "").lower().replace("licence", "license")
    if not re.search(L.ANCHORS, (text or "").lower()):
        return [], [], 0
    low = low.replace(L.TAG, "spdx license identifier ")
    low = re.sub(r"(?a)" + L.SHORT, "\\1\n", low)
    low = re.sub(r"[^a-z0-9\n]+", " ", re.sub(L.ITEM, "\n\n", re.sub(r"[.;:!?]+([ \t\n\r\f]|\Z)", "\n\n", low)))
    low = re.sub(r" ?\n ?", "~", re.sub(r" ?\n ?\n[ \n]*", "|", low)).strip(" ")
    low = re.sub("[ ~]all[ ~]rights[ ~]reserved", "|all rights reserved", low)
    ids, at = [], 0
    starts = sorted({0, *(m.end() for m in re.finditer(r"[|~]", low))})
    for start in starts:
        if start < at:
            continue
        for name, template in L.SENTENCES:
            m = re.compile(f"({L._pattern(template, '[ ~]')})(?=[|~]|$)").match(low, start)
            if m:
                said = m[1].replace("~", " ")
                first = next(k for k, t in L.SENTENCES if re.fullmatch(L._pattern(t, " "), said))
                ids.append("Spdx:" + said[len("spdx license identifier ") :] if first == "Spdx" else first)
                at = m.end() + 1 if m.end() > start else start
                break
    known = {L._tagged(x): x for x in L.SPDX}
    found = [known.get(p, p) for i in ids if i.startswith("Spdx:") for p in re.split(" (?:or|and) ", i[5:].replace(" or later", "-or-later"))] + [i[4:] for i in ids if i.startswith("Ref:")]
    rest = list(ids)
    for group, alone in ((L.RULES, False), (L.LONE, True)):
        for name, seq, bad in group:
            if alone and found:
                continue
            spans, i = [], 0
            while i < len(rest):
                j = i
                for x in seq.split():
                    if j < len(rest) and rest[j] == x.rstrip("?"):
                        j += 1
                    elif not x.endswith("?"):
                        j = i
                        break
                if j > i:
                    spans.append((i, j))
                i = max(j, i + 1)
            if not spans or bad and any(set(rest[j : j + 4]) & set(bad.split()) for _, j in spans):
                continue
            for i, j in reversed(spans):
                del rest[i:j]
            found.append(name)
    return ids, sorted(set(found)), sum(not re.match(L._QUIET, r) for r in rest)


TEXTS = [
    None,
    "",
    "No licence here.",
    "Nothing of the kind.",
    "Released under the MIT License.",
    "Text before. Released under the MIT License!\nLicensed under the Apache License, Version 2.0.\n\nYou may not use this file except in compliance with the License.",
    'Licensed under the Apache License, Version 2.0 (the "License"). You may not use this file except in compliance with the License. You may obtain a copy of the License at: x',
    "SPDX-License-Identifier: Apache-2.0",
    "SPDX-License-Identifier: (MIT OR GPL-2.0-or-later)",
    "SPDX-License-Identifier: my own",
    "Copyright (c) 2020 Acme. All rights reserved.",
    "Copyright 2020 Acme Inc. All rights reserved.",
    "Copyright 2020 Acme Inc. All rights reserved. Released under the MIT License.",
    "All rights reserved.",
    "This program is free software: you can redistribute it",
    "Permission is hereby granted, free of charge, to any person",
    "word " * 20_000 + ". This work is licensed under the GNU General Public License, version 3. " + "word " * 20_000,
    "Released under the MIT License. Released under the MIT License.",
    "Neither the name of Jo Doe nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
]


def test_against_brute_force(spark):
    rows = [(i, t) for i, t in enumerate([*TEXTS, *[t for t, _, _ in CASES]])] + [(1, None)]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    got = sorted(L.scan(df).collect(), key=lambda r: r.doc_id)
    for r in got:
        assert (r.sentence_ids, sorted(r.licences), r.unmatched) == plain(r.text), r.text
    assert len(got) == len(rows)


def test_against_sql(spark, tmp_path):
    """The query's SQL over the same texts, wrapped sentences and variable parts among them."""
    from ..compare import database, normal

    spark.createDataFrame([(i, t) for i, t in enumerate([*TEXTS, *[t for t, _, _ in CASES]])], "doc_id int, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    from rolodeck.llm import queries as Q

    ours = Q.op4_licence_scan(spark, str(tmp_path)).toPandas()
    [file] = (tmp_path / "documents.parquet").glob("*.parquet")
    (tmp_path / "sql").mkdir()
    file.rename(tmp_path / "sql" / "documents.parquet")
    assert normal(ours) == normal(database(str(tmp_path / "sql")).sql(L.oracle()).df())


def test_anchors_lose_nothing(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    a, b = (df.select(L.sentence_ids(F.col("text"), anchors=x).alias("v")).collect() for x in (L.ANCHORS, None))
    assert a == b


def test_gaps_between_words(spark):
    """Each known sentence as a text's only one, whatever stands between its words."""
    known = [(k, form(t)) for k, t in L.SENTENCES if k not in ("Spdx", "Copyright", "?endorse", "?license") and not k.startswith(("Only", "Note:"))]
    df = spark.createDataFrame([(n, said.replace(" ", gap)) for n, (_, said) in enumerate(known) for gap in ("  ", "\t", "\u00a0", "-", "\n")], "n int, text string")
    for r in df.select("n", "text", L.sentence_ids(F.col("text"), anchors=None).alias("v")).collect():
        assert r.v == [known[r.n][0]], (r.text, known[r.n])


def test_clash_and_empty(spark):
    df = spark.createDataFrame([], "text string, Licences int")
    with pytest.raises(ValueError):
        L.scan(df)
    assert L.scan(df, into=("a", "b", "c")).count() == 0


MIT = """MIT License

Copyright (c) 2021 Jo Doe

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
BSD2 = """Copyright (c) 2021, Jo Doe
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
APACHE = """Copyright 2021 Jo Doe

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
"""
GPL3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.
"""
GPL2 = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.
"""


ISC = """Copyright (c) 2021, Jo Doe <jo@doe.example>

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.
"""
LGPL21 = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
Lesser General Public License for more details.
"""
AGPL3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as
published by the Free Software Foundation, either version 3 of the
License, or (at your option) any later version.
"""
GPL2_ONLY = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; version 2 of the License.
"""
GPL2_ONLY_OTHER = """This program is free software; you can redistribute it and/or modify it
under the terms of version 2 of the GNU General Public License as
published by the Free Software Foundation.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/.
"""
ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software. If you use this software
   in a product, an acknowledgment in the product documentation would be
   appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be
   misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.
"""
BOOST = """Distributed under the Boost Software License, Version 1.0.
(See accompanying file LICENSE_1_0.txt or copy at
https://www.boost.org/LICENSE_1_0.txt)
"""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.
"""
CC0 = """To the extent possible under law, Jo Doe has waived all copyright and
related or neighboring rights to this work.
"""
BSD4 = BSD2 + """
3. All advertising materials mentioning features or use of this software
   must display the following acknowledgement:
     This product includes software developed by the University of Somewhere.

4. Neither the name of the University nor the names of its contributors may be
   used to endorse or promote products derived from this software without
   specific prior written permission.
"""
HOLDERS = ["the copyright holder", "Google Inc.", "the University of California, Berkeley", "the ORGANIZATION", "Jo Doe", "Acme Co. Ltd.", "The R. and D. Group"]


def held(holder):
    """The third clause of a BSD licence, wrapped as one finds it."""
    import textwrap

    said = f"3. Neither the name of {holder} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    return BSD2 + "\n" + "\n".join(textwrap.wrap(said, 60, subsequent_indent="   ")) + "\n"


def commented(text, mark):
    return "".join(f"{mark}{line}\n" for line in text.splitlines())


def cases():
    """(text, licences, unmatched), written by hand: verbatim, wrapped, in comments, on one line a paragraph, and with other list marks."""
    want = [
        (MIT, ["MIT"], 1), (BSD2, ["BSD-2-Clause"], 0), (BSD3, ["BSD-3-Clause"], 0), (BSD4, ["BSD-4-Clause"], 0), (APACHE, ["Apache-2.0"], 1), (GPL3, ["GPL-3.0-or-later"], 0), (GPL2, ["GPL-2.0-or-later"], 0), (ISC, ["ISC"], 1),
        (LGPL21, ["LGPL-2.1-or-later"], 0), (AGPL3, ["AGPL-3.0-or-later"], 0), (GPL2_ONLY, ["GPL-2.0-only"], 0), (GPL2_ONLY_OTHER, ["GPL-2.0-only"], 0), (MPL, ["MPL-2.0"], 0), (ZLIB, ["Zlib"], 0), (BOOST, ["BSL-1.0"], 0), (UNLICENSE, ["Unlicense"], 0), (CC0, ["CC0-1.0"], 0),
        *[(held(h), ["BSD-3-Clause"], 0) for h in HOLDERS],
    ]
    out = []
    for text, names, left in want:
        forms = [text, text.replace("\n", "\r\n"), *(commented(text, m) for m in (" * ", "# ", "// ", "-- ")), "Prose\nbefore it\n\n" + text + "\nand after", re.sub(r"(?<!\n)\n(?!\n|All)", " ", text)]
        out += [(f, names, left) for f in forms + [re.sub(r"(?m)^(\d)\.", r"\1)", text), re.sub(r"(?m)^\d\.", "*", text)]]
    ref = lambda said, *names: (f"A title\nLicensed under {said}.\nmore words", list(names), 0)
    odd = BSD2 + "\n3. You must not use our names to promote products without asking.\n"
    return out + [
        ("A title\nReleased under the MIT License\nmore words", ["MIT"], 0),
        ("Released under the\n\nMIT License", [], 0),
        ("Foo is not released under the\nMIT License", [], 0),
        (MIT.replace("to deal\nin", "to trade\nin"), [], 6),
        (odd, [], 6),
        (odd + "\n\n" + BSD3, ["BSD-3-Clause"], 6),
        ("Copyright 2020 Acme Inc. All rights reserved.", ["Proprietary"], 0),
        ("Copyright 2020 Acme Inc. All rights reserved. Released under the MIT licence.", ["MIT"], 2),
        ("SPDX-License-Identifier: (MIT OR GPL-2.0-or-later)", ["MIT", "GPL-2.0-or-later"], 0),
        ref("the Creative Commons Attribution 4.0 International License", "CC-BY-4.0"),
        ref("a Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported License", "CC-BY-NC-SA-3.0"),
        ref("CC BY-NC 4.0", "CC-BY-NC-4.0"), ref("CC BY-SA 4.0", "CC-BY-SA-4.0"), ref("CC BY 4.0", "CC-BY-4.0"), ref("CC0 1.0 Universal", "CC0-1.0"), ref("the CC0", "CC0-1.0"),
        ref("the GNU General Public License, version 2", "GPL-2.0-only"), ref("the GNU GPL v3 or later", "GPL-3.0-or-later"), ref("the GPLv2", "GPL-2.0-only"), ref("the terms of the GNU Lesser General Public License version 2.1", "LGPL-2.1-only"), ref("AGPL v3", "AGPL-3.0-only"),
        ref("the ISC License", "ISC"), ref("the zlib License", "Zlib"), ref("the Unlicense", "Unlicense"), ref("the Boost Software License 1.0", "BSL-1.0"), ref("the 3-clause BSD license", "BSD-3-Clause"), ref("the simplified BSD license", "BSD-2-Clause"), ref("the Mozilla Public License, v. 2.0", "MPL-2.0"), ref("the Eclipse Public License v2.0", "EPL-2.0"),
    ]


CASES = cases()


def test_original_texts(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(CASES)], "doc_id int, text string")
    wrong = []
    for r in L.scan(df).collect():
        if (r.licences, r.unmatched) != CASES[r.doc_id][1:]:
            wrong.append((r.licences, r.unmatched, *CASES[r.doc_id][1:], r.sentence_ids, r.text))
    assert not wrong, (len(wrong), wrong[:6])
