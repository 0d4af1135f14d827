from lexigraph.llm import licenses as L

MIT = """Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"""


def found(spark, *texts):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id INT, text STRING, licenses INT, seq STRING")
    return [(r.licenses, r.license_sentences) for r in L.scan(df).orderBy("doc_id").collect()]


def test_rules(spark):
    rows = found(
        spark,
        MIT,
        APACHE,
        "Words.\n***\nReleased under the MIT License.\nMore words",
        "LICENSED UNDER CC BY-NC 4.0! This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the Apache License, Version 2.0. Licensed under the Apache License, Version 2.0.",
        "This licence is not known.",
        "",
        None,
    )
    assert rows == [
        (["MIT"], 2),
        (["Apache-2.0"], 2),
        (["MIT"], 1),
        (["GPL-3.0", "CC-BY-NC-4.0"], 2),
        (["Apache-2.0"], 2),
        ([], 0),
        ([], 0),
        ([], 0),
    ]


def test_rules_name_known_sentences():
    assert all(s in L.SENTENCES for _, seq in L.RULES for s in seq)
    seqs = [seq for _, seq in L.RULES]
    # A rule that contains another comes before it.
    for i, a in enumerate(seqs):
        assert not any(set(a) < set(b) for b in seqs[i + 1 :])


def test_odd_rows(docs, empty):
    out = L.scan(docs)
    assert out.columns == [*docs.columns, "licenses", "license_sentences"]
    assert all(r.licenses == [] for r in out.collect())
    assert L.scan(empty).collect() == []


# Headers as their licences publish them.
AS_PUBLISHED = {
    "MIT": MIT,
    "Apache-2.0": """Copyright 2021 Someone

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
""",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
""",
    "LGPL-2.1-or-later": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.
""",
    "AGPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as
published by the Free Software Foundation, either version 3 of the
License, or (at your option) any later version.
""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
""",
    "ISC": """Copyright (c) 2019, Someone

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
""",
    "BSD-3-Clause": """Copyright (c) 2018, Someone
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
   this software without specific prior written permission.
""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

* Redistributions of source code must retain the above copyright notice, this
  list of conditions and the following disclaimer.

* Redistributions in binary form must reproduce the above copyright notice,
  this list of conditions and the following disclaimer in the documentation
  and/or other materials provided with the distribution.
""",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.\n(See accompanying file LICENSE_1_0.txt)\n",
    "Unlicense": "This is free and unencumbered software released into the public domain.\n",
}


def commented(text, first, mark, last):
    return first + "".join(f"{mark} {line}".rstrip() + "\n" for line in text.splitlines()) + last + "code = 1\n"


def test_published_headers_plain_and_commented(spark):
    forms = [("", "", ""), ("", "#", ""), ("/*\n", " *", " */\n"), ("", "//", ""), ("", ";;", ""), ("", "--", ""), ("<!--\n", "", "-->\n")]
    cases = [(name, commented(text, *form)) for name, text in AS_PUBLISHED.items() for form in forms]
    cases += [(name, commented(text, "", "#", "").replace("\n", "\r\n")) for name, text in AS_PUBLISHED.items()]
    assert [r[0] for r in found(spark, *(t for _, t in cases))] == [[name] for name, _ in cases]


def test_tags(spark):
    rows = found(
        spark,
        "# SPDX-License-Identifier: MIT\nx = 1",
        "/* SPDX-License-Identifier: (GPL-2.0-only OR BSD-3-Clause) */\nint x;",
        "// SPDX-License-Identifier: Apache-2.0 WITH LLVM-exception\n",
        "// SPDX-License-Identifier: LicenseRef-own\n",
        "SPDX-License-Identifier: MIT\n\n" + MIT,
    )
    assert rows == [(["MIT"], 1), (["BSD-3-Clause", "GPL-2.0-only"], 2), (["Apache-2.0"], 1), ([], 0), (["MIT"], 3)]


def test_every_rule_can_fire(spark):
    known = {**L.SENTENCES, **{name: f"x\nSPDX-License-Identifier: {name}\nx" for name in L.SPDX}}
    texts = [".\n".join(known[s] for s in seq) for _, seq in L.RULES + L.TAG_RULES]
    assert [r[0] for r in found(spark, *texts)] == [[name] for name, _ in L.RULES + L.TAG_RULES]


def test_long_lines_of_marks(spark):
    text = "* " * 50_000 + "\n" * 50_000 + "1. " * 50_000 + "\n# Released under the MIT License.\n" + "#\n" * 50_000
    assert found(spark, text) == [(["MIT"], 1)]
