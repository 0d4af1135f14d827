"""Licence scan by sentence rules.

Marks of comments and bullets are taken off the starts of lines, so that an empty comment line
is a blank one, and a list number at a line's start ends the sentence before it. The text is
then cut into sentences twice, once with line breaks as ends and once with single line
breaks as spaces, as licence texts may be wrapped. Sentences are normalised to lower-case
ASCII words and looked up among known licence sentences; each text becomes a sequence of
sentence numbers (0: unknown), followed by the numbers of the identifiers in its SPDX tags.
Rules are tried in order, longer ones first; a rule's numbers must follow each other, and
sentences it has used are not used by later rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

# Licence sentences, normalised (lower case, words joined by one space).
SENTENCES = {
    "mit_release": "released under the mit license",
    "mit_licensed": "licensed under the mit license",
    "mit_grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit_notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "as_is_upper": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "no_liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "apache_2": "licensed under the apache license version 2.0",
    "apache_2_the": "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license",
    "apache_obtain": "you may obtain a copy of the license at http www.apache.org licenses license 2.0",
    "apache_unless": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "gpl_3": "this work is licensed under the gnu general public license version 3",
    "gpl_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl_2_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl_hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl_details": "see the gnu general public license for more details",
    "cc_by_nc_4": "licensed under cc by nc 4.0",
    "cc_by_4": "licensed under cc by 4.0",
    "cc_by_sa_4": "licensed under cc by sa 4.0",
    "cc_by_4_long": "this work is licensed under a creative commons attribution 4.0 international license",
    "cc_by_nc_4_long": "this work is licensed under a creative commons attribution noncommercial 4.0 international license",
    "bsd_grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "isc_grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "mpl_2": "this source code form is subject to the terms of the mozilla public license v 2.0",
    "mpl_obtain": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla.org mpl 2.0",
    "mpl_obtain_http": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla.org mpl 2.0",
    "apache_obtain_at": "you may obtain a copy of the license at",
    "apache_url": "http www.apache.org licenses license 2.0",
    "apache_url_https": "https www.apache.org licenses license 2.0",
    "apache_see": "see the license for the specific language governing permissions and limitations under the license",
    "gpl_2_comma": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 or at your option any later version",
    "gpl_2_only": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "lgpl_21_free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2.1 of the license or at your option any later version",
    "lgpl_3_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl_hope": "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "lgpl_details": "see the gnu lesser general public license for more details",
    "agpl_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl_details": "see the gnu affero general public license for more details",
    "bsd_source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd_binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd_endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd_style": "use of this source code is governed by a bsd style license that can be found in the license file",
    "mit_style": "use of this source code is governed by an mit style license that can be found in the license file",
    "isc_grant_old": "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "boost_1": "distributed under the boost software license version 1.0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "zlib": "this software is provided as is without any express or implied warranty",
    "cc0": "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide",
}

# Identifiers that SPDX tags name.
SPDX = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0",
    "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0", "GPL-2.0+", "GPL-2.0-only",
    "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0+", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1",
    "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense", "Zlib",
)

# Ordered rules, each a licence and the sentences that must follow each other.
RULES = [
    ("MIT", ("mit_grant", "mit_notice", "as_is_upper", "no_liability")),
    ("MIT", ("mit_grant", "mit_notice", "as_is_upper")),
    ("MIT", ("mit_grant", "mit_notice")),
    ("MIT", ("mit_release",)),
    ("MIT", ("mit_licensed",)),
    ("MIT", ("mit_grant",)),
    ("MIT", ("mit_style",)),
    ("Apache-2.0", ("apache_2_the", "apache_obtain_at", "apache_url", "apache_unless", "apache_see")),
    ("Apache-2.0", ("apache_2_the", "apache_obtain_at", "apache_url_https", "apache_unless", "apache_see")),
    ("Apache-2.0", ("apache_2_the", "apache_obtain", "apache_unless")),
    ("Apache-2.0", ("apache_2_the",)),
    ("Apache-2.0", ("apache_2",)),
    ("GPL-3.0-or-later", ("gpl_free", "gpl_hope", "gpl_details")),
    ("GPL-3.0-or-later", ("gpl_free",)),
    ("GPL-2.0-or-later", ("gpl_2_free", "gpl_hope", "gpl_details")),
    ("GPL-2.0-or-later", ("gpl_2_free",)),
    ("GPL-2.0-or-later", ("gpl_2_comma", "gpl_hope", "gpl_details")),
    ("GPL-2.0-or-later", ("gpl_2_comma",)),
    ("GPL-2.0-only", ("gpl_2_only", "gpl_hope", "gpl_details")),
    ("GPL-2.0-only", ("gpl_2_only",)),
    ("LGPL-2.1-or-later", ("lgpl_21_free", "lgpl_hope", "lgpl_details")),
    ("LGPL-2.1-or-later", ("lgpl_21_free",)),
    ("LGPL-3.0-or-later", ("lgpl_3_free", "gpl_hope", "lgpl_details")),
    ("LGPL-3.0-or-later", ("lgpl_3_free",)),
    ("AGPL-3.0-or-later", ("agpl_free", "gpl_hope", "agpl_details")),
    ("AGPL-3.0-or-later", ("agpl_free",)),
    ("GPL-3.0", ("gpl_3",)),
    ("CC-BY-NC-4.0", ("cc_by_nc_4",)),
    ("CC-BY-NC-4.0", ("cc_by_nc_4_long",)),
    ("CC-BY-SA-4.0", ("cc_by_sa_4",)),
    ("CC-BY-4.0", ("cc_by_4",)),
    ("CC-BY-4.0", ("cc_by_4_long",)),
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary")),
    ("BSD", ("bsd_grant",)),
    ("BSD", ("bsd_style",)),
    ("ISC", ("isc_grant",)),
    ("ISC", ("isc_grant_old",)),
    ("MPL-2.0", ("mpl_2", "mpl_obtain")),
    ("MPL-2.0", ("mpl_2", "mpl_obtain_http")),
    ("MPL-2.0", ("mpl_2",)),
    ("BSL-1.0", ("boost_1",)),
    ("Unlicense", ("unlicense",)),
    ("Zlib", ("zlib",)),
    ("CC0-1.0", ("cc0",)),
]
TAG_RULES = [(name, (name,)) for name in SPDX]

# Identifiers are numbered after the sentences.
NUMBER = {name: i for i, name in enumerate((*SENTENCES, *SPDX), 1)}

# Steps before the cut, each a pattern and what its groups become: comment marks and bullets;
# numbers of a list; the version after "v.", whose point ends no sentence.
LINE_STARTS = (r"(^|\n)[ \t*/#;%<>!\"-]+", "{1}")
LIST_NUMBERS = (r"\n[ \t]*\(?(?:[0-9]{1,2}|[a-z])[.)][ \t]+", "\n\n")
VERSIONS = (r"([ \t-\r])v\.[ \t-\r]+([0-9])", "{1}v {2}")
STEPS = (LINE_STARTS, LIST_NUMBERS, VERSIONS)
LINE_ENDS = r"[.!?]+[ \t-\r]+|[\n\r]+"
WRAPPED_ENDS = r"[.!?]+[ \t-\r]+|\n[ \t\r]*\n[ \t-\r]*"
TAG = r"spdx-license-identifier:[ \t]*([^\n\r]*)"
TAG_WORDS = r"[^a-z0-9.+-]+"


def bare(text: Column) -> Column:
    """Lower-case text without comment marks and list numbers at the starts of its lines."""
    text = F.lower(text)
    for pattern, to in STEPS:
        text = F.regexp_replace(text, pattern, to.format("", "$1", "$2"))
    return text


def sentences(text: Column, wrapped: bool) -> Column:
    """Normalised sentences of a bare text. ``wrapped``: only full stops and blank lines end one."""
    marked = F.regexp_replace(text, WRAPPED_ENDS if wrapped else LINE_ENDS, "\u0001")
    found = F.transform(
        F.split(F.regexp_replace(marked, "[^a-z0-9.\u0001]+", " "), "\u0001"), lambda s: F.btrim(s, F.lit(" ."))
    )
    return F.filter(found, lambda s: s != "")


def numbers(found: Column) -> Column:
    """``,0,3,4,0,``: the sentences' numbers, runs of unknown ones as one 0."""
    known = F.array(*(F.lit(s) for s in SENTENCES.values()))
    ids = F.transform(found, lambda s: F.array_position(known, s).cast("string"))
    return F.regexp_replace(F.concat(F.lit(","), F.array_join(ids, ","), F.lit(",")), "(,0)+,", ",0,")


def tags(text: Column) -> Column:
    """``0,31,0,40,0``: the numbers of the identifiers in the SPDX tags of a lower-case text."""
    known = F.array(*(F.lit(name.lower()) for name in SPDX))
    words = F.flatten(F.transform(F.regexp_extract_all(text, F.lit(TAG), F.lit(1)), lambda t: F.split(t, TAG_WORDS)))
    named = F.filter(F.transform(words, lambda w: F.array_position(known, w)), lambda n: n > 0)
    ids = F.transform(named, lambda n: F.concat((n + len(SENTENCES)).cast("string"), F.lit(",0,")))
    return F.concat(F.lit("0,"), F.array_join(ids, ""))


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` with ``licenses`` (identifiers in rule order, each once) and ``license_sentences``.

    ``license_sentences`` counts known sentences (of the cut that has more of them) and SPDX
    identifiers. Null and empty texts have none; each row is looked at by itself, repeated or not,
    and an empty table has no rows. Columns of ``docs`` with these names are replaced.
    """
    own = [c for c in docs.columns if c not in ("licenses", "license_sentences")]
    rules = F.array(
        *(
            F.struct(F.lit(name).alias("name"), F.lit("," + ",".join(str(NUMBER[s]) for s in seq) + ",").alias("seq"))
            for name, seq in RULES + TAG_RULES
        )
    )
    texts = docs.select(F.struct(*own).alias("__row"), bare(text_or_empty()).alias("__text"))
    lines, flowing = (numbers(sentences(F.col("__text"), wrapped)) for wrapped in (False, True))
    rows = texts.select("__row", lines.alias("__lines"), flowing.alias("__flow"), tags(F.col("__text")).alias("__tags"))
    by_lines, by_flow, by_tags = (F.regexp_count(c, F.lit("[1-9][0-9]*")) for c in ("__lines", "__flow", "__tags"))
    nothing = F.array().cast("array<string>")

    def apply(state: Column, rule: Column) -> Column:
        hit = F.contains(state["seq"], rule["seq"])
        names = F.when(hit, F.array_append(state["names"], rule["name"])).otherwise(state["names"])
        seq = F.when(hit, F.replace(state["seq"], rule["seq"], F.lit(",0,"))).otherwise(state["seq"])
        return F.struct(seq.alias("seq"), names.alias("names"))

    start = F.struct(F.concat("__lines", F.lit("0"), "__flow", "__tags").alias("seq"), nothing.alias("names"))
    matched = F.aggregate(rules, start, apply)["names"]
    count = (F.greatest(by_lines, by_flow) + by_tags).cast("bigint")
    return rows.select(
        "__row.*",
        F.when(count > 0, F.array_distinct(matched)).otherwise(nothing).alias("licenses"),
        count.alias("license_sentences"),
    )
