"""License scan by sentences. A text is normalised (lower case, everything but letters
and digits to one blank, so comment markers, wraps and punctuation vanish) and
read as a sequence of known licence sentences; the identifiers found, in text order,
are matched against ordered licence rules, longer rules first, each match using
up its identifiers. Every known sentence is in some rule. SPDX expressions are read from
their line, and every licence they name counts.

Sentences are found leftmost first, the longest of those that start at one word. A
sentence may name an organisation where the published text leaves room for one.

DataFrame functions only, one narrow pass and no shuffle: texts without any word
that every known sentence has are skipped, and the tables below are constants.
Null and empty text give no row; texts of any length are read whole; repeated rows give
their rows each; an empty table gives no rows; columns other than the id and the
text are not read."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Licence sentences as published (normalised before use), by identifier.
_GNU = ("This {what} is free software{a} you can redistribute it and/or modify it under the terms of the GNU {name} "
        "as published by the Free Software Foundation{b} either version {v} of the License, or (at your option) any later version")
_GNU_ONLY = ("This {what} is free software{a} you can redistribute it and/or modify it under the terms of the GNU {name} "
             "version {v} as published by the Free Software Foundation")
_CC = "This work is licensed under a Creative Commons {name} {v} International License"
SENTENCES = {
    "apache2-short": "Licensed under the Apache License, Version 2.0",
    "apache2-under": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "apache2-comply": "you may not use this file except in compliance with the License",
    "apache2-obtain": "You may obtain a copy of the License at",
    "apache2-basis": "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                     "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "apache2-see": "See the License for the specific language governing permissions and limitations under the License",
    "apache2-asf": "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements",
    "mit-short": "Released under the MIT License",
    "mit-short2": "Licensed under the MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
                 "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
                 "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
                  "of the Software",
    "mit-0-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                   "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
                   "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
                   "Software, and to permit persons to whom the Software is furnished to do so.",
    "gpl-work2": "This work is licensed under the GNU General Public License, version 2",
    "gpl-work3": "This work is licensed under the GNU General Public License, version 3",
    "gpl-free2": _GNU.format(what="program", a=";", name="General Public License", b=";", v="2"),
    "gpl-free3": _GNU.format(what="program", a=":", name="General Public License", b=",", v="3"),
    "gpl-only2": _GNU_ONLY.format(what="program", a=";", name="General Public License", v="2"),
    "gpl-only3": _GNU_ONLY.format(what="program", a=":", name="General Public License", v="3"),
    "lgpl-lib2": _GNU.format(what="library", a=";", name="Library General Public License", b=";", v="2"),
    "lgpl-free21": _GNU.format(what="library", a=";", name="Lesser General Public License", b=";", v="2.1"),
    "lgpl-program21": _GNU.format(what="program", a=";", name="Lesser General Public License", b=";", v="2.1"),
    "lgpl-free3": _GNU.format(what="library", a=":", name="Lesser General Public License", b=",", v="3"),
    "lgpl-program3": _GNU.format(what="program", a=":", name="Lesser General Public License", b=",", v="3"),
    "agpl-free3": _GNU.format(what="program", a=":", name="Affero General Public License", b=",", v="3"),
    "gpl-see": "See the GNU General Public License for more details",
    "lgpl-see": "See the GNU Lesser General Public License for more details",
    "lgpl-see2": "See the GNU Library General Public License for more details",
    "agpl-see": "See the GNU Affero General Public License for more details",
    "mpl2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "mpl2-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at",
    "mpl11": "The contents of this file are subject to the Mozilla Public License Version 1.1",
    "epl1": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0",
    "epl2": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "epl2-v": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v. 2.0",
    "cddl1": "The contents of this file are subject to the terms of the Common Development and Distribution License",
    "bsd-redist": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                  "the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                  "following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                  "following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                 "products derived from this software without specific prior written permission",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                 "granted, provided that the above copyright notice and this permission notice appear in all copies",
    "isc-grant2": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby "
                  "granted, provided that the above copyright notice and this permission notice appear in all copies",
    "0bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "zlib-warranty": "In no event will the authors be held liable for any damages arising from the use of this software",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
                  "alter it and redistribute it freely, subject to the following restrictions",
    "bsl1-short": "Distributed under the Boost Software License, Version 1.0",
    "bsl1-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
                  "accompanying documentation covered by this license",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "wtfpl": "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is "
             "allowed as long as the name is changed",
    "postgresql": "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, "
                  "and without a written agreement is hereby granted",
    "cc0-waiver": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to "
                  "this software to the public domain worldwide",
    "cc-nc-short": "Licensed under CC BY-NC 4.0",
    "cc-by-short": "Licensed under CC BY 4.0",
    "cc-sa-short": "Licensed under CC BY-SA 4.0",
    "cc-by-work": _CC.format(name="Attribution", v="4.0"),
    "cc-sa-work": _CC.format(name="Attribution-ShareAlike", v="4.0"),
    "cc-nc-work": _CC.format(name="Attribution-NonCommercial", v="4.0"),
    "cc-nd-work": _CC.format(name="Attribution-NoDerivatives", v="4.0"),
    "cc-ncsa-work": _CC.format(name="Attribution-NonCommercial-ShareAlike", v="4.0"),
    "cc-ncnd-work": _CC.format(name="Attribution-NonCommercial-NoDerivatives", v="4.0"),
}
# Rules of several sentences, in the order they are tried.
LONG_RULES = (
    ("Apache-2.0", ("apache2-under", "apache2-comply", "apache2-obtain", "apache2-basis", "apache2-see")),
    ("Apache-2.0", ("apache2-asf", "apache2-comply", "apache2-obtain", "apache2-basis", "apache2-see")),
    ("BSD-3-Clause", ("bsd-redist", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-redist", "bsd-source", "bsd-binary")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("GPL-2.0-or-later", ("gpl-free2", "gpl-see")),
    ("GPL-3.0-or-later", ("gpl-free3", "gpl-see")),
    ("GPL-2.0-only", ("gpl-only2", "gpl-see")),
    ("GPL-3.0-only", ("gpl-only3", "gpl-see")),
    ("LGPL-2.0-or-later", ("lgpl-lib2", "lgpl-see2")),
    ("LGPL-2.1-or-later", ("lgpl-free21", "lgpl-see")),
    ("LGPL-2.1-or-later", ("lgpl-program21", "lgpl-see")),
    ("LGPL-3.0-or-later", ("lgpl-free3", "lgpl-see")),
    ("LGPL-3.0-or-later", ("lgpl-program3", "lgpl-see")),
    ("AGPL-3.0-or-later", ("agpl-free3", "agpl-see")),
    ("MPL-2.0", ("mpl2", "mpl2-copy")),
    ("Zlib", ("zlib-warranty", "zlib-grant")),
)
# What a sentence that no longer rule used up stands for.
SINGLE = {
    "Apache-2.0": ("apache2-under", "apache2-short", "apache2-asf", "apache2-comply", "apache2-obtain", "apache2-basis", "apache2-see"),
    "MIT": ("mit-grant", "mit-short", "mit-short2", "mit-notice"),
    "MIT-0": ("mit-0-grant",),
    "GPL-1.0-or-later": ("gpl-see",),
    "GPL-2.0-or-later": ("gpl-free2",),
    "GPL-3.0-or-later": ("gpl-free3",),
    "GPL-2.0-only": ("gpl-work2", "gpl-only2"),
    "GPL-3.0-only": ("gpl-work3", "gpl-only3"),
    "LGPL-2.0-or-later": ("lgpl-lib2", "lgpl-see2", "lgpl-see"),
    "LGPL-2.1-or-later": ("lgpl-free21", "lgpl-program21"),
    "LGPL-3.0-or-later": ("lgpl-free3", "lgpl-program3"),
    "AGPL-3.0-or-later": ("agpl-free3", "agpl-see"),
    "MPL-2.0": ("mpl2", "mpl2-copy"),
    "MPL-1.1": ("mpl11",),
    "EPL-1.0": ("epl1",),
    "EPL-2.0": ("epl2", "epl2-v"),
    "CDDL-1.0": ("cddl1",),
    "BSD-2-Clause": ("bsd-redist", "bsd-source", "bsd-binary"),
    "BSD-3-Clause": ("bsd-names",),
    "ISC": ("isc-grant", "isc-grant2"),
    "0BSD": ("0bsd-grant",),
    "Zlib": ("zlib-grant", "zlib-warranty"),
    "BSL-1.0": ("bsl1-short", "bsl1-grant"),
    "Unlicense": ("unlicense",),
    "WTFPL": ("wtfpl",),
    "PostgreSQL": ("postgresql",),
    "CC0-1.0": ("cc0-waiver",),
    "CC-BY-NC-4.0": ("cc-nc-short", "cc-nc-work"),
    "CC-BY-4.0": ("cc-by-short", "cc-by-work"),
    "CC-BY-SA-4.0": ("cc-sa-short", "cc-sa-work"),
    "CC-BY-ND-4.0": ("cc-nd-work",),
    "CC-BY-NC-SA-4.0": ("cc-ncsa-work",),
    "CC-BY-NC-ND-4.0": ("cc-ncnd-work",),
}
RULES = (*LONG_RULES, *((name, (i,)) for name, ids in SINGLE.items() for i in ids))
# SPDX identifiers, besides the names above, and older spellings.
SPDX_OTHER = ("AGPL-3.0-only", "Artistic-2.0", "BSD-1-Clause", "BSD-4-Clause", "LGPL-2.0-only", "LGPL-2.1-only", "LGPL-3.0-only",
              "GPL-1.0-only", "GPL-1.0-or-later", "MS-PL", "NCSA", "OFL-1.1", "Python-2.0", "X11", "EUPL-1.2", "CECILL-2.1")
SPDX_OLD = {f"{name}-{v}{end}": f"{name}-{v}-{new}" for name, vs in (("GPL", ("1.0", "2.0", "3.0")), ("LGPL", ("2.0", "2.1", "3.0")),
                                                                     ("AGPL", ("3.0",)))
            for v in vs for end, new in (("", "only"), ("+", "or-later"))}
SPDX = {**{n.lower(): n for n in (*SINGLE, *SPDX_OTHER)}, **{k.lower(): v for k, v in SPDX_OLD.items()}}
#: Every known sentence has one of these.
ANCHORS = ("licens", "permission", "redistribut", "copyright", "unencumbered", "mpl", "held liable")

_OTHER = "[^a-z0-9]+"
#: An organisation in the place of the copyright holder (at most 12 words), and nearby wordings.
_HOLDER = r"neither the name of (?:[a-z0-9]+ ){1,12}?nor the names of (?:its|any|their) contributors may"
_HOLDER_PLAIN = "neither the name of the copyright holder nor the names of its contributors may"
_SPDX_LINE = r"(?i)SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+() \t-]+)"


def normalise(sentence: str) -> str:
    return re.sub(_OTHER, " ", sentence.lower()).strip()


def _known() -> dict[str, str]:
    """Normalised sentence -> identifier, longer sentences first. Where one is the beginning of
    another, the text decides by its next words."""
    out = {normalise(text): name for name, text in SENTENCES.items()}
    return dict(sorted(out.items(), key=lambda x: (-len(x[0]), x[0])))


def _normal(text: Column) -> Column:
    plain = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), _OTHER, " ")), F.lit(" "))
    return F.regexp_replace(plain, _HOLDER, _HOLDER_PLAIN)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, license, n_matches (rule matches and SPDX mentions), n_sentences (known sentences of
    the document), one row per licence found in a row's text."""
    names = _known()
    known = F.create_map(*[F.lit(x) for s, n in names.items() for x in (s, f"<{n}>")])
    spdx = F.create_map(*[F.lit(x) for pair in SPDX.items() for x in pair])
    rows = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .where(F.lower("text").rlike("|".join(ANCHORS))))
    one = "(?<= )(?:" + "|".join(names) + ")(?= )"
    words = F.flatten(F.transform(F.regexp_extract_all("text", F.lit(_SPDX_LINE), F.lit(1)),
                                  lambda line: F.split(F.regexp_replace(F.lower(line), "(^| )with +[a-z0-9.+-]+", " "), "[^a-z0-9.+-]+")))
    found = rows.select(
        "doc_id", F.transform(F.regexp_extract_all(_normal(F.col("text")), F.lit(one), F.lit(0)), lambda s: F.element_at(known, s)).alias("ids"),
        F.filter(F.transform(words, lambda w: F.try_element_at(spdx, F.regexp_replace(w, r"\.$", ""))), lambda x: x.isNotNull()).alias("spdx"))
    seq = found.where((F.size("ids") > 0) | (F.size("spdx") > 0)).select(
        "doc_id", F.size("ids").cast("long").alias("n_sentences"), "spdx", F.array_join("ids", "").alias("seq"))
    counts: dict[str, list[str]] = {}
    for k, (license_, ids) in enumerate(RULES):        # one column a rule; what it matched is used up
        pattern = "".join(f"<{i}>" for i in ids)
        seq = seq.withColumn(f"r{k}", ((F.length("seq") - F.length(F.replace("seq", F.lit(pattern), F.lit(""))))
                                       / len(pattern)).cast("long"))
        if len(ids) > 1:                               # single sentences do not overlap
            seq = seq.withColumn("seq", F.replace("seq", F.lit(pattern), F.lit("|")))
        counts.setdefault(license_, []).append(f"r{k}")
    total = {name: sum(F.col(c) for c in cols) for name, cols in counts.items()}
    each = F.array(*[F.struct(F.lit(name).alias("license"), n.alias("n")) for name, n in total.items()],
                   *[F.struct(F.lit(name).alias("license"), F.lit(0).cast("long").alias("n")) for name in sorted(set(SPDX.values()) - set(total))])
    mentions = F.transform(each, lambda e: F.struct(
        e["license"].alias("license"), (e["n"] + F.size(F.filter("spdx", lambda x: x == e["license"]))).alias("n_matches")))
    return (seq.select("doc_id", "n_sentences", F.explode(F.filter(mentions, lambda e: e["n_matches"] > 0)).alias("e"))
            .select("doc_id", "e.license", "e.n_matches", "n_sentences"))


def oracle_sql(table: str = "documents") -> str:
    """The same scan as DuckDB SQL, by words instead of patterns: runs of words are joined with the
    known sentences, and runs inside a longer match go."""
    def q(s):
        return "'" + s.replace("'", "''") + "'"

    names = _known()
    known = ", ".join(f"({q(s)}, {q(f'<{n}>')}, {len(s.split())})" for s, n in names.items())
    spdx = ", ".join(f"({q(k)}, {q(v)})" for k, v in SPDX.items())
    steps, prev = [], "s0"
    by_license: dict[str, list[str]] = {}
    for k, (license_, ids) in enumerate(RULES):
        p = "".join(f"<{i}>" for i in ids)
        steps.append(f"s{k + 1} AS (SELECT * EXCLUDE (seq), CAST((length(seq) - length(replace(seq, {q(p)}, ''))) / {len(p)} "
                     f"AS BIGINT) AS r{k}, replace(seq, {q(p)}, '|') AS seq FROM {prev})")
        prev = f"s{k + 1}"
        by_license.setdefault(license_, []).append(f"r{k}")
    union = " UNION ALL ".join(
        f"SELECT rk, doc_id, {q(n)} AS license, {' + '.join(c)} AS n, n_sentences FROM {prev}" for n, c in by_license.items())
    anchor = " OR ".join(f"contains(lower(text), {q(a)})" for a in ANCHORS)
    return f"""
WITH known(sentence, id, n) AS (VALUES {known}),
spdx(name, license) AS (VALUES {spdx}),
docs AS (SELECT row_number() OVER () AS rk, doc_id, text FROM {table} WHERE {anchor}),
w0 AS (SELECT rk, doc_id, list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM docs),
holder AS (SELECT rk, i, j FROM (SELECT rk, w, unnest(range(1, len(w) + 1)) AS i FROM w0), (SELECT unnest(range(5, 18)) AS j)
  WHERE array_to_string(w[i:i + 3], ' ') = 'neither the name of' AND w[i + j:i + j + 3] = ['nor', 'the', 'names', 'of']
    AND w[i + j + 4] IN ('its', 'any', 'their') AND array_to_string(w[i + j + 5:i + j + 6], ' ') = 'contributors may'),
first_holder AS (SELECT rk, i, min(j) AS j FROM holder GROUP BY rk, i),
words AS (SELECT w0.rk, p, CASE WHEN p = i + 4 THEN ['the', 'copyright', 'holder'] WHEN p > i + 4 AND p < i + j THEN []
    WHEN p = i + j + 4 THEN ['its'] ELSE [w[p]] END AS x
  FROM (SELECT rk, w, unnest(range(1, len(w) + 1)) AS p FROM w0) w0
  LEFT JOIN first_holder h ON h.rk = w0.rk AND p >= h.i + 4 AND p <= h.i + h.j + 4),
w1 AS (SELECT rk, flatten(list(x ORDER BY p)) AS w FROM words GROUP BY rk),
runs AS (SELECT rk, i, n, array_to_string(w[i:i + n - 1], ' ') AS run
  FROM (SELECT rk, w, unnest(range(1, len(w) + 1)) AS i FROM w1), (SELECT DISTINCT n FROM known) WHERE i + n - 1 <= len(w)),
hit AS (SELECT rk, i, i + runs.n AS upto, id FROM runs JOIN known ON run = sentence),
ids AS (SELECT * FROM hit h WHERE NOT EXISTS (SELECT 1 FROM hit o WHERE o.rk = h.rk AND o.i <= h.i AND o.upto >= h.upto
    AND o.upto - o.i > h.upto - h.i)),
s0 AS (SELECT rk, doc_id, count(id) AS n_sentences, coalesce(string_agg(id, '' ORDER BY i), '') AS seq
  FROM docs LEFT JOIN ids USING (rk) GROUP BY rk, doc_id),
{", ".join(steps)},
lines AS (SELECT rk, unnest(regexp_extract_all(text, '(?i)spdx-license-identifier:[ \t]*([A-Za-z0-9.+() \t-]+)', 1)) AS line FROM docs),
mentions AS (SELECT rk, rtrim(unnest(string_split_regex(regexp_replace(lower(line), '(^| )with +[a-z0-9.+-]+', ' ', 'g'), '[^a-z0-9.+-]+')), '.') AS name
  FROM lines),
every AS ({union}
  UNION ALL SELECT s0.rk, s0.doc_id, license, 1, n_sentences FROM mentions JOIN spdx USING (name) JOIN s0 ON s0.rk = mentions.rk)
SELECT doc_id, license, CAST(sum(n) AS BIGINT) AS n_matches, n_sentences FROM every GROUP BY rk, doc_id, license, n_sentences HAVING sum(n) > 0"""
