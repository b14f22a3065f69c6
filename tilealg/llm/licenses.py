"""License scans: MinHash bands of overlapping windows find templates (operator 4).

A text's letters and digits are lower-cased words; its 5-word shingles are hashed.  Windows
of six words (two shingles) start at every second word, so that they overlap by four and no
shingle is missed.  ``BANDS`` minimum hashes of a window (the hash values under a mask each)
are its bands.  An index holds, per band, the templates of each value; a window retrieves the
templates under its values (a list of all values finds the few windows that have any).  If
half of a window's shingles are the template's, as for a template of five words, a band
collides with probability 1/2, and all of them miss with probability 2^-20; a window inside
a longer template collides in every band.  A retrieved template matches if at least
``CONTAINED`` of its shingles, compared exactly, occur in the text.

Notices of related licenses differ in a word or a version number and hold most of each
other's shingles.  With ``decide``, a match stays only if the text holds what sets its template
apart: it is taken back if all its shingles in the text are also those of a matching template
of another license.  A template that lies within another one as a whole (``GPL`` without a
version) gives way only to a match that stays.

Everything is one pass of JVM expressions without a shuffle: the templates are a list of
this module (a parameter of ``scan``), their bands and shingles literals of the plan.

Defined results: null, empty and short texts hold no license; a text may hold several;
repeated rows are scanned alike; null ids are ids like others; further columns are not
looked at.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import plain

SHINGLE = 5
BANDS = 20
CONTAINED = 0.8
PATTERN = r"[\p{L}\p{N}]+"

#: License id and a notice that declares it (public texts, fixed values).
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
     "except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
     "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
     "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
     "permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
     "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
     "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
     "following conditions: The above copyright notice and this permission notice shall be included in all "
     "copies or substantial portions of the Software."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the "
     "GNU General Public License as published by the Free Software Foundation, either version 3 of the License, "
     "or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the "
     "GNU General Public License as published by the Free Software Foundation; either version 2 of the License, "
     "or (at your option) any later version."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met: Redistributions of source code must retain the above "
     "copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form "
     "must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
     "documentation and/or other materials provided with the distribution."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
     "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
     "the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
     "modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
     "compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
     "License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
     "License."),
]


def _notices(name: str, tags: list[str], *licenses: str) -> list[tuple[str, str]]:
    """Notices of the names a license goes by: ``under`` a name, after the usual verbs if that
    is too short for a shingle; and of its SPDX tags."""
    verbs = ("Licensed", "Released", "Distributed", "Available", "Published", "Provided", "Covered")
    return ([(name, f"{v}under {x}") for x in licenses
             for v in (("",) if len(re.findall(r"\w+", x)) >= SHINGLE - 1 else [f"{v} " for v in verbs])]
            + [(name, f"SPDX-License-Identifier: {x}") for x in tags])


def _gnu() -> list[tuple[str, str]]:
    by = "as published by the Free Software Foundation"
    out = []
    for short, name, versions in (("GPL", "General Public License", ("2", "3")),
                                  ("LGPL", "Lesser General Public License", ("2.1", "3")),
                                  ("LGPL", "Library General Public License", ("2",)),
                                  ("AGPL", "Affero General Public License", ("3",))):
        out.append((short, f"This work is licensed under the GNU {name}."))
        out += _notices(short, [], f"the GNU {name}", f"the terms of the GNU {name}", f"the GNU {short}",
                        f"the {short} license")
        for v in versions:
            full = v if "." in v else f"{v}.0"
            of = f"{short}-{full}"
            out.append((of, f"This work is licensed under the GNU {name}, version {v}."))
            for what in ("program", "library", "file"):
                start = f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name}"
                out += [(of, f"{start} {by}, either version {v} of the License, or (at your option) any later version."),
                        (of, f"{start} {by}, version {v}."), (of, f"{start} version {v} {by}.")]
            out += _notices(of, [of], f"the GNU {name}, version {v}", f"the GNU {name} v{v}", f"the GNU {name} {v}",
                            f"the GNU {short} v{v}", f"the GNU {short} version {v}", f"the GNU {short}v{v}",
                            f"the {short} v{v}", f"the {short}v{v} license", f"the {short} version {v}", of, f"the {of}")
    return out


def _creative_commons() -> list[tuple[str, str]]:
    out = []
    for short, name in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
                        ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                        ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")):
        for v, port in (("4.0", "International"), ("3.0", "Unported"), ("2.5", "Generic"), ("2.0", "Generic")):
            of = f"CC-{short}-{v}"
            out += [(of, f"This work is licensed under {a} Creative Commons {name} {v} {port} License.") for a in ("a", "the")]
            out += _notices(of, [of], f"CC {short} {v}", f"a CC {short} {v}", f"the CC {short} {v}",
                            f"Creative Commons {name} {v}", f"a Creative Commons {name} {v}",
                            f"the Creative Commons {name} {v}")
    return out


def _bsd() -> list[tuple[str, str]]:
    out = []
    for one, two, three in (("", "", ""), ("1. ", "2. ", "3. ")):
        head = ("Redistribution and use in source and binary forms, with or without modification, are permitted "
                f"provided that the following conditions are met: {one}Redistributions of source code must retain the "
                f"above copyright notice, this list of conditions and the following disclaimer. {two}Redistributions in "
                "binary form must reproduce the above copyright notice, this list of conditions and the following "
                "disclaimer in the documentation and/or other materials provided with the distribution.")
        names = (f"{three}Neither the name of the copyright holder nor the names of its contributors may be used to "
                 "endorse or promote products derived from this software without specific prior written permission.")
        end = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\""
        out += [("BSD-2-Clause", f"{head} {end}"), ("BSD-3-Clause", f"{head} {names} {end}"), ("BSD-3-Clause", f"{head} {names}")]
    return out


def _distinct(templates: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Without templates of the same words as an earlier one."""
    seen: dict[tuple, tuple[str, str]] = {}
    for name, text in templates:
        seen.setdefault(tuple(re.findall(r"\w+", text.lower())), (name, text))
    return list(seen.values())


#: ``TEMPLATES`` and the usual further licenses and wordings; made for ``scan`` with ``decide``.
CATALOGUE: list[tuple[str, str]] = _distinct([
    *TEMPLATES, *_gnu(), *_creative_commons(), *_bsd(),
    *_notices("Apache-2.0", ["Apache-2.0"], "the Apache License 2.0", "Apache License 2.0", "Apache License, Version 2.0",
              "the Apache License, Version 2.0", "the Apache License v2.0", "the Apache 2.0 License", "Apache 2.0",
              "the Apache Software License 2.0"),
    *_notices("MIT", [], "the MIT License", "an MIT License", "the terms of the MIT License", "MIT License terms",
              "the Expat License", "an MIT-style license"),
    ("MIT", "The MIT License (MIT) Copyright (c)"),
    *_notices("BSD-2-Clause", ["BSD-2-Clause"], "the BSD 2-Clause License", "the 2-Clause BSD License",
              "the Simplified BSD License", "the FreeBSD License", "BSD-2-Clause"),
    *_notices("BSD-3-Clause", ["BSD-3-Clause"], "the BSD 3-Clause License", "the 3-Clause BSD License",
              "the New BSD License", "the Modified BSD License", "BSD-3-Clause"),
    *_notices("BSD", [], "the BSD License", "a BSD License", "a BSD-style license"),
    *_notices("ISC", [], "the ISC License"),
    *_notices("MPL-2.0", ["MPL-2.0"], "the Mozilla Public License, v. 2.0", "the Mozilla Public License 2.0",
              "the Mozilla Public License, version 2.0", "the Mozilla Public License v2.0", "the MPL 2.0"),
    *_notices("Unlicense", [], "the terms of the Unlicense"),
    *_notices("CC0-1.0", ["CC0-1.0"], "CC0 1.0", "CC0 1.0 Universal", "the CC0 1.0 Universal", "the Creative Commons CC0",
              "Creative Commons Zero v1.0", "the Creative Commons Zero"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring "
     "rights to this work."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0"),
    *_notices("EPL-2.0", ["EPL-2.0"], "the Eclipse Public License 2.0", "the Eclipse Public License v2.0",
              "the Eclipse Public License, version 2.0"),
    *_notices("EPL-1.0", ["EPL-1.0"], "the Eclipse Public License 1.0", "the Eclipse Public License v1.0"),
    *_notices("BSL-1.0", ["BSL-1.0"], "the Boost Software License, Version 1.0", "the Boost Software License 1.0"),
    *_notices("Zlib", [], "the zlib License", "the zlib/libpng License"),
])


def masks() -> list[int]:
    """One signed 64-bit mask per band, from a linear congruence."""
    out, x = [], 12345
    for _ in range(BANDS):
        x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append(x - (1 << 64) if x >= 1 << 63 else x)
    return out


def _shingled(rows: DataFrame) -> DataFrame:
    """Adds ``_sh``: hashes of the shingles of ``text``."""
    text = F.lower(F.coalesce("text", F.lit("")))
    r = rows.select("*", F.regexp_extract_all(text, F.lit(f"({PATTERN})"), 1).alias("_words"))
    sh = F.when(F.size("_words") >= SHINGLE, F.transform(
        F.sequence(F.lit(1), F.size("_words") - (SHINGLE - 1)),
        lambda i: F.xxhash64(F.slice("_words", i, SHINGLE)))).otherwise(F.array().cast("array<bigint>"))
    return r.select("*", sh.alias("_sh")).drop("_words", "text")


def _nested(templates: list[tuple[str, str]], hashes: dict[int, list[int]]) -> tuple[dict, dict]:
    """Per template, those that hold all its shingles, and those of them that it gives way to:
    all of other licenses; of its own license only if it is not one of ``TEMPLATES``, so that
    a further wording is not counted beside the notice that it is a part of."""
    sets = {k: set(v) for k, v in hashes.items()}
    holds: dict[int, list[int]] = {}
    for k, v in sets.items():
        for x in v:
            holds.setdefault(x, []).append(k)
    within = {k: [n for n in holds[min(v, key=lambda x: len(holds[x]))] if n != k and v <= sets[n]] if v else []
              for k, v in sets.items()}
    gives = {k: [n for n in w if templates[n][0] != templates[k][0] or templates[k] not in TEMPLATES]
             for k, w in within.items()}
    return within, gives


def scan(spark: SparkSession, docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES,
         id_col: str = "doc_id", text_col: str = "text", decide: bool = False) -> DataFrame:
    """doc_id and ``matches`` (array of template number, license, share of its shingles
    found) of every row; with ``decide``, without those that a template of another license
    explains."""
    listed = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(templates)], "k int, text string")
    ordered = {r["k"]: r["_sh"] for r in _shingled(listed).collect()}
    hashes = {k: list(dict.fromkeys(s)) for k, s in ordered.items()}
    bands: list[dict[int, set[int]]] = []  # per band: value -> templates
    for m in masks():
        index: dict[int, set[int]] = {}
        for k, s in ordered.items():
            for x, y in zip(s, s[1:]) if len(s) > 1 else [(v, v) for v in s]:
                index.setdefault(min(x ^ m, y ^ m), set()).add(k)
        bands.append(index)
    within, gives = _nested(templates, hashes) if decide else ({}, {})
    numbers = lambda of: f"CAST(array({', '.join(map(str, of))}) AS array<int>)"
    known = "array(" + ", ".join(
        f"named_struct('k', {k}, 'license', '{templates[k][0]}', 's', CAST(array({', '.join(f'{v}L' for v in s)}) AS array<bigint>)"
        + (f", 'within', {numbers(within[k])}, 'gives', {numbers(gives[k])}" if decide else "") + ")"
        for k, s in sorted(hashes.items())) + ")"

    def values(index) -> str:
        return ", ".join(f"{v}L" for v in sorted(index)).replace("-9223372036854775808L", "(-9223372036854775807L - 1)")
    bands_of = [(f"least(w.a ^ {m}L, w.b ^ {m}L)", index) for m, index in zip(masks(), bands) if index]
    hit = " OR ".join(f"{value} IN ({values(index)})" for value, index in bands_of) or "false"
    under = [f"coalesce(try_element_at(map_from_arrays(array({values(index)}), array({', '.join(numbers(sorted(index[v])) for v in sorted(index))})), {value}), CAST(array() AS array<int>))"
             for value, index in bands_of]
    windows = ("transform(sequence(0, greatest(size(_sh) - 1, 0), 2), i -> named_struct("
               "'a', get(_sh, i), 'b', coalesce(get(_sh, i + 1), get(_sh, i))))")
    rows = _shingled(plain(docs, doc_id=id_col, text=text_col))
    rows = rows.select("doc_id", "_sh", F.expr(f"filter({windows}, w -> {hit})").alias("_hits"))
    none = "CAST(array() AS array<int>)"
    candidates = f"array_sort(array_distinct(flatten(transform(_hits, w -> flatten(array({', '.join(under) or none}))))))"
    retrieved = f"transform({candidates}, k -> get({known}, k))"
    parts = "'template', t.k, 'license', t.license, 'contained', size(array_intersect(t.s, _sh)) / size(t.s)"
    more = ", 's', t.s, 'within', t.within, 'gives', t.gives, 'found', array_intersect(t.s, _sh)" if decide else ""
    found = f"filter(transform({retrieved}, t -> named_struct({parts}{more})), m -> m.contained >= {CONTAINED})"
    if decide:
        apart = ("NOT exists(x, n -> n.license <> m.license AND NOT array_contains(m.within, n.template)"
                 " AND size(array_except(m.found, n.s)) = 0)")
        for stays in (apart, "NOT exists(x, n -> array_contains(m.gives, n.template))"):
            found = f"transform(array({found}), x -> filter(x, m -> {stays}))[0]"
        found = (f"transform({found}, m -> named_struct('template', m.template, 'license', m.license, "
                 "'contained', m.contained))")
    none = "CAST(array() AS array<struct<template: int, license: string, contained: double>>)"
    return rows.select("doc_id", F.expr(f"CASE WHEN size(_hits) = 0 THEN {none} ELSE {found} END").alias("matches"))
