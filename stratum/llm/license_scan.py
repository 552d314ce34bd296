"""License scans: MinHash bands over overlapping windows retrieve templates, shingles verify.

A text's words give hashed five-word shingles. Windows of 1, 2, 4 and 8 shingles slide over
it by a quarter of their size; each has one MinHash per band, and a template is cut into
windows of the largest size it holds, at every shingle. A text that shares a band value with
a template's window is a candidate. ``BANDS`` bands of one row find a pair of windows of
similarity s with probability 1 - (1 - s) ** BANDS: a passage that fills a window is always
found, one that lies half a step off (s = 7/9) in 99.7 % of cases, for each of the
template's windows. Candidates are verified exactly: the share of the template's shingles that
occur in the text must reach ``CONTAINMENT``.

A text without a single shingle of any template cannot reach it and is passed over before
windows are built, which loses nothing; before that, so is a text without any of ``MARKS``, for
templates of which so many shingles hold such a word that the others alone cannot reach
``CONTAINMENT``. All of it is one projection: no shuffle, no user
function. Templates are a small fixed table, so they travel as a literal.

Defined results: null and empty texts, and texts below five words, hold no license;
repeated rows repeat their result; a template below five words is one shorter shingle and
is rejected; other columns are not read.
"""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.text import let, whole

SHINGLE = 5
LEVELS = (1, 2, 4, 8)
BANDS = 4
CONTAINMENT = 0.8

# fixed values: notices as their licenses' texts or common practice word them
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied."),
    "MIT": "Released under the MIT License.",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software"),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation"),
    "BSD-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
# standard headers of licenses whose texts ask for one
TEMPLATES |= {
    "GPL-2.0-notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."),
    "LGPL-2.1-notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version."),
    "LGPL-3.0-notice": (
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version."),
    "AGPL-3.0-notice": (
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version."),
    "EPL-2.0-notice": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0"),
    "EPL-1.0-notice": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "v1.0 which accompanies this distribution"),
    "Unlicense-notice": "This is free and unencumbered software released into the public domain.",
    "BSD-style-notice": "Use of this source code is governed by a BSD-style license",
    "CC0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights",
}
# names in one-line wordings, as "licensed under the ..."
NAMES = {
    "Apache-2.0": ("Apache License 2.0", "Apache License, Version 2.0", "Apache 2.0 License", "Apache-2.0 license"),
    "MIT": ("MIT License", "terms of the MIT License"),
    "ISC": ("ISC License", "terms of the ISC License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"),
    "BSD": ("BSD License",),
    "GPL-2.0": ("GNU General Public License v2.0", "GNU General Public License, version 2", "GNU GPL v2", "GPLv2 license"),
    "GPL-3.0": ("GNU General Public License v3.0", "GNU General Public License, version 3", "GNU GPL v3", "GPLv3 license"),
    "GPL": ("terms of the GNU General Public License",),
    "LGPL": ("GNU Lesser General Public License", "terms of the GNU Lesser General Public License", "GNU LGPL"),
    "AGPL": ("GNU Affero General Public License", "terms of the GNU Affero General Public License", "GNU AGPL"),
    "MPL-2.0": ("Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "Mozilla Public License, v. 2.0"),
    "EPL": ("Eclipse Public License", "terms of the Eclipse Public License"),
    "Unlicense": ("Unlicense license", "terms of the Unlicense"),
    "Zlib": ("zlib License", "zlib/libpng License"),
    "BSL-1.0": ("Boost Software License",),
    "CC0-1.0": ("CC0 1.0 Universal", "CC0 1.0 license", "Creative Commons Zero license"),
    "CC-BY-4.0": ("Creative Commons Attribution 4.0 International License", "CC BY 4.0 license"),
    "CC-BY-SA-4.0": ("Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 4.0 license"),
    "CC-BY-NC-4.0": ("Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 4.0 license"),
}
SPDX = ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "MPL-2.0",
        "EPL-2.0", "BSL-1.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0")


def _wordings() -> dict[str, str]:
    """One-line wordings that are not templates as yet."""
    seen, out = {t.lower().rstrip(".") for t in TEMPLATES.values()}, {}
    for name, forms in NAMES.items():
        for verb in ("Licensed", "Released", "Distributed", "Available"):
            for k, form in enumerate(forms):
                if f"{verb} under the {form}".lower() not in seen:
                    out[f"{name}-{verb.lower()}-{k}"] = f"{verb} under the {form}"
    return out | {f"{name}-spdx": f"SPDX-License-Identifier: {name}" for name in SPDX}


TEMPLATES |= _wordings()
# whole license texts
TEMPLATES |= {f"{p.stem}-text": p.read_text(encoding="utf-8")
              for p in sorted((Path(__file__).parent / "licenses").glob("*.txt"))}
# words of which a text must hold one, to reach a template most of whose shingles hold one
MARKS = (
    "license", "licensed", "licenses", "licensor", "licensee", "sublicense", "unlicense", "copyright", "copyrighted",
    "software", "warranty", "warranties", "permission", "redistribution", "redistributions", "redistribute",
    "redistributing", "distribute", "distributing", "modify", "modification", "derivative", "patent", "patents", "liable",
    "disclaimer", "disclaimed", "merchantability", "contributor", "contributors", "convey", "conveying", "affirmer",
    "binary", "package", "governed", "artistic", "bsd", "gnu", "gpl", "gplv2", "gplv3", "lgpl", "zlib", "eclipse", "cc", "cc0",
    "creative", "commons", "attribution", "sharealike", "noncommercial")
TABLE = "array<struct<id:string,shingles:array<string>>>"
# band values by their residue, with the places in the table that have them
LOOKUP = "array<array<struct<k:bigint,t:array<int>>>>"


def license_words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _runs(words: Column, make) -> Column:
    n = F.size(words) - (SHINGLE - 1)
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: make(F.slice(words, i, SHINGLE)))) \
        .otherwise(F.array())


def shingle_hashes(words: Column) -> Column:
    return _runs(words, F.xxhash64)


def shingle_texts(words: Column) -> Column:
    return _runs(words, lambda w: F.array_join(w, " "))


def band_keys(hashes: Column, levels: tuple[int, ...], step: dict[int, int]) -> Column:
    """Band values of all windows: a long each of (window size, band, MinHash)."""
    def permuted(h: Column, j: int) -> Column:
        return F.transform(h, lambda x: F.xxhash64(x, F.lit(j)))

    def minima(m: Column, starts: Column, size: int, j: int) -> Column:
        return F.coalesce(F.transform(starts, lambda i: F.xxhash64(
            F.lit(size), F.lit(j), F.array_min(F.slice(F.get(m, F.lit(j)), i, size)))),
            F.array().cast("array<bigint>"))

    def of(h: Column) -> Column:
        rows = F.array(*[permuted(h, j) for j in range(BANDS)])

        def keys(m: Column) -> Column:
            parts = []
            for size in levels:
                starts = F.when(F.size(h) >= size, F.sequence(F.lit(1), F.size(h) - (size - 1), F.lit(step[size])))
                # the last window, where the step leaps over it
                starts = F.array_union(starts, F.array(F.size(h) - (size - 1)))
                parts += [minima(m, starts, size, j) for j in range(BANDS)]
            return F.array_distinct(F.concat(*parts))

        return let(rows, keys)

    return let(hashes, of)


def template_table(spark: SparkSession, templates: dict[str, str]) -> list[dict]:
    """Hashes, band values and shingles of every template (a small fixed table, kept on the driver)."""
    rows = spark.createDataFrame(list(templates.items()), "id string, text string")
    every = {size: 1 for size in LEVELS}
    # words and hashes are evaluated once a template, which whole license texts need
    both = let(license_words(F.col("text")), lambda w: F.struct(
        shingle_hashes(w).alias("hashes"), shingle_texts(w).alias("shingles")))
    rows = rows.select("id", let(both, lambda b: F.struct(b["hashes"].alias("hashes"), b["shingles"].alias("shingles"), F.coalesce(
        *[F.when(F.size(b["hashes"]) >= s, band_keys(b["hashes"], (s,), every)) for s in sorted(LEVELS, reverse=True)]
    ).alias("keys"))).alias("x")).select("id", "x.*")
    keys = F.col("keys")
    out = [r.asDict() for r in rows.select("id", F.array_distinct("hashes").alias("hashes"), keys.alias("keys"),
                                           F.array_distinct("shingles").alias("shingles")).collect()]
    short = [r["id"] for r in out if not r["shingles"]]
    if short:
        raise ValueError(f"templates below {SHINGLE} words: {short}")
    return out


def band_lookup(table: list[dict]) -> list[list[dict]]:
    """The band values of all templates, dealt to about as many residues as there are values."""
    places: dict[int, list[int]] = {}
    for i, t in enumerate(table):
        for k in set(t["keys"]):
            places.setdefault(k, []).append(i)
    slots: list[list[dict]] = [[] for _ in range(max(1, len(places)))]
    for k, at in places.items():
        slots[k % len(slots)].append({"k": k, "t": at})
    return slots


def marked(shingles: list[str], containment: float) -> bool:
    """Whether a text without any of ``MARKS`` cannot hold enough of the template's distinct shingles."""
    return sum(not set(s.split()) & set(MARKS) for s in shingles) < containment * len(shingles)


def find_licenses(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                  templates: dict[str, str] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """(id, n_licenses, licenses): verified templates as ``id:shared/all`` shingles, comma-joined, by id."""
    table = template_table(docs.sparkSession, templates or TEMPLATES)
    known = sorted({h for t in table for h in t["hashes"]})
    plain = [t for t in table if not marked(t["shingles"], containment)]
    unmarked = sorted({h for t in plain for h in t["hashes"]})
    literal = F.from_json(F.lit(json.dumps([{"id": t["id"], "shingles": t["shingles"]} for t in table])), TABLE)
    slots = band_lookup(table)
    lookup = F.from_json(F.lit(json.dumps(slots)), LOOKUP)
    any_of = F.from_json(F.lit(json.dumps(known)), "array<bigint>")
    step = {size: max(1, size // 4) for size in LEVELS}

    rows = docs.select(F.col(id_col), license_words(whole(F.col(text))).alias("_w"))

    def places(keys: Column) -> Column:
        """Places of the templates that share a band value: one slot is read for each value."""
        def met(k: Column) -> Column:
            slot = F.get(lookup, F.pmod(k, F.lit(len(slots))).cast("int"))
            return F.flatten(F.transform(F.filter(slot, lambda e: e["k"] == k), lambda e: e["t"]))

        return F.array_distinct(F.flatten(F.transform(keys, met)))

    def verified(x: Column) -> Column:
        def check(i: Column) -> Column:
            t = F.get(literal, i)
            shared = F.size(F.array_intersect(t["shingles"], x["shingles"]))
            return F.struct(t["id"].alias("id"), shared.alias("shared"), F.size(t["shingles"]).alias("all"))

        return F.filter(F.transform(places(x["keys"]), check),
                        lambda c: c["shared"] >= F.lit(containment) * c["all"])

    def retrieved(h: Column) -> Column:
        doc = F.struct(band_keys(h, LEVELS, step).alias("keys"), shingle_texts(F.col("_w")).alias("shingles"))
        return F.when(F.arrays_overlap(h, any_of), let(doc, verified))

    may = F.arrays_overlap(F.col("_w"), F.array(*[F.lit(m) for m in MARKS]))
    if unmarked:
        may |= F.arrays_overlap(shingle_hashes(F.col("_w")), F.from_json(F.lit(json.dumps(unmarked)), "array<bigint>"))
    found = F.when(may, let(shingle_hashes(F.col("_w")), retrieved))
    out = rows.select(id_col, F.array_sort(found).alias("_f"))
    return out.select(
        id_col, F.coalesce(F.size("_f"), F.lit(0)).cast("long").alias("n_licenses"),
        F.coalesce(F.array_join(F.transform("_f", lambda c: F.concat(
            c["id"], F.lit(":"), c["shared"].cast("string"), F.lit("/"), c["all"].cast("string"))), ","),
            F.lit("")).alias("licenses"))
