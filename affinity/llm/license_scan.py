"""Licence scans: passages compared to licence templates by Dice's coefficient over word bigrams.

Text is normalised (A-Z lower-cased, everything but letters and digits as one space) and compared in two ways.

Passages: each
line, each paragraph of more than one line and the whole text of more than one paragraph is
a passage. A passage of ``a`` bigrams and a template of ``b``, repeats included, can reach a
coefficient of ``t`` only if ``b t / (2 - t) <= a <= b (2 - t) / t``. A passage's size is its
number of spaces; if it is outside the bounds of all templates the passage is pruned before
it is cut into words. The others' bigrams look up the templates that hold them in a literal
index by hash; templates outside the bounds are pruned, and for the rest the smaller of the
two counts of each shared bigram adds up to the coefficient.

Windows: the whole text's words, whatever lines and sentences they stand in, so that a notice inside a longer line or
over several paragraphs is found. A window has a template's size, so it can reach ``t`` only if at most ``1 - t`` of
the template's bigrams are missing: of any more than that, some are there. These are the template's seeds, its rarest
bigrams. Each seed met in a text names a window, the one in which it stands where the template has it, and
the window is compared with the template. Windows that overlap are one notice, which goes to the best of them.

All is one projection in DataFrame operations: no row moves, so no key can be hot.

Cases: a null or empty text has no passages; repeated lines count each; ties between
templates go to the larger one, then to the smaller name; texts with fewer words than a template are compared
with it as passages only; an empty table gives no rows; other columns stay, and names
of results that the table has already are replaced.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import ascii_lower, free_names, in_blocks
from affinity.llm.common import let as _let

THRESHOLD = 0.8


@dataclass(frozen=True)
class Template:
    name: str
    bigrams: tuple[tuple[str, str], ...]


# How one-line notices begin, and the names that licences go by in them.
NOTICES = (
    "Licensed under {}",
    "Released under {}",
    "Distributed under {}",
    "This work is licensed under {}",
    "This file is licensed under {}",
    "This software is licensed under {}",
)
NAMES = {
    "AGPL-3.0": "the GNU Affero General Public License, version 3",
    "Apache-2.0": "the Apache License, Version 2.0",
    "BSD-2-Clause": "the BSD 2-Clause License",
    "BSD-3-Clause": "the BSD 3-Clause License",
    "CC-BY-4.0": "CC BY 4.0",
    "CC-BY-NC-4.0": "CC BY-NC 4.0",
    "CC-BY-NC-ND-4.0": "CC BY-NC-ND 4.0",
    "CC-BY-NC-SA-4.0": "CC BY-NC-SA 4.0",
    "CC-BY-ND-4.0": "CC BY-ND 4.0",
    "CC-BY-SA-4.0": "CC BY-SA 4.0",
    "CC0-1.0": "CC0 1.0",
    "GPL-2.0": "the GNU General Public License, version 2",
    "GPL-3.0": "the GNU General Public License, version 3",
    "ISC": "the ISC License",
    "LGPL-2.1": "the GNU Lesser General Public License, version 2.1",
    "LGPL-3.0": "the GNU Lesser General Public License, version 3",
    "MIT": "the MIT License",
    "MPL-2.0": "the Mozilla Public License, version 2.0",
}
CREATIVE = "a Creative Commons {} 4.0 International License"
LONG_NAMES = {
    "CC-BY-4.0": CREATIVE.format("Attribution"),
    "CC-BY-NC-4.0": CREATIVE.format("Attribution-NonCommercial"),
    "CC-BY-NC-ND-4.0": CREATIVE.format("Attribution-NonCommercial-NoDerivatives"),
    "CC-BY-NC-SA-4.0": CREATIVE.format("Attribution-NonCommercial-ShareAlike"),
    "CC-BY-ND-4.0": CREATIVE.format("Attribution-NoDerivatives"),
    "CC-BY-SA-4.0": CREATIVE.format("Attribution-ShareAlike"),
    "CC0-1.0": "the Creative Commons CC0 1.0 Universal Public Domain Dedication",
}
SPDX = "SPDX-License-Identifier: {}"
GNU_GRANT = (
    "This {0} is free software: you can redistribute it and/or modify it under the terms of the {1} as published by the "
    "Free Software Foundation, either version {2} of the License, or (at your option) any later version."
)
GNU_HEADER = (
    GNU_GRANT + " This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {1} for more details."
)
BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\nRedistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer.\nRedistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution."
)
GNU = {
    "AGPL-3.0": ("program", "GNU Affero General Public License", "3"),
    "GPL-2.0": ("program", "GNU General Public License", "2"),
    "GPL-3.0": ("program", "GNU General Public License", "3"),
    "LGPL-2.1": ("library", "GNU Lesser General Public License", "2.1"),
    "LGPL-3.0": ("library", "GNU Lesser General Public License", "3"),
}
# Wordings of public licences, a line a paragraph.
TEXTS = {
    **{k: GNU_HEADER.format(*v) for k, v in GNU.items()},
    "BSD-2-Clause": BSD,
    "BSD-3-Clause": BSD + "\nNeither the name of the copyright holder nor the names of its contributors may be used to endorse "
    "or promote products derived from this software without specific prior written permission.",
    "CC0-1.0": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring "
    "rights to this software to the public domain worldwide. This software is distributed without any warranty.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
    "compliance with the License. You may obtain a copy of the License at\nhttp://www.apache.org/licenses/LICENSE-2.0\n"
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
    "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for "
    "the specific language governing permissions and limitations under the License.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions:\nThe above copyright notice "
    "and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
    "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
    "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
    "purpose, commercial or non-commercial, and by any means.",
}


def bigrams_of(text: str) -> tuple[tuple[str, str], ...]:
    words = re.findall("[a-z0-9]+", text.lower())
    return tuple(zip(words, words[1:]))


#: Paragraphs of wordings with at least so many bigrams are templates too.
LEAST_PARAGRAPH = 12


def default_templates() -> list[Template]:
    named = [Template(k, bigrams_of(n.format(v))) for names in (NAMES, LONG_NAMES) for k, v in names.items() for n in NOTICES]
    tagged = [Template(k, bigrams_of(SPDX.format(k))) for k in sorted({*NAMES, *TEXTS})]
    whole = [Template(k, bigrams_of(v)) for k, v in TEXTS.items()]
    grants = [Template(k, bigrams_of(GNU_GRANT.format(*v))) for k, v in GNU.items()]
    parts = [Template(k, bigrams_of(p)) for k, v in TEXTS.items() if "\n" in v for p in v.split("\n")]
    # What several licences have in common tells none of them.
    shared = Counter(t.bigrams for t in parts)
    own = [t for t in parts if len(t.bigrams) >= LEAST_PARAGRAPH and shared[t.bigrams] == 1]
    return named + tagged + whole + grants + own


# Words that make a pair of words common in English or in licences.
COMMON = frozenset("a an and any as at be by for from in is it license of on or software that the this to under with work you".split())


def seeds_of(templates: list[Template], threshold: float) -> dict[tuple[str, str], list[tuple[int, int]]]:
    """Bigram -> (template, place) of the seeds of each template: more of its rarest bigrams than a window may lack."""
    holders = Counter(b for t in templates for b in set(t.bigrams))
    seeds: dict[tuple[str, str], list[tuple[int, int]]] = {}
    for i, t in enumerate(templates):
        places: dict[tuple[str, str], list[int]] = {}
        for q, b in enumerate(t.bigrams):
            places.setdefault(b, []).append(q)
        may_lack = int(len(t.bigrams) * (1 - threshold) + 1e-9)
        chosen = 0
        for b in sorted(places, key=lambda b: (len(COMMON.intersection(b)), holders[b], places[b][0])):
            if chosen > may_lack:
                break
            chosen += len(places[b])
            seeds.setdefault(b, []).extend((i, q) for q in places[b])
    return seeds


def size_bounds(size: int, threshold: float) -> tuple[int, int]:
    """The fewest and most bigrams of a passage that can reach the threshold against ``size``."""
    # A little wider, so that rounding cannot cut an exact bound.
    return int(-(-(size * threshold / (2 - threshold) - 1e-9) // 1)), int(size * (2 - threshold) / threshold + 1e-9)


def normalised(text: Column) -> Column:
    """A-Z lower-cased; letters, digits and line ends stay, anything else becomes one space."""
    return F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\n]+", " ")


class Index:
    """A literal hash index of bigrams: their hashes by bucket, and behind each hash its entries (two numbers each)."""

    def __init__(self, entries: dict[int, list[tuple[int, int]]], first: str, second: str):
        n = 1 << (2 * len(entries)).bit_length()
        buckets: list[list] = [[] for _ in range(n)]
        for h, held in entries.items():
            buckets[h % n].append((h, held))
        known = json.dumps([[h for h, _ in b] for b in buckets])
        rows = [[{"h": h, "held": [{first: x, second: y} for x, y in held]} for h, held in b] for b in buckets]
        kind = f"array<array<struct<h:bigint,held:array<struct<{first}:int,{second}:int>>>>>"
        self.known = F.from_json(F.lit(known), "array<array<bigint>>")
        self.rows = F.from_json(F.lit(json.dumps(rows)), kind)
        self.at = lambda h: F.pmod(h, F.lit(n)).cast("int")

    def has(self, h: Column) -> Column:
        return F.array_contains(F.get(self.known, self.at(h)), h)

    def held(self, h: Column) -> Column:
        of_hash = F.filter(F.get(self.rows, self.at(h)), lambda e: e["h"] == h)
        return F.flatten(F.transform(of_hash, lambda e: e["held"]))


def _grams(words: Column) -> Column:
    """The hashes of a word list's bigrams; a null stands behind the last."""
    return F.zip_with(words, F.slice(words, F.lit(2), F.size(words)), lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b)))


def _windows(grams: Column, seeds: Index, sizes: list[int]) -> Column:
    """The different (template, start) windows that seeds in a text's bigrams name."""
    size_of = F.array(*map(F.lit, sizes))
    n = F.size(grams)
    met = F.filter(F.transform(grams, lambda h, i: F.when(seeds.has(h), F.struct(i.alias("i"), h.alias("h")))), lambda x: x.isNotNull())

    def named(x: Column) -> Column:
        fits = F.filter(seeds.held(x["h"]), lambda p: F.get(size_of, p["t"]) <= n)
        start = lambda p: F.greatest(F.lit(0), F.least(x["i"] - p["q"], n - F.get(size_of, p["t"])))
        return F.transform(fits, lambda p: F.struct(p["t"].alias("t"), start(p).alias("s")))

    return F.array_distinct(F.flatten(F.transform(met, named)))


def _notices(windows: Column) -> Column:
    """(start, end, d, n, t) windows with at least one -> (d, n, t) of the best of each run of overlapping ones.

    In blocks, so that texts with very many notices stay cheap.
    """
    kind = "array<struct<d:double,n:int,t:int>>"
    what = lambda x: F.struct(x["d"].alias("d"), x["n"].alias("n"), x["t"].alias("t"))
    state = lambda end, best, out: F.struct(end.alias("end"), best.alias("best"), out.alias("out"))

    def add(acc, x):
        joined = state(F.greatest(acc["end"], x["end"]), F.greatest(acc["best"], what(x)), acc["out"])
        return F.when(x["start"] < acc["end"], joined).otherwise(
            state(x["end"], what(x), F.concat(acc["out"], F.array(acc["best"])))
        )

    def of_block(acc, block):
        inner = F.aggregate(block, state(acc["end"], acc["best"], F.array().cast(kind)), add)
        return state(inner["end"], inner["best"], F.concat(acc["out"], F.array(inner["out"])))

    ordered = F.array_sort(windows)
    first = F.get(ordered, F.lit(0))
    start = state(first["end"], what(first), F.array().cast(f"array<{kind}>"))
    return F.aggregate(in_blocks(ordered), start, of_block, lambda acc: F.concat(F.flatten(acc["out"]), F.array(acc["best"])))


def scan_licenses(docs: DataFrame, templates: list[Template] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """The table with license (the best), license_dice, n_license_passages, n_license_notices, licenses (comma-joined)."""
    templates = sorted(templates or default_templates(), key=lambda t: t.name)
    sizes = [len(t.bigrams) for t in templates]
    bounds = [size_bounds(n, threshold) for n in sizes]
    fewest, most = min(b[0] for b in bounds), max(b[1] for b in bounds)
    spark = docs.sparkSession
    counts = [Counter(t.bigrams) for t in templates]
    every = sorted(set().union(*counts))
    pairs = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(every)], "i int, a string, b string")
    hashes = {every[r["i"]]: r["h"] for r in pairs.select("i", F.xxhash64("a", "b").alias("h")).collect()}
    holders: dict[int, list[tuple[int, int]]] = {}
    for i, c in enumerate(counts):
        for b, n in c.items():
            holders.setdefault(hashes[b], []).append((i, n))
    index = Index(holders, "t", "n")
    seeds = Index({hashes[b]: places for b, places in seeds_of(templates, threshold).items()}, "t", "q")
    grams_of = [[{"h": hashes[b], "n": n} for b, n in c.items()] for c in counts]
    wanted = F.from_json(F.lit(json.dumps(grams_of)), "array<array<struct<h:bigint,n:int>>>")

    ours = ["license", "license_dice", "n_license_passages", "n_license_notices", "licenses"]
    docs = docs.drop(*(c for c in docs.columns if c.lower() in ours))
    inner = free_names([*docs.columns, *ours], ["license_plain", "license_cut", "license_parts", "license_met", "license_shared", "license_grams", "license_windows", "license_found"])
    plain, cut, parts, met, common, grams, windows, found = inner
    flat = lambda p: F.regexp_replace(p, r"\s+", " ")
    several = F.transform(F.filter(cut, lambda p: p.contains("\n")), flat)
    whole = F.when(F.size(cut) > 1, F.array(flat(F.col(plain)))).otherwise(F.array().cast("array<string>"))
    df = docs.withColumn(plain, normalised(F.col("text")))
    df = df.withColumn(cut, F.split(plain, r"\n\s*\n"))
    passages = F.transform(F.concat(F.split(plain, "\n"), several, whole), lambda p: F.trim(p))

    size = lambda p: F.length(p) - F.length(F.replace(p, F.lit(" "), F.lit("")))
    df = df.withColumn(parts, F.filter(passages, lambda p: size(p).between(fewest, most)))
    hits = lambda p: F.filter(_grams(F.split(p, " ")), index.has)
    held = F.transform(parts, lambda p: F.struct(size(p).alias("n"), hits(p).alias("h")))
    df = df.withColumn(met, F.filter(held, lambda m: F.size(m["h"]) > 0))
    size_of, low_of, high_of = (F.array(*map(F.lit, x)) for x in (sizes, [b[0] for b in bounds], [b[1] for b in bounds]))

    def shared(m):
        """(template, shared count) for each different bigram found in a passage."""

        def of_bigram(h):
            here = F.size(F.filter(m["h"], lambda x: x == h))
            return F.transform(index.held(h), lambda e: F.struct(e["t"].alias("t"), F.least(e["n"], here).alias("c")))

        return F.flatten(F.transform(F.array_distinct(m["h"]), of_bigram))

    df = df.withColumn(common, F.transform(met, lambda m: F.struct(m["n"].alias("n"), shared(m).alias("s"))))

    def best(m):
        fits = F.filter(
            F.array_distinct(F.transform(m["s"], lambda s: s["t"])),
            lambda t: (m["n"] >= F.get(low_of, t)) & (m["n"] <= F.get(high_of, t)),
        )

        def dice(t):
            both = F.aggregate(F.filter(m["s"], lambda s: s["t"] == t), F.lit(0), lambda a, s: a + s["c"])
            d = F.lit(2.0) * both / (m["n"] + F.get(size_of, t))
            return F.struct(d.alias("d"), F.get(size_of, t).alias("n"), (-t).alias("t"))

        return F.array_max(F.transform(fits, dice))

    def of_window(w):
        n = F.get(size_of, w["t"])
        return _let(
            F.slice(grams, w["s"] + 1, n),
            lambda here: F.struct(
                w["s"].alias("start"),
                (w["s"] + n).alias("end"),
                (
                    F.lit(2.0)
                    * F.aggregate(
                        F.get(wanted, w["t"]),
                        F.lit(0),
                        lambda a, e: a + F.least(e["n"], F.size(F.filter(here, lambda h: h == e["h"]))),
                    )
                    / (n + n)
                ).alias("d"),
                n.alias("n"),
                (-w["t"]).alias("t"),
            ),
        )

    words = F.split(F.trim(flat(F.col(plain))), " ")
    df = df.withColumn(grams, F.filter(_grams(words), lambda h: h.isNotNull()))
    df = df.withColumn(windows, _windows(F.col(grams), seeds, sizes))
    df = df.withColumn(windows, F.filter(F.transform(windows, of_window), lambda x: x["d"] >= threshold))
    none = F.array().cast("array<struct<d:double,n:int,t:int>>")
    df = df.withColumn(windows, F.when(F.size(windows) > 0, _notices(F.col(windows))).otherwise(none))
    df = df.withColumn(found, F.filter(F.transform(common, best), lambda x: x["d"] >= threshold))
    names = F.array(*(F.lit(t.name) for t in templates))
    both = F.concat(found, windows)
    top = F.array_max(both)
    name = lambda x: F.get(names, -x["t"])
    return df.select(
        *docs.columns,
        name(top).alias("license"),
        top["d"].alias("license_dice"),
        F.size(found).cast("long").alias("n_license_passages"),
        F.size(windows).cast("long").alias("n_license_notices"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(both, name))), ",").alias("licenses"),
    )
