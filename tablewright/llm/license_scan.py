"""License scans: MinHash bands over overlapping windows retrieve templates, exact containment verifies.

Only DataFrame functions run here. A template with m shingles of five words is looked for in windows of 1.25 times
the power of two above m, a quarter of that power apart, so that any run as long as the template lies in one whole.
A window that contains 0.8 of the template then resembles it by at least 0.29, and one of 24 bands of one MinHash
each agrees with a chance above 0.999.

Windows are made only around cue words. A template's cues are chosen so that more than a fifth of its shingles hold
one: text that holds none of them cannot contain 0.8 of the template.

Licences and versions of nearly the same wording are told apart by marks, words that must all be in the window.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHINGLE = 5
BANDS = 24
LEAST_CONTAINED = 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

# Notices and grants as their publishers word them, and the words that tell a licence or a version from
# others of nearly the same wording: all of them must be there.
NOTICE = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {family} Public License "
    "as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
)
OLD_NOTICE = (
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {family} Public License "
    "as published by the Free Software Foundation; either version {version} of the License, or (at your option) any later version."
)
GNU = (("GPL", "General", "2"), ("GPL", "General", "3"), ("LGPL", "Lesser General", "2.1"), ("LGPL", "Lesser General", "3"),
       ("AGPL", "Affero General", "3"))
CREATIVE = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-NC": "Attribution-NonCommercial",
            "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}


def gnu_templates():
    for name, family, version in GNU:
        label = f"{name}-{version if '.' in version else version + '.0'}"
        marks = (f"gnu {family.lower()} public", f"version {version.replace('.', ' ')}")
        yield label, f"This work is licensed under the GNU {family} Public License, version {version}.", marks
        # The two wordings of the notice differ in punctuation only.
        yield label, (OLD_NOTICE if version.startswith("2") else NOTICE).format(family=family, version=version), marks


def creative_templates():
    for code, name in CREATIVE.items():
        for version in ("3.0", "4.0"):
            words = name.lower().replace("-", " ")
            yield f"CC-{code}-{version}", f"Creative Commons {name} {version}", (f"commons {words} {version.replace('.', ' ')}",)
            if code != "BY":
                short = f"under CC {code} {version}"
                yield f"CC-{code}-{version}", f"Licensed {short}.", (f"cc {code.lower().replace('-', ' ')} {version.replace('.', ' ')}",)


TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0.", ("version 2 0",)),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
     "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", ("version 2 0",)),
    ("MIT", "Released under the MIT License.", ()),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
     "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
     "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", ()),
    *gnu_templates(),
    *creative_templates(),
    # Both BSD licences begin alike; the third clause tells them apart.
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
     "following conditions are met", ()),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
     "derived from this software without specific prior written permission.", ()),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
     "that the above copyright notice and this permission notice appear in all copies.", ("with or without fee",)),
    ("Unlicense", "This is free and unencumbered software released into the public domain.", ("free and unencumbered",)),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ("v 2 0",)),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1", ("version 1 1",)),
)


@dataclass(frozen=True)
class Template:
    number: int
    license: str
    words: tuple[str, ...]
    marks: tuple[str, ...] = ()

    def marked(self) -> list[list[str]]:
        """For each mark, the shingles that hold it (or, of one longer than a shingle, lie in it): one of them must be found."""
        out = []
        for mark in self.marks:
            held = [s for s in self.shingles if f" {mark} " in f" {s} " or f" {s} " in f" {mark} "]
            if not held:
                raise ValueError(f"the template of {self.license} lacks {mark!r}")
            out.append(held)
        return out

    @property
    def shingles(self) -> list[str]:
        return sorted({" ".join(self.words[i : i + SHINGLE]) for i in range(len(self.words) - SHINGLE + 1)})

    @property
    def span(self) -> int:
        """The power of two that its shingles' places fit in."""
        return 1 << (max(1, len(self.words) - SHINGLE + 1) - 1).bit_length()

    def cues(self) -> set[str]:
        """Longest words first, until less than 0.8 of the shingles hold none."""
        left, chosen = self.shingles, set()
        for word in sorted(set(self.words), key=lambda w: (-len(w), w)):
            if len(left) < LEAST_CONTAINED * len(self.shingles):
                break
            chosen.add(word)
            left = [s for s in left if word not in s.split()]
        return chosen


def read_templates(pairs=TEMPLATES) -> list[Template]:
    out = []
    for number, (name, text, *more) in enumerate(pairs):
        words = tuple(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(str.maketrans(UPPER, LOWER))))
        if len(words) < SHINGLE:
            raise ValueError(f"a template needs {SHINGLE} words: {text}")
        out.append(Template(number, name, words, *more))
    return out


def shingled(words: Column, first: Column, last: Column) -> Column:
    """Shingles that begin at the places first..last (from 0); none where last is before first."""
    places = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.array_join(F.slice(words, i + 1, SHINGLE), " "))


def min_hashes(shingles: Column) -> Column:
    hashes = F.transform(shingles, lambda s: F.xxhash64(s))
    bands = F.array(*[F.lit(i) for i in range(BANDS)])
    return F.transform(bands, lambda band: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, band))))


def windows_near(span: int) -> Column:
    """The windows for templates of a span that hold a shingle with a cue word (places ``at`` among ``n`` words)."""
    step, size = max(1, span // 4), span + max(1, span // 4)
    last = F.floor((F.col("n") - SHINGLE) / step)

    def near(place: Column) -> Column:
        first = F.greatest(F.lit(0), F.ceil((place - (SHINGLE - 1) - (size - 1)) / step))
        return F.sequence(first.cast("int"), F.greatest(F.lit(0), F.least(last, F.floor(place / step))).cast("int"))

    windows = F.array_distinct(F.flatten(F.transform("at", near)))
    return F.struct(F.lit(span).alias("span"), F.lit(step).alias("step"), F.lit(size).alias("size"), windows.alias("windows"))


def scan_licenses(docs: DataFrame, *, templates=TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, license, contained (largest share of a template's shingles in a window), first_word of that window.

    One row per license found in a row of ``docs``; a row without any, or with a null or empty text, gives none. Repeated rows
    and rows of one id count as one document; a null id stays null. Other columns are ignored. Of equal windows the first counts.
    """
    spark = docs.sparkSession
    known = read_templates(templates)
    cues = sorted(set().union(*(t.cues() for t in known)))
    text = F.translate(F.col(f"`{text_col}`").cast("string"), UPPER, LOWER)
    # A cheap look for cues in the raw text, before it is cut into words. The text is bound to a name of its own, as it
    # would be lowered anew for every cue otherwise; a cue that holds another one tells no more than that.
    least = [cue for cue in cues if not any(other in cue for other in cues if other != cue)]
    hint = F.exists(F.array("text"), lambda lowered: reduce(or_, [F.contains(lowered, F.lit(cue)) for cue in least]))
    cue_list = F.array(*map(F.lit, cues))
    words = (
        docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text")).where(hint)
        .select("doc_id", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words")).where(F.size("words") >= SHINGLE)
        .withColumn("n", F.size("words"))
    )
    cued = words.withColumn("at", F.filter(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.array_contains(cue_list, F.get("words", i))))
    spans = sorted({t.span for t in known})
    by_span = cued.select("doc_id", "words", "n", F.inline(F.array(*map(windows_near, spans))))
    windows = (
        by_span.select("doc_id", "words", "n", "span", "step", "size", F.explode("windows").alias("window"))
        .withColumn("first", F.col("window") * F.col("step"))
        .withColumn("shingles", F.array_distinct(shingled(F.col("words"), F.col("first"), F.least(F.col("first") + F.col("size"), F.col("n") - SHINGLE + 1) - 1)))
        .select("doc_id", "span", "first", "shingles")
    )
    # Equal windows of copies are looked up once for all of them.
    banded = windows.where(F.size("shingles") > 0).select("doc_id", "first", "span", "shingles", F.posexplode(min_hashes(F.col("shingles"))).alias("band", "value"))
    rows = [
        F.struct(
            F.lit(t.number).alias("template"), F.lit(t.license).alias("license"), F.lit(t.span).alias("span"),
            F.array(*map(F.lit, t.shingles)).alias("parts"),
            F.array(*[F.array(*map(F.lit, held)) for held in t.marked()]).cast("array<array<string>>").alias("marks"),
        )
        for t in known
    ]
    table = spark.range(1).select(F.inline(F.array(*rows)))
    keyed = table.select("template", "license", "span", "parts", "marks", F.posexplode(min_hashes(F.col("parts"))).alias("band", "value"))
    return (
        banded.join(keyed, ["span", "band", "value"])
        .withColumn("contained", F.size(F.array_intersect("shingles", "parts")) / F.size("parts"))
        .where(F.col("contained") >= LEAST_CONTAINED)
        .where(F.forall("marks", lambda held: F.arrays_overlap("shingles", held)))
        .groupBy("doc_id", "license")
        .agg(F.max(F.struct("contained", (-F.col("first")).alias("before"))).alias("best"))
        .select("doc_id", "license", F.col("best.contained").alias("contained"), (-F.col("best.before")).alias("first_word"))
    )
