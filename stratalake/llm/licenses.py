"""License scans: sparse TF-IDF cosine of lines, blocks and licence files to templates, then inheritance.

Every line of a file, every block of up to ``BLOCK`` consecutive lines with words, and the whole text
of a licence file are compared with templates: notices of one sentence, headers of several lines and
whole licence texts. Weights use document frequencies of all terms over the whole corpus. A
cosine of ``threshold`` needs shared terms that carry ``threshold ** 2`` of a template's squared
norm. So a text without any of a template's anchors (terms with the rest) can be left out without
loss, and so can a file whose terms carry less of every template. A block that begins or ends with a
line without terms of a template is never nearer to it than the block without that line. A file without a
notice inherits from the nearest directory above it that has a licence file.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import free_name, saved, small

THRESHOLD = 0.8
#: Lines with words of a block, at most: the longest header or short licence wrapped at some 60 characters.
BLOCK = 32
TERM = r"[a-z0-9]+"
LICENSE_FILE = r"(?i)(^|/)(licen[cs]e|copying|unlicense)([.-][^/]*)?$"

# SPDX identifiers and the names that notices use.
NAMES = [
    ("AGPL-3.0", "the GNU Affero General Public License, version 3"),
    ("Apache-2.0", "the Apache License, Version 2.0"),
    ("BSD-2-Clause", "the BSD 2-Clause License"),
    ("BSD-3-Clause", "the BSD 3-Clause License"),
    ("CC-BY-4.0", "CC BY 4.0"),
    ("CC-BY-NC-4.0", "CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "CC BY-SA 4.0"),
    ("CC0-1.0", "CC0 1.0"),
    ("GPL-2.0", "the GNU General Public License, version 2"),
    ("GPL-3.0", "the GNU General Public License, version 3"),
    ("ISC", "the ISC License"),
    ("LGPL-3.0", "the GNU Lesser General Public License, version 3"),
    ("MIT", "the MIT License"),
    ("MPL-2.0", "the Mozilla Public License, version 2.0"),
    ("Unlicense", "the Unlicense"),
]
# Notices that name a licence, and the opening words of some licence files.
NOTICES = [
    "Licensed under {}.",
    "Released under {}.",
    "This work is licensed under {}.",
    "This file is part of a program under {}.",
]
OPENINGS = [
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files, to deal in the Software without restriction",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


# The standard headers of files under licences that have one.
GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0}General"
    " Public License as published by the Free Software Foundation, either version {1} of the License, or (at your"
    " option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY"
    " WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU"
    " {0}General Public License for more details. You should have received a copy of the GNU {0}General Public License"
    " along with this program. If not, see <https://www.gnu.org/licenses/>."
)
COMMONS = (
    "This work is licensed under the Creative Commons {0} 4.0 International License. To view a copy of this license,"
    " visit https://creativecommons.org/licenses/{1}/4.0/ or send a letter to Creative Commons, PO Box 1866, Mountain"
    " View, CA 94042, USA."
)
HEADERS = [
    ("AGPL-3.0", GNU.format("Affero ", 3)),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance'
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless"
        " required by applicable law or agreed to in writing, software distributed under the License is distributed on"
        ' an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License'
        " for the specific language governing permissions and limitations under the License.",
    ),
    ("CC-BY-4.0", COMMONS.format("Attribution", "by")),
    ("CC-BY-NC-4.0", COMMONS.format("Attribution-NonCommercial", "by-nc")),
    ("CC-BY-SA-4.0", COMMONS.format("Attribution-ShareAlike", "by-sa")),
    (
        "CC0-1.0",
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights"
        " to this software to the public domain worldwide. This software is distributed without any warranty. You should"
        " have received a copy of the CC0 Public Domain Dedication along with this software. If not, see"
        " <http://creativecommons.org/publicdomain/zero/1.0/>.",
    ),
    ("GPL-2.0", GNU.format("", 2)),
    ("GPL-3.0", GNU.format("", 3)),
    ("LGPL-3.0", GNU.format("Lesser ", 3)),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was"
        " not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
]


def templates() -> list[tuple[str, str]]:
    """``license, text`` of every template of one sentence."""
    notices = [(spdx, notice.format(name)) for spdx, name in NAMES for notice in NOTICES]
    return notices + [(spdx, f"SPDX-License-Identifier: {spdx}") for spdx, _ in NAMES] + OPENINGS


def long_templates() -> list[tuple[str, str]]:
    """``license, text`` of headers of several lines and of whole licence texts."""
    texts = sorted((Path(__file__).parent / "license_texts").glob("*.txt"))
    return HEADERS + [(path.stem, path.read_text(encoding="utf-8")) for path in texts]


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TERM), F.lit(0))


def _template_terms(files: DataFrame, given: list[tuple[str, str]]) -> DataFrame:
    """``template, license, term, tf`` from literals."""
    listed = F.array(
        *[
            F.struct(F.lit(k).alias("template"), F.lit(a).alias("license"), F.lit(t).alias("t"))
            for k, (a, t) in enumerate(given)
        ]
    )
    rows = files.sparkSession.range(1).select(F.explode(listed).alias("x")).select("x.*")
    return (
        rows.select("template", "license", F.explode(terms_of(F.col("t"))).alias("term"))
        .groupBy("template", "license", "term")
        .agg(F.count("*").alias("tf"))
    )


def _frequencies(files: DataFrame) -> DataFrame:
    """``term, df``: the number of files that have a term, for every term; that of all files with the empty one."""
    held = F.array_distinct(F.concat(F.array(F.lit("")), terms_of(F.col("text"))))
    return saved(files.select(F.explode(held).alias("term")).groupBy("term").agg(F.count("*").alias("df")))


def _idf(n: int) -> Column:
    return F.log((1.0 + n) / (1.0 + F.coalesce(F.col("df"), F.lit(0)))) + 1.0


def _weighted(files: DataFrame, given: list[tuple[str, str]], frequencies: DataFrame, n: int) -> DataFrame:
    """``template, license, term, unit`` (weight in a vector of length 1) and ``idf``."""
    own = _template_terms(files, given)
    weighted = F.broadcast(own).join(frequencies, "term")
    unseen = own.join(weighted.select("term").distinct(), "term", "left_anti").withColumn("df", F.lit(0))
    weighted = saved(weighted.unionByName(unseen).withColumn("idf", _idf(n)))
    norms = weighted.groupBy("template").agg(F.sqrt(F.sum(F.pow(F.col("tf") * F.col("idf"), 2))).alias("norm"))
    return saved(
        weighted.join(F.broadcast(norms), "template").select(
            "template", "license", "term", "idf", (F.col("tf") * F.col("idf") / F.col("norm")).alias("unit")
        )
    )


def _anchors(unit: DataFrame, threshold: float) -> list[str]:
    """Terms of which every text that reaches the threshold with some template has one, rare ones first."""
    by_template: dict[int, list] = {}
    for r in unit.collect():
        by_template.setdefault(r.template, []).append((-r.idf, -r.unit, r.term, r.unit))
    anchors: set[str] = set()
    for terms in by_template.values():
        left = 1.0
        for *_, term, weight in sorted(terms):
            if left < threshold**2 - 1e-9:
                break
            anchors.add(term)
            left -= weight**2
    return sorted(anchors)


def _covered(texts: DataFrame, unit: DataFrame, threshold: float) -> DataFrame:
    """``id, template`` where the text's terms carry enough of the template's squared norm."""
    held = texts.select("id", F.explode(F.array_distinct(terms_of(F.col("text")))).alias("term"))
    return (
        held.join(F.broadcast(unit.select("template", "term", "unit")), "term")
        .groupBy("id", "template")
        .agg(F.sum(F.pow("unit", 2)).alias("share"))
        .where(F.col("share") >= threshold**2 - 1e-9)
        .select("id", "template")
    )


def _blocks(
    texts: DataFrame, covered: DataFrame, unit: DataFrame, frequencies: DataFrame, n: int, threshold: float, block: int
) -> DataFrame:
    """``id, terms`` of the lines and blocks of different ``id, text`` that may reach the threshold.

    Vectors of lines add up to that of a block: products with a template do, and squared norms are
    at least their sum. Both are running sums, so a line meets at most ``block`` others, whatever the
    length of the text. Texts come divided by ``id``, so their terms are counted where they are; only
    terms that no template has are shuffled, to look up their frequency.
    """
    lines = texts.join(covered.select("id").distinct(), "id", "left_semi").select(
        "id", F.filter(F.transform(F.split("text", "\n"), terms_of), lambda t: F.size(t) > 0).alias("lines")
    )
    tf = (
        lines.select("id", F.posexplode("lines").alias("at", "terms"))
        .select("id", "at", F.explode("terms").alias("term"))
        .groupBy("id", "at", "term")
        .agg(F.count("*").alias("tf"))
    )
    known = F.broadcast(unit.select("term", "idf").distinct())
    others = tf.join(known, "term", "left_anti").join(frequencies, "term").withColumn("idf", _idf(n))
    square = F.sum(F.pow(F.col("tf") * F.col("idf"), 2)).alias("square")
    squares = tf.join(known, "term").groupBy("id", "at").agg(square).unionByName(others.groupBy("id", "at").agg(square))
    squares = squares.groupBy("id", "at").agg(F.sum("square").alias("square"))
    squares = squares.withColumn("squares", F.sum("square").over(Window.partitionBy("id").orderBy("at")))
    dots = (
        tf.join(F.broadcast(unit.select("template", "term", "idf", "unit")), "term")
        .join(covered, ["id", "template"], "left_semi")
        .groupBy("id", "template", "at")
        .agg(F.sum(F.col("tf") * F.col("idf") * F.col("unit")).alias("dot"))
    )
    of_template = Window.partitionBy("id", "template").orderBy("at")
    ends = dots.withColumn("dots", F.sum("dot").over(of_template)).join(squares, ["id", "at"])
    before = F.struct(
        F.col("at").alias("start"), (F.col("dots") - F.col("dot")).alias("d"), (F.col("squares") - F.col("square")).alias("q")
    )
    starts = F.collect_list(before).over(of_template.rangeBetween(1 - block, 0))
    found = (
        ends.withColumn("starts", starts)
        .withColumn(
            "starts",
            F.filter(
                "starts",
                lambda s: F.col("dots") - s["d"] >= (threshold - 1e-6) * F.sqrt(F.col("squares") - s["q"]),
            ),
        )
        .select("id", "at", F.explode("starts.start").alias("start"))
        .distinct()
    )
    cut = F.flatten(F.slice("lines", F.col("start") + 1, F.col("at") - F.col("start") + 1))
    return found.join(lines, "id").select("id", cut.alias("terms"))


def notices(
    files: DataFrame, threshold: float = THRESHOLD, given: list[tuple[str, str]] | None = None, block: int = BLOCK
) -> DataFrame:
    """``path, license, score``: the most similar template of every file that reaches the threshold.

    ``block`` is the most lines with words that are compared together in a file that is no licence
    file; a longer text of a licence inside another file is found as far as such parts of it allow.
    Ties go to the licence that comes first by name. Paths that occur more than once are one file.
    """
    given = templates() + long_templates() if given is None else given
    frequencies = _frequencies(files)
    n = sum(r.df for r in frequencies.where("term = ''").collect())
    unit = _weighted(files, given, frequencies, n)
    anchors = F.array(*[F.lit(t) for t in _anchors(unit, threshold)])
    near = files.select("path", "text", terms_of(F.col("text")).alias("terms")).where(F.arrays_overlap("terms", anchors))
    same = F.substring(F.unhex(F.sha2("text", 256)), 1, 16)
    near = saved(near.select("path", "text", same.alias("id")))
    # One of equal texts, divided by id: what follows counts terms without a shuffle.
    texts = near.groupBy("id").agg(F.any_value("text").alias("text"))
    covered = saved(_covered(texts, unit, threshold))
    blocks = _blocks(texts, covered, unit, frequencies, n, threshold, block)
    blocks = blocks.join(near.select("path", "id").distinct(), "id").drop("id")
    whole = near.where(F.col("path").rlike(LICENSE_FILE)).select("path", terms_of(F.col("text")).alias("terms"))
    candidates = saved(
        blocks.unionByName(whole).select("path", F.sha2(F.array_join("terms", " "), 256).alias("bag"), "terms")
    )
    best = saved(_best(candidates.select("bag", "terms").distinct(), unit, frequencies, n, threshold))
    return (
        candidates.join(small(best, best.count(), 500_000), "bag")
        .groupBy("path")
        .agg(F.min("best").alias("best"))
        .select("path", "best.license", (-F.col("best.s")).alias("score"))
    )


def _best(bags: DataFrame, unit: DataFrame, frequencies: DataFrame, n: int, threshold: float) -> DataFrame:
    """``bag, best`` (negative score, licence) of those ``bag, terms`` that reach the threshold with some template.

    Terms that no template has weigh 1 at least: what can't reach the threshold even so is left out
    before the frequencies of the rest are looked up.
    """
    tf = bags.select("bag", F.explode("terms").alias("term")).groupBy("bag", "term").agg(F.count("*").alias("tf"))
    idf = unit.select("term", "idf").distinct()
    tf = saved(tf.join(F.broadcast(idf), "term", "left"))
    least = tf.groupBy("bag").agg(F.sum(F.pow(F.col("tf") * F.coalesce("idf", F.lit(1.0)), 2)).alias("least"))
    dots = (
        tf.join(F.broadcast(unit.select("template", "license", "term", "unit")), "term")
        .groupBy("bag", "template", "license")
        .agg(F.sum(F.col("tf") * F.col("idf") * F.col("unit")).alias("dot"))
        .join(least, "bag")
        .where(F.col("dot") >= (threshold - 1e-6) * F.sqrt("least"))
    )
    dots = saved(dots)
    others = tf.where("idf IS NULL").drop("idf").join(dots.select("bag").distinct(), "bag", "left_semi")
    # A term outside the templates has weighed 1 in ``least``; now comes what it weighs more.
    more = (
        others.join(frequencies, "term")
        .groupBy("bag")
        .agg(F.sum(F.pow(F.col("tf") * _idf(n), 2) - F.pow("tf", 2)).alias("more"))
    )
    norm = F.sqrt(F.col("least") + F.coalesce("more", F.lit(0.0)))
    return (
        dots.join(more, "bag", "left")
        .select("bag", "license", F.round(F.col("dot") / norm, 6).alias("score"))
        .where(F.col("score") >= threshold)
        .groupBy("bag")
        .agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("best"))
    )


def _folder(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scan(
    files: DataFrame, threshold: float = THRESHOLD, given: list[tuple[str, str]] | None = None, block: int = BLOCK
) -> DataFrame:
    """Every row of ``files`` (``path, text`` and any others) with its licence, without ``text``.

    Added: ``license``, ``score`` (of its own notice), ``inherited_from`` (the folder whose licence
    file it comes from, NULL for its own). A NULL path counts as a file without name at the root.
    Folders are resolved once each, not per file, so a folder with a third of all files is one row
    of the path join.
    """
    folder, mine, nearest_above = (free_name(name, files.columns) for name in ("__folder", "__own", "__nearest"))
    keyed = files.withColumn("path", F.coalesce("path", F.lit("")))
    own = saved(notices(keyed, threshold, given, block))
    granted = (
        own.where(F.col("path").rlike(LICENSE_FILE))
        .groupBy(_folder(F.col("path")).alias("above"))
        .agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("best"))
        .select("above", F.col("best.license").alias("granted"))
    )
    folders = keyed.select(_folder(F.col("path")).alias("folder")).distinct()
    parts = F.split("folder", "/")
    above = F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(parts, F.lit(1), k), "/").alias("above")),
    )
    nearest = (
        folders.select("folder", F.explode(above).alias("a"))
        .select("folder", "a.depth", "a.above")
        .join(granted, "above")
        .groupBy("folder")
        .agg(F.max_by(F.struct("above", "granted"), "depth").alias(nearest_above))
        .withColumnRenamed("folder", folder)
    )
    rest = [F.col(f"`{c}`") for c in files.columns if c not in ("path", "text", "license", "score", "inherited_from")]
    return (
        keyed.select("path", *rest, _folder(F.col("path")).alias(folder))
        .join(own.select("path", F.struct("license", "score").alias(mine)), "path", "left")
        .join(nearest, folder, "left")
        .select(
            "path",
            *rest,
            F.coalesce(f"{mine}.license", f"{nearest_above}.granted").alias("license"),
            F.col(f"{mine}.score").alias("score"),
            F.when(F.col(mine).isNull(), F.col(f"{nearest_above}.above")).alias("inherited_from"),
        )
    )
