"""Licence scan: normalised text against licence templates by the Dice coefficient over word bigrams.

Units are the lines, the blank-line paragraphs and the whole of a text, each
normalised: lower case, every run of other characters than letters and digits
one space.  A unit matches a template when the Dice coefficient of their sets
of word bigrams, 2 |A and B| / (|A| + |B|), reaches the threshold.  That needs
t / (2 - t) <= |A| / |B| <= (2 - t) / t, so every template is listed under the
set sizes it can match and a unit meets only the templates of its own size.

Column expressions only.  The broadcast side is the template list: the
templates times the sizes they admit, whatever the input.

Defined cases: a NULL or empty text has no match; units of fewer than two
words have no bigram and match nothing; repeated lines of one text count once;
rows of equal doc_id are reported together, those without an id as one; an
empty table yields no rows; other columns are not read.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import whole

THRESHOLD = 0.8

# Licence notices and short licence texts.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and '
            'associated documentation files (the "Software"), to deal in the Software without restriction, including '
            'without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell '
            'copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the '
            'following conditions:'),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all "
            "copies."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except '
                   'in compliance with the License. You may obtain a copy of the License at'),
    ("Apache-2.0", "Released under the Apache 2.0 license."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring "
                "rights to this work."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
                     "License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
                     "License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("proprietary", "All rights reserved."),
)


def template_bigrams(text: str) -> list[str]:
    """The distinct word bigrams of a template, normalised as units are."""
    words = re.sub(r"[^a-z0-9]+", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def size_range(n: int, threshold: float) -> range:
    """Sizes of sets that can reach the threshold with a set of ``n``."""
    return range(math.ceil(round(n * threshold / (2 - threshold), 9)),
                 math.floor(round(n * (2 - threshold) / threshold, 9)) + 1)


def template_table(spark: SparkSession, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``size, license, template`` (bigrams): a row for each set size that a template can match."""
    rows = [(n, license_id, bigrams) for license_id, text in templates
            if (bigrams := template_bigrams(text)) for n in size_range(len(bigrams), threshold)]
    return spark.createDataFrame(rows, "size int, license string, template array<string>")


def _bigram_set(unit: Column) -> Column:
    """Distinct word bigrams of a normalised unit."""
    words = F.array(F.split(unit, " "))
    pairs = F.transform(words, lambda w: F.array_distinct(F.filter(
        F.zip_with(w, F.slice(w, F.lit(2), F.size(w)), lambda a, b: F.concat(a, F.lit(" "), b)),
        lambda p: p.isNotNull())))
    return F.element_at(pairs, 1)


def units_of(text: Column) -> Column:
    """Distinct normalised units of a text."""
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\n]+", " "))
    units = F.concat(F.split(plain, "\n"), F.split(plain, "\n ?\n"), F.array(plain))
    return F.array_distinct(F.transform(units, lambda u: F.trim(F.regexp_replace(u, r"[ \n]+", " "))))


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, license, dice, n_units``: licences of each document, the best coefficient, the units that match best."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be over 0 and at most 1")
    listed = template_table(docs.sparkSession, templates, threshold)
    sizes = [n for _, text in templates for n in size_range(len(template_bigrams(text)), threshold)]
    units = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.explode(F.transform(units_of(whole()), _bigram_set)).alias("unit"))
    units = units.withColumn("size", F.size("unit")).where(
        F.col("size").between(max(1, min(sizes, default=1)), max(sizes, default=0)))
    # the template list is a constant of the program
    met = units.join(F.broadcast(listed), "size")
    shared = F.size(F.array_intersect("unit", "template"))
    found = met.select("doc_id", "license", "unit", (
        F.lit(2.0) * shared / (F.col("size") + F.size("template"))).alias("dice")).where(F.col("dice") >= threshold)
    # every unit goes to the template it is most like; ties to the first licence by name
    best = found.groupBy("doc_id", F.xxhash64("unit").alias("unit")).agg(
        F.min(F.struct((-F.col("dice")).alias("less"), "license")).alias("best"))
    return best.groupBy("doc_id", F.col("best.license").alias("license")).agg(
        (-F.min("best.less")).alias("dice"), F.count(F.lit(1)).alias("n_units"))


def oracle_sql(templates=TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The scan over ``documents`` in DuckDB's SQL."""
    quote = "'{}'".format
    rows = ", ".join("({}, [{}])".format(quote(license_id), ", ".join(map(quote, bigrams)))
                     for license_id, text in templates if (bigrams := template_bigrams(text)))
    return f"""
WITH plain AS (
  SELECT doc_id, trim(regexp_replace(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g'), ' ') AS x
  FROM documents),
parts AS (
  SELECT doc_id, unnest(list_distinct(list_concat(
    string_split(x, chr(10)), string_split_regex(x, '\\n ?\\n'), [x]))) AS u FROM plain),
worded AS (SELECT doc_id, string_split(trim(regexp_replace(u, '[ \\n]+', ' ', 'g'), ' '), ' ') AS w FROM parts),
units AS (
  SELECT DISTINCT doc_id, list_sort(list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))])) AS unit
  FROM worded WHERE len(w) > 1),
templates(license, template) AS (VALUES {rows}),
found AS (
  SELECT doc_id, license, unit,
         max(2.0::DOUBLE * len(list_intersect(unit, template)) / (len(unit) + len(template))) AS dice
  FROM units, templates
  WHERE len(unit) >= {threshold / (2 - threshold)} * len(template) - 1e-6
    AND len(unit) <= {(2 - threshold) / threshold} * len(template) + 1e-6
  GROUP BY ALL),
best AS (
  SELECT * FROM found WHERE dice >= {threshold}
  QUALIFY row_number() OVER (PARTITION BY doc_id, unit ORDER BY dice DESC, license) = 1)
SELECT doc_id, license, max(dice) AS dice, count(*) AS n_units FROM best GROUP BY doc_id, license"""
