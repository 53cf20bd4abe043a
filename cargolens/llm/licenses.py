"""Licence scan by Dice coefficients over word bigrams (DataFrame functions only).

A text's units -- its lines, its paragraphs and the whole -- are normalised
(lower case, everything but ASCII letters and digits is a blank) and compared
with licence templates: Dice = 2 |A and B| / (|A| + |B|) over the sets of word
bigrams.  Two sets can only reach the threshold if their sizes are near enough,
so most templates are pruned by size before any bigrams are compared.

The scan is one pass without a shuffle; the templates (a parameter, a few
kilobytes) are broadcast.

Defined results: a null or empty text, or one of a single word, matches
nothing; of equally good templates the last by name counts; repeated rows are
scanned one by one; equal units of a text count once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import attach
from .common import as_row, restored

THRESHOLD = 0.8
# Names and wording of public licences and their usual notices.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
                 "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
                 "(at your option) any later version."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                   "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                   "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met: 1. Redistributions of source code must retain the above "
                     "copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary "
                     "form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
                     "in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met: 1. Redistributions of source code must retain the above "
                     "copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary "
                     "form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
                     "in the documentation and/or other materials provided with the distribution. 3. Neither the name of the "
                     "copyright holder nor the names of its contributors may be used to endorse or promote products derived "
                     "from this software without specific prior written permission."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
                "this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions: The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def _words(unit: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(unit), "[^a-z0-9]+", " ")), " ")


def _bigrams(words: Column) -> Column:
    """Distinct hashes of neighbouring words; empty for fewer than two words."""
    pairs = F.transform(words, lambda w, i: F.when(i > 0, F.xxhash64(F.get(words, i - 1), w)))
    return F.array_distinct(F.slice(pairs, F.lit(2), F.size(words)))


def template_table(spark: SparkSession, templates: Sequence[tuple[str, str]]) -> DataFrame:
    """One row: array of (name, n, grams)."""
    rows = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit(text).alias("text")) for name, text in templates])).alias("t"))
    words = rows.select("t.name", _words(F.col("t.text")).alias("w"))
    grams = words.select("name", _bigrams(F.col("w")).alias("grams"))
    return grams.agg(F.collect_list(F.struct("name", F.size("grams").alias("n"), "grams")).alias("_templates"))


def license_scan(df: DataFrame, text_col: str = "text", threshold: float = THRESHOLD,
                 templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """All columns of ``df``, the best matching ``license`` and its ``dice`` (null
    without a match), and ``licensed_units``, how many units match a template (in
    place of columns of these names)."""
    text = F.coalesce("_text", F.lit(""))
    units = as_row(df, _text=text_col).withColumn("_units", F.array_distinct(F.concat(
        F.split(text, r"\n+"), F.split(text, r"\n[ \t]*\n"), F.array(text))))
    words = units.withColumn("_words", F.transform("_units", _words))
    grams = words.withColumn("_grams", F.filter(F.transform("_words", _bigrams), lambda g: F.size(g) > 0))
    least, most = threshold / (2 - threshold), (2 - threshold) / threshold
    eps = 1e-9

    def best(g: Column) -> Column:
        near = F.filter("_templates", lambda t: (F.size(g) >= t["n"] * (least - eps)) & (F.size(g) <= t["n"] * (most + eps)))
        return F.array_max(F.transform(near, lambda t: F.struct(
            (F.size(F.array_intersect(g, t["grams"])) * 2.0 / (F.size(g) + t["n"])).alias("dice"), t["name"].alias("name"))))

    scored = attach(grams, template_table(df.sparkSession, templates)).withColumn(
        "_hits", F.filter(F.transform("_grams", best), lambda m: m["dice"] >= threshold))
    top = scored.withColumn("_top", F.array_max("_hits"))
    made = {"license": F.col("_top.name"), "dice": F.col("_top.dice"), "licensed_units": F.size("_hits").cast("long")}
    return top.select(*restored(df, tuple(made), _text=text_col), *[v.alias(c) for c, v in made.items()])


def oracle(threshold: float = THRESHOLD, templates: Sequence[tuple[str, str]] = TEMPLATES) -> str:
    """DuckDB SQL for the scan of ``documents``: (doc_id, license, dice, licensed_units)."""
    values = ", ".join("('" + name + "', '" + text.replace("'", "''") + "')" for name, text in templates)
    words = "string_split(trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g')), ' ')"
    grams = "list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))])"
    return f"""
WITH templates AS (
  SELECT name, {grams} AS grams FROM (SELECT name, {words.format('text')} AS w FROM (VALUES {values}) AS t(name, text))),
units AS (
  SELECT doc_id, unnest(list_distinct(list_concat(string_split_regex(coalesce(text, ''), '\\n+'),
         string_split_regex(coalesce(text, ''), '\\n[ \\t]*\\n'), [coalesce(text, '')]))) AS unit FROM documents),
grams AS (
  SELECT doc_id, unit, {grams} AS grams FROM (SELECT doc_id, unit, {words.format('unit')} AS w FROM units)),
scored AS (
  SELECT doc_id, unit, t.name, len(list_intersect(g.grams, t.grams)) * 2.0 / (len(g.grams) + len(t.grams)) AS dice
  FROM grams AS g JOIN templates AS t ON len(g.grams) > 0
   AND len(g.grams) >= len(t.grams) * {threshold / (2 - threshold) - 1e-9} AND len(g.grams) <= len(t.grams) * {(2 - threshold) / threshold + 1e-9}),
best AS (
  SELECT doc_id, unit, max({{'dice': dice, 'name': name}}) AS top FROM scored WHERE dice >= {threshold} GROUP BY doc_id, unit),
hits AS (
  SELECT doc_id, max(top) AS top, count(*) AS n FROM best GROUP BY doc_id)
SELECT d.doc_id, h.top.name AS license, h.top.dice AS dice, coalesce(h.n, 0) AS licensed_units
FROM documents AS d LEFT JOIN hits AS h ON d.doc_id = h.doc_id
"""
