"""Licence scans: normalised text against licence templates by the Dice coefficient of word bigrams.

Compared are every line and the whole text of a document. With ``a`` and ``b`` different bigrams
the coefficient is at most ``2 min(a, b) / (a + b)``, so a threshold bounds the ratio of the sizes:
units outside the bounds of all templates are dropped before bigrams are built, and each of the
others meets only the templates its size admits. All of it is built-in functions.

Defined results: a null text counts as empty and has no match; a line found several times in a
document counts once; of templates with equal likeness the first by name is a unit's; repeated
and null ids keep their rows; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Public licence notices as they stand in files and pages.
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required "
        "by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
        "the specific language governing permissions and limitations under the License."
    ),
    "BSD": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "MIT": "Released under the MIT License.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
#: The whole texts of common licences, beside the notices; names are those of the files.
TEXTS = {f"{p.stem}-text": p.read_text() for p in sorted((Path(__file__).parent / "texts").glob("*.txt"))}
THRESHOLD = 0.8
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """Lower-case ASCII letters and digits, with one space between words."""
    return F.trim(F.regexp_replace(F.translate(text, CAPITALS, SMALL), "[^a-z0-9]+", " "))


def n_words(normal: Column) -> Column:
    return F.when(normal == "", 0).otherwise(F.length(normal) - F.length(F.replace(normal, F.lit(" "), F.lit(""))) + 1)


def bigrams(found: Column) -> Column:
    """The different pairs of neighbouring words, of an array of at least two."""
    return F.array_distinct(
        F.zip_with(F.slice(found, 1, F.size(found) - 1), F.slice(found, 2, F.size(found) - 1), lambda a, b: F.concat_ws(" ", a, b))
    )


def template_bigrams(text: str) -> list[str]:
    low = "".join(c if c in SMALL or c.isascii() and c.isdigit() else " " for c in "".join(c.lower() if c in CAPITALS else c for c in text))
    found = low.split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(found, found[1:])))


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES | TEXTS, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, matches): for each document the distinct units like a template, as structs
    (unit, licence, dice) by unit; ``unit`` is the normalised text."""
    parts = {name: template_bigrams(text) for name, text in sorted(templates.items())}
    least, most = threshold / (2 - threshold), (2 - threshold) / threshold
    text = F.coalesce(F.col(text_col), F.lit(""))
    # A unit has fewer different bigrams than words; repeats may leave it far fewer.
    smallest = min(map(len, parts.values())) * least
    units = F.concat(F.split(text, "\n"), F.array(text))
    normal = F.array_distinct(F.transform(F.filter(units, lambda u: F.length(u) > smallest), normalised))
    large = F.filter(normal, lambda u: (n_words(u) > smallest) & (n_words(u) > 1))
    # Each step binds what the next uses more than once.
    counted = F.transform(large, lambda u: F.struct(u.alias("unit"), bigrams(F.split(u, " ")).alias("own")))
    known = F.array(*[
        F.struct(F.lit(-k).alias("place"), F.lit(name).alias("licence"), F.split(F.lit("\n".join(p)), "\n").alias("pairs"), F.lit(len(p)).alias("n"))
        for k, (name, p) in enumerate(parts.items())
    ])

    def likenesses(x: Column) -> Column:
        size = F.size(x["own"])
        admitted = F.filter(known, lambda t: size.between(t["n"] * least, t["n"] * most))
        dice = F.transform(
            admitted, lambda t: F.struct((2.0 * F.size(F.array_intersect(x["own"], t["pairs"])) / (size + t["n"])).alias("dice"), t["place"].alias("place"), t["licence"].alias("licence"))
        )
        return F.struct(x["unit"].alias("unit"), F.array_max(dice).alias("best"))

    liked = F.filter(F.transform(counted, likenesses), lambda x: x["best"]["dice"] >= threshold)
    matches = F.transform(liked, lambda x: F.struct(x["unit"].alias("unit"), x["best"]["licence"].alias("licence"), x["best"]["dice"].alias("dice")))
    return docs.select(F.col(id_col).alias("id"), F.array_sort(matches).alias("matches"))
