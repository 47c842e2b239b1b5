"""License scans: TF-IDF cosine of lines to templates, then inheritance from the nearest directory.

Every line of every whole text, groups of neighbouring lines with up to ``MOST_TERMS`` terms and
the whole text are compared with templates: opening sentences, standard headers and, for
whole texts, full licences (``license_texts``). In a whole text the frequency of a term
counts by its logarithm, or common words would make all long texts alike. Inverse document frequencies come from all documents and never reach
zero, so a licence line keeps its weight however many documents have it; a term of no
template counts as one no document has. A copyright notice has a gap for year and holder: it is compared by its other
terms and has to begin with the word copyright and one to eight terms in the gap, so the footer "All rights
reserved" alone is none; it counts only where no other licence is found. Lines and groups without any of the rare terms that a
similarity of ``LIKE`` needs are left out before they are compared. A file that is a licence file, by its name
or because licence lines make up much of it, speaks for its directory. A file without
a licence of its own inherits from the nearest ancestor directory that has one.

Everything is DataFrame operations; the driver sees one number per template term.
"""

from __future__ import annotations

import math
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide.session import staged

LIKE = 0.7  # cosine from which a line is a licence line
FILE_SHARE = 0.25  # of a file's terms in licence lines, from which it is a licence file
FILE_NAME = r"(?i)^(un)?(licen[cs]e|copying|notice|copyright)\b"
TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"

# How licences name themselves.
TEMPLATES = [
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MIT", "Released under the MIT License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Proprietary", "Copyright. All rights reserved"),  # with a gap for year and holder
]
NOTICE = "Proprietary"
NOTICE_FORM = r"^(?:c )?copyright (?:c )?+(?:\S+ ){1,8}?all rights"  # terms joined by spaces

#: Headers as their licences ask for them; they stand on one line or on several.
_GNU = (
    "This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License "
    "as published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version."
)
_GNU_END = (
    " This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}General Public License for more details."
)
_APACHE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
    "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
)
_APACHE_END = (
    " Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
    '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific '
    "language governing permissions and limitations under the License."
)
_MPL = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
    "with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
)
_GNU_KINDS = [
    ("AGPL-3.0", "Affero ", "3", "19 November 2007"), ("GPL-2.0", "", "2", "June 1991"), ("GPL-3.0", "", "3", "29 June 2007"),
    ("LGPL-2.1", "Lesser ", "2.1", "February 1999"), ("LGPL-3.0", "Lesser ", "3", "29 June 2007"),
]
_NAMED = [
    ("AGPL-3.0", "GNU Affero General Public License v3.0"), ("Apache-2.0", "Apache License 2.0"), ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"), ("GPL-2.0", "GNU General Public License v2.0"), ("GPL-3.0", "GNU General Public License v3.0"),
    ("ISC", "ISC License"), ("LGPL-3.0", "GNU Lesser General Public License v3.0"), ("MIT", "MIT License"), ("MPL-2.0", "Mozilla Public License 2.0"),
]
_TAGS = ["Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "ISC", "MIT", "MPL-2.0"]
HEADERS = [
    *[(name, _GNU.format(work="program", kind=kind, v=v) + end.format(work="program", kind=kind)) for name, kind, v, _ in _GNU_KINDS for end in ("", _GNU_END)],
    *[(name, f"GNU {kind}General Public License Version {v}, {date}") for name, kind, v, date in _GNU_KINDS],
    ("Apache-2.0", _APACHE), ("Apache-2.0", _APACHE + _APACHE_END), ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("MPL-2.0", _MPL), ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file"),
    ("MIT", "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    *[(name, f"This project is licensed under the {title} - see the LICENSE file for details") for name, title in _NAMED],
    *[(name, f"SPDX-License-Identifier: {name}") for name in _TAGS],
    *[(name, f"SPDX-License-Identifier: {name}{end}") for name, _, _, _ in _GNU_KINDS for end in ("", "-only", "-or-later")],
]
FULL_TEXTS = [(p.stem, p.read_text("utf-8")) for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))]
GROUPS = (1, 2, 3, 4, 5, 6, 8, 11, 16, 22)  # lines with terms in a group
MOST_TERMS = 300


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def _listed(terms: list[str]) -> Column:
    return F.split(F.lit(" ".join(terms)), " ")


def _damped(tf: int) -> float:
    return 1 + math.log(tf)


def term_weights(files: DataFrame, templates: list) -> tuple[dict[str, float], float]:
    """Inverse document frequency of each template term over all files, and that of an unseen term."""
    vocabulary = sorted({t for _, text in templates for t in re.findall(TERM, text.lower())})
    known = _listed(vocabulary)
    # terms of a text that a template has; one row per term and task reaches the shuffle
    inside = files.select(F.explode(F.array_intersect(_terms(F.col("text")), known)).alias("term"))
    n = files.count()
    counts = {r["term"]: r["n"] for r in inside.groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}
    unseen = math.log(1 + n) + 1
    weights = {t: math.log((1 + n) / (1 + counts.get(t, 0))) + 1 for t in vocabulary}
    return weights, unseen


def unit_vectors(templates: list, weights: dict[str, float], counted=float) -> list[dict[str, float]]:
    """Share of each term in the unit vector of each template."""
    made = []
    for _, text in templates:
        terms = re.findall(TERM, text.lower())
        vector = {t: counted(terms.count(t)) * weights[t] for t in sorted(set(terms))}
        norm = math.sqrt(sum(w * w for w in vector.values()))
        made.append({t: w / norm for t, w in vector.items()})
    return made


def telling_terms(vectors: list[dict[str, float]], weights: dict[str, float], like: float) -> list[str]:
    """Terms of which any line has one that is similar to a template.

    With no other terms in common than the most frequent ones of a template, a line has at most the
    length of that part of the unit vector as cosine; as long as it is below ``like``, they are left out.
    """
    found = set()
    for vector in vectors:
        rest = 0.0
        for term in sorted(vector, key=lambda t: (weights[t], t)):
            rest += vector[term] ** 2
            if math.sqrt(rest) >= like - 1e-6:
                found.add(term)
    return sorted(found)


def fewest_terms(vector: dict[str, float], like: float) -> int:
    """Number of different terms of a template that any similar text has."""
    rest = 0.0
    for n, share in enumerate(sorted(vector.values(), reverse=True), start=1):
        rest += share**2
        if math.sqrt(rest) >= like - 1e-6:
            return n
    return len(vector)


def template_vectors(spark, templates: list, vectors: list[dict[str, float]]) -> DataFrame:
    """form, license, term, share: unit vectors of the templates."""
    rows = [(form, name, *item) for form, ((name, _), vector) in enumerate(zip(templates, vectors)) for item in vector.items()]
    return spark.createDataFrame(rows, "form int, license string, term string, share double")


def scan(files: DataFrame, templates: list | None = None, like: float = LIKE, full: list | None = None) -> DataFrame:
    """One row per row of ``files`` (path, text and others): with ``license``, ``cosine`` and ``line`` of its most
    similar licence line or group of lines (its first line), all null where there is none, and ``file_share``.

    A whole text that is like a full licence has that licence, from line 0; a copyright notice gives way to any licence. Ties go to the first
    line, then to the first template. A null or empty text has no licence.
    """
    spark = files.sparkSession
    templates = TEMPLATES + HEADERS if templates is None else templates
    full = FULL_TEXTS if full is None else full
    weights, unseen = term_weights(files, templates + full)
    shares, whole_shares = unit_vectors(templates, weights), unit_vectors(full, weights, _damped)
    needed = _listed(telling_terms(shares, weights, like))
    # one pass over the texts: what is stored are the other columns and the few lines that can match
    def marked(body: Column, line: Column) -> Column:
        terms = _terms(body)
        return F.struct(line.alias("line"), terms.alias("terms"))

    lines = F.filter(F.transform(F.split("text", "\n"), marked), lambda x: F.size(x["terms"]) > 0)
    every = _terms(F.col("text"))
    ours = F.array_intersect(every, _listed(sorted(weights)))

    def possible(vectors: list) -> Column:
        """The text has the terms that a line, a group or a whole text similar to one of the templates has.

        Each template is only looked at in texts with a telling term of any, and counted in those with one of its own.
        """
        if not vectors:
            return F.lit(False)
        found = F.lit(False)
        for vector in vectors:
            own = F.arrays_overlap("ours", _listed(telling_terms([vector], weights, like)))
            both = F.array_intersect("ours", _listed(sorted(vector)))
            found = found | F.when(own, F.size(both) >= fewest_terms(vector, like)).otherwise(F.lit(False))
        return F.when(F.arrays_overlap("ours", _listed(telling_terms(vectors, weights, like))), found).otherwise(F.lit(False))

    rows = files.withColumns({"uid": F.monotonically_increasing_id(), "every": every}).withColumns(
        {"ours": ours, "terms_in_all": F.size("every")}
    ).withColumns({"some": possible(shares), "all": possible(whole_shares)})
    rows = rows.withColumns({"lines": F.when(F.col("some"), lines), "every": F.when(F.col("all"), F.col("every"))})
    rows = rows.drop("text", "ours", "some", "all")
    rows = staged(rows, "license-lines")
    stored = rows.drop("lines", "terms_in_all", "every")

    # groups of neighbouring lines that have terms, and whole texts as group 0
    begun = rows.filter("lines is not null").select("uid", "lines", F.posexplode(F.col("lines.line")).alias("at", "line"))
    groups = begun.withColumn("many", F.explode(F.array(*map(F.lit, GROUPS)))).filter(F.col("at") + F.col("many") <= F.size("lines"))
    groups = groups.select("uid", "line", "many", F.flatten(F.expr("slice(lines, at + 1, many)")["terms"]).alias("terms"))
    groups = groups.filter((F.col("many") == 1) | (F.size("terms") <= MOST_TERMS)).filter(F.arrays_overlap("terms", needed))
    noticed = F.array_contains("terms", "reserved") & F.array_join("terms", " ").rlike(NOTICE_FORM)
    groups = groups.withColumn("noticed", noticed)
    whole = rows.filter("every is not null").select(
        "uid", F.lit(0).alias("line"), F.lit(0).alias("many"), F.col("every").alias("terms"), F.lit(False).alias("noticed")
    )
    unit = ["uid", "line", "many", "noticed"]
    counted = groups.unionAll(whole).select(*unit, F.explode("terms").alias("term")).groupBy(*unit, "term").agg(F.count(F.lit(1)).alias("tf"))
    known = spark.createDataFrame(sorted(weights.items()), "term string, weight double")
    tf = F.when(F.col("many") == 0, 1 + F.log(F.col("tf").cast("double"))).otherwise(F.col("tf"))
    vectors = counted.join(known, "term", "left").withColumn("value", tf * F.coalesce("weight", F.lit(unseen)))
    notice = sorted({t for name, text in templates if name == NOTICE for t in re.findall(TERM, text.lower())})
    squared = F.col("value") * F.col("value")
    norms = vectors.groupBy(*unit).agg(
        F.sqrt(F.sum(squared)).alias("norm"), F.sum("tf").alias("n"),
        F.sqrt(F.sum(F.when(F.col("term").isin(notice), squared))).alias("notice_norm"),
    )
    sides = template_vectors(spark, templates, shares).withColumn("whole", F.lit(False)).unionAll(
        template_vectors(spark, full, whole_shares).withColumn("whole", F.lit(True))
    )
    dots = vectors.withColumn("whole", F.col("many") == 0).join(sides, ["term", "whole"]).groupBy(*unit, "form", "license").agg(
        F.sum(F.col("value") * F.col("share")).alias("dot")
    )
    is_notice = F.col("license") == NOTICE
    against = F.when(~is_notice, F.col("norm")).when(F.col("noticed"), F.col("notice_norm"))
    alike = dots.join(norms, unit).withColumn("cosine", F.round(F.col("dot") / against, 9)).filter(F.col("cosine") >= like)
    best_of_unit = alike.groupBy(*unit).agg(
        F.max(F.struct((~is_notice).alias("granted"), "cosine", (-F.col("form")).alias("form"), "license")).alias("best"), F.first("n").alias("n")
    )
    best = best_of_unit.groupBy("uid").agg(
        F.max(F.struct(
            (F.col("many") == 0).alias("whole"), "best.granted", "best.cosine", (-F.col("line")).alias("line"), (-F.col("many")).alias("many"),
            "best.form", "best.license", "n",
        )).alias("found"),
        F.coalesce(F.sum(F.when(F.col("many") == 1, F.col("n"))), F.lit(0)).alias("inside"),
    )
    found = best.join(rows.select("uid", "terms_in_all"), "uid").select(
        "uid", F.col("found.license").alias("license"), F.col("found.cosine").alias("cosine"), (-F.col("found.line")).alias("line"),
        (F.greatest("inside", "found.n") / F.col("terms_in_all")).alias("file_share"),
    )
    return stored.join(found, "uid", "left").drop("uid")


def _directory(path: Column) -> Column:
    """The path without its last part; empty at the top."""
    return F.array_join(F.slice(F.split(path, "/"), 1, F.greatest(F.size(F.split(path, "/")) - 1, F.lit(0))), "/")


def inherit(found: DataFrame) -> DataFrame:
    """``found`` (a stored scan) with ``inherited`` and ``inherited_from`` where a file has no licence of its own.

    Directories are resolved once each: all their ancestors are joined with the directories
    that hold a licence file, and the deepest one counts. A null path has no directory.
    """
    placed = found.withColumn("directory", _directory(F.col("path")))
    name = F.element_at(F.split("path", "/"), -1)
    speaks = placed.filter(F.col("license").isNotNull() & (name.rlike(FILE_NAME) | (F.col("file_share") >= FILE_SHARE)))
    licensed = speaks.groupBy(F.col("directory").alias("ancestor")).agg(
        F.max(F.struct(name.rlike(FILE_NAME).alias("named"), "cosine", "file_share", "license")).alias("best")
    ).select("ancestor", F.col("best.license").alias("inherited"))
    parts = F.split("directory", "/")
    depths = F.sequence(F.lit(0), F.when(F.col("directory") == "", 0).otherwise(F.size(parts)))
    ancestors = (
        placed.select("directory").filter("directory is not null").distinct()
        .withColumn("depth", F.explode(depths))
        .withColumn("ancestor", F.array_join(F.expr("slice(split(directory, '/'), 1, depth)"), "/"))
    )
    nearest = ancestors.join(licensed, "ancestor").groupBy("directory").agg(
        F.max(F.struct("depth", "ancestor", "inherited")).alias("best")
    ).select("directory", F.col("best.inherited").alias("inherited"), F.col("best.ancestor").alias("inherited_from"))
    own = F.col("license").isNotNull()
    return placed.join(nearest, "directory", "left").withColumns(
        {"inherited": F.when(~own, F.col("inherited")), "inherited_from": F.when(~own, F.col("inherited_from"))}
    ).drop("directory")


def query(docs: DataFrame) -> DataFrame:
    """Documents lie at source/lang/doc_id."""
    path = F.concat_ws("/", F.coalesce(F.col("source").cast("string"), F.lit("")), F.coalesce(F.col("lang").cast("string"), F.lit("")), F.col("doc_id").cast("string"))
    files = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), path.alias("path"), F.coalesce("text", F.lit("")).alias("text"))
    found = staged(scan(files), "licenses")
    return inherit(found).select("doc_id", "path", "license", "cosine", "line", "inherited", "inherited_from")
