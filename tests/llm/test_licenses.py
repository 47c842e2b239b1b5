"""Licence lines that many documents have, and small tables."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from stocktide.llm import licenses

MIT = "Released under the MIT License."
WORDS = "some words that are not about it and more of them under the same old version of this work".split()


def _files(rng, n, hot):
    texts = [" ".join(rng.choices(WORDS, k=30)) + "\n" + " ".join(rng.choices(WORDS, k=20)) for _ in range(n)]
    return [(f"d/{i}.py", f"{t}\n{MIT}" if i < hot else t) for i, t in enumerate(texts)]


def _best(files):
    """Best cosine of any line of each file, by the formula over all lines and templates."""
    df = Counter(t for _, text in files for t in set(re.findall(licenses.TERM, text.lower())))
    vocabulary = {t for _, text in licenses.TEMPLATES for t in re.findall(licenses.TERM, text.lower())}

    def vector(text):
        terms = Counter(re.findall(licenses.TERM, text.lower()))
        made = {t: c * (math.log((1 + len(files)) / (1 + (df[t] if t in vocabulary else 0))) + 1) for t, c in terms.items()}
        norm = math.sqrt(sum(v * v for v in made.values())) or 1.0
        return {t: v / norm for t, v in made.items()}

    templates = [vector(text) for _, text in licenses.TEMPLATES]
    found = {}
    for path, text in files:
        lines = [vector(line) for line in text.split("\n")]
        found[path] = max(sum(v * t.get(k, 0) for k, v in line.items()) for line in lines for t in templates)
    return found


@pytest.mark.parametrize("n,hot", [(90, 30), (90, 90), (12, 1), (3, 1), (1, 1)])
def test_frequent_line_is_found(spark, n, hot):
    files = _files(random.Random(n), n, hot)
    files[-1] = (files[-1][0], files[-1][1] + "\n# Licensed under CC BY-NC, version 4.0 of this work")
    got = {r["path"]: (r["license"], r["cosine"]) for r in licenses.scan(spark.createDataFrame(files, "path string, text string"), licenses.TEMPLATES, full=[]).collect()}
    want = _best(files)
    assert all(got[f"d/{i}.py"][0] == "MIT" for i in range(hot) if i < n - 1 or hot == n == 1)
    for path, cosine in want.items():
        assert got[path][1] == (pytest.approx(cosine, abs=1e-8) if cosine >= licenses.LIKE else None)


APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     https://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""
GNU = """ * Frobnicate is free software; you can redistribute it and/or modify
 * it under the terms of the GNU Lesser General Public License as published by
 * the Free Software Foundation; either version 3 of the License, or
 * (at your option) any later version."""


def test_headers_tags_and_whole_licences(spark):
    full = dict(licenses.FULL_TEXTS)
    wanted = {
        "apache.py": ("Apache-2.0", APACHE), "oneline.py": ("Apache-2.0", " ".join(APACHE.replace("#", "").split())), "gnu.c": ("LGPL-3.0", GNU),
        "tag.c": ("Apache-2.0", "// SPDX-License-Identifier: Apache-2.0"), "later.c": ("GPL-2.0", "/* SPDX-License-Identifier: GPL-2.0-or-later */"),
        "readme.md": ("MIT", "This project is licensed under the MIT License - see the LICENSE file for details"),
        "title": ("GPL-3.0", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007"),
        "gpl": ("GPL-3.0", full["GPL-3.0"]), "gpl2": ("GPL-2.0", full["GPL-2.0"]), "asl": ("Apache-2.0", full["Apache-2.0"]),
        "mit": ("MIT", "Copyright (c) 2019 Some One\n\n" + full["MIT"].split("\n", 2)[2]),
        "isc": ("ISC", "Copyright 2020 Some One <one@example.org>\n" + full["ISC"]),
    }
    rng = random.Random(5)
    plain = _files(rng, 40, 0)
    around = [(path, text if path in full or len(text) > 900 else f"import os\n{text}\n\ndef main():\n    return 1") for path, (_, text) in wanted.items()]
    got = {r["path"]: r["license"] for r in licenses.scan(spark.createDataFrame(around + plain, "path string, text string")).collect()}
    assert {p: got[p] for p in wanted} == {p: name for p, (name, _) in wanted.items()}
    assert all(got[p] is None for p, _ in plain)


def test_notices_need_a_year_or_holder_and_give_way(spark):
    wanted = {
        "footer": ("All rights reserved.", None), "bare": ("Copyright (c). All rights reserved.", None),
        "holder": ("Copyright Acme Widgets Ltd. All rights reserved.", "Proprietary"),
        "year": ("# Copyright (c) 2031 All Rights Reserved", "Proprietary"),
        "two_lines": ("Copyright 2011-2013 The Frobnicate Authors\nAll rights reserved.", "Proprietary"),
        "bsd": ("Copyright 2011 Some One. All rights reserved.\n\nRedistribution and use in source and binary forms, with or "
                "without modification, are permitted provided", "BSD-3-Clause"),
        "prose": ("the copyright office says that all the members of this long list of people hold some rights that nobody reserved", None),
        "empty": ("", None), "long": ("Copyright " + "x" * 2_000_000 + "\nAll rights reserved." + " word" * 100_000, None),
    }
    files = [(path, f"import os\n{text}\n\nreturn 1" if text else text) for path, (text, _) in wanted.items()] + _files(random.Random(3), 30, 0)
    rows = spark.createDataFrame(files + [("null", None)], "path string, text string")
    got = {r["path"]: r["license"] for r in licenses.scan(rows).collect()}
    assert {p: got[p] for p in wanted} == {p: name for p, (_, name) in wanted.items()}
    assert got["null"] is None
