import re
from collections import namedtuple

import pytest
from pyspark.sql import functions as F

from voxloom.llm import license_scan as ls

from .brute import ALNUM, ascii_lower

TEXTS = [
    None,
    "",
    "MIT License",
    "permit license, mit-license mit\n\nLICENSE mit  é license",
    "x" * 100_000 + " mit LICENSE " + "- " * 50_000,
    'Licensed under the Apache License, Version 2.0 (the "License"); see http://www.apache.org/licenses/LICENSE-2.0',
    "GNU General Public License, version 3. General public-license",
    "all rights reserved " * 300,
    "Copyright (c) 2020 İ SPDX-License-Identifier: BSD-3-Clause",
]


def base(text):
    words = ALNUM.findall(ascii_lower(text or ""))
    places = sorted((i, label) for label, p in ls.BASE.items() for i in range(len(words)) if tuple(words[i : i + len(p)]) == p)
    return (len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None, sorted({x for _, x in places}))


def suppressed(found):
    """All pairs: a detection goes when another of the same or a stronger priority contains it; of equal ones the first by rule stays."""
    better = lambda e, d: (e.start <= d.start and e.end >= d.end) and e.priority <= d.priority and ((e.start, e.end, e.priority) != (d.start, d.end, d.priority) or e.rule < d.rule)
    return [d for d in found if not any(better(e, d) for e in found)]


def test_base_places_and_labels(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in ls.license_scan(docs).collect():
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == base(TEXTS[r["doc_id"]])
        assert set(r["base_labels"]) <= set(r["labels"]) and 0 <= r["score"] <= 1
        assert r["labels"] == sorted(set(r["labels"]))
        assert suppressed(r["detections"]) == r["detections"]
    labels = {r["doc_id"]: r["labels"] for r in ls.license_scan(docs).collect()}
    assert labels[5] == ["apache", "apache-2.0"] and labels[6] == ["gpl", "gpl-3"] and labels[8] == ["bsd", "copyright-notice"]


def test_op10_whole_table(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = ls.op10_license_scan(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = base(texts[r["doc_id"]])
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (*want[:4], ",".join(want[4]))


def test_every_keyword_passes_the_gate(spark):
    rules = ls.default_rules()
    assert len({r.name for r in rules}) == len(rules) > 200
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string").limit(0).withColumn("found", F.lit(1))
    assert ls.license_scan(docs).count() == 0


def raw_detections(text):
    """Every rule on the whole text, with Python's regular expressions."""
    out = []
    for rule in ls.default_rules():
        out += [Detection(*m.span(), rule.priority, rule.name, rule.label) for m in re.finditer(rule.regex, text, re.IGNORECASE | re.ASCII)]
    return out


Detection = namedtuple("Detection", "start end priority rule label")


def test_what_is_left_of_all_detections(spark):
    texts = [
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. MIT License, BSD 3-clause license",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published, either version 3 of the License, or (at your option) any later version. GNU Lesser General Public License, version 2.1",
        "Copyright (c) 2019. All rights reserved. Permission is hereby granted, free of charge, to any person obtaining a copy. licensed under the MIT License is licensed under the MIT license",
        "SPDX-License-Identifier: Apache-2.0 SPDX-License-Identifier: MIT\nproprietary and confidential, GPLv2 gpl-2.0-or-later",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in ls.license_scan(docs).collect():
        found = raw_detections(texts[r["doc_id"]])
        want = suppressed(found)
        assert len(found) >= len(want) > 1
        assert sorted(tuple(d) for d in r["detections"]) == sorted(tuple(d) for d in want)


def test_repeated_rows_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "MIT License"), (1, "MIT License"), (None, None)], "doc_id long, text string")
    rows = ls.license_scan(docs).collect()
    assert len(rows) == 3 and rows[0] == rows[1]
    with pytest.raises(ValueError):
        ls.license_scan(docs.withColumnRenamed("doc_id", "score"))


def samples(parsed):
    """Strings that a regular expression matches: every alternative, white space as a line break, repeats at their least and once more."""
    out = [""]
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            new = [chr(arg)]
        elif name == "BRANCH":
            new = [x for p in arg[1] for x in samples(p)]
        elif name == "SUBPATTERN":
            new = samples(arg[3])
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            one = samples(arg[2])
            new = [x * n for n in sorted({arg[0], max(arg[0], 1)}) for x in one]
        elif name == "IN":
            new = ["\n" if str(o) == "CATEGORY" and str(a) == "CATEGORY_SPACE" else "w" if str(o) == "CATEGORY" else chr(a[0]) if str(o) == "RANGE" else chr(a) for o, a in arg]
        elif name in ("ANY", "NOT_LITERAL"):
            new = ["w"]
        elif name == "AT":
            new = [""]
        else:
            raise ValueError(name)
        out = [a + b for a in out for b in dict.fromkeys(new)][:5000]
    return out


def test_samples_of_every_rule_pass_gate_and_keywords():
    families = set(ls.family_rules())
    for r in ls.default_rules():
        found = [x for x in samples(re._parser.parse(r.regex)) if re.search(r.regex, x)]
        assert found, r.name
        for x in found:
            gate = ls.FAMILY_GATE if r in families else ls.GATE
            assert any(k in x for k in gate) and any(k in x for k in r.keywords), (r.name, x)


def test_forms_that_the_prefilter_dropped(spark):
    want = {
        "X11 License": "mit",
        "licensed under the Expat License": "mit",
        "Creative Commons Zero License": "cc0",
        "https://creativecommons.org/publicdomain/zero/1.0": "creative-commons",
        "GNU General\n    Public License,\n    version 3": "gpl-3",
        "released into the\npublic\n domain": "public-domain",
        "All rights\nreserved": "proprietary",
        "Permission is hereby granted, free of charge, to any\nperson obtaining a copy": "mit",
        "// Redistribution and use in source and\n// binary forms": "bsd",
        "the Mozilla\n# Public License, version 2.0": "mpl-2.0",
        "Apache\nLicense, Version 2.0": "apache-2.0",
        " * You may not use this file except in\n * compliance with the License.": "apache-2.0",
        "This is free and unencumbered software\n> released into the public domain.": "unlicense",
        "Origin: the origin of this\r\n;; software must not be misrepresented": "zlib",
    }
    docs = spark.createDataFrame(list(enumerate(want)), "doc_id long, text string")
    for r in ls.license_scan(docs).collect():
        assert want[r["text"]] in r["labels"], r["text"]
