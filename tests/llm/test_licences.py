import pytest

from tidemark.llm import licences

SF = "/root/testdata/sf0.001"

CASES = [
    ("Licensed under the Apache License, Version 2.0.", "apache-2.0"),
    ("Copyright 2020 Somebody. Licensed under the Apache License, Version 2.0, with thanks.", "apache-2.0"),
    ("released under the mit license", "mit"), ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
    ("Licensed under CC BY 4.0.", "cc-by"), ("All rights reserved.", "proprietary"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl-3.0"),
    ("This work is licensed under the GNU General Public License, version 2.", "gpl-2.0"),
    ("He was licensed to drive and all the rights of the city were kept.", ""),
    ("the of and to in under the terms of the day", ""), ("license", ""), ("", ""), ("...", ""),
]


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, t) for i, (t, _) in enumerate(CASES)]
    rows += [(100, "First line.\nLicensed under CC BY 4.0.\n\nReleased under the MIT License."), (101, None),
             (102, "word " * 30_000 + "\nAll rights reserved."), (None, "Released under the MIT License."), (0, CASES[0][0])]
    return rows


def test_families(docs_of, corpus):
    out = licences.scan(docs_of(corpus)).collect()
    assert len(out) == len(corpus)
    got = {r.doc_id: r.families for r in out}
    assert {i: got[i] for i in range(len(CASES))} == {i: f for i, (_, f) in enumerate(CASES)}
    assert (got[100], got[101], got[102], got[None]) == ("cc-by,mit", "", "proprietary", "mit")
    by = {r.doc_id: r for r in out}
    assert (by[100].n_paragraphs, by[100].n_licences, by[101].n_paragraphs) == (3, 2, 0)
    assert all(r.probability is None or 0.5 <= r.probability <= 1 for r in out)


def test_lines_of_the_table_are_found_and_others_left_alone(spark):
    telling = {"Licensed under CC BY-NC 4.0.": "cc-by-nc", "Released under the MIT License.": "mit",
               "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0",
               "Licensed under the Apache License, Version 2.0.": "apache-2.0", "All rights reserved.": "proprietary"}
    sf = SF.replace("0.001", "0.01")
    want = {r.doc_id: ",".join(sorted({f for line, f in telling.items() if line in (r.text or "").split("\n")}))
            for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r.families for r in licences.query(spark, sf).collect()}
    assert got == want and any(want.values())


def test_empty_table_and_plan(spark, docs_of):
    empty = licences.scan(docs_of([(1, "a")]).where("false"))
    assert empty.count() == 0
    plan = licences.query(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan


BSD = ("# Redistribution and use in source and binary forms, with or without\n"
       "# modification, are permitted provided that the following conditions\n# are met:")
ISC = (" * Permission to use, copy, modify, and/or distribute this software for\n"
       " * any purpose with or without fee is hereby granted, provided that the\n * above notice appears.")
GPL = ("// This program is free software: you can redistribute it and/or modify\n"
       "// it under the terms of the GNU General Public License as published by\n"
       "// the Free Software Foundation, either version 3 of the License, or\n// (at your option) any later version.")
LGPL = ("This library is free software; you can redistribute it and/or modify it\nunder the terms of the GNU Lesser General"
        " Public\nLicense as published by the Free Software\nFoundation.")
LONG = "the end of the day was in the hall and of the city " * 400
WRAPPED = [
    (BSD, "bsd"), (ISC, "isc"), (GPL, "gpl-3.0"), (LGPL, "lgpl"), ("int x;\n\n" + BSD + "\n#\n" + GPL + "\n\nint y;", "bsd,gpl-3.0"),
    ("Released under the MIT License. Licensed under the Mozilla Public License, version 2.0.", "mit,mpl-2.0"),
    (LONG + "This work is licensed under the GNU General Public License, version 2. " + LONG, "gpl-2.0"),
    (LONG + "Licensed under CC BY-NC 4.0. " + LONG + "Released under the ISC License. " + LONG, "cc-by-nc,isc"),
    ("This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International License.", "cc-by-sa"),
    ("Released under the\n\nMIT License of old.", ""), (LONG, ""),
]


def test_wrapped_and_long_one_line_notices(docs_of):
    got = {r.doc_id: r.families for r in licences.scan(docs_of([(i, t) for i, (t, _) in enumerate(WRAPPED)])).collect()}
    assert got == {i: f for i, (_, f) in enumerate(WRAPPED)}


def test_no_template_reaches_the_share_without_a_telling_word():
    """The prefilter loses nothing: grams without a telling word are fewer than CONFIRM of every template."""
    import re

    for t in (t for ts in licences.TEMPLATES.values() for t in ts):
        w = ["^", *re.findall(r"[^\W_]+", t.lower()), "$"]
        grams = {tuple(w[i:i + n]) for n in (2, 3) for i in range(len(w) - n + 1)}
        plain = [g for g in grams if not set(g) & set(licences.TELLING)]
        assert len(plain) / len(grams) < licences.CONFIRM, t


def test_units_equal_plain_python(spark, docs_of):
    """Every line's and window's weighted grams, against slices of words in plain Python."""
    import random
    import re
    from collections import Counter

    r = random.Random(4)
    vocabulary = ["license", "the", "mit", "under", "of", "terms", "word", "day"]
    bodies = [" ".join(r.choice(vocabulary) for _ in range(n)) for n in (1, 2, 3, 5, 6, 7, 9, 40, 66, 67, 513, 1100)]
    docs = [(i, b) for i, b in enumerate(bodies)]
    docs += [(50, "the license\n# of the mit.\nunder terms\n\n--\n\nthe license of day"), (51, None), (52, "")]
    telling = set(licences.TELLING)
    weight = {"the license": 2.0, "license of the": 3.0, "mit under": 5.0, "^ the license": 7.0, "terms $": 11.0}

    def grams(w):
        return [" ".join(w[i:i + n]) for n in (2, 3) for i in range(len(w) - n + 1)]

    want = {}
    for i, text in docs:
        for b, body in enumerate(re.split(r"\n(?:[^a-z0-9\n]*\n)+", text or "")):
            for u, line in enumerate(body.split("\n")):
                w = ["^", *re.findall("[a-z0-9]+", line.lower()), "$"]
                if len(w) <= licences.LINE + 2 and telling & set(w):
                    want[i, b, u] = Counter(g for g in grams(w) if g in weight)
            ends = re.sub(r"[.!?]+(?=\s|$)", " $ ^ ", re.sub("[$^]", " ", body.lower()))
            every = ["^", *re.findall("[a-z0-9$^]+", ends), "$"]
            most = max(licences.WINDOWS)
            for p, at in enumerate(range(0, max(1, len(every) - most), licences.PIECE - most)):
                w = every[at:at + licences.PIECE]
                for k, (size, less) in enumerate(zip(licences.WINDOWS, (0, *licences.WINDOWS))):
                    if len(w) > less and telling & set(w):
                        for n, start in enumerate(range(0, max(1, len(w) - size + size // 4), size // 4)):
                            want[i, b, -1 - p * 8192 - (k << 10) - n] = Counter(
                                g for g in grams(w[start:start + size]) if g in weight)
    want = {k: (sum(weight[g] * n for g, n in c.items()), sorted(c)) for k, c in want.items() if c}

    model = licences.Classifier.__new__(licences.Classifier)
    model.columns = ["w0"]
    model.weights = spark.createDataFrame(list(weight.items()), "gram string, w0 double")
    got = {(u.doc_id, u.block, u.unit): (u.w0, sorted(u.held)) for u in model.units(docs_of(docs)).collect()}
    assert len(want) > 500 and got == want
