"""Licence notices that many files hold, that stand inside long lines, and tables of different sizes."""

import random

import pytest

from starhouse.llm import license_scan as L

NOTICES = {"MIT": "Released under the MIT License.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
           "GPL-3.0": "This work is licensed under the GNU General Public License, version 3."}


def licences(spark, files):
    rows = L.scan(spark.createDataFrame(files, "path string, text string")).collect()
    return {r.path: r.licence if r.origin == "own" else None for r in rows}


@pytest.mark.parametrize("share", [3, 1])
def test_the_commonest_notice_is_found(spark, share):
    """A notice that a third of all files, or every file, hold."""
    files = [(f"d{i}/x.c", f"word{i} of text\n" + (NOTICES["MIT"] if i % share == 0 else "and no notice")) for i in range(120)]
    got = licences(spark, files)
    assert got == {f"d{i}/x.c": "MIT" if i % share == 0 else None for i in range(120)}


def test_no_marker_no_match():
    """Brute force over random units: one without a template's marker has a cosine below the least one."""
    rng, tt = random.Random(5), L.template_terms()
    weight = {t: rng.uniform(1, 12) for _, _, t, _ in tt}
    markers = L.markers_of(tt, weight)
    for key in {(lic, i) for lic, i, _, _ in tt}:
        terms = {t: tf * weight[t] for lic, i, t, tf in tt if (lic, i) == key}
        rest = [t for t in terms if (*key, t) not in markers]
        norm = sum(w * w for w in terms.values()) ** 0.5
        assert len(rest) < len(terms) and sum(terms[t] ** 2 for t in rest) ** 0.5 / norm < L.MIN_COSINE


LONG = "copyright someone Permission is hereby granted, free of charge, to any person obtaining a copy of this software and " \
    "associated documentation files, to deal in the software without restriction, including the rights to use and to copy it"
WRAPPED = "// Permission is hereby granted, free of charge, to any\n// person obtaining a copy of this\n// software and more"


def test_notices_inside_long_lines_and_over_line_ends(spark):
    files = [("a/1.c", "int x;\n" + LONG), ("a/2.c", WRAPPED), ("a/3.c", "x" + " word" * 500 + " " + NOTICES["GPL-3.0"] + " word" * 500)]
    got = licences(spark, files + [(f"n/{i}.c", f"ordinary words of file {i} and of any person") for i in range(80)])
    assert [got[p] for p, _ in files] == ["MIT", "MIT", "GPL-3.0"] and not any(got[f"n/{i}.c"] for i in range(80))


def test_other_words_weigh_by_their_files_and_not_by_the_table(spark):
    """A notice with a word put in that most files hold; and no weight grows with the table beyond rare terms."""
    files = [("a/1.c", "Released under the old MIT License old")] + [(f"n/{i}.c", "old text") for i in range(200)]
    cosine = {r.path: r.cosine for r in L.scan(spark.createDataFrame(files, "path string, text string")).collect()}
    assert cosine["a/1.c"] > 0.95
    assert L.idf(15_000_000, 0) == L.idf(L.RARE - 1, 0) and abs(L.idf(15_000_000, 150_000) - L.idf(10_000, 100)) < 0.02
