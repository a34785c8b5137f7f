from __future__ import annotations

import hashlib
from pathlib import Path

import pytest

from recordloom.llm import licenses
from recordloom.llm.known_licenses import GRANT_MIT, LICENSES, SPELLINGS, WARRANTY_MIT
from recordloom.llm.queries import queries

MIT = next(t for n, t in LICENSES if n == "MIT")


def variants():
    wrapped = MIT.replace(", ", ",\n").replace('"', "\u201d")
    return [
        ("MIT", MIT),
        ("MIT", "Copyright (c) 2019 Some One\n" + MIT.upper()),
        ("MIT", "MIT License\n\n  © 2001 A. B.\nAll rights reserved.\n" + f"{GRANT_MIT}, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n" + WARRANTY_MIT.replace("NONINFRINGEMENT", "NON-INFRINGEMENT").replace("OTHERWISE", "otherwise")),
        ("MIT", wrapped.replace("sublicense", "sub-licence").replace("MIT License", "MIT Licence")),
        (None, MIT[:-40]),
        (None, MIT.replace("without restriction", "with restriction")),
        (None, None),
        (None, ""),
        (None, "word " * 50000),
        ("Apache-2.0", "licensed under the APACHE licence, version 2.0"),
    ]


def test_variants_and_odd_rows(spark):
    rows = [(None if i == 3 else i, t, 5, "x") for i, (_, t) in enumerate(variants())]
    df = spark.createDataFrame([*rows, rows[0]], "doc_id long, text string, license_id int, notices string")
    got = licenses.scan(df).collect()
    assert len(got) == len(rows) + 1 and licenses.scan(df.limit(0)).count() == 0
    by = {r.doc_id: r for r in got}
    for i, (want, text) in enumerate(variants()):
        r = by[None if i == 3 else i]
        assert r.license_id == want, i
        assert r.canonical_sha256 == hashlib.sha256(licenses.plain_canonical(text).encode()).hexdigest()


def test_notices_inside_longer_texts(spark):
    text = "Some prose here.\nReleased under the MIT License.\nMore prose.\n  licensed under the Apache Licence, version 2.0\nReleased under the MIT license\nno license at all"
    r = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (r.license_id, r.notices, r.n_notices) == (None, "Apache-2.0,MIT", 3)


def test_whole_table_finds_planted_lines(spark):
    got = queries()["op10_license_scans"](spark, "/root/testdata/sf0.01").collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(got) == len(docs)
    for r in got:
        want = sum(licenses.plain_canonical(x) in {licenses.plain_canonical(t) for _, t in LICENSES} for x in docs[r.doc_id].split("\n"))
        assert r.n_notices == want
    assert sum(r.n_notices > 0 for r in got) > 5


def test_every_known_form_is_told_as_a_line_of_a_longer_text(spark):
    assert all(a[:3] == b[:3] for a, b in SPELLINGS)
    rows = [(i, f"Some prose.\n ** {t.replace(chr(10), ' ').upper()}\nno license") for i, (_, t) in enumerate(LICENSES)]
    got = {r.doc_id: (r.notices, r.n_notices) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: (n, 1) for i, (n, _) in enumerate(LICENSES)}


def test_full_texts(spark):
    folder = Path("/usr/share/common-licenses")
    files = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    if not all((folder / f).exists() for f in files):
        pytest.skip("no local licence texts")
    df = spark.createDataFrame([(n, (folder / f).read_text(encoding="utf-8")) for f, n in files.items()], "doc_id string, text string")
    assert all(r.license_id == r.doc_id for r in licenses.scan(df).collect())
