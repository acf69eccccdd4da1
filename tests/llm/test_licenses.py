"""Licence texts in the forms they are published in, and notices."""

from pathlib import Path

import pytest

from transitloom.llm import license_scan, license_texts

MIT = next(text for name, text in license_texts.KNOWN_TEXTS if name == "MIT")
BSD = license_texts._BSD_START + license_texts._BSD_END
PUBLISHED = Path(license_texts.__file__).parent / "licenses"


@pytest.fixture(scope="module")
def scanned(spark):
    gpl = (PUBLISHED / "GPL-3.0.txt").read_text()
    texts = {
        "Apache-2.0 whole": (PUBLISHED / "Apache-2.0.txt").read_text(),
        "Apache-2.0 unindented": "\n".join(
            line.strip() for line in (PUBLISHED / "Apache-2.0.txt").read_text().splitlines()
        ),
        "GPL-3.0 whole": gpl,
        "GPL-3.0 without appendix": gpl.split("How to Apply These Terms to Your New")[0],
        "LGPL-2.1 whole": (PUBLISHED / "LGPL-2.1.txt").read_text(),
        "MPL-2.0 whole": (PUBLISHED / "MPL-2.0.txt").read_text(),
        "CC0-1.0 untitled": (PUBLISHED / "CC0-1.0.txt").read_text().split("Legal Code", 1)[1],
        "MIT no heading": MIT.removeprefix("MIT License"),
        "MIT other heading": MIT.replace("MIT License", "The MIT License (MIT)", 1),
        "BSD-2-Clause bullets": BSD.replace("1. ", "* ").replace("2. ", "* "),
        "BSD-2-Clause title": "BSD 2-Clause License\n\nCopyright (c) 2020, A. B.\n\n" + BSD,
        "ISC title": "ISC License\n\nCopyright 2020 A. B.\n\n" + license_texts._ISC,
    }
    lines = {
        "MPL-2.0 line": "x\nThis project is licensed under the Mozilla Public License 2.0.\ny",
        "LGPL-2.1 line": "x\nSPDX-License-Identifier: LGPL-2.1-or-later\ny",
    }
    docs = spark.createDataFrame(list((texts | lines).items()), "doc_id string, text string")
    found = license_scan.scan_licenses(docs, license_scan.known_licenses(spark)).collect()
    return texts, lines, {row["doc_id"]: row for row in found}


def test_published_texts_in_their_forms(scanned):
    texts, _, found = scanned
    assert {name: found[name]["license"] for name in texts} == {name: name.split()[0] for name in texts}


def test_notices_of_the_same_licences(scanned):
    _, lines, found = scanned
    assert {name: found[name]["notices"] for name in lines} == {name: name.split()[0] for name in lines}
