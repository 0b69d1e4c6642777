"""Whole texts of the common licences, and usual forms of notices."""

import re
import textwrap
from pathlib import Path

import pytest

from kelda.llm import licenses


def test_common_licenses(spark):
    folder = Path(licenses.__file__).parent / "license_texts"
    rows, wanted = [], {}
    for number, (name, ids) in enumerate(licenses.FILES):
        rows.append((number, (folder / f"{name}.txt").read_text().replace("  ", " ")))
        wanted[number] = (",".join(sorted(ids)), "")
    lines = {
        "Released under the Apache License, Version 2.0.": "Apache-2.0",
        "Licensed under the GNU General Public License, version 3.": "GPL-3.0-only",
        "This program is distributed under the terms of the GNU General Public License v2.0 or later": "GPL-2.0-or-later",
        "Some words about the MIT License.": "",
    }
    for number, (line, name) in enumerate(lines.items(), 100):
        rows.append((number, f"words before\n{line}\nwords after"))
        wanted[number] = ("", name)
    bsd = (folder / "BSD.txt").read_text()
    rows.append((200, bsd))
    wanted[200] = ("BSD-3-Clause", "")
    found = licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = {r["doc_id"]: (r["licenses"], r["notices"]) for r in found}
    assert got == wanted


@pytest.mark.parametrize("width", [60, 72, 80, 100, 10**6])
def test_line_breaks_do_not_matter(spark, width):
    """Every shipped text, and a short licence with its holder's line, wrapped anew."""
    folder = Path(licenses.__file__).parent / "license_texts"
    wrap = lambda text: "\n\n".join(
        textwrap.fill(part, width, break_long_words=False, break_on_hyphens=False) for part in re.split(r"\n\s*\n", text)
    )
    rows = [(k, wrap((folder / f"{name}.txt").read_text())) for k, (name, _) in enumerate(licenses.FILES)]
    wanted = {k: ",".join(sorted(ids)) for k, (_, ids) in enumerate(licenses.FILES)}
    mit = licenses.KNOWN[0][1]
    for k, holder in enumerate(("", "Copyright (c) 2020 Somebody\n\n", "\u00a9 2019, 2021 A. B. All rights reserved.\n\n", "Copyright \u00a9 Us\n\n"), 100):
        rows.append((k, holder + wrap(mit)))
        wanted[k] = "MIT"
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["licenses"] for r in licenses.license_scan(frame).collect()} == wanted


def test_notices_behind_a_copyright(spark):
    lines = {
        "Copyright 2020 X. Licensed under the MIT License.": "MIT",
        "Copyright (c) 2020 X Inc. and others. All rights reserved. Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "Copyright holders. Licensed under the MIT License.": "",
        "(c) You must retain it. Licensed under the MIT License.": "",
        "Copyright 2020 X Licensed under the MIT License.": "",
    }
    rows = [(k, f"a\n{line}\nb") for k, line in enumerate(lines)]
    got = licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r["notices"] for r in got] == list(lines.values())
