"""Notices in direct succession, and licenses that are not the planted notices."""

import pytest

from opsloom.llm import licenses

KNOWN = {name: licenses.WORD.findall(t.lower()) for name, t in licenses.TEMPLATES.items()}


@pytest.mark.parametrize("copies", [2, 3, 7])
@pytest.mark.parametrize("name", list(KNOWN))
def test_notices_in_direct_succession(name, copies):
    notice = licenses.TEMPLATES[name]
    for before, after in [("", ""), ("x x x x x ", " y y y y"), ("the license ", " the license")]:
        text = before + " ".join([notice] * copies) + after
        hits = licenses.scan(text, KNOWN, 0.8)
        assert [h[:2] for h in hits] == [(name, 1.0)] * copies
        assert all(text[a:b].lower().startswith(notice[:8].lower()) for _, _, a, b in hits)


def test_changed_notices_in_direct_succession():
    text = "Released under the MIT License. Released under MIT License. Released under the old MIT License."
    assert [h[0] for h in licenses.scan(text, KNOWN, 0.8)] == ["mit"] * 3


PREPARED = {n: licenses.Template(licenses.WORD.findall(t.lower())) for n, t in licenses.common_templates().items()}


def test_each_text_is_found_by_its_own_name():
    for name in PREPARED.keys() - KNOWN.keys():
        text = licenses.common_templates()[name]
        hits = licenses.scan(f"Some prose before.\n{text}\nSome prose after.", PREPARED, 0.8)
        assert (name, 1.0) in [h[:2] for h in hits], (name, hits)


def test_licenses_as_files_hold_them():
    """Texts typed here, not taken from the resource: another holder, comment signs, changed words."""
    apache = """# Copyright 2019 The Example Authors.
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#     https://www.apache.org/licenses/LICENSE-2.0
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License."""
    agpl = """This file is part of Example. It is free software: you can redistribute it and/or modify it under the
terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of
the License, or (at your option) any later version. It is distributed in the hope that it will be useful, but
WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See
the GNU Affero General Public License for more details."""
    for want, text in [("apache-2.0-header", apache), ("agpl-3.0-header", agpl)]:
        assert want in [h[0] for h in licenses.scan("prose " * 50 + text + " prose" * 50, PREPARED, 0.8)]


def test_spdx_lines(spark):
    text = "# SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0\nimport os"
    docs = spark.createDataFrame([(1, text), (2, "/* SPDX-License-Identifier: ISC */")], "doc_id long, text string")
    rows = {r["doc_id"]: [n["name"] for n in r["notices"]] for r in licenses.scan_licenses(docs).collect()}
    assert rows[1] == ["spdx (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0"]
    assert rows[2] == ["spdx ISC"]


def test_two_full_texts_in_direct_succession():
    text = " ".join([licenses.common_templates()["mit-text"]] * 3)
    assert [h[:2] for h in licenses.scan(text, PREPARED, 0.8)] == [("mit-text", 1.0)] * 3
