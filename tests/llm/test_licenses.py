"""License notices on small cases and the whole table."""

import llm_data

from opsloom.llm import licenses, queries

KNOWN = {name: licenses.WORD.findall(t.lower()) for name, t in licenses.TEMPLATES.items()}


def names(text):
    return [h[0] for h in licenses.scan(text, KNOWN, 0.8)]


def test_alignment_recurses_into_gaps():
    pairs = licenses.align("x a b b c y".split(), "a b b c".split())
    assert [t for _, t in pairs] == [0, 1, 2, 3]
    assert licenses.align([], ["a"]) == [] and licenses.align(["b"], ["a"]) == []


def test_exact_changed_and_repeated_notices():
    for name, notice in licenses.TEMPLATES.items():
        assert names(f"Some prose here. {notice}\nMore prose.") == [name]
        text = f"é {notice} words between that say nothing. {notice.upper()}"
        hits = licenses.scan(text, KNOWN, 0.8)
        assert [h[0] for h in hits] == [name] * 2 and hits[0][2] == 2
    changed = "This work is now licensed under the GNU General Public License, version 2."
    assert names(changed) == ["gpl-3.0"]
    assert names("The version under the public work is general, this license.") == []


def test_awkward_rows(spark):
    texts = llm_data.awkward() + ["İ " + licenses.TEMPLATES["mit"]]
    rows = llm_data.by_id(licenses.scan_licenses(llm_data.documents(spark, texts)))
    assert len(rows) == len(texts) + 1 and rows[len(texts) - 1]["n_notices"] == 1
    assert licenses.scan_licenses(llm_data.documents(spark, []).where("false")).collect() == []


def test_every_planted_notice_is_found(spark):
    folder = "/root/testdata/sf0.01"
    rows = llm_data.by_id(queries.queries()["op2_license_notices"](spark, folder))
    planted = 0
    for doc in spark.read.parquet(f"{folder}/documents.parquet").collect():
        for name, notice in licenses.TEMPLATES.items():
            if notice in doc["text"]:
                planted += 1
                assert f"{name}:1.0:" in rows[doc["doc_id"]]["notices"]
    assert planted
