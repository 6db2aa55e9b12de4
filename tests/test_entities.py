"""Character references against Python's reader, and the plans that use them."""

import html
from html.entities import html5

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from opsloom.functions.entities import unescape
from opsloom.plans.queries import queries

FOLDER = "/root/testdata/sf0.001"


def check(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "t string")
    for raw, ours in frame.select("t", unescape(F.col("t"))).collect():
        assert ours == html.unescape(raw), repr(raw)


def test_every_name(spark):
    check(spark, [f"a&{name}b &{name} &{name[:-1]}x &{name};" for name in html5])


def test_every_kind_of_number(spark):
    points = [*range(0x180), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDCF, 0xFDD0, 0xFDEF, 0xFDF0, 0xFFFD,
              0xFFFE, 0xFFFF, 0x1F600, 0x1FFFE, 0x10FFFF, 0x110000, 2**31, 2**63, 10**30]
    check(spark, [f"{mark}{p:{base}}{end}z" for p in points for mark, base in
                  [("&#", "d"), ("&#x", "x"), ("&#X", "X"), ("&#000", "d"), ("&#x0000000000", "x")]
                  for end in (";", "", " ", "&")])


def test_broken_references(spark):
    check(spark, ["&", "&&", "&;", "&#", "&#;", "&#x;", "&#xg", "&#-1;", "& amp;", "&amp", "&ampamp;", "&am",
                  "&notit;", "&notin;", "&no tin;", "&amp;lt;", "&AMP;&Amp;", "x&", "&" + "a" * 40 + ";",
                  "&amp" + "a" * 40 + ";", "&<amp;", "&\namp;", "&é;", "&ampé;", "", "plain", "&#38;lt;", "&5;"])


def test_null(spark):
    frame = spark.createDataFrame([(None,)], "t string")
    assert frame.select(unescape(F.col("t"))).collect()[0][0] is None


PIECES = st.sampled_from(["&", "#", "x", ";", "amp", "lt", "not", "in", "eacute", "12", "E9", " ", "<", "é", "\n"])


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=12).map("".join), min_size=1, max_size=50))
def test_any_mixture(spark, values):
    check(spark, values)


def plan(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_no_python_worker_for_entities(spark):
    for name in ("c2_pair_by_question", "g14_clean_html", "d31_yields"):
        assert "PythonUDF" not in plan(queries()[name](spark, FOLDER))


def test_yields_read_each_source_once(spark):
    # questions, answers and second answers: three readings of the table that all come from
    assert plan(queries()["d31_yields"](spark, FOLDER)).count("Relation [") <= 3
