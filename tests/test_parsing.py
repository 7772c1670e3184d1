"""Parsers agree with Python's own float() and strptime()."""

import math
from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from batchgate.functions import parse_iso_date, parse_number

NUMBERS = """25.00|-0.00|+7|.5|5.|.|1e3|1E-3|1e|e5|1_000|1__0|_1|1_|1_.5|1e1_0|25d|25.0F|0x10|
 25.00 |\t1\n|inf|-Infinity|+inf|infinit|nan|-NaN|+nan|1e400|-1e400|١٢٣|1,000|--1|1 2|''||
 7 |1\x00|9999999999999999999999|0.1e-400|¼|²|5\x1c|true|None""".split("|")
DATES = """2026-09-01|2026-9-1|2026-09- 1|2026-09-  1|2026|2026-09|2026-02-30|2024-02-29|2023-02-29|
2026-13-01|2026-00-10|2026-09-00|2026-09-32|2026-09-01T00:00:00|2026-09-01 | 2026-09-01|0000-01-01|
0001-01-01|9999-12-31|12026-01-01|26-01-01|2026/01/01|٢٠٢٦-09-01|2026-09-1٢|2026-٠9-01|٠٠٠٠-01-01|
+2026-01-01|-001-01-01|2026-9-011||2026-1-1x|1582-10-10""".replace("\n", "").split("|")


def python_number(text):
    try:
        return float(text)
    except (ValueError, TypeError):
        return None


def python_date(text):
    try:
        return datetime.strptime(text, "%Y-%m-%d").date()
    except (ValueError, TypeError):
        return None


def same(a, b):
    if a is None or b is None:
        return a is b
    return a == b or (isinstance(a, float) and math.isnan(a) and math.isnan(b))


def check(spark, texts, parse, expect):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", parse(F.col("t")).alias("v")).collect():
        assert same(r.v, expect(r.t)), (r.t, r.v, expect(r.t))


def test_known_numbers(spark):
    check(spark, [*NUMBERS, None], parse_number, python_number)


def test_known_dates(spark):
    check(spark, [*DATES, None], parse_iso_date, python_date)


FEW = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@FEW
@given(st.lists(st.text("0123456789+-._eE infanNAty١ ", max_size=9), min_size=200))
def test_any_number(spark, texts):
    check(spark, texts, parse_number, python_number)


@FEW
@given(
    st.lists(
        st.tuples(
            st.text("0129", min_size=3, max_size=5),
            st.text("0129 ", min_size=1, max_size=2),
            st.text("01239 ", min_size=1, max_size=3),
        ).map("-".join),
        min_size=200,
    )
)
def test_any_date(spark, texts):
    check(spark, texts, parse_iso_date, python_date)
