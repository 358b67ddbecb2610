"""Property tests (hypothesis): Spark expressions against plain Python rules."""

from __future__ import annotations

import re

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from hypercube.functions import hour24_timestamp, normalize_columns, normalize_name, normalize_name_table

stamps = st.lists(st.tuples(st.integers(1, 12), st.integers(1, 28), st.integers(1, 24),
                            st.integers(0, 59), st.integers(0, 59),
                            st.text(" \t", min_size=0, max_size=3), st.text(" \t", min_size=1, max_size=3)),
                  min_size=1, max_size=200)


@settings(max_examples=3, deadline=None)
@given(stamps)
def test_hour24_parse_matches_calendar_arithmetic(spark, rows):
    texts = [f"{lead}{m:02d}/{d:02d}{gap}{h:02d}:{mi:02d}:{s:02d}" for m, d, h, mi, s, lead, gap in rows]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.x for r in df.select(hour24_timestamp("t").alias("x")).collect()]
    want = [dt.datetime(2001, m, d) + dt.timedelta(hours=h, minutes=mi, seconds=s)
            for m, d, h, mi, s, _, _ in rows]
    assert got == want


names = st.lists(st.text(alphabet=st.sampled_from(list("aZ9_ -./é#") + [" "]), max_size=12),
                 min_size=1, max_size=100)


@settings(max_examples=3, deadline=None)
@given(names)
def test_normalised_names_are_identifiers_and_never_repeat(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, n string")
    got = normalize_name_table(df, "n", ["i"]).orderBy("i").collect()
    assert len(got) == len(values) and len({r.deduped for r in got}) == len(values)
    assert all(re.fullmatch(r"[a-z_][a-z0-9_]*", r.normalized) and r.deduped.startswith(r.normalized) for r in got)
    again = spark.createDataFrame([(r.normalized,) for r in got], "n string")
    assert [r.x for r in again.select(normalize_name("n").alias("x")).collect()] == [r.normalized for r in got]



def _taken_in_order(normalized):
    """The naming rule, row by row."""
    taken, out = set(), []
    for n in normalized:
        k, new = 1, n
        while new in taken:
            k += 1
            new = f"{n}_{k}"
        taken.add(new)
        out.append(new)
    return out


nested = st.lists(st.builds(lambda parts: "_".join(["a", *parts]), st.lists(st.sampled_from(["1", "2", "3", "02", "11"]), max_size=3)),
                  min_size=1, max_size=120)


@settings(max_examples=8, deadline=None)
@given(nested)
def test_clashing_suffixes_as_row_by_row(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, n string").repartition(5)
    got = normalize_name_table(df, "n", ["i"]).orderBy("i").collect()
    assert [r.deduped for r in got] == _taken_in_order(values)
    wide = spark.range(1).select(*[F.lit(0).alias(v) for v in values])
    assert normalize_columns(wide).columns == _taken_in_order(values)
