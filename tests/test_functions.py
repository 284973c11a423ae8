from __future__ import annotations

import datetime as dt
import html
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plaint.functions import color, sampling, text, typing, vector

ENDS = "\r\n\x85\u2028\u2029"


def test_line_ends_become_one_space(rows):
    found = rows(text.one_line("x"), [f"a{ENDS}\n\nb", 'say "hi"\r\n', f"  {ENDS}", None, "", "a b"])
    assert found == ["a b", "say hi ", "   ", None, "", "a b"]


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab \" " + ENDS + "ก…")), min_size=40, max_size=80))
def test_cleaning_twice_changes_nothing(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "x string")
    once = frame.select(text.one_line("x").alias("x"))
    both = once.select("x", text.one_line("x").alias("again")).collect()
    for source, row in zip(texts, both):
        assert row.x == row.again
        assert not set(row.x) & set('"' + ENDS)
        kept = [c for c in source if c not in '"' + ENDS and c != " "]
        assert [c for c in row.x if c != " "] == kept


def test_short_comment_always_ends_with_the_ending(rows):
    found = rows(text.short_comment("x"), [None, "abc", "ก" * 200, "ก" * 201])
    assert found == ["…", "abc…", "ก" * 200 + "…", "ก" * 200 + "…"]


def test_bad_values_become_null(rows):
    assert rows(typing.whole("x"), ["4", "4.0", " 5 ", "abc", "", None, "9" * 12]) == [
        4, 4, 5, None, None, None, None
    ]
    assert rows(typing.real("x"), ["13.7", " 13.7", "n/a", "", None]) == [13.7, 13.7, None, None, None]


def test_instants(rows):
    values = ["2024-01-05 10:00:00.123+00", "2024-01-05 10:00:00+07", "2024-01-05 10:00:00", "abc", "", None]
    utc = rows(typing.instant("x").cast("timestamp_ntz"), values)
    assert utc[0] == dt.datetime(2024, 1, 5, 10, 0, 0, 123000)
    assert utc[1] == dt.datetime(2024, 1, 5, 3)
    assert utc[2] == dt.datetime(2024, 1, 5, 10)
    assert utc[3:] == [None, None, None]


def test_parts(rows):
    values = ["100.5,13.7", "100.5, 13.7", "100.5", "", None]
    assert rows(typing.part("x", 0), values) == ["100.5", "100.5", "100.5", "", None]
    assert rows(typing.real(typing.part("x", 1)), values) == [13.7, 13.7, None, None, None]


def test_element_text_joins_trimmed_pieces(rows):
    values = ["  a <b> b </b> c<!-- no --> ", "&amp;lt; &#39;x&#39; &#x0e01; &hellip;", "", None, "<i></i>"]
    assert rows(text.element_text("x"), values) == ["abc", "&lt; 'x' ก …", "", "", ""]


def test_every_named_reference(rows):
    names = sorted(html.entities.html5)[::37]
    values = [f"x&{name}y" for name in names]
    assert rows(text.decode_entities("x"), values) == [html.unescape(v) for v in values]


def test_palette_repeats_after_twenty_and_clamps(rows):
    found = rows(color.palette_color("x"), [0, 9, 10, 19, 20, 21], "int")
    assert found == [color.PALETTE[i] for i in (0, 9, 9, 9, 0, 1)]


def test_color_texts(rows):
    values = [[31, 119, 180, 255], [0, 8, 255, 51], None]
    assert rows(color.rgba_text("x"), values[:2], "array<int>") == [
        "rgba(31,119,180,1.0)", "rgba(0,8,255,0.2)"
    ]
    assert rows(color.rgba_text("x", ", "), values[:1], "array<int>") == ["rgba(31, 119, 180, 1.0)"]
    assert rows(color.hex_text("x"), values, "array<int>") == ["#1f77b4", "#0008ff", "#888888"]


def test_name_colors_are_light_and_stable(rows):
    names = [f"D{i}" for i in range(300)]
    found = rows(color.name_color("x"), names)
    assert found == rows(color.name_color("x"), names)
    channels = np.array(found)
    assert channels.min() >= 150 and channels.max() <= 255 and len(np.unique(channels)) > 90


def test_draw_depends_on_seed_and_all_of_the_identity(spark):
    frame = spark.createDataFrame([("a", "b"), ("a", None), (None, "a")], "x string, y string")
    one, other = sampling.draw(1, ["x", "y"]), sampling.draw(2, ["x", "y"])
    found = frame.select(one, other).collect()
    assert len({value for row in found for value in row}) == 6


VECTORS = [[3.0, 4.0], [0.0, 0.0], None, [], [-2.0, 0.0, 0.0], [1.0, float("nan")]]


def test_l2_normalize(rows):
    found = rows(vector.l2_normalize("x"), VECTORS, "array<double>")
    assert found[:5] == [[0.6, 0.8], [0.0, 0.0], None, [], [-1.0, 0.0, 0.0]]
    assert all(math.isnan(v) for v in found[5])


def test_nearest_takes_the_first_of_equal_centers(rows):
    centers = np.array([[0.0, 0.0], [2.0, 0.0], [2.0, 0.0]])
    column = vector.nearest("x", ["a", "b", "c"], centers)
    values = [[1.0, 0.0], [1.9, 0.0], None, [1.0], [9.0, 9.0]]
    assert rows(column, values, "array<double>") == ["a", "b", None, None, "b"]


def test_project(rows):
    column = vector.project("x", np.array([[1.0, 0.0], [0.0, 2.0]]), mean=np.array([1.0, 1.0]))
    values = [[3.0, 4.0], None, [1.0], [1.0, 1.0]]
    assert rows(column, values, "array<double>") == [[2.0, 6.0], None, None, [0.0, 0.0]]


def test_distance(spark):
    frame = spark.createDataFrame(
        [([0.0, 0.0], [3.0, 4.0]), (None, [1.0, 1.0]), ([1.0, 2.0], None), ([1.0], [1.0])],
        "x array<double>, y array<double>",
    )
    assert [r[0] for r in frame.select(vector.distance("x", "y")).collect()] == [5.0, None, None, 0.0]


def test_distance_of_unequal_widths_fails(spark):
    frame = spark.createDataFrame([([0.0], [3.0, 4.0])], "x array<double>, y array<double>")
    with pytest.raises(Exception, match="different width"):
        frame.select(vector.distance("x", "y")).collect()


def test_concat_of_missing_is_missing(spark):
    frame = spark.createDataFrame([([1.0], [2.0]), ([1.0], None)], "x array<double>, y array<double>")
    assert [r[0] for r in frame.select(vector.concat("x", "y")).collect()] == [[1.0, 2.0], None]


def test_nothing_thrown_on_empty_frames(spark):
    frame = spark.createDataFrame([], "x array<double>, t string")
    for column in (vector.l2_normalize("x"), vector.nearest("x", ["a"], np.zeros((1, 2)))):
        assert frame.select(column).collect() == []
    assert frame.select(F.lit(1), text.element_text("t")).collect() == []
