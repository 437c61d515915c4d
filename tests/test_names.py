"""Column name rules."""

import re

import pytest
from hypothesis import given
from hypothesis import strategies as st

from millrace.functions import standard_name, standard_names
from millrace.operators import standardize_columns


@pytest.mark.parametrize(
    ("name", "want"),
    [
        ("First Name", "first_name"),
        ("total-amount", "total_amount"),
        ("a.b", "ab"),
        ("9lives", "9lives"),
        ("a\u00a0b", "ab"),
        ("A - B", "a_b"),
        ("a--_b", "a__b"),
        ("été", "t"),
        ("x/y", "xy"),
        ("CamelCase", "camelcase"),
        ("Price ($)", "price_"),
        ("  x ", "_x_"),
        ("Straße", "strae"),
        ("__A", "__a"),
        ("tab\tand\nline", "tab_and_line"),
        ("!!!", ""),
    ],
)
def test_rule(name, want):
    assert standard_name(name) == want


def spelled_out(name):
    out, in_run = "", False
    for c in name.lower():
        if c in " \t\n\r\f\v-":
            out += "" if in_run else "_"
            in_run = True
            continue
        in_run = False
        if c in "abcdefghijklmnopqrstuvwxyz0123456789_":
            out += c
    return out


@given(st.text())
def test_rule_on_any_name(name):
    new = standard_name(name)
    assert re.fullmatch("[a-z0-9_]*", new)
    assert standard_name(new) == new
    assert new == spelled_out(name)


@given(st.lists(st.sampled_from(["a", "A", "a 2", "a-2", "A_2", "b", "a_2_2"]), max_size=8))
def test_suffixes_make_names_unique(names):
    new = standard_names(names, "suffix")
    assert len(set(new)) == len(new) == len(names)


def test_clashes(spark):
    df = spark.sql("select 1 as `A b`, 2 as `a-b`, 3 as c")
    with pytest.raises(ValueError, match="A b"):
        standardize_columns(df)
    assert standardize_columns(df, "suffix").first().asDict() == {"a_b": 1, "a_b_2": 2, "c": 3}
    with pytest.raises(ValueError, match="on_collision"):
        standardize_columns(df, "drop")
    with pytest.raises(ValueError, match="!!!"):
        standardize_columns(spark.sql("select 1 as `!!!`"))


def test_names_are_taken_by_position(spark):
    df = spark.sql("select named_struct('b', 9) as a, 1 as `a.b`, 2 as `c``d`")
    assert standardize_columns(df).selectExpr("a.b as inner", "ab", "cd").first() == (9, 1, 2)
    same = spark.sql("select 1 as x, 2 as x")
    assert tuple(standardize_columns(same, "suffix").first()) == (1, 2)
