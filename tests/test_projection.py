from __future__ import annotations

import pytest

from martloom.operators.projection import rename_columns, select_columns
from martloom.sources.tables import TableSource, catalog_reader, load_sources
from tests.frames import settings


@pytest.fixture(scope="module")
def abc(spark):
    return spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")


def test_rename_follows_map_order(abc):
    assert rename_columns(abc, {"a": "x", "x": "y", "b": "a"}, "t").columns == ["y", "a", "c"]


def test_rename_keeps_values(abc):
    assert rename_columns(abc, {"b": "z"}, "t").first().asDict() == {"a": 1, "z": 2, "c": 3}


@pytest.mark.parametrize("renames", [{}, {"a": "a"}, {"absent": "absent"}])
def test_nothing_to_rename(abc, renames):
    assert rename_columns(abc, renames, "t") is abc


def test_rename_of_missing_column_names_table_and_columns(abc):
    with pytest.raises(ValueError, match=r"tab: cannot rename 'd'.*\['a', 'b', 'c'\]"):
        rename_columns(abc, {"d": "e"}, "tab")


def test_rename_is_case_sensitive(abc):
    with pytest.raises(ValueError, match="cannot rename 'A'"):
        rename_columns(abc, {"A": "x"}, "t")


@pytest.mark.parametrize("renames", [{"a": "b", "b": "a"}, {"a": "c"}, {"a": "C"}])
def test_rename_to_a_taken_name(abc, renames):
    with pytest.raises(ValueError, match="second"):
        rename_columns(abc, renames, "t")


def test_rename_may_change_case(spark, abc):
    assert rename_columns(abc, {"a": "A"}, "t").columns == ["A", "b", "c"]
    with settings(spark, spark__sql__caseSensitive="true"):
        assert rename_columns(abc, {"a": "C"}, "t").columns == ["C", "b", "c"]


def test_rename_is_one_projection(abc):
    renamed = rename_columns(abc, {"a": "x", "b": "y", "c": "z"}, "t")
    assert renamed._jdf.queryExecution().optimizedPlan().toString().count("Project") <= 1


def test_select_reports_all_missing(abc):
    with pytest.raises(ValueError, match="no column d, A"):
        select_columns(abc, ["a", "d", "A"])


def test_select_takes_any_name(spark):
    odd = spark.createDataFrame([(1, 2)], "`a.b` int, `c``d` int")
    assert select_columns(odd, ["c`d", "a.b"]).first() == (2, 1)


def test_sources(spark, abc):
    abc.createOrReplaceTempView("abc_source")
    sources = {"one": TableSource("abc_source", {"a": "x"}), "two": TableSource("no_such_table")}
    loaded = load_sources(catalog_reader(spark), sources, ["one"])
    assert {name: df.columns for name, df in loaded.items()} == {"one": ["x", "b", "c"]}
    with pytest.raises(KeyError, match="three"):
        load_sources(catalog_reader(spark), sources, ["one", "three"])


def test_catalog_source_by_qualified_name(spark, abc):
    abc.write.mode("overwrite").saveAsTable("source_abc")
    source = TableSource("source_abc", {"b": "y"})
    assert source.load(catalog_reader(spark, "spark_catalog.default")).columns == ["a", "y", "c"]
    spark.sql("DROP TABLE source_abc")
