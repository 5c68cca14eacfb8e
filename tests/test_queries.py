"""Every registered query on the smallest tables: rows and types equal its SQL, and the plan is sound."""

import pytest

import __spark_entry__ as entry
from starqueries import registry
from starqueries.compare import actual, connect, expected
from tests.conftest import SMALL, plan

NAMES = sorted(registry.QUERIES)
TYPES = {"INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "DATE": "date",
         "BOOLEAN": "boolean"}
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups")
PARSERS = ("html_elements", "html_rows", "html_spanned_cells", "visa_codes")


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    frame = entry.queries()[name](spark, SMALL)
    sql = entry.oracle_sql()[name]

    described = duck.sql(sql)
    wanted_types = {c: TYPES.get(str(t), str(t)) for c, t in zip(described.columns, described.types, strict=True)}
    assert {f.name: f.dataType.simpleString() for f in frame.schema} == wanted_types

    shown = plan(frame)
    assert "CartesianProduct" not in shown and "BroadcastNestedLoopJoin" not in shown
    if name not in PARSERS:
        assert not any(node in shown for node in PYTHON_NODES)

    columns, found = actual(frame)
    wanted_columns, wanted = expected(duck, sql)
    assert columns == wanted_columns
    assert found == wanted


def test_entry_has_rows_and_a_schema(spark):
    found = entry.entry(spark)
    assert found.columns == ["continent_name", "country_name", "number_immigrants"] and found.count() > 0


def test_every_query_has_sql():
    assert set(registry.SQL) == set(registry.QUERIES) <= set(entry.queries())
