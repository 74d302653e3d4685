"""Tables derived where they are read: only the columns a query reads are shuffled."""

from datetime import datetime

import pytest

from checks.binding import Domain
from checks.registry import QUERIES
import checks.tables  # noqa: F401
import checks.views  # noqa: F401


@pytest.fixture(scope="module")
def given(spark, tmp_path_factory):
    """Two orders; one line item twice, one without a part, one without an order; a part that is there twice."""
    day, folder = datetime(2001, 7, 1), tmp_path_factory.mktemp("given")
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    rest = (5.0, 10.0, 0.1, 0.1, "A", "F", day)
    tables = {
        "lineitem": (line, [(1, 7, 1, 1, *rest), (1, 7, 1, 1, *rest), (2, 99, 1, 1, *rest), (3, 8, 1, 1, *rest), (3, None, 1, 2, *rest)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
                   [(1, 1, "F", 10.0, day, "1-U"), (2, None, "O", 10.0, day, "2-H")]),
        "part": ("p_partkey long, p_brand string, p_type string", [(7, "b", "t"), (8, "b", "u"), (8, "c", "v")]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def scanned(df) -> set[str]:
    """Columns of the line items that a query's plan reads from the files."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    reads = [part.split(">", 1)[0] for part in plan.split("ReadSchema: struct<")[1:]]
    return {c.split(":")[0] for r in reads for c in r.split(",") if c.startswith("l_")}


@pytest.mark.parametrize("name, columns", [
    ("duplicates_side_by_side", {"l_orderkey", "l_partkey", "l_linenumber"}),
    ("key_violations", {"l_orderkey", "l_partkey", "l_linenumber"}),
    ("duplicate_report", {"l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_linestatus", "l_returnflag"}),
])
def test_only_the_columns_in_use_are_read(spark, given, name, columns):
    assert scanned(QUERIES[name](spark, given)) == columns


def test_rows_of_line_items_stay(spark, given):
    d = Domain(spark, given)
    requirements = sorted((r.task_pk, r.requirement_id, r.section_name or "") for r in d["task_requirements"].collect())
    assert requirements == [(1, "1", "t"), (1, "1", "t"), (2, "1", ""), (3, "1", "u"), (3, "1", "v"), (3, "2", "")]
    photos = sorted(((r.property_pk or 0), r.photo_id) for r in d["property_photos"].collect())
    assert photos == [(0, "49"), (1, "7"), (1, "7")]
    assert [tuple(r) for r in QUERIES["duplicates_side_by_side"](spark, given).collect()] == [(1, 2)]
    assert [tuple(r) for r in QUERIES["key_violations"](spark, given).orderBy("task_pk").collect()] == [(1, "1", 2), (3, "1", 2)]
    assert not {name for _, folder, name in Domain._written if folder == given} & {"task_requirements", "property_photos"}
