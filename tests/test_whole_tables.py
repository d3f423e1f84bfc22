"""Queries read their whole tables, whatever the ids are."""

import __spark_entry__  # noqa: F401  (registers the queries)
from quantloom.plans.catalog import QUERIES


def test_indent_paths_of_every_order(spark, tmp_path):
    rows = [(order, place, float(13 * indent), label) for order in (1, 1999, 2000, 600_000) for place, indent, label in ((1, 0, "A"), (2, 1, "N"), (3, 2, "R"))]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_quantity double, l_returnflag string").write.parquet(str(tmp_path / "lineitem.parquet"))
    got = sorted((r.l_orderkey, r.place, r.path, r.depth) for r in QUERIES["o1_09_indent_paths"](spark, str(tmp_path)).collect())
    assert got == [(order, k + 1, path, k) for order in (1, 1999, 2000, 600_000) for k, path in enumerate(("", "A", "A>N"))]
