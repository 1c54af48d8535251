"""The base tables from rows of a star schema."""

from quotegrid.schema import METRICS
from quotegrid.sources import star


def test_price_table_groups_lines_by_the_suppliers_number(spark, tmp_path):
    """The station's text is made from the quotes: as a grouping key it would be made and shuffled for every line."""
    spark.sql(
        "select * from values (date '2001-01-01', 7L, 'A', 1, 1000.0D), (date '2001-01-01', 7L, 'R', 2, 3000.0D), "
        "(date '2001-01-02', null, 'A', 1, 500.0D) as t(l_shipdate, l_suppkey, l_returnflag, l_linenumber, l_extendedprice)"
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    table = star.prices(spark, str(tmp_path))
    got = {(str(r["date"]), r["station_id"]): (r[METRICS[0]], r[METRICS[1]], r[METRICS[2]]) for r in table.collect()}
    assert got == {("2001-01-01", "7"): (1.22, 1.21, 1.23), ("2001-01-02", None): (1.205, 1.205, None)}
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    keys = [line.split("Aggregate [", 1)[1].split("]", 1)[0] for line in plan.splitlines() if "Aggregate [" in line]
    assert len(keys) == 1 and "l_suppkey" in keys[0] and "station_id" not in keys[0]
    assert "cast(l_suppkey" not in plan.split("Aggregate [", 1)[1]
