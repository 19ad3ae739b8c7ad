"""Table reads and statements (no database server is started)."""

import pytest

from chartwright.sources import tables as TB
from conftest import SF_SMALL


def test_read_table_by_path_and_name(spark):
    by_path = TB.read_table(spark, f"{SF_SMALL}/region.parquet")
    assert by_path.count() == 5
    by_path.createOrReplaceTempView("region_v")
    assert TB.read_table(spark, "region_v").count() == 5


def test_run_statement_binds_parameters(spark):
    TB.run_statement(spark, "CREATE OR REPLACE TEMP VIEW param_v AS SELECT :market AS market, :n AS n",
                     market="EUROPE", n=3)
    assert [tuple(r) for r in spark.table("param_v").collect()] == [("EUROPE", 3)]


def test_read_warehouse_checks_arguments(spark):
    with pytest.raises(ValueError):
        TB.read_warehouse(spark, "jdbc:postgresql://h/db")                       # neither
    with pytest.raises(ValueError):
        TB.read_warehouse(spark, "jdbc:postgresql://h/db", query="select 1", table="t")  # both
    with pytest.raises(ValueError):
        TB.read_warehouse(spark, "jdbc:postgresql://h/db", query="select 1", partition_column="k",
                          lower_bound=0, upper_bound=10, num_partitions=4)
