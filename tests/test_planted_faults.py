"""Key checks and left joins on tables with planted faults, against the SQL twins."""

from pathlib import Path

import pandas as pd
import pytest

from compare import TABLES, database, differences
from souk.plans.oracle import oracle_sql
from souk.plans.queries import queries

SOURCE = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SOURCE).exists(), reason="no test data")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    out = tmp_path_factory.mktemp("faults")
    tables = {t: pd.read_parquet(f"{SOURCE}/{t}.parquet") for t in TABLES}
    lines, orders, customers = tables["lineitem"], tables["orders"], tables["customer"]
    lines.loc[:4, "l_orderkey"] = orders.o_orderkey.max() + 7  # five lines of one unknown order
    lines.loc[5:6, "l_partkey"] = tables["part"].p_partkey.max() + 1
    tables["lineitem"] = pd.concat([lines, lines.iloc[[10]]])  # a line twice
    orders.loc[:2, "o_custkey"] = customers.c_custkey.max() + 9
    tables["orders"] = pd.concat([orders, orders.iloc[[20]]])
    customers.loc[:1, "c_nationkey"] = 99
    for name, df in tables.items():
        df.to_parquet(out / f"{name}.parquet", coerce_timestamps="us")
    return str(out)


@pytest.mark.parametrize("name", ["fk_violations", "duplicate_keys", "export_users", "entity_counts"])
def test_same_result(spark, folder, name):
    assert differences(queries()[name](spark, folder), oracle_sql()[name], database(folder)) == ""


def test_faults_are_found(spark, folder):
    found = {r.relation: r for r in queries()["fk_violations"](spark, folder).collect()}
    assert found["transactions-items"].orphan_rows == 5 and found["transactions-items"].orphan_keys == 1
    assert found["transactions-items"].repeated_parent_keys == 1
    assert found["products-items"].orphan_rows == 2
    assert found["users-transactions"].orphan_rows == 3
    copies = {(r.entity, r.copies) for r in queries()["duplicate_keys"](spark, folder).collect()}
    assert {("order_lines", 2), ("transactions", 2)} <= copies


def test_users_of_unknown_nations_stay(spark, folder):
    users = queries()["export_users"](spark, folder)
    assert users.count() == spark.read.parquet(f"{folder}/customer.parquet").count()
    assert users.where("city = ''").count() == 2
