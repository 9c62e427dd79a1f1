"""The registered forms of the jobs against their SQL."""

import os

import duckdb
import pytest

from jobs import queries


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_against_sql(spark, name, sf):
    data = f"/root/testdata/{sf}"
    con = duckdb.connect()
    for f in os.listdir(data):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{data}/{f}'")
    df = queries.QUERIES[name](spark, data)
    got = sorted(tuple(map(str, r)) for r in df.collect())
    columns = ", ".join(f'"{c}"' for c in df.columns)
    want = con.execute(f"SELECT {columns} FROM ({queries.ORACLE[name]})").fetchall()
    assert got and got == sorted(tuple(map(str, r)) for r in want)


def test_each_call_has_a_folder_of_its_own(spark):
    from sigspark.sources.shared import fresh_folder

    a, b = fresh_folder(spark, "job"), fresh_folder(spark, "job")
    assert a != b and os.path.dirname(a) == os.path.dirname(b)
