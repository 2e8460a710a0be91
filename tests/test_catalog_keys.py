"""Catalogue queries on keys and costs that the small tables lack: DuckDB's rows."""

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessera.model import profiles


def compared(spark, folder, name, **tables):
    """The rows of a query over the tables, and DuckDB's."""
    c = duckdb.connect()
    for t, df in tables.items():
        df.to_parquet(f"{folder}/{t}.parquet")
        c.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    got = entry.queries()[name](spark, str(folder))
    want = c.execute(f"select {', '.join(got.columns)} from ({entry.oracle_sql()[name]})").fetchall()
    return [tuple(r) for r in got.collect()], want


def suppliers(*keys):
    return pd.DataFrame({"s_suppkey": list(keys), "s_name": [f"Supplier {k}" for k in keys]})


def test_names_of_five_digits_come_last(spark, tmp_path):
    got, want = compared(spark, tmp_path, "front_matter_parse", supplier=suppliers(60_001, 10_000, 7, 9_998, 3))
    assert [r[0] for r in got] == ["ISA-7", "ISA-9998", "ISA-10000", "ISA-60001"] and sorted(got) == sorted(want)


def test_ids_of_five_digits(spark, tmp_path):
    got, want = compared(spark, tmp_path, "standard_ids", supplier=suppliers(1, 9_800, 9_801, 59_999))
    assert sorted(got) == sorted(want) and {r[3] for r in got} == {"ISA-200", "ISA-9999", "ISA-10000", "ISA-60198"}
    with pytest.raises(Exception, match="STANDARD_ID"):
        spark.range(1).select(profiles.standard_id("ISA", F.lit("10000"))).collect()


def test_parts_cost_what_their_paragraphs_cost(spark, tmp_path):
    turns = {1: [500, 500], 2: [500, 500, 8], 3: [400, 404, 200], 4: [333, 331, 335, 9, 640], 7: [2000], 8: [1000, 1], 9: [1001], 10: [996]}
    rows = [(c, k, f" {'x' * n} " if c % 2 else "x" * n) for c, sizes in turns.items() for k, n in enumerate(sizes)] + [(3, 9, " "), (11, 0, None), (14, 0, None), (15, 0, ""), (16, 0, None), (16, 1, "x")]
    conversations = pd.DataFrame(rows, columns=["conv_id", "turn", "text"])
    got, want = compared(spark, tmp_path, "split_oversized_chunks", conversations=conversations)
    assert sorted(got) == sorted(want) and ("c1", 1) in got and ("c2", 2) in got


def test_header_costs_what_the_sql_starts_with(spark, tmp_path):
    rows = [(1, 10_000 + i, 1, 5) for i in range(97)] + [(1, 1, 1, 5)]  # 97 rows of four tokens, one of three
    rows += [(2, *r[1:]) for r in rows[:-1]] + [(2, 2, 1, 5), (2, 3, 1, 5)]
    got, want = compared(spark, tmp_path, "split_table_header_repeat", lineitem=pd.DataFrame(rows, columns=["l_suppkey", "l_orderkey", "l_linenumber", "l_partkey"]))
    assert sorted(got) == sorted(want) == [(1, 1, 98), (2, 2, 99)]
