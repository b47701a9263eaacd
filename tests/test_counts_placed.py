"""Line items are placed by trip once for all counts, and what is counted stays what its SQL says."""

import datetime as dt

import pytest

from workload.frames import catalog, derived
from workload.tables import TABLES

T = dt.datetime(1998, 3, 1)
PARTS = [(1, "hot ring", 1), (2, "red bolt", 3), (3, "old gear", 9), (4, "hot ring", 12), (5, "large rod", 50), (5, "red bolt", 4), (6, None, 7), (7, "dim plate", None), (None, "hot ring", 2)]


def lines():
    found = [(o, p, s, n, float(q), q * 10.25, "F" if n % 2 else "O", T + dt.timedelta(days=o)) for o in range(12) for n, (p, s, q) in enumerate([(1, 17, 3), (2, 13, 5), (4, 11, 2), (5, 6, 7), (3 + o % 5, o, 1 + o), (1, 8, 4), (9, 1, 1)], 1)]
    gone = [(None, 1, 2, 1, 2.0, 5.0, "O", T), (3, None, 2, 2, 2.0, 5.0, "O", T), (3, 2, None, 3, 2.0, 5.0, None, None), (4, 2, 3, None, None, None, "F", T)]
    return found + found[::3] + gone


@pytest.fixture
def tables(spark, tmp_path):
    made = {
        "lineitem": (lines(), "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_linestatus string, l_shipdate timestamp_ntz"),
        "part": (PARTS, "p_partkey bigint, p_name string, p_size int"),
        "orders": ([(o, o % 4, "O" if o % 3 else "F", T + dt.timedelta(days=o), "3-MEDIUM") for o in range(12)] + [(None, 1, "O", T, "1-URGENT")], "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string"),
        "events": ([(o, o % 4, T + dt.timedelta(days=5114 + 5478 + o - o % 2400)) for o in range(12)], "event_id bigint, user_id bigint, ts timestamp_ntz"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def as_text(df):
    return sorted(repr(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("name", ["bgc_phyto_raw", "bgc_zoop_raw", "measurements"])
def test_placed_tables_hold_the_rows_of_their_sql(spark, tables, name):
    lineitem, part = (spark.read.parquet(f"{tables}/{t}.parquet") for t in ("lineitem", "part"))
    args = {"lineitem": lineitem} if name == "measurements" else {"lineitem": lineitem, "taxon": spark.sql(TABLES["taxon"], part=part)}
    want = spark.sql(TABLES[name], **args)
    got = derived(spark, tables, name)
    assert got.dtypes == want.dtypes and got.count() > 12
    assert as_text(got) == as_text(want)


def test_counts_move_once_for_the_index_product(spark, tables):
    product = catalog(spark, tables)["nrs_derived_indices_data"]
    assert product.filter("PhytoAbundance_CellsL > 0 AND ZoopAbundance_m3 > 0").count() > 0
    product.collect()
    plan = product._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in plan
    moved = [line for line in plan.splitlines() if "Exchange " in line]
    # Counts went to (trip, taxon), to (trip, species) and to trip, each table on its own.
    assert not [line for line in moved if "species" in line.split("hashpartitioning")[-1]]
    counts = [line for line in moved if "REPARTITION_BY_NUM" in line and "ReusedExchange" not in line]
    assert len(counts) == 4, counts  # counts, profiles, chemistry and pigments
    assert [line for line in moved if "ReusedExchange" in line and "taxon_name" in line]
