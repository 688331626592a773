import datetime
import random

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark import catalog

TABLES = "customer orders lineitem supplier part nation events documents pages labels".split()


def made_up():
    """Small tables of the driver's shapes."""
    rng = random.Random(8)
    day = lambda n: datetime.datetime(2020, 1, 1) + datetime.timedelta(days=n, hours=n % 24)
    words = "the tion of and ing thing to nation a $$$ ### river".split()
    text = lambda: "".join(rng.choice(words) + rng.choice([" ", " ", "\n", ", "]) for _ in range(rng.choice([3, 30, 90])))
    link = lambda: rng.choice(["/the", "/of", "/and", "/der", "/la", "/el", "/und", "/für", "/Thing", "/x"])
    return {
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", [(i, f"c{i}", i % 3, 1.0, rng.choice(["BUILDING", "AUTOMOBILE", "MACHINERY"])) for i in range(40)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string", [(i, rng.randrange(35), rng.choice("FOP"), round(rng.uniform(1, 500_000), 2), day(rng.randrange(1500)), rng.choice(["1-URGENT", "2-HIGH"])) for i in range(200)]),
        "lineitem": (
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
            [(rng.randrange(200), 1, 1, 1, 1.0, round(rng.uniform(1, 1e5), 2), round(rng.uniform(0, 0.1), 2), 0.0, rng.choice("RAN"), rng.choice("FO"), day(5)) for _ in range(500)],
        ),
        "supplier": ("s_suppkey long, s_name string", [(i, "s") for i in range(20)]),
        "part": ("p_partkey long, p_name string", [(i, "p") for i in range(10, 40)]),
        "nation": ("n_nationkey int, n_name string", [(0, "A"), (1, "B")]),
        "events": ("event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string", [(i, day(i % 9), 1, rng.choice("ab"), round(rng.uniform(0, 9), 2), '{"k": %d}' % i if i % 5 else "{}") for i in range(60)]),
        "documents": ("doc_id long, text string, lang string, source string, n_chars long", [(i, text(), rng.choice(["en", "de"]), "s", 1) for i in range(60)]),
        "pages": ("page_id long, url string, html string", [(i, f"http://h/{i}?a=b|c", f'<html lang="en"><title>t{i}</title>' + "".join(f'<a href="{link()}">x</a>' for _ in range(rng.randrange(6)))) for i in range(30)]),
        "labels": ("doc_id long, quality int, toxic int", [(i, i % 2, 0) for i in range(50, 70)]),
    }


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder, con = tmp_path_factory.mktemp("tables"), duckdb.connect()
    for name, (schema, rows) in made_up().items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet/*.parquet'")
    return str(folder), con


def plain(v):
    return round(v, 6) if isinstance(v, float) else v if v is None or isinstance(v, (str, int)) else str(v)


@pytest.mark.parametrize("name", list(catalog.ORACLES))
def test_query_equals_sql(spark, tables, name):
    folder, con = tables
    df = catalog.QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    cursor = con.execute(catalog.ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()), key=repr)
    assert got == want and (want or name in ("link_neighbours",))


def test_entry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert "link_graph" in entry.queries()
