"""The registered queries on awkward tables: hot keys, orphans, nulls, equal times, empty tables."""

import random
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry
from ledgerloom.plans import almanac, captures, finder, learning, panel, profiling, retail, vectors
from tools.compare import TABLES, duck, rows_of

NAMES = ["blue ring", "hot bolt", "large plate", "red cup", None]


def write(folder, name, columns, rows):
    """``columns`` as in SQL; rows as tuples."""
    con = duckdb.connect()
    con.execute(f"CREATE TABLE t ({columns})")
    if rows:
        con.executemany(f"INSERT INTO t VALUES ({', '.join('?' * len(rows[0]))})", rows)
    con.execute(f"COPY t TO '{folder}/{name}.parquet' (FORMAT parquet)")


def build(folder, n_lines, n_events, n_pages, seed=11):
    rng = random.Random(seed)
    some = bool(n_lines)
    write(folder, "region", "r_regionkey INTEGER, r_name VARCHAR", [(0, "R")])
    write(
        folder, "nation", "n_nationkey INTEGER, n_name VARCHAR, n_regionkey INTEGER",
        [(i, f"NATION_{i}", 0) for i in range(25)],
    )
    # A third of the customers live in one nation, some in none that exists.
    homes = [rng.choice([7, 7, 3, 12, 20, 5, 99, None]) for _ in range(100)]
    write(
        folder, "customer",
        "c_custkey BIGINT, c_name VARCHAR, c_nationkey INTEGER, c_acctbal DOUBLE, c_mktsegment VARCHAR",
        [(i, f"C{i}", homes[i], 0.0, "S") for i in range(100)] if some else [],
    )
    write(folder, "supplier", "s_suppkey BIGINT, s_name VARCHAR, s_nationkey INTEGER, s_acctbal DOUBLE", [])
    write(
        folder, "part",
        "p_partkey BIGINT, p_name VARCHAR, p_brand VARCHAR, p_type VARCHAR, p_size INTEGER, p_retailprice DOUBLE",
        [(i, NAMES[i % 5], "B", "T", 1, 9000.1 + i * 13.37) for i in range(40)] if some else [],
    )
    # A third of the orders are on one day and by one customer; some by customers that do not exist.
    orders = []
    for i in range(300 if some else 0):
        day = "2000-05-05" if i % 3 == 0 else f"{rng.randint(1995, 2001)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"
        customer = 42 if i % 3 == 1 else rng.choice([77, 500, None, *range(100)])
        orders.append((i * 5000, customer, "O", rng.randint(1, 99999) / 100, day + " 00:00:00", "1-URGENT"))
    write(
        folder, "orders",
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus VARCHAR, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP, o_orderpriority VARCHAR",
        orders,
    )
    lines = []
    for i in range(n_lines):
        order = rng.choice([5000, 5000, 10000, 7, *range(0, 1500000, 5000)])
        part = rng.choice([0, 0, 0, 1000, *range(40)]) if i % 3 else 1
        quantity = rng.choice([float(rng.randint(1, 50)), 1.5, 2.25])
        flag = rng.choice(["R", "A", "N", None])
        price = None if i % 50 == 0 else rng.choice([1e6, rng.randint(100, 9999999) / 100])
        lines.append((order, part, i % 10, i, quantity, price, 0.1, 0.02, flag, "O", "2000-01-01 00:00:00"))
    write(
        folder, "lineitem",
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INTEGER, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag VARCHAR, l_linestatus VARCHAR, "
        "l_shipdate TIMESTAMP",
        lines,
    )
    events = []
    for i in range(n_events):
        ts = f"2024-{rng.choice(['01', '01', '02'])}-{rng.randint(1, 29):02d} {rng.randint(0, 23):02d}:00:01"
        kind = "view" if i % 3 else rng.choice(["click", "error", None])
        events.append((i, ts, rng.choice([1, 1, 1, 2, 3, 3_000_000_000]), kind, 1.0, f'{{"k": {rng.randint(0, 9)}}}'))
    write(
        folder, "events",
        "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE, props VARCHAR", events,
    )
    pages, documents = [], []
    for i in range(n_pages):
        items = "".join(
            f'<li><a href="/{rng.choice(["New_York", "Caf%C3%A9", "44_BC", "a+b", "1969", str(i)])}">{rng.choice(["x", "1969", "", "y z"])}</a></li>'
            for _ in range(rng.choice([0, 1, 3, 40]))
        )
        pages.append((i, f"http://site.example/wiki/{i}", f"<html><nav><ul>{items}</ul></nav><p>text</p></html>"))
        texts = ["44 BC – x", "AD 69 – y", "1969 – z", "none", "c. 500 – w", "AD", "99999999999999999999 big", " [3] 7 – q ", ""]
        documents.append((i, "\n".join(rng.sample(texts, 5)), rng.choice(["en", "en", "de"]), rng.choice(["s", "t"]), rng.randint(0, 5000)))
    write(folder, "pages", "page_id BIGINT, url VARCHAR, html VARCHAR", pages)
    write(folder, "documents", "doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT", documents)
    labels = [(i, rng.randint(0, 1), 0) for i in range(n_pages)]
    write(folder, "labels", "doc_id BIGINT, quality INTEGER, toxic INTEGER", labels)
    embeddings = [(i, [rng.gauss(0, 0.3) for _ in range(64)], rng.randint(0, 9)) for i in range(n_pages)]
    write(folder, "embeddings", "vec_id BIGINT, embedding FLOAT[], label INTEGER", embeddings)
    write(folder, "benchmark", "item_id BIGINT, text VARCHAR", [])
    write(folder, "conversations", "conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR", [])


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    build(folder, 3000, 600, 30)
    return folder, duck(folder)


@pytest.fixture(scope="module")
def empty(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    build(folder, 0, 0, 0)
    return folder, duck(folder)


def test_an_unknown_nation_is_a_column_of_its_own(spark, tmp_path):
    folder = str(tmp_path)
    build(folder, 500, 0, 0)
    write(folder, "nation", "n_nationkey INTEGER, n_name VARCHAR, n_regionkey INTEGER", [(i, f"NATION_{i}" if i != 3 else "NEWLAND", 0) for i in range(25)])
    wide = panel.long_to_wide(spark, folder)
    assert "NEWLAND" in wide.columns and wide.filter("NEWLAND IS NOT NULL").count() > 0
    check(spark, folder, duck(folder), "wide_to_long")


def test_events_of_the_leap_day_are_counted(spark, odd):
    days = almanac.valid_month_days(spark, odd[0]).collect()
    assert len(days) == 366 and sum(r.events for r in days) == 600
    assert next(r for r in days if r.day_of_year is None).events > 0


AREAS = {**retail.QUERIES, **panel.QUERIES, **captures.QUERIES, **almanac.QUERIES}
MEASURED = {**vectors.QUERIES, **profiling.QUERIES, "one_hot_features": learning.one_hot_features, **{k: v for k, v in learning.QUERIES.items() if k != "train_eval_classifier"}, **finder.QUERIES}


def check(spark, folder, con, name):
    df = entry.queries()[name](spark, folder)
    result = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    assert rows_of(df.columns, df.collect()) == want
    return want


@pytest.mark.parametrize("name", sorted({**AREAS, **MEASURED}))
def test_odd_tables(spark, odd, name):
    assert check(spark, *odd, name)


@pytest.mark.parametrize("name", sorted(AREAS))
def test_empty_tables(spark, empty, name):
    check(spark, *empty, name)


@pytest.mark.parametrize("name", sorted({**vectors.QUERIES, **profiling.QUERIES}))
def test_empty_tables_are_no_error(spark, empty, name):
    entry.queries()[name](spark, empty[0]).collect()


def test_all_tables_are_written(odd):
    assert all(Path(odd[0], f"{t}.parquet").exists() for t in TABLES)
