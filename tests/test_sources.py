import datetime
import json
import os
import subprocess
import sys
from decimal import Decimal
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.reshape import heading_faults, map_headings
from ledgerloom.plans.almanac import search, search_times
from ledgerloom.sources import calendar, delimited, html, nested, survey_labels, tables

# ---------------------------------------------------------------- delimited text

RETAIL = """InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country
536365,85123A,"PAPER CRAFT , LITTLE BIRDIE",6,2010-12-01 08:26:00,2.55,17850.0,United Kingdom
C536379,D,Discount,-1,2010-12-01 09:41:00,27.50,,France
"""


def test_retail_csv(spark, tmp_path):
    (tmp_path / "r.csv").write_text(RETAIL)
    rows = delimited.read_retail(spark, str(tmp_path / "r.csv"), timestampFormat="yyyy-MM-dd HH:mm:ss").collect()
    assert rows[0].Description == "PAPER CRAFT , LITTLE BIRDIE"
    assert rows[0].UnitPrice == Decimal("2.55") and rows[0].CustomerID == "17850.0"
    assert rows[0].InvoiceDate == datetime.datetime(2010, 12, 1, 8, 26)
    assert rows[1].Quantity == -1 and rows[1].CustomerID is None


def test_other_columns_are_an_error(spark, tmp_path):
    (tmp_path / "r.csv").write_text(RETAIL.replace("Quantity,InvoiceDate", "InvoiceDate,Quantity"))
    with pytest.raises(Exception, match="header|schema"):
        delimited.read_retail(spark, str(tmp_path / "r.csv")).collect()


def test_passengers(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        "survived,sex,age,n_siblings_spouses,parch,fare,class,deck,embark_town,alone\n"
        "0,male,22.0,1,0,7.25,Third,unknown,Southampton,n\n"
    )
    row = delimited.read_passengers(spark, str(tmp_path / "p.csv")).first()
    assert (row.survived, row.age, row["class"], row.alone) == (0, 22.0, "Third", "n")


def survey_file(path, labels, rows, bom=False):
    codes = [f"S1901_C{i:02d}" for i in range(len(labels))]
    lines = [["GEO_ID", "NAME", *codes], ["Geography", delimited.LABEL_ROW, *labels], *rows]
    text = "".join(",".join(f'"{c}"' for c in line) + ("\n" if i == 0 else ",\n") for i, line in enumerate(lines))
    path.write_bytes((b"\xef\xbb\xbf" if bom else b"") + text.encode())


def test_survey(spark, tmp_path):
    by_year = {}
    for year, vintage in ((2017, 2015), (2018, 2018), (2022, 2019)):
        labels = [h[2] for h in survey_labels.INCOME_HEADINGS if h[0] == vintage] + ["Households!!Other"]
        area = f"g{year}"
        rows = [
            [area, "Anderson County, Tennessee", "100", "5", "200", "6", "N"],
            [area, "Van Buren County, Tennessee", "(X)", "**", "250,000+", "-", "1"],
        ]
        by_year[year] = str(tmp_path / f"{year}.csv")
        survey_file(tmp_path / f"{year}.csv", labels, rows, bom=year == 2022)
    long = delimited.read_survey(spark, by_year)
    assert long.count() == 3 * 2 * 5
    assert heading_faults(long, survey_labels.INCOME_HEADINGS).count() == 0
    mapped = map_headings(long, survey_labels.INCOME_HEADINGS)
    got = {(r.county, r.year, r.metric): r.value for r in mapped.collect()}
    assert len(got) == 3 * 2 * 4
    for year in by_year:
        assert got["Anderson", year, "median_household_income"] == 100
        assert got["Anderson", year, "mean_income_error"] == 6
        assert got["Van Buren", year, "median_household_income"] is None
    raw = {r.raw for r in long.filter(F.col("value").isNull()).collect()}
    assert raw == {"N", "(X)", "**", "250,000+", "-"}


def test_survey_files_in_one_scan(spark, tmp_path, plan):
    """Seven files of different headings and widths; the same cells as file by file."""
    by_year = {}
    for n, year in enumerate(range(2015, 2022)):
        labels = [f"Estimate!!{'Old' if year < 2018 else 'New'}!!Column {i}" for i in range(3 + n)]
        rows = [
            [f"g{year}", "Anderson County, Tennessee", *[str(year + i) for i in range(3 + n)]],
            [f"g{year}", "Van Buren County, Tennessee", "(X)", "**", "250,000+", *["N"] * n],
        ]
        by_year[year] = str(tmp_path / f"ACSST1Y{year}.S1901-Data.csv")
        survey_file(tmp_path / f"ACSST1Y{year}.S1901-Data.csv", labels, rows, bom=year == 2020)
    found = delimited.read_survey_files(spark, f"{tmp_path}/*-Data.csv", width=40)
    assert plan(found).count("FileScan") == 1
    want = delimited.read_survey(spark, by_year)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, want.select(*found.columns).collect()), key=str)

    for year in by_year:
        text = '"Column Name","Label"\n"GEO_ID","Geography"\n"S1901_C00","Named by the dictionary"\n'
        (tmp_path / f"ACSST1Y{year}.S1901-Column-Metadata.csv").write_text(text)
    names = delimited.read_survey_metadata(spark, f"{tmp_path}/*-Metadata.csv")
    assert names.count() == 14 and {r.year for r in names.collect()} == set(by_year)
    named = delimited.read_survey_files(spark, f"{tmp_path}/*-Data.csv", names, width=40)
    got = {(r.year, r.code, r.label) for r in named.filter("code IN ('S1901_C00', 'S1901_C01')").collect()}
    assert got == {(y, "S1901_C00", "Named by the dictionary") for y in by_year} | {
        (y, "S1901_C01", f"Estimate!!{'Old' if y < 2018 else 'New'}!!Column 1") for y in by_year
    }


def test_survey_files_of_another_shape_are_errors(spark, tmp_path):
    (tmp_path / "Y2015.csv").write_text("GEO_ID,NAME,a,b\nGeography,Geographic Area Name,x,y\ng,A County,1,2\n")
    assert delimited.read_survey_files(spark, str(tmp_path / "Y2015.csv"), width=4).count() == 2
    with pytest.raises(Exception, match="more than 3 columns"):
        delimited.read_survey_files(spark, str(tmp_path / "Y2015.csv"), width=3).collect()
    (tmp_path / "Y2016.csv").write_text("GEO_ID,a,NAME\nGeography,x,Geographic Area Name\ng,1,A County\n")
    with pytest.raises(Exception, match="not NAME"):
        delimited.read_survey_files(spark, str(tmp_path / "Y2016.csv")).collect()


def test_poverty_headings():
    headings = survey_labels.POVERTY_HEADINGS
    assert len(headings) == 36 and len({(h[0], h[2]) for h in headings}) == 36
    assert (2015, 2017, "Percent below poverty level!!Margin of Error!!AGE!!Under 18 years", "pov_children_error") in headings


def test_write_csv(spark, tmp_path):
    df = spark.createDataFrame([(2015, "a", 1.5), (2016, "b", None)], "year int, county string, value double")
    delimited.write_csv(df, str(tmp_path / "out"), ["year"])
    back = delimited.read_csv(spark, str(tmp_path / "out"), "county string, value double, year int", enforceSchema="true")
    assert sorted(map(tuple, back.select("year", "county", "value").collect())) == [(2015, "a", 1.5), (2016, "b", None)]


# ---------------------------------------------------------------- nested documents


def photo(i, day="2024-02-19"):
    rover = dict(name="R", status="active", max_sol=4102, total_photos=7, launch_date="2011-11-26", landing_date="2012-08-06")
    return dict(id=i, sol=4100, camera=dict(name="MAST", id=3), img_src=f"u{i}", earth_date=day, rover=rover)


def test_photo_pages(spark, tmp_path):
    pages = [dict(photos=[photo(1), photo(2, "not a date")]), dict(photos=[])]
    (tmp_path / "pages.json").write_text("\n".join(map(json.dumps, pages)))
    rows = nested.flatten_photos(nested.read_photo_pages(spark, str(tmp_path / "pages.json"))).orderBy("id").collect()
    assert [r.id for r in rows] == [1, 2]
    assert rows[0].camera == "MAST" and rows[0].max_sol == 4102
    assert rows[0].earth_date == datetime.date(2024, 2, 19) and rows[1].earth_date is None
    assert rows[0].landing_date == datetime.date(2012, 8, 6)


# ---------------------------------------------------------------- saved tables


def test_insert_if_absent_twice_is_once(spark):
    tables.create_if_missing(spark, "photos_t", "id bigint, camera string, sol int", ["sol"])
    tables.create_if_missing(spark, "photos_t", "id bigint, camera string, sol int", ["sol"])
    first = spark.createDataFrame([(1, "a", 5), (2, "b", 5)], "id bigint, camera string, sol int")
    tables.insert_if_absent(first, "photos_t", ["id"], ["camera"])
    batch = spark.createDataFrame([(2, "z", 6), (3, "d", 6), (3, "c", 6)], "id bigint, camera string, sol int")
    for _ in range(2):
        tables.insert_if_absent(batch, "photos_t", ["id"], ["camera"])
    assert sorted(map(tuple, spark.table("photos_t").select("id", "camera", "sol").collect())) == [
        (1, "a", 5), (2, "b", 5), (3, "c", 6),
    ]


def test_append_matches_columns_by_name(spark):
    tables.create_if_missing(spark, "entries_t", "date string, year int, event_type string", ["event_type"])
    df = spark.createDataFrame([("birth", 1900, "January 1")], "event_type string, year int, date string")
    tables.append(df, "entries_t")
    assert tables.register(spark.table("entries_t"), "entries_v").first().date == "January 1"
    assert spark.sql("SELECT year FROM entries_v WHERE event_type = 'birth'").first().year == 1900


# ---------------------------------------------------------------- pages

PAGE = """<html><head><title><ul><li>no</li></ul></title><script>var t = "<ul><li>no</li></ul>";</script></head>
<body><!-- <ul><li>no</li></ul> -->
<ul><li><a href="/wiki/44_BC">44 BC</a> &ndash; <b>Caesar</b>[12]
 dies<li><a href="/wiki/1969">1969</a> – <a title="a > b" href='/wiki/Moon_landing'>Moon</a></li></ul>
<UL><LI>outer <ul><li>inner <a href="x">x</a></li></ul> end</LI></UL>
<p>not an item <a href="/wiki/Other">other</a></p></body></html>"""


def test_list_items():
    items = html.list_items(PAGE, "https://site.example/wiki/March_15")
    assert [(i[0], i[1], i[2]) for i in items] == [
        (0, 0, "44 BC – Caesar[12] dies"),
        (0, 1, "1969 – Moon"),
        (1, 0, "outer inner x end"),
        (1, 1, "inner x"),
        (2, 0, "inner x"),
    ]
    assert [a["url"] for a in items[1][3]] == ["https://site.example/wiki/1969", "https://site.example/wiki/Moon_landing"]
    assert [a["text"] for a in items[3][3]] == ["x"]
    assert html.list_items("", None) == [] and html.list_items(None, None) == []


def test_items_are_handed_on_by_size():
    """Many large pages in one batch: no output batch above the stated size by more than one item."""
    page = "<ul>" + "".join(f"<li>{'x' * 500} {i}</li>" for i in range(40)) + "</ul>"
    pages = pd.DataFrame({"page_id": range(30), "url": ["u"] * 30, "html": [page] * 29 + [None]})
    parts = list(html.item_batches(pages, chars=5000))
    assert len(parts) > 100 and all(p.raw_text.str.len().sum() <= 5000 + 600 for p in parts)
    found = pd.concat(parts)
    assert list(zip(found.page_id, found.item_no)) == [(n, i) for n in range(29) for i in range(40)]
    assert len(list(html.item_batches(pages))) == 1 and not list(html.item_batches(pages[29:]))


def test_entry_counts_of_nine_lists(spark):
    page = "".join(f"<ul>{'<li>1 – x</li>' * (i + 1)}</ul>" for i in range(11))
    pages = spark.createDataFrame([(1, "https://site.example/wiki/May_1", page)], "page_id long, url string, html string")
    counts = html.entries(html.page_items(pages)).groupBy("event_type").count().collect()
    assert {r.event_type: r["count"] for r in counts} == {"event": 6, "birth": 15, "death": 24}


def test_entries_by_list_number(spark):
    page = "".join(f"<ul><li>{i} – text {i}</li></ul>" for i in range(11))
    pages = spark.createDataFrame([(1, "https://site.example/wiki/May_1", page), (2, "u", PAGE), (3, "u", None)], "page_id long, url string, html string")
    rows = html.entries(html.page_items(pages)).collect()
    kinds = [r.event_type for r in sorted(rows, key=lambda r: r.list_no) if r.page_id == 1]
    assert kinds == ["event"] * 3 + ["birth"] * 3 + ["death"] * 3
    first = [r for r in rows if r.page_id == 2 and r.list_no == 0]
    assert {r.text for r in first} == {"44 BC – Caesar dies", "1969 – Moon"}
    # A link whose text is a bare number is left out.
    assert {r.item_no: [x.tag for x in r.links] for r in first} == {0: ["44 BC"], 1: ["Moon landing"]}


# ---------------------------------------------------------------- calendar and search


def test_month_days(spark):
    days = [r.month_day for r in calendar.month_days(spark).orderBy("day_of_year").collect()]
    assert len(days) == 365 and days[0] == "January 1" and days[58:60] == ["February 28", "March 1"]


def test_search(spark):
    rows = [("January 5", 1600, "event"), ("January 20", 1800, "event"), ("January 21", 1700, "event"), ("January 6", -44, "event"), ("January 6", 1700, "birth")]
    events = spark.createDataFrame(rows, "date string, year int, event_type string")
    assert search(events, "January 5", "January 20", 1500, 1800, "event").count() == 2
    assert search(events, "December 20", "January 20", 1500, 1800, "event").isEmpty()
    times = [("2001-01-05 00:00:00", "event"), ("2001-01-20 23:59:59", "event"), ("2001-01-21 00:00:00", "event"), ("2003-01-10 00:00:00", "event"), ("2000-02-29 01:00:00", "event")]
    timed = spark.createDataFrame(times, "t string, event_type string").select(F.col("t").cast("timestamp_ntz").alias("ts"), "event_type")
    assert search_times(timed, "January 5", "January 20", 2001, 2002, "event").count() == 2
    assert search_times(timed, "February 29", "February 29", 2000, 2000, "event").count() == 1
    assert search_times(timed, "December 20", "January 20", 2000, 2003, "event").isEmpty()


def test_workers_need_no_copy_of_the_package(tmp_path):
    """Started elsewhere, Python workers cannot import the package; its functions are sent along."""
    root = Path(__file__).resolve().parents[1]
    script = f"""
import sys
sys.path.insert(0, {str(root)!r})
from ledgerloom.plans import registry
from ledgerloom.session import local_session
spark = local_session("2")
print("rows", len(registry.QUERIES["page_entries"](spark, "/root/testdata/sf0.001").collect()))
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 281" in done.stdout, done.stderr[-2000:]


def test_pages_are_objects_a_few_at_a_time(spark, monkeypatch):
    """A task turns a slice of its pages into Python objects, not the whole batch; null numbers and addresses stay null."""
    page = "<ul><li><a href='/wiki/A'>a</a> b</li></ul>"
    rows = [(None if n == 7 else n, None if n == 8 else "http://x/y", page) for n in range(1000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    items = html.page_items(pages)
    assert "MapInArrow" in items._jdf.queryExecution().toString() and html.PAGES_AT_ONCE < 1000
    found = items.select("page_id", "url", "list_no", "item_no", "raw_text", "anchors").collect()
    assert [(r.page_id, r.url) for r in found] == [r[:2] for r in rows]
    assert all(r.raw_text == "a b" and len(r.anchors) == 1 for r in found)
