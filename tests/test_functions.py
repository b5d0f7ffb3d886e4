import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import arrays as A, dates as D, text as X


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def vector(*values):
    return A.literal_vector(values)


# ---------------------------------------------------------------- text


@pytest.mark.parametrize(
    "text, year, body",
    [
        ("44 BC – Caesar dies", -44, "Caesar dies"),
        ("AD 69 – Four emperors", 69, "Four emperors"),
        ("1969 – Moon landing", 1969, "Moon landing"),
        ("c. 500 – A town is founded", 500, "A town is founded"),
        ("1969 – Letter to BC Hydro", 1969, "Letter to BC Hydro"),
        ("no digits here", None, "here"),
        ("1969", 1969, ""),
    ],
)
def test_years(spark, text, year, body):
    row = one(spark, X.signed_year(F.lit(text)), X.entry_body(F.lit(text)))
    assert tuple(row) == (year, body)


def test_citations(spark):
    assert one(spark, X.strip_citations(F.lit(" text[1] goes[22] on [x] ")))[0] == "text goes on [x]"


@pytest.mark.parametrize(
    "url, tag",
    [
        ("https://site.example/wiki/New_York", "New York"),
        ("https://site.example/wiki/Caf%C3%A9_au_lait#History", "Café au lait"),
        ("https://site.example/wiki/C%2B%2B", "C++"),
        ("https://site.example/wiki/A+B?x=/y", "A+B"),
        ("https://site.example/wiki/100%_sure", "100% sure"),
        ("/wiki/44_BC", "44 BC"),
        ("https://site.example/", ""),
    ],
)
def test_tags(spark, url, tag):
    assert one(spark, X.url_tag(F.lit(url)))[0] == tag


def test_links(spark):
    links = F.array(
        *[F.struct(F.lit(t).alias("tag"), F.lit("u" + t).alias("link")) for t in ("January 1", "Rome", "January 1 BC")]
    )
    kept = X.blank_own_date(links, F.lit("January 1"))
    row = one(spark, kept.alias("kept"), X.filled_links(kept).alias("filled"), *X.link_slots(kept))
    assert [x.tag for x in row.kept] == [None, "Rome", "January 1 BC"]
    assert [x.link for x in row.filled] == ["uRome", "uJanuary 1 BC"]
    assert (row.tag_1, row.tag_2, row.link_2, row.tag_4, row.link_20) == (None, "Rome", "uRome", None, None)
    assert len(row) == 42


def test_link_text(spark):
    row = one(spark, *[X.is_link_text(F.lit(t)) for t in ("1969", "Rome", "", "19a")])
    assert list(row) == [False, True, True, True]


def test_keys(spark):
    year, metric = X.split_metric_key(X.metric_key(F.lit(2015), F.lit("pov_adult")))
    assert list(one(spark, year, metric)) == [2015, "pov_adult"]
    names = ["Anderson County, Tennessee", "Van Buren County, Tennessee", "Elsewhere, Ohio"]
    assert list(one(spark, *[X.county_name(F.lit(n)) for n in names])) == ["Anderson", "Van Buren", "Elsewhere"]


# ---------------------------------------------------------------- dates


def test_dates(spark):
    day = F.lit(datetime.date(2024, 2, 19))  # a Monday
    row = one(
        spark, D.week_start(day), D.week_start(day, "monday"), D.week_start(F.lit(datetime.date(2024, 2, 18))),
        D.month_start(F.lit(2011), F.lit(12)), D.mission_sol(day), D.mission_sol(F.lit(datetime.date(2024, 3, 1))),
        D.page_name(D.month_day_name(day)), D.month_day_of_page(F.lit("January_5")),
    )
    assert list(row) == [
        datetime.date(2024, 2, 18), datetime.date(2024, 2, 19), datetime.date(2024, 2, 18),
        datetime.date(2011, 12, 1), 4102, 4113, "February_19", "January 5",
    ]
    with pytest.raises(ValueError):
        D.week_start(day, "friday")


def test_days_in_month(spark):
    months = "January February March April May June July August September October November December".split()
    assert list(one(spark, *[D.days_in_month(F.lit(m)) for m in months])) == [31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]


def test_month_day_as_date(spark):
    row = one(spark, *[D.month_day_as_date(F.lit(t)) for t in ("March 1", "February 29", "February 30", "x")])
    assert list(row) == [datetime.date(2000, 3, 1), datetime.date(2000, 2, 29), None, None]


# ---------------------------------------------------------------- arrays

X4 = [1.0, 2.0, 3.0, 2.5]
BATCH = [X4, [2.0, 5.0, -1.0, 2.0], [-1.5, 2.7, 3.3, -0.8]]
W1 = [[0.2, 0.8, -0.5, 1.0], [0.5, -0.91, 0.26, -0.5], [-0.26, -0.27, 0.17, 0.87]]
B1 = [2.0, 3.0, 0.5]
W2 = [[0.1, -0.14, 0.5], [-0.5, 0.12, -0.33], [0.44, 0.73, -0.13]]
B2 = [-1.0, 2.0, -0.5]


def test_dense(spark):
    assert one(spark, A.dense(vector(*X4), [W1[0]], [2.0]))[0] == pytest.approx([4.8])
    batch = spark.createDataFrame([(x,) for x in BATCH], "x array<double>")
    got = [r[0] for r in batch.select(A.dense(A.dense(F.col("x"), W1, B1), W2, B2)).collect()]
    want = (np.array(BATCH) @ np.array(W1).T + B1) @ np.array(W2).T + B2
    assert np.allclose(got, want)
    with pytest.raises(ValueError):
        A.dense(F.col("x"), W1, [1.0])


def test_activations(spark):
    x = [0, 2, -1, 3.3, -2.7, 1.1, 2.2, -100]
    row = one(spark, A.relu(vector(*x)), A.step(vector(*x)), A.sigmoid(vector(*x)))
    assert row[0] == [0, 2, 0, 3.3, 0, 1.1, 2.2, 0]
    assert row[1] == [0, 1, 0, 1, 0, 1, 1, 0]
    assert row[2] == pytest.approx([1 / (1 + math.exp(-v)) for v in x])


@pytest.mark.parametrize("x", [[4.8, 1.21, 2.385], [8.9, -1.81, 0.2], [1.41, 1.051, 0.026], [1000.0, 999.0]])
def test_softmax(spark, x):
    row = one(spark, A.softmax(vector(*x)), A.softmax(vector(*[v - max(x) for v in x])))
    assert sum(row[0]) == pytest.approx(1.0)
    assert row[0] == pytest.approx(row[1])
    if max(x) < 100:
        e = np.exp(x)
        assert row[0] == pytest.approx(list(e / e.sum()))


def test_cross_entropy(spark):
    p = vector(0.7, 0.1, 0.2)
    row = one(
        spark, A.cross_entropy(p, F.lit(0)), A.cross_entropy_one_hot(p, vector(1, 0, 0)),
        A.cross_entropy(vector(0, 1), F.lit(0)), A.cross_entropy(vector(0, 1), F.lit(1)),
    )
    assert row[0] == pytest.approx(0.35667494393873245)
    assert row[1] == pytest.approx(row[0])
    assert row[2] == pytest.approx(-math.log(1e-7))
    assert row[3] == pytest.approx(-math.log(1 - 1e-7))


def test_mean_loss_and_accuracy(spark):
    rows = [([0.7, 0.1, 0.2], 0), ([0.5, 0.1, 0.4], 1), ([0.02, 0.9, 0.08], 1)]
    df = spark.createDataFrame(rows, "p array<double>, y int")
    loss, hits = df.select(
        F.avg(A.cross_entropy(F.col("p"), F.col("y"))), F.avg((A.argmax(F.col("p")) == F.col("y")).cast("int"))
    ).first()
    assert loss == pytest.approx(-np.mean(np.log([0.7, 0.1, 0.9])))
    assert hits == pytest.approx(2 / 3)


def test_top_classes(spark):
    best = one(spark, A.top_classes(vector(0.1, 0.4, 0.4, 0.05, 0.05), 3))[0]
    assert [(b["class"], b["score"]) for b in best] == [(1, 0.4), (2, 0.4), (0, 0.1)]


def test_cosine(spark):
    a, b = [1.0, 2.0, 2.0], [2.0, 0.0, 1.0]
    row = one(spark, A.cosine(vector(*a), vector(*b)), A.cosine_to(vector(*a), b), A.cosine_to(vector(0, 0, 0), b))
    want = np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b)
    assert list(row) == pytest.approx([want, want, 0.0])


def test_sums_and_grid(spark):
    row = one(spark, A.total(vector(1, 2, 3.5)), A.mean(vector(1, 2, 3)), A.grid(-1, 1, 5), A.grid(2, 3, 1))
    assert row[0] == 6.5 and row[1] == 2
    assert row[2] == pytest.approx(list(np.linspace(-1, 1, 5)))
    assert row[3] == [2.0]
