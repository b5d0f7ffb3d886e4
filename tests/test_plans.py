"""What the plans must look like: pruned scans, pushed filters, no Python where Spark has the function."""

import re

import pytest

from ledgerloom.operators import profile
from ledgerloom.plans import registry

FOLDER = "/root/testdata/sf0.001"
# Reading HTML, scoring layers and fitting models are the only steps run in Python or on stored rows.
WITH_PYTHON = {
    "page_entries", "entry_counts", "entry_links", "link_slots", "filtered_text_search",
    "dense_forward", "softmax_scores", "cross_entropy", "classification_accuracy", "top5_classes",
}
#: Joins of a few years with a few spans, or of one asked range with its answer.
KNOWN_SMALL = {"heading_check", "filtered_text_search"}
#: Blocks of a stated set of queries meet blocks of all rows; no pair of rows is a row of the join.
IN_BLOCKS = {"similar_vectors", "similarity_index_recall"}
#: Its scans run before it returns a few rows; test_profiles_scan_twice looks at them.
RUN_BEFORE = {"describe_numeric"}
FITTED = {"one_hot_features", "train_eval_classifier"}
#: Columns of the wide tables; a scan that reads all of them is not pruned.
WIDE = {"l_": 11, "o_": 6, "p_": 6, "c_": 5, "n_chars": 2}


@pytest.fixture(params=[True, False], ids=["broadcast", "as at scale"])
def any_size(spark, request):
    """Plans with small tables broadcast, and as they are with large ones."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if not request.param:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def large(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - FITTED))
def test_python_only_where_needed(spark, plan, name, any_size):
    text = plan(registry.QUERIES[name](spark, FOLDER))
    python = bool(re.search(r"MapInPandas|MapInArrow|ArrowEvalPython|BatchEvalPython", text))
    assert python == (name in WITH_PYTHON | IN_BLOCKS)
    if name not in KNOWN_SMALL | IN_BLOCKS:
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - FITTED - RUN_BEFORE - {"columns_numbered"}))
def test_scans_are_pruned(spark, plan, name):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan(registry.QUERIES[name](spark, FOLDER)))
    assert schemas
    for schema in schemas:
        for prefix, columns in WIDE.items():
            assert len(re.findall(rf"(?:^|,){prefix}", schema)) < columns


@pytest.mark.parametrize(
    "name",
    ["customer_history", "revenue_by_item_in_country", "monthly_cumulative_top_items", "monthly_cumulative_by_country_threshold"],
)
def test_lines_meet_filtered_orders_before_parts(spark, plan, name, large):
    """The join with the parts stands above the one with the orders."""
    text = plan(registry.QUERIES[name](spark, FOLDER))
    joins = re.findall(r"SortMergeJoin \[(\w+)#", text)
    assert joins.index("part_key") < joins.index("order_key")


@pytest.mark.parametrize("name, scans", [("stack_years", 3), ("key_set_difference", 1)])
def test_number_of_scans(spark, plan, name, scans):
    assert plan(registry.QUERIES[name](spark, FOLDER)).count("ReadSchema") <= scans


def test_profiles_scan_twice(spark, plan, monkeypatch):
    """Each of the two steps of describe_numeric reads its table once, and only the columns described."""
    seen = []
    for step in ("_measured", "_in_brackets"):
        made = getattr(profile, step)
        monkeypatch.setattr(profile, step, lambda *a, made=made: seen.append(made(*a)) or seen[-1])
    assert registry.QUERIES["describe_numeric"](spark, FOLDER).count() > 0
    assert len(seen) == 2
    for df in seen:
        schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan(df).split("Initial Plan")[0])  # it has run, so both are shown
        assert len(schemas) == 1 and len(re.findall(r"(?:^|,)l_", schemas[0])) < WIDE["l_"]


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("item_lookup", "EqualTo(p_name"),
        ("customer_history", "In(o_custkey"),
        ("revenue_by_item_in_country", "EqualTo(n_name"),
        ("monthly_cumulative_by_country_threshold", "In(n_name"),
        ("returns_by_count", "EqualTo(l_returnflag,R)"),
        ("top_orders_by_quantity", "GreaterThan(l_quantity"),
        ("month_day_year_search", "EqualTo(event_type"),
        ("month_day_year_search", "GreaterThanOrEqual(ts"),
        ("key_set_difference", "GreaterThanOrEqual(o_orderdate"),
        ("member_filter", "EqualTo(event_type"),
    ],
)
def test_filters_reach_the_scan(spark, plan, name, pushed):
    assert pushed in plan(registry.QUERIES[name](spark, FOLDER)).replace("[", "(")


@pytest.mark.parametrize(
    "name", ["top_orders_by_quantity", "revenue_by_item", "top_customers", "returns_by_value", "most_similar"]
)
def test_top_k_is_one_pass(spark, plan, name):
    assert "TakeOrderedAndProject" in plan(registry.QUERIES[name](spark, FOLDER))


def test_order_sums_share_the_join_shuffle(spark, plan):
    """Lines are added up per order and joined to the orders in one shuffle of the lines."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(registry.QUERIES["quantity_by_country"](spark, FOLDER))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(re.findall(r"Exchange hashpartitioning\(order_key", text)) == 2
