"""Shapes of physical plans that the scale of the data depends on."""

import re

import pytest

from tallymark.plans import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture()
def no_broadcast(spark):
    """Plans as they are for tables far beyond the broadcast threshold."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def plan(spark, key):
    frame = QUERIES[key](spark, SF_DIR)
    frame.collect()
    text = spark._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")
    final, _, rest = text.partition("== Initial Plan ==")
    used = set(re.findall(r"\((\d+)\)\s*$", final, re.M))
    details = [block for block in rest.split("\n\n") if (m := re.match(r"\s*\((\d+)\)", block)) and m.group(1) in used]
    return final + "\n\n".join(details)


@pytest.mark.parametrize("key, pushed", [
    ("b01_compare_between", "GreaterThanOrEqual(o_orderdate"), ("r02_store_revenue_since", "GreaterThanOrEqual(l_shipdate"),
    ("r12_month_category_region", "LessThan(o_orderdate"), ("r17_revenue_by_category_quarter", "GreaterThanOrEqual(l_shipdate"),
    ("b02_in_list", "In(l_returnflag")])
def test_filters_reach_the_scan(spark, key, pushed):
    filters = " ".join(re.findall(r"PushedFilters: \[(.*)\]", plan(spark, key)))
    assert pushed in filters


@pytest.mark.parametrize("key, columns", [
    ("d02_count_distinct", {"l_partkey", "l_suppkey", "l_returnflag"}), ("r24_most_active_customer", {"l_orderkey", "l_linenumber"}),
    ("r22_stock_state", {"l_partkey", "l_suppkey", "l_linestatus"}), ("d13_column_max", None)])
def test_only_needed_columns_are_read(spark, key, columns):
    schemas = re.findall(r"ReadSchema: struct<(l_.*?)>", plan(spark, key))
    assert schemas
    for schema in schemas:
        read = {part.split(":")[0] for part in schema.split(",")}
        assert len(read) <= 6 if columns is None else read == columns


@pytest.mark.parametrize("key", ["e13_latest_per_group", "e14_first_duplicate", "f04_topk_per_group"])
def test_ranks_are_limited_before_the_shuffle(spark, key):
    assert plan(spark, key).count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("key", ["f03_topk_keep_ties", "r02_store_revenue_since", "r22_stock_state", "d02_count_distinct",
                                 "r27_sales_per_employee_flag", "r29_filtered_extremes"])
def test_the_facts_are_read_once(spark, no_broadcast, key):
    text = plan(spark, key)
    scans = re.findall(r"Location: InMemoryFileIndex.*?(\w+)\.parquet", text)
    assert scans
    assert scans.count("lineitem") <= 1 and scans.count("orders") <= 1


@pytest.mark.parametrize("key", ["r10_quarter_crosstab", "r13_pct_vs_previous_period", "r13b_pct_prev_by_groups_frame",
                                 "r14_weekly_cumsum_centered_avg"])
def test_lines_are_filtered_before_their_shuffle(spark, no_broadcast, key):
    """On the way up from the scan of the lines, the semi join with the wanted keys comes before an exchange."""
    text = plan(spark, key)
    scans = set(re.findall(r"^\((\d+)\) Scan parquet(?:(?!\n\n)[\s\S])*?lineitem\.parquet", text, re.M))
    tree = [line for line in text.splitlines() if re.search(r"\(\d+\)(, Statistics.*)?$", line)]
    found = 0
    for n, line in enumerate(tree):
        number = re.search(r"Scan parquet\s+\((\d+)\)$", line)
        if not number or number.group(1) not in scans:
            continue
        depth, above = len(line) - len(line.lstrip(" :+-*")), []
        for parent in reversed(tree[:n]):
            if (indent := len(parent) - len(parent.lstrip(" :+-*"))) < depth:
                depth = indent
                above.append(parent)
        exchange = next(i for i, p in enumerate(above) if re.search(r"[ -]Exchange \(", p))
        assert any("BroadcastHashJoin LeftSemi" in p for p in above[:exchange])
        found += 1
    assert found


def test_few_leaders_are_broadcast_to_their_names(spark):
    """Written leaders have a known size, so the table of names is not shuffled."""
    text = plan(spark, "r09_top5_customers_per_channel")
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_what_the_library_does_without():
    """No Python functions, no RDDs, one crossing: that of the two lists whose pairs are asked for."""
    import pathlib

    import tallymark

    root = pathlib.Path(tallymark.__file__).parent
    sources = {p.name: p.read_text() for p in root.rglob("*.py") if p.parent.name != "llm"}
    assert not [n for n, s in sources.items() if "pandas_udf(" in s or "mapInPandas" in s]
    assert not [n for n, s in sources.items() if ".rdd" in s or "localCheckpoint" in s or "toPandas" in s]
    assert sorted(n for n, s in sources.items() if ".crossJoin(" in s) == ["joins_and_aggregates.py"]
