"""Hand-made rows for what the driver's tables do not have: ties, gaps, NULLs, repeats."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallymark.functions.dates import calendar
from tallymark.operators import maintenance as m
from tallymark.operators import quality as q
from tallymark.operators import textindex
from tallymark.operators.frames import describe, exact_mean, fill_with, row_extreme_flags
from tallymark.operators.joins import densify, keep_keys
from tallymark.operators.maintenance import deleted_where, update_from, updated_rows
from tallymark.operators.ordered import rank_in_group
from tallymark.operators.scores import trainee_scores
from tallymark.operators.topk import top_distinct_values, top_rank
from tallymark.operators.windows import groups_frame, latest_per_group, with_group_total
from tallymark.plans import account_reports, rental_reports, sales_reports
from tallymark.sources import files


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def ts(text):
    return dt.datetime.fromisoformat(text)


# --- ties and ranks -----------------------------------------------------------------------


def test_five_highest_counts_keep_all_ties(spark):
    values = [9, 9, 8, 7, 6, 5, 5, 5, 4, 1]
    df = spark.createDataFrame([(f"k{i}", v) for i, v in enumerate(values)], "k string, v int")
    kept = [r.v for r in top_distinct_values(df, "v", 5).collect()]
    assert sorted(kept, reverse=True) == [9, 9, 8, 7, 6, 5, 5, 5]


def test_rank_skips_after_ties(spark):
    df = spark.createDataFrame([("a", v) for v in (5, 5, 4, 3)], "k string, v int")
    assert [r.v for r in top_rank(df, ["k"], "v", 2).collect()] == [5, 5]


def test_same_name_does_not_merge_actors(spark):
    film = spark.createDataFrame([(1, 2016), (2, 2017), (3, 2000)], "film_id int, release_year int")
    plays = spark.createDataFrame([(1, 1), (2, 2), (2, 1), (1, 3)], "actor_id int, film_id int")
    actor = spark.createDataFrame([(1, "Ann Lee"), (2, "Ann Lee")], "actor_id int, full_name string")
    out = rental_reports.busiest_actors(film, plays, actor, 2015, 5)
    assert rows(out) == [(1, "Ann Lee", 1), (2, "Ann Lee", 2)]
    gaps = rental_reports.release_gaps(plays, film, actor)
    assert rows(gaps, "actor_id", "prev_release_year", "next_release_year", "gap_between_films") == [
        (1, 2000, 2016, 16), (1, 2016, None, None), (2, 2016, 2017, 1), (2, 2017, None, None)]


def test_store_address_of_one_or_two_lines(spark):
    stores = spark.createDataFrame([(1, "A st", "flat 2"), (2, "B st", None)],
                                   "store_id int, address string, address2 string")
    payments = spark.createDataFrame(
        [(1, 1.10, ts("2017-04-01")), (1, 2.20, ts("2017-05-01")), (2, 3.0, ts("2017-03-31")), (2, 0.5, ts("2018-01-01"))],
        "store_id int, amount double, paid_at timestamp_ntz")
    out = rental_reports.revenue_per_store(payments, stores, "2017-04-01")
    assert [tuple(r) for r in out.collect()] == [
        (2, "B st", Decimal("0.50")), (1, "A st, flat 2", Decimal("3.30"))]


def test_popular_films_of_no_countries(spark):
    rentals = spark.createDataFrame([("X", 1), ("X", 1), ("X", 2), ("Y", 2), ("Y", 1)], "country string, film_id int")
    film = spark.createDataFrame([(1, "one", "G", 2000), (2, "two", "R", 2001)],
                                 "film_id int, title string, rating string, release_year int")
    best = rental_reports.most_popular(rentals, film, ["X", "Y"])
    assert rows(best, "country", "film") == [("X", "one"), ("Y", "one"), ("Y", "two")]
    assert rental_reports.most_popular(rentals, film, []).count() == 0
    assert rental_reports.most_popular(rentals, film, None).count() == 0


# --- periods ------------------------------------------------------------------------------


def test_previous_year_with_a_skipped_one(spark):
    data = [("ASIA", 1998, "web", 1000), ("ASIA", 1998, "shop", 3000), ("ASIA", 1999, "shop", 5000),
            ("ASIA", 2000, "web", 1000), ("ASIA", 2000, "shop", 1000)]
    df = spark.createDataFrame(data, "country_region string, calendar_year int, channel_desc string, total long")
    by_lag = {(r.calendar_year, r.channel_desc): r for r in sales_reports.percent_vs_previous(df, 1998, 2000).collect()}
    by_group = {(r.calendar_year, r.channel_desc): r
                for r in sales_reports.percent_vs_previous_group(df, 1998, 2000).collect()}
    assert by_lag[2000, "web"].pct_previous_period == "25.00%"
    assert by_lag[2000, "web"].pct_diff == "25.00%"
    assert by_lag[1998, "web"].pct_previous_period == "0%"
    assert by_group[1998, "web"].pct_previous_period is None
    assert by_group[2000, "web"].pct_previous_period == "20.00%"  # 1998 of the channel, 1999 of the region
    assert by_group[2000, "shop"].pct_previous_period == "100.00%"


def test_weeks_with_missing_days(spark):
    days = calendar(spark, "1999-11-29", "1999-12-31").filter("calendar_week_number between 48 and 52")
    daily = spark.createDataFrame([(dt.date(1999, 12, 4), 300), (dt.date(1999, 12, 6), 500), (dt.date(1999, 12, 7), 100)],
                                  "time_id date, sold_cents long")
    out = {r.time_id.day: r for r in sales_reports.weekly_centered_average(days, daily, 49, 51).collect()}
    assert len(out) == 21 and sorted(out)[0] == 6
    assert out[6].day_name == "Monday" and out[6].centered_3_day_avg == Decimal("2.25")  # Sat, Sun, Mon, Tue
    assert out[7].cum_sum == Decimal("6.00") and out[8].sales == 0


def test_frame_modes_over_repeated_and_empty_days(spark):
    days = calendar(spark, "1999-01-01", "1999-01-06").select(F.col("time_id").alias("d_time"))
    sales = spark.createDataFrame(
        [(dt.date(1999, 1, 1), 100), (dt.date(1999, 1, 1), 200), (dt.date(1999, 1, 5), 1000), (dt.date(1998, 1, 1), 7)],
        "time_id date, sold_cents long")
    out = sales_reports.frame_modes_by_date(days, sales)
    assert [tuple(map(str, r)) for r in out.orderBy("d_time", "cum_sum_row").collect()] == [
        ("1999-01-01", "1.00", "1.00", "3.00", "3.00"), ("1999-01-01", "2.00", "3.00", "3.00", "3.00"),
        ("1999-01-02", "0.00", "3.00", "3.00", "3.00"), ("1999-01-03", "0.00", "3.00", "3.00", "3.00"),
        ("1999-01-04", "0.00", "3.00", "3.00", "3.00"), ("1999-01-05", "10.00", "13.00", "13.00", "10.00"),
        ("1999-01-06", "0.00", "13.00", "13.00", "10.00")]


def test_densify_keeps_every_frame_row(spark):
    frame = spark.range(4).select(F.col("id").alias("d"))
    facts = spark.createDataFrame([(1, 5), (1, 6), (9, 1)], "d long, x int")
    assert rows(densify(frame, facts, "d", {"x": F.lit(0)})) == [(0, 0), (1, 5), (1, 6), (2, 0), (3, 0)]


def test_groups_frame_and_excluded_group(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 1, 20), ("a", 5, 1), ("a", 9, 2)], "k string, o int, v int")
    whole = groups_frame(df, ["k"], F.col("o").asc(), F.col("v"), -1, 0, "s")
    assert rows(whole, "o", "s") == [(1, 30), (1, 30), (5, 31), (9, 3)]
    before = groups_frame(df, ["k"], F.col("o").asc(), F.col("v"), -1, -1, "s")
    assert rows(before, "o", "s") == [(1, None), (1, None), (5, 30), (9, 1)]


def test_latest_rows_keep_ties(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "c"), (2, 1, "d")], "k int, d int, x string")
    assert rows(latest_per_group(df, ["k"], "d"), "x") == [("a",), ("b",), ("d",)]


def test_revenue_of_a_quarter(spark):
    film = spark.createDataFrame([(1, "Drama"), (2, "Travel")], "film_id int, category string")
    payments = spark.createDataFrame(
        [(1, 1.5, ts("2017-04-01 00:00:00")), (1, 2.5, ts("2017-06-30 23:59:59")), (2, 9.0, ts("2017-07-01"))],
        "film_id int, amount double, paid_at timestamp_ntz")
    out = account_reports.revenue_by_category_quarter(payments, film, "2017-05-01")
    assert rows(out) == [("Drama", Decimal("4.00"))]
    assert account_reports.revenue_by_category_quarter(payments, film, None).count() == 0


# --- accounts -----------------------------------------------------------------------------


def test_balance_rules(spark):
    rentals = spark.createDataFrame([
        (1, ts("2017-01-01"), ts("2017-01-03"), 3, 100, 2000),   # in time
        (2, ts("2017-01-01"), ts("2017-01-05 12:00:00"), 3, 100, 2000),  # 1.5 days late: 1
        (3, ts("2017-01-01"), None, 3, 100, 2050),               # more than 2 x 3 days late: replacement 20.50
        (4, ts("2017-01-01"), ts("2017-01-10"), 3, 100, 2000),   # exactly 6 days late: 6
        (5, ts("2017-03-01"), None, 3, 100, 2000),               # after the day
        (6, ts("2017-01-01"), ts("2017-01-10 00:00:00.000001"), 3, 100, 2000),  # a moment more than 6: replacement
    ], "cust_id int, rental_date timestamp_ntz, return_date timestamp_ntz, rental_duration int, rate_cents long, replacement_cents long")
    payments = spark.createDataFrame([(1, 0.25, ts("2017-01-02")), (1, 5.0, ts("2017-03-01"))],
                                     "cust_id int, amount double, paid_at timestamp_ntz")
    customers = spark.createDataFrame([(i,) for i in range(1, 7)], "cust_id int")
    out = account_reports.customer_balances(rentals, payments, customers, "2017-02-01")
    assert rows(out, "cust_id", "late_fees", "balance") == [
        (1, 0, Decimal("0.75")), (2, 1, Decimal("2.00")), (3, 21, Decimal("22.00")), (4, 6, Decimal("7.00")),
        (5, 0, Decimal("0.00")), (6, 20, Decimal("21.00"))]


def test_rewards_exceed_both_limits_in_the_month_before(spark):
    customers = spark.createDataFrame([(1,), (2,), (3,)], "cust_id int")
    payments = spark.createDataFrame(
        [(1, 6.0, ts("2017-01-31 23:00:00")), (1, 6.0, ts("2017-01-01")), (2, 50.0, ts("2017-01-05")),
         (3, 5.0, ts("2017-01-05")), (3, 5.0, ts("2017-01-06")), (2, 50.0, ts("2017-02-01"))],
        "cust_id int, amount double, paid_at timestamp_ntz")
    assert rows(account_reports.rewards_report(customers, payments, 1, 10, "2017-02-15")) == [(1,)]


def test_stock(spark):
    rentals = spark.createDataFrame([(1, 1, False), (1, 1, True), (1, 2, False), (2, 1, True)],
                                    "film_id int, store_id int, is_open boolean")
    assert rows(account_reports.stock_state(rentals)) == [(1, 1, 1), (2, 0, 1)]


def test_titles_by_pattern(spark):
    film = spark.createDataFrame([(1, "Love Me", "en"), (2, "glove", "fr"), (3, "Hate", "en")],
                                 "film_id int, title string, language string")
    rentals = spark.createDataFrame(
        [(1, 7, 1, ts("2017-01-01")), (1, 7, 2, ts("2017-01-02")), (1, 8, 1, ts("2016-01-01")),
         (2, 7, 1, ts("2017-01-01")), (2, 7, 2, ts("2017-01-01"))],
        "film_id int, copy_id int, cust_id int, rental_date timestamp_ntz")
    names = spark.createDataFrame([(1, "Ann"), (2, "Bo")], "cust_id int, customer_name string")
    out = account_reports.latest_rentals_by_title(film, rentals, names, "%LOVE%")
    assert rows(out, "row_num", "film_title", "language", "copy_id", "customer_name", "rental_date") == [
        (1, "Love Me", "en", 7, "Bo", "2017-01-02 00:00:00"), (2, "Love Me", "en", 8, "Ann", "2016-01-01 00:00:00"),
        (3, "glove", "fr", 7, "Ann", "2017-01-01 00:00:00"), (4, "glove", "fr", 7, "Bo", "2017-01-01 00:00:00")]
    for bad in (None, "", "  "):
        with pytest.raises(ValueError):
            account_reports.latest_rentals_by_title(film, rentals, names, bad)
    with pytest.raises(LookupError):
        account_reports.latest_rentals_by_title(film, rentals, names, "%nothing%")


@pytest.mark.parametrize("purchases, amount", [(0, 5.0), (5, 0.0)])
def test_rewards_refuse_zero(spark, purchases, amount):
    with pytest.raises(ValueError):
        account_reports.rewards_report(None, None, purchases, amount, "2017-01-01")


# --- frames -------------------------------------------------------------------------------


def test_fill_and_mean(spark):
    df = spark.createDataFrame([(1, 4), (2, None), (3, 8)], "i int, v int")
    assert rows(fill_with(df, "v", F.min("v"))) == [(1, 4), (2, 4), (3, 8)]
    assert rows(fill_with(df, "v", exact_mean("v").cast("int"))) == [(1, 4), (2, 6), (3, 8)]


def test_describe_whole_and_by_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 4.0), ("b", 7.0), ("b", None)], "k string, v double")
    whole = describe(df, [], "v", {"median": 0.5}).first()
    assert (whole["count"], whole["median"], whole["min"], whole["max"]) == (4, 3.0, 1.0, 7.0)
    groups = {r.k: r for r in describe(df, ["k"], "v", {"q1": 0.25}).collect()}
    assert groups["a"].q1 == 1.5 and groups["b"]["std"] is None and groups["b"]["count"] == 1


def test_extremes(spark):
    df = spark.createDataFrame([(1,), (5,), (5,)], "v int")
    assert rows(row_extreme_flags(df, "v")) == [(1, False, True), (5, True, False), (5, True, False)]


def test_null_keys_and_values_are_kept(spark):
    df = spark.createDataFrame([("a", 3), ("a", None), ("a", 3), (None, 1), (None, None), ("c", None)], "k string, v int")
    ranked = {(r.k, r.v, r.rnk) for r in rank_in_group(df, ["k"], "v").collect()}
    assert ranked == {("a", 3, 1), ("a", None, 3), (None, 1, 1), (None, None, 2), ("c", None, 1)}
    assert rank_in_group(df, ["k"], "v").count() == 6
    totals = sorted(((r.k or "-", r.t) for r in with_group_total(df, ["k"], F.col("v"), "t").collect()), key=str)
    assert totals == sorted([("a", 6)] * 3 + [("-", 1)] * 2 + [("c", None)], key=str)
    groups = {r.k: r for r in describe(df, ["k"], "v", {"q": 0.5}).collect()}
    assert set(groups) == {"a", "c", None} and groups[None].q == 1.0
    assert groups["c"]["count"] == 0 and groups["c"].q is None
    only = describe(df.where("k = 'c'"), [], "v", {"q": 0.5}).collect()
    assert [(r["count"], r.q) for r in only] == [(0, None)]


def test_trainee_without_a_name_has_a_mark(spark):
    df = spark.createDataFrame([(None, ts("2020-01-01"), 1, "visit_lecture"), (1, ts("2020-01-01"), 2, "do_homework")],
                               "trainee long, at timestamp_ntz, seq long, action string")
    assert {(r.trainee, r.mark) for r in trainee_scores(df).collect()} == {(None, 1), (1, 2)}


def test_kept_keys_are_all_there(spark):
    lines = spark.range(20_000).selectExpr("nullif(id % 5000, 17) AS k", "id")
    keys = spark.range(0, 5000, 7).selectExpr("id AS key").union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    kept = keep_keys(lines, "k", keys, "key")
    wanted = {i for i in range(20_000) if i % 5000 % 7 == 0 and i % 5000 != 17}
    got = {r.id for r in kept.collect()}
    assert wanted <= got and len(got) < 1.01 * len(wanted)
    assert keep_keys(lines, "k", keys.limit(0), "key").count() == 0


def test_equal_amounts_of_a_day_are_summed_one_by_one(spark):
    days = spark.sql("SELECT DATE'2020-01-01' AS d_time UNION ALL SELECT DATE'2020-01-02'")
    sales = spark.createDataFrame([(dt.date(2020, 1, 1), 5)] * 3 + [(dt.date(2020, 1, 1), 2), (dt.date(2020, 1, 9), 1)],
                                  "time_id date, sold_cents long")
    got = [tuple(map(float, r[1:4])) for r in sales_reports.frame_modes_by_date(days, sales).orderBy("d_time", "cum_sum_row").collect()]
    assert got == [(0.02, 0.02, 0.17), (0.05, 0.07, 0.17), (0.05, 0.12, 0.17), (0.05, 0.17, 0.17), (0.0, 0.17, 0.17)]


def test_one_change_per_key(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    changes = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z")], "k int, v string")
    assert sorted(map(tuple, update_from(target, changes, ["k"], ["v"]).collect())) == [(1, "y"), (2, "b")]
    assert list(map(tuple, updated_rows(target, changes, ["k"], ["v"]).collect())) == [(1, "y")]
    assert list(map(tuple, deleted_where(target, F.col("k") == 1).collect())) == [(1, "a")]


def test_lines_with_breaks_survive_or_fail(spark, tmp_path):
    df = spark.createDataFrame([("a\nb", 1), ('say "x", y', 2), ("plain", 3)], "t string, n int")
    files.write_csv(df, str(tmp_path / "csv"))
    back = files.read_csv(spark, str(tmp_path / "csv"), df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    with pytest.raises(Exception, match="line break"):
        files.write_lines(df.select("t"), str(tmp_path / "lines"))


# --- table maintenance --------------------------------------------------------------------


def test_insert_keeps_one_of_a_batch(spark):
    table = spark.createDataFrame([("a", 1)], "k string, v int")
    batch = spark.createDataFrame([("a", 9), ("b", 3), ("b", 2), ("c", None)], "k string, v int")
    fresh = m.insert_on_conflict_do_nothing(table, batch, ["k"], ["v"])
    assert rows(fresh) == [("b", 2), ("c", None)]
    assert rows(m.insert_if_absent(table, fresh, ["k"])) == [("a", 1), ("b", 2), ("c", None)]
    assert m.absent_rows(m.insert_if_absent(table, fresh, ["k"]), fresh, ["k"]).count() == 0


def test_update_can_set_null(spark):
    target = spark.createDataFrame([(1, "x", 5), (2, "y", 6)], "id int, a string, b int")
    changes = spark.createDataFrame([(1, None)], "id int, a string")
    assert rows(m.update_from(target, changes, ["id"], ["a"])) == [(1, None, 5), (2, "y", 6)]


def test_delete_spares_the_unknown(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    assert rows(m.delete_where(df, F.col("v") > 2)) == [(1,), (None,)]


def test_stamp_moves_only_with_a_value(spark):
    target = spark.createDataFrame([(1, "x", "old"), (2, None, "old"), (3, "z", "old")], "id int, a string, t string")
    changes = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, a string")
    out = m.upsert_touching(target, changes, ["id"], ["a"], "t", F.lit("new"))
    assert rows(out) == [(1, "x", "old"), (2, "y", "new"), (3, None, "new")]


def test_next_ids(spark):
    batch = spark.createDataFrame([("b",), ("a",)], "name string")
    table = spark.createDataFrame([(7, "x")], "id long, name string")
    assert rows(m.with_next_ids(table, batch, "id", [F.col("name")]), "id", "name") == [(8, "a"), (9, "b")]
    assert rows(m.with_next_ids(table.limit(0), batch, "id", [F.col("name")]), "id", "name") == [(1, "a"), (2, "b")]


def test_update_cell(spark):
    df = spark.createDataFrame([(1, "x", dt.date(2000, 1, 1)), (2, "y", None)], "id int, a string, d date")
    out = m.update_cell(df, "id", 2, "d", "2020-02-03", ["a", "d"])
    assert rows(out, "id", "d") == [(1, dt.date(2000, 1, 1)), (2, dt.date(2020, 2, 3))]
    for args in ((None, "a", "v"), (1, "", "v"), (1, "id", "v"), (1, "a", ""), (1, "a", None)):
        with pytest.raises(ValueError):
            m.update_cell(df, "id", *args, ["a", "d"])
    with pytest.raises(LookupError):
        m.update_cell(df, "id", 3, "a", "v", ["a"])


def test_films_and_their_languages(spark):
    languages = spark.createDataFrame([(1, "English")], "language_id long, name string")
    films = spark.createDataFrame([(10, "Harbour", 2025)], "film_id long, title string, release_year int")
    batch = spark.createDataFrame(
        [(1, "Tides", 2025, "Frisian"), (2, "Harbour", 2025, "english"), (3, "Harbour", 2022, "ENGLISH"),
         (4, "Dunes", 2020, "frisian"), (5, "Dunes", 2020, "Danish"), (6, None, 2020, "Welsh"), (7, " ", 2020, "Welsh"),
         (8, "Salt", None, None)],
        "batch_id int, title string, release_year int, language string")
    new_languages, new_films = m.create_films(batch, films, languages, F.lit(2030))
    assert rows(new_languages) == [(2, "Frisian"), (3, "Danish"), (4, "Klingon")]
    assert rows(new_films, "film_id", "title", "release_year", "language_id") == [
        (11, "Tides", 2025, 2), (12, "Harbour", 2022, 1), (13, "Dunes", 2020, 2), (14, "Salt", 2030, 4)]


def test_payments_are_checked(spark):
    day, later = ts("2025-11-17 14:00:00"), ts("2025-12-01 10:00:00")
    people = spark.createDataFrame([(1, "olga"), (2, "ivan")], "person_id int, person_name string")
    shows = spark.createDataFrame([("Textile",)], "exhibition_title string")
    visits = spark.createDataFrame([(9, 1, "Textile", day), (8, 2, "Textile", day), (7, 1, "Textile", later)],
                                   "visit_id int, person_id int, exhibition_title string, visited_at timestamp_ntz")
    paid = spark.createDataFrame([(8,)], "visit_id int")
    base = dict(person_name="olga", exhibition_title="Textile", visit_at=day, amount=170.0, method="card", status="paid", ref=None, paid_at=None)
    changes = [{}, {}, dict(person_name=""), dict(person_name="nobody"), dict(exhibition_title="Other"), dict(visit_at=None),
               dict(visit_at=ts("2020-01-01")), dict(person_name="ivan"), dict(visit_at=later, amount=-1.0),
               dict(visit_at=later, method=""), dict(visit_at=later, status=None), dict(visit_at=later, ref="R1")]
    batch = spark.createDataFrame(
        [(i, *{**base, **c}.values()) for i, c in enumerate(changes)],
        "batch_id int, person_name string, exhibition_title string, visit_at timestamp_ntz, amount double, method string, status string, ref string, paid_at timestamp_ntz")
    out = {r.batch_id: r for r in m.add_transactions(
        batch, people, shows, visits, paid, F.lit("2026-01-01").cast("timestamp_ntz")).collect()}
    assert [out[i].error for i in range(12)] == [
        None, "visit is paid", "no name given", "nobody has this name",
        "no such exhibition", "no time of visit given", "no visit on this day",
        "visit is paid", "amount is missing or negative", "no method given",
        "no status given", None]
    assert out[0].ref == "TX-9" and out[11].ref == "R1" and out[0].paid_at == ts("2026-01-01")


# --- checks -------------------------------------------------------------------------------


def test_each_rule_finds_its_row(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", None), (None, "toolong", -1), (2, "b", 7)], "id int, s string, n int")
    assert rows(q.primary_key_violations(df, ["id"])) == [(1, 2), (None, 1)]
    assert rows(q.unique_violations(df, ["s"])) == [("b", 2)]
    assert rows(q.unique_violations(df, ["id"])) == [(1, 2)]
    parents = spark.createDataFrame([(1,)], "pid int")
    assert rows(q.foreign_key_violations(df, ["id"], parents, ["pid"]), "id") == [(2,)]
    assert rows(q.null_counts(df, ["id", "n", "s"])) == [("id", 1), ("n", 1), ("s", 0)]
    rules = {"list": q.in_list("s", ["a", "b"]), "range": F.col("n") >= 0, "length": q.max_length("s", 3)}
    assert rows(q.broken_rules(df, rules, ["s"])) == [("toolong", "length"), ("toolong", "list"), ("toolong", "range")]


def test_age(spark):
    df = spark.createDataFrame([(dt.date(2000, 6, 30),), (dt.date(2000, 7, 1),)], "d date")
    assert [r[0] for r in df.orderBy("d").select(q.adult_on("d", "2018-06-30")).collect()] == [True, False]


# --- files and index ----------------------------------------------------------------------


def test_delimited_documents(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1\tFirst\n\n   \n2\tÉtre\tet tab\n1\tSecond \n", encoding="utf-8")
    (tmp_path / "b.txt").write_text("  3\tThird\n1\tLast Wins\n", encoding="utf-8")
    docs = files.read_delimited_docs(spark, str(tmp_path))
    assert rows(docs) == [(1, "last wins"), (2, "étre\tet tab"), (3, "third")]


def test_bad_document_line_fails(spark, tmp_path):
    (tmp_path / "a.txt").write_text("no tab here\n")
    with pytest.raises(Exception):
        files.read_delimited_docs(spark, str(tmp_path)).collect()


def test_words_file_and_sorted_json(spark, tmp_path):
    (tmp_path / "w.txt").write_text(" The \n\nAnd\n   \n")
    assert rows(files.read_words(spark, str(tmp_path / "w.txt"))) == [("and",), ("the",)]
    df = spark.createDataFrame([(1, "é\"x"), (3, "b\nc"), (2, None)], "p int, t string")
    files.write_json_records(df, str(tmp_path / "j"), [F.col("p").desc()])
    parts = sorted((tmp_path / "j").glob("part-*"))
    lines = [line for part in parts for line in part.read_text(encoding="utf-8").splitlines()]
    assert lines == ['{"p":3,"t":"b\\nc"}', '{"p":2,"t":null}', '{"p":1,"t":"é\\"x"}']


def test_missing_format_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        files.write_table(spark.range(1), str(tmp_path / "x"), "no_such_format")


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "avro"])
def test_table_formats(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, "a"), (2, None)], "i int, s string")
    files.write_table(df, str(tmp_path / fmt), fmt)
    assert rows(files.read_table(spark, str(tmp_path / fmt), fmt, "i int, s string")) == [(1, "a"), (2, None)]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    docs = spark.createDataFrame(
        [(5, "Golden dataset, obi van"), (1, "golden Age"), (70000, "dataset golden golden"), (3, "été d'or"), (4, "")],
        "doc_id long, text string")
    path = str(tmp_path_factory.mktemp("index") / "i")
    textindex.save_index(textindex.build_index(docs, block=100), path, buckets=3)
    return textindex.load_index(spark, path)


def test_index_blocks(index):
    golden = sorted((r.block, r.n_docs, list(r.doc_ids)) for r in index.filter("word = 'golden'").collect())
    assert golden == [(0, 2, [1, 5]), (700, 1, [70000])]


def test_index_as_json(spark, index, tmp_path):
    textindex.save_index(index, str(tmp_path / "j"), 2, "json")
    assert rows(textindex.load_index(spark, str(tmp_path / "j"), "json")) == rows(index)


@pytest.mark.parametrize("query, expected", [
    ("golden dataset", [5, 70000]), ("GOLDEN", [1, 5, 70000]), ("obi-van", []), ("obi van", [5]), ("hello", []),
    ("golden hello", []), ("   ", []), ("", []), ("golden golden", [1, 5, 70000]), ("d or été", [3]), ("van age", [])])
def test_queries_over_the_index(spark, index, query, expected):
    asked = textindex.query_words(spark.createDataFrame([("q", query)], "query_id string, query string"))
    assert [r.doc_id for r in textindex.query_index(index, asked).orderBy("doc_id").collect()] == expected


def test_answers_as_lines(spark, index):
    queries = spark.createDataFrame([("a", "golden"), ("b", "dataset golden")], "query_id string, query string")
    lines = textindex.answer_lines(textindex.query_index(index, textindex.query_words(queries)), 100)
    assert rows(lines) == [("a", 0, "1,5"), ("a", 700, "70000"), ("b", 0, "5"), ("b", 700, "70000")]
