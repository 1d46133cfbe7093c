"""Reports on small hand-checked inputs."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.plans import book, crm, general, monthly, revenue, staging, status, subscriptions, touchpoints

D = dt.date


def test_recurring_revenue(spark):
    moment = dt.datetime
    subs = spark.createDataFrame([
        ("s1", "c1", moment(2024, 1, 5), None, "active"),
        ("s2", "c1", moment(2024, 3, 5), None, "active"),                       # replaces the amount from March on
        ("s3", "c1", moment(2024, 3, 7), moment(2024, 3, 20), "canceled"),       # cancelled in its first month: dropped
        ("s4", "c2", moment(2024, 1, 1), moment(2024, 2, 10), "canceled"),       # gone after February
        ("s5", "c3", moment(2020, 1, 1), None, "active"),                        # began before the calendar
        ("s1", None, moment(2024, 1, 5), None, "active"),                        # belongs to nobody
    ], "id string, customer_id string, start_date timestamp, canceled_at timestamp, status string")
    items = spark.createDataFrame([
        ("s1", 2, 1000, "month", 1), ("s1", 1, 12000, "year", 1), ("s2", 1, 9000, "month", 3), ("s3", 1, 500, "month", 1),
        ("s4", 1, 700, "month", 1), ("s5", 1, 700, "month", 1)], "subscription string, quantity bigint, amount bigint, interval_period string, interval_count bigint")
    history = revenue.recurring_revenue(subs, items, "2024-04-15", "2023-12-01", history=True)
    found = {(r["customer_id"], r["month"]): (r["mrr"], r["mrr_change"], r["mrr_rank_asc"], r["mrr_rank_desc"]) for r in history.collect()}
    assert found == {
        ("c1", D(2024, 1, 1)): (30, 30, 1, 4), ("c1", D(2024, 2, 1)): (30, 0, 2, 3),
        ("c1", D(2024, 3, 1)): (30, 0, 3, 2), ("c1", D(2024, 4, 1)): (30, 0, 4, 1),
        ("c2", D(2024, 1, 1)): (7, 7, 1, 2), ("c2", D(2024, 2, 1)): (7, 0, 2, 1)}
    now = revenue.recurring_revenue(subs, items, "2024-04-15", "2023-12-01").collect()
    assert [(r["customer_id"], r["mrr"], r["mrr_change"], r["start_date_month"]) for r in now] == [("c1", 30, 30, None)]


def test_a_half_is_not_missed_by_a_hair(spark):
    subs = spark.createDataFrame([("s", "c", dt.datetime(2024, 1, 5), None, "active")],
                                 "id string, customer_id string, start_date timestamp, canceled_at timestamp, status string")
    thirds = [("s", 1, 50, "month", 3)] * 3  # three times 16 2/3 cents are half a unit
    items = spark.createDataFrame(thirds, "subscription string, quantity bigint, amount bigint, interval_period string, interval_count bigint")
    assert revenue.recurring_revenue(subs, items, "2024-01-15").first()["mrr"] == 1


def test_customer_status(spark):
    subs = spark.createDataFrame([
        (1, "a", "canceled", 1704067200), (2, "a", "active", None), (3, "a", "past_due", None), (4, "a", "canceled", 1704153600),
        (1, "b", "canceled", 1704067200), (2, "b", "canceled", 1704153600), (1, None, "active", None)], "n int, customer string, status string, canceled_at bigint")
    found = {r["customer_id"]: (r["status"], r["delete_by"]) for r in status.customer_status(subs, "n").collect()}
    assert found == {"a": ("past_due", ""), "b": ("canceled", "2024-04-04")}


def test_high_water_marks(spark):
    months = [D(2023, m, 1) for m in (1, 6, 12)] + [D(2024, 1, 1)]
    book_rows = [("c", m, v) for m, v in zip(months, (90.0, 50.0, 70.0, 40.0))] + [(None, D(2024, 1, 1), 5.0), ("Ops Test", D(2025, 1, 1), 1.0)]
    licences = spark.createDataFrame(book_rows, "customer string, month date, mrr double")
    services = spark.createDataFrame([("c", D(2024, 1, 1), 3.0)], "customer string, month date, mrr double")
    accounts = spark.createDataFrame([("c", "A1", D(2023, 7, 1))], "app_customer_key string, account_id string, last_owner_change date")
    found = {r["customer_key"]: r.asDict() for r in book.revenue_book(licences, services, accounts, ["2023-12", "2024-01"]).collect()}
    assert set(found) == {"c", "null", "Ops Test"}
    c = found["c"]
    assert (c["high_water_this_month_license"], c["high_water_last_month_license"]) == (70, 70)  # 90 and 50 are before the new owner
    assert (c["rgr_2023-12"], c["msp_2024-01"], c["total_2024-01"], c["total_0"], c["rgr_1"]) == (70, 3, 43, 43, 70)
    assert found["null"]["high_water_this_month_total"] == 5 and found["Ops Test"]["high_water_this_month_total"] == 0
    no_owner = accounts.withColumn("last_owner_change", F.lit(None).cast("date"))
    marks = {r["customer_key"]: r for r in book.revenue_book(licences, services, no_owner, ["2024-01"]).collect()}
    assert (marks["c"]["high_water_this_month_license"], marks["c"]["high_water_last_month_license"]) == (70, 90)


def test_several_accounts_do_not_inflate_sums(spark):
    licences = spark.createDataFrame([("c", D(2024, 1, 1), 10.0)], "customer string, month date, mrr double")
    accounts = spark.createDataFrame([("c", "A1", D(2023, 7, 1)), ("c", "A2", D(2022, 7, 1))], "app_customer_key string, account_id string, last_owner_change date")
    found = book.revenue_book(licences, licences, accounts, ["2024-01"]).collect()
    assert [(r["account_id"], r["total_2024-01"]) for r in sorted(found)] == [("A1", 20), ("A2", 20)]


def wide(spark, data):
    fields = "plan_product string, quantity int, plan_amount int, plan_interval string, plan_interval_count int"
    kind = "id string, " + ", ".join(f"items_data_{n}_{f}" for n in (0, 1, 2) for f in fields.split(", "))
    empty = (None,) * 5
    return spark.createDataFrame([(i, *(slots + [empty] * 3)[0], *(slots + [empty] * 3)[1], *(slots + [empty] * 3)[2]) for i, slots in data], kind)


def test_licences_over_slots(spark):
    subs = wide(spark, [("s1", [("p1", 2, 1000, "month", 1), ("p2", 3, 500, "month", 1)]), ("s2", [("p3", 4, 100, "year", 1)]), ("s3", []),
                        ("s4", [("p1", None, 100, "year", 1)])])
    products = spark.createDataFrame([("p1", "Starter"), ("p2", "Extra"), ("p3", None)], "id string, name string")
    found = {r["id"]: (r["paid_licenses"], float(r["total_amount"]), r["total_licenses"])
             for r in subscriptions.with_licences(subs, products, ["Starter"], ["Data"]).collect()}
    assert found == {"s1": (2, 10.0, 5), "s2": (0, 0.0, 0), "s4": (None, 1.0, None)}


def test_first_touch(spark):
    leads = spark.createDataFrame([("l1", "o", D(2024, 1, 2)), ("l3", "o", D(2024, 1, 1)), ("l2", "o", D(2024, 1, 1)), ("l9", None, D(2023, 1, 1))],
                                  "id string, converted_opportunity_id string, converted_date date")
    assert [tuple(r) for r in crm.first_touch(leads).collect()] == [("o", "l3")]


def test_owners_seen_before(spark):
    orgs = spark.createDataFrame([(1, "x"), (2, "x"), (3, None), (4, "x")], "id int, converted_at string")
    roles = spark.createDataFrame([(1, "OWNER"), (2, "member")], "id int, name string")
    members = spark.createDataFrame([(1, 10, 1, 1), (2, 10, 2, 2), (3, 11, 3, 1), (4, 12, 4, 1), (5, 10, 3, 2)],
                                    "id int, user_id int, organization_id int, role_id int")
    users = spark.createDataFrame([(10,), (11,), (12,)], "user_id int")
    assert [r[0] for r in general.owners_seen_before(orgs, members, roles, users).collect()] == [1]


def test_base_slot_and_average(spark):
    df = spark.createDataFrame([("p9", "p1", 5, 7), ("p9", "p9", 5, 7)], "items_data_0_price_id string, items_data_1_price_id string, items_data_0_quantity int, items_data_1_quantity int")
    df = df.withColumn("items_data_2_price_id", F.lit(None).cast("string")).withColumn("items_data_2_quantity", F.lit(1))
    assert [r[0] for r in df.select(monthly.base_slot("quantity", ["p1"], 0)).collect()] == [7, 0]
    history = spark.createDataFrame([("s", "2024-01", 2), ("s", "2024-01", 3), ("s", "2019-01", 9)], "id string, period string, n int")
    assert [tuple(r) for r in monthly.measure_by_month(history, ["id"], "n", ["2024-01", "2024-02"]).collect()] == [("s", 3, None)]


def test_touchpoints_use_exact_keys_and_local_time(spark):
    raw = spark.createDataFrame([('{"Id": "1", "At": "2024-01-01T02:00:00.000+0000", "N": "3.5"}', "20240102000000"), ('{"Id": "0"}', "20240101000000")],
                                "json_data string, run_date string")
    row = touchpoints.touchpoints(raw, {"id": "Id", "n": ("N", "double"), "no": "id", "at": ("At", "moment")}).first()
    assert (row["id"], row["n"], row["no"], row["date_at"], row["at"], row["run_date"]) == (
        "1", 3.5, None, D(2024, 1, 1), dt.datetime(2023, 12, 31, 18), "20240102")


def test_standard_touchpoints_and_campaigns(spark):
    raw = spark.createDataFrame([('{"Id": "1", "Name": "n", "Type": "t", "CreatedDate": "2024-01-01T09:00:00.000+0000", "bizible2__Count_U_Shaped__c": 0.5, '
                                  '"bizible2__Count_First_Touch__c": 2}', "20240102000000")], "json_data string, run_date string")
    found = touchpoints.touchpoints(raw)
    row = found.first()
    assert len(found.columns) == 16 + 2 + 46 + 8 + 1
    assert (row["Name_c"], row["date_Createddate"], row["bizible2__Count_U_Shaped__c"], row["bizible2__Count_First_Touch__c"]) == ("n", D(2024, 1, 1), 0.5, 2)
    assert row["Createddate"] == dt.datetime(2024, 1, 1, 1) and row["bizible2__Touchpoint_date__c"] is None
    campaign = touchpoints.campaigns(raw).first()
    assert len(campaign) == 72 + 1 and len(touchpoints.TOUCHPOINT_FIELDS) == 68
    assert list(found.columns[21:24]) == ["Name_c", "date_Createddate", "Createddate"]
    assert (campaign["CampaignName"], campaign["CampaignType"], campaign["CampaignStatus"]) == ("n", "t", None)


def test_staging_catalogue(spark, tmp_path):
    users = spark.createDataFrame([(1, "a", "b", "c", "d", None, None, 9)],
                                  "id int, first_name string, last_name string, phone string, email string, last_sign_in_at timestamp, last_synced_at timestamp, more int")
    copies = spark.createDataFrame([("a", "20240101000000"), ("b", "20240102000000")], "id string, run_date string")
    views = staging.stage_all({"app_users": users, "raw_subscriptions": copies})
    assert views["app_users"].columns[0] == "user_id" and views["raw_subscriptions"].count() == 1
    assert views["app_users"].columns[-1] == "more"
    few = staging.only(staging.renaming(staging.STAGING["app_users"], more="extra"), ["id", "more"])
    assert staging.stage_all({"app_users": users}, {"app_users": few})["app_users"].columns == ["user_id", "extra"]
    left = staging.excluding(staging.STAGING["app_users"], "first_name", ["a", "it's"])
    assert staging.stage_all({"app_users": users}, {"app_users": left})["app_users"].count() == 0
    path = tmp_path / "views.json"
    path.write_text('{"app_users": {"columns": ["id", "more"], "renames": {"more": "extra"}, "where": "id = 1"}}')
    assert staging.stage_all({"app_users": users}, staging.read_config(str(path)))["app_users"].columns == ["id", "extra"]


def test_interval_labels_differ_between_reports():
    assert subscriptions.FACT_PERIODS["month", 6] == "biannually" and general.REPORT_PERIODS["month", 6] == "semiannualy"
    with pytest.raises(KeyError):
        general.REPORT_PERIODS["week", 1]


def test_months_are_written_out_after_all_sorting(spark):
    subs = spark.createDataFrame([(1, "c", None, None, "active")], "id long, customer_id string, start_date timestamp, canceled_at timestamp, status string")
    items = spark.createDataFrame([(1, 1, 100, "month", 1)], "subscription long, quantity long, amount long, interval_period string, interval_count int")
    plan = revenue.recurring_revenue(subs, items, "2024-04-15", "2023-12-01", history=True)._jdf.queryExecution().optimizedPlan().toString()
    before_generate = plan[:plan.index("Generate posexplode" if "Generate posexplode" in plan else "Generate explode")]
    assert "Window" not in before_generate and "Sort" not in before_generate
