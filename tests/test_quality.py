import datetime as dt

from odometer.operators.quality import expense_feed_checks

D = dt.date(2026, 9, 26)


def test_feed_contract_violations(spark):
    feed = spark.createDataFrame(
        [
            (D, "V1", 10.0, 0.0, "required", "2026-09-26"),
            (D, "V1", 10.0, 0.0, "required", "2026-09-26"),  # duplicate vehicle
            (D, "V2", 0.0, -1.0, "maybe", "2026-09-25"),  # bad fuel, maintenance, flag, date
            (D, "V7", None, None, None, "garbage"),  # unknown vehicle, nulls, unparsable date
        ],
        "report_date date, vehicle_id string, fuel_cost double, maintenance_cost double, service_flag string, "
        "csv_report_date string",
    )
    vehicles = spark.createDataFrame([("V1",), ("V2",), ("V3",), ("V3",)], "vehicle_id string")
    r = expense_feed_checks(feed, vehicles).first()
    assert r["rows"] == 4
    assert r["duplicate_vehicle_rows"] == 2
    assert r["unknown_vehicle_rows"] == 1
    assert r["missing_vehicles"] == 1  # V3
    assert r["bad_fuel_rows"] == 2 and r["bad_maintenance_rows"] == 2 and r["bad_flag_rows"] == 2
    assert r["date_mismatch_rows"] == 2


def test_clean_feed_has_no_violations(spark):
    feed = spark.createDataFrame(
        [(D, "V1", 1.0, 0.0, "required"), (D, "V2", 2.0, 3.0, "not_required")],
        "report_date date, vehicle_id string, fuel_cost double, maintenance_cost double, service_flag string",
    )
    r = expense_feed_checks(feed, feed.select("vehicle_id")).first()
    assert (r["rows"], r["duplicate_vehicle_rows"], r["unknown_vehicle_rows"], r["missing_vehicles"]) == (2, 0, 0, 0)
    assert (r["bad_fuel_rows"], r["bad_maintenance_rows"], r["bad_flag_rows"], r["date_mismatch_rows"]) == (0, 0, 0, 0)
