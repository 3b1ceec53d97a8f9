"""The three trip dialects on a retyped 19-field sample."""

import math

import pytest

from kestrel.plans.trip import trip_means_mapreduce, trip_means_pig, trip_means_sql

HEADER = ("VendorID,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,"
          "pickup_longitude,pickup_latitude,RateCodeID,store_and_fwd_flag,dropoff_longitude,"
          "dropoff_latitude,payment_type,fare_amount,extra,mta_tax,tip_amount,tolls_amount,"
          "improvement_surcharge,total_amount")


def trip(distance, amount):
    return ",".join(["1", "2015-01-10 20:33:38", "2015-01-10 20:53:28", "1", distance,
                     "-73.99", "40.72", "1", "N", "-73.99", "40.75", "1", "12", "0.5", "0.5",
                     "2", "0", "0.3", amount])


GOOD = [HEADER, trip("1.59", "17.05"), trip("2.20", "15.3"), trip("1.80", "10.8"),
        trip(".50", "4.8"), trip("2.5", "16.3"), trip("3.30", "17.8")]


def floor6(x):
    return math.floor(x * 1e6 + 1e-9) / 1e6


def test_mapreduce_dialect(spark, lines):
    got = {r["distance"]: r["mean"] for r in trip_means_mapreduce(lines(GOOD)).collect()}
    assert got == {1: 4.8, 2: floor6((17.05 + 15.3 + 10.8) / 3), 3: floor6((16.3 + 17.8) / 2)}


def test_mapreduce_drops_negative_and_fails_on_bad(spark, lines):
    got = trip_means_mapreduce(lines(GOOD + [trip("-2.5", "9.0")])).collect()
    assert -2 not in {r["distance"] for r in got}
    with pytest.raises(Exception):
        trip_means_mapreduce(lines(GOOD + [trip("2.0", "abc")])).collect()


def test_pig_dialect_nulls_and_negative(spark, lines):
    data = GOOD + [trip("-2.5", "9.0"), trip("2.0", "abc"), trip("xyz", "5.0")]
    got = {r["distance"]: r["mean"] for r in trip_means_pig(lines(data)).collect()}
    assert got[-2] == 9.0                       # no lower bound
    assert got[2] == pytest.approx((17.05 + 15.3 + 10.8) / 3)   # null amount ignored
    assert set(got) == {-2, 1, 2, 3}            # unparsed distance dropped by the bound


def test_sql_dialect_drop_float_and_min_count(spark, lines):
    data = GOOD + [trip("2.0", "abc"), trip("-2.5", "9.0")]
    out = trip_means_sql(lines(data), with_line=True).collect()
    got = {r["distance"]: r["avg"] for r in out}
    assert set(got) == {-2, 1, 2, 3}
    # float amounts averaged in double: 4.8f widened
    assert got[1] == pytest.approx(4.800000190734863)
    assert [r["distance"] for r in out] == sorted(got)   # ORDER BY distance
    assert out[1]["line"].startswith("  1\t4.800")
    kept = trip_means_sql(lines(data), min_count=3).collect()
    assert [r["distance"] for r in kept] == [2]


def test_sql_dialect_short_row_fails(spark, lines):
    with pytest.raises(Exception):
        trip_means_sql(lines(GOOD + ["1,2,3"])).collect()
