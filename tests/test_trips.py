import bz2

import pytest
from pyspark.sql import functions as F

from lodestat.functions.clock import hour_of_text
from lodestat.functions.numbers import round_half_up, to_number
from lodestat.plans import trips as jobs
from lodestat.sources.files import read_lines
from lodestat.sources.trips import clean_basic, clean_range, parse_trips, regression_rows


def line(taxi="t", driver="d", pickup="2013-01-01 08:15:00", secs="600", miles="2.5", fare="9", surcharge="0.5",
         tolls="4", total="14.5"):
    return ",".join(
        [taxi, driver, pickup, "2013-01-01 08:30:00", secs, miles, "0", "0", "0", "0", "CSH", fare, surcharge, "0.5",
         "0", tolls, total]
    )


@pytest.mark.parametrize(
    "text, value",
    [("12", 12.0), (" 1.5 ", 1.5), ("-.5e2", -50.0), ("3.", 3.0), ("inf", float("inf")), ("-Infinity", float("-inf")),
     ("1d", None), ("1f", None), ("0x1p3", None), ("1_0", None), ("", None), ("x", None), (".", None)],
)
def test_to_number(spark, text, value):
    assert spark.range(1).select(to_number(F.lit(text))).first()[0] == value


def test_nan_is_a_number_that_fails_every_range(lines):
    trips = parse_trips(lines(line(secs="nan"), line(tolls="NaN"), line(total="nan"), line()))
    assert clean_range(trips).count() == 2  # the total is not part of the range rules
    assert clean_basic(trips).count() == 3


def test_parse_keeps_text_and_numbers(lines):
    row = parse_trips(lines(line(), line() + ",extra", line().rsplit(",", 1)[0], line(secs="x"))).collect()
    assert [r["n_fields"] for r in row] == [17, 18, 16, 17]
    assert row[0]["medallion"] == "t" and row[0]["secs"] == 600.0 and row[0]["pickup"] == "2013-01-01 08:15:00"
    assert row[2]["total"] is None and row[3]["secs"] is None


def test_clean_basic_drops_bad_rows_only(lines):
    good = [line(), line(secs="0", miles="0", fare="0"), line(total="-1")]
    bad = [line(total="0"), line(total="0.00"), line(secs="x"), line(surcharge=""), line() + ",x", "a,b"]
    assert clean_basic(parse_trips(lines(*good, *bad))).count() == len(good)


def test_clean_range_bounds_are_inclusive(lines):
    good = [line(secs="120"), line(secs="3600"), line(fare="3"), line(fare="200"), line(miles="1"), line(miles="50"),
            line(tolls="3"), line(tolls="inf"), line(surcharge="x")]
    bad = [line(secs="119"), line(secs="3601"), line(fare="2.9"), line(miles="0.9"), line(miles="51"), line(tolls="2")]
    trips = parse_trips(lines(*good, *bad))
    assert clean_range(trips).count() == len(good)
    assert regression_rows(trips).count() == len(good) - 1


def test_hour_and_rounding(spark):
    row = spark.range(1).select(
        hour_of_text(F.lit("2013-01-01 07:05:00")), hour_of_text(F.lit("2013-01-01")), round_half_up(F.lit(2.675) * 1)
    ).first()
    assert row[0] == "07" and row[1] is None and row[2] == pytest.approx(2.68)


def test_rankings_break_ties_by_key(spark, text_file):
    path = text_file(
        "trips.csv",
        line("b", "1"), line("b", "2"), line("a", "1"), line("a", "3"), line("a", "3"), line("c", "9"),
        line("z", "9", total="0"),
    )
    assert [tuple(r) for r in jobs.busiest_taxis(spark, path, 2).collect()] == [("a", 2), ("b", 2)]


def test_best_paid_uses_sums_and_skips_short_trips(spark, text_file):
    path = text_file(
        "trips.csv",
        line(driver="slow", secs="600", total="10"), line(driver="slow", secs="60", total="100"),
        line(driver="brief", secs="59", total="1000"), line(driver="even", secs="120", total="20"),
    )
    assert [tuple(r) for r in jobs.best_paid_drivers(spark, path).collect()] == [("even", 10.0), ("slow", 10.0)]


def test_huge_and_infinite_amounts_are_kept(spark, text_file):
    path = text_file(
        "trips.csv",
        line(driver="inf", total="inf"), line(driver="inf", total="5"), line(driver="huge", secs="60", total="1e15"),
        *[line(driver="many", secs="60", total="0.1")] * 10,
    )
    rows = [tuple(r) for r in jobs.best_paid_drivers(spark, path).collect()]
    assert rows == [("inf", float("inf")), ("huge", 1e15), ("many", 0.1)]


def test_best_hour(spark, text_file):
    path = text_file(
        "trips.csv",
        line(pickup="2013-01-01 08:00:00", miles="2", surcharge="1"),
        line(pickup="2013-01-02 08:59:59", miles="2", surcharge="2"),
        line(pickup="2013-01-01 09:00:00", miles="1", surcharge="0.5"),
        line(pickup="2013-01-01 09:00:00", miles="0", surcharge="50"),
        line(pickup="2013-01-01", miles="1", surcharge="50"),
    )
    assert [tuple(r) for r in jobs.best_surcharge_hour(spark, path).collect()] == [("08", 0.75)]


def test_bz2_input_and_pair_lines(spark, tmp_path):
    path = tmp_path / "trips.csv.bz2"
    path.write_bytes(bz2.compress(("\n".join([line("a", "1"), line("a", "2"), line("b", "1")]) + "\n").encode()))
    out = str(tmp_path / "out")
    jobs.save_ranking(jobs.busiest_taxis(spark, str(path)), out)
    assert sorted(r["value"] for r in read_lines(spark, out).collect()) == ["('a', 2)", "('b', 1)"]


def test_regression_jobs_agree(spark, text_file):
    rows = [line(miles=str(m), fare=str(3 + 2 * m)) for m in (1, 2, 3, 5, 8)]
    path = text_file("trips.csv", *rows)
    fit = jobs.fare_line(spark, path).first()
    assert fit["n"] == 5 and fit["m"] == pytest.approx(2) and fit["b"] == pytest.approx(3)
    course = jobs.fare_descent(spark, path, precision=1e-12, max_iter=20000)
    assert course.theta == pytest.approx([3, 2], abs=1e-2)
    assert len(jobs.total_descent(spark, path, max_iter=3).steps[0][3]) == 5
