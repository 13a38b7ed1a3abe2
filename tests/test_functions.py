"""Scalar functions on small literal frames."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from refinery.functions import dates, metrics, numbers, text
from refinery.operators import cleaning, fact


def one_column(spark, values, type_="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {type_}")


DATES = {
    "2024-03-04": date(2024, 3, 4),
    "05-01-2024": date(2024, 5, 1),
    "25-01-2024": date(2024, 1, 25),
    "01-25-2024": date(2024, 1, 25),
    "1-5-2024": date(2024, 1, 5),
    "2024-1-5": date(2024, 1, 5),
    "5-13-2024": date(2024, 5, 13),
    "05-01-24": None,
    "13-13-2024": None,
    "02-30-2024": None,
    "99-01-2024": None,
    "03/04/2024": date(2024, 3, 4),
    " 2024-03-04 ": date(2024, 3, 4),
    "\t2024-03-04": date(2024, 3, 4),
    "2024-01-05 10:00:00": date(2024, 1, 5),
    "2024-01-05T10:00:00Z": date(2024, 1, 5),
    "05-01-2024 10:00": date(2024, 5, 1),
    "2024-01-05, late": date(2024, 1, 5),
    "2024-01-051": None,
    "05-01-20245": None,
    "29/02/2024": date(2024, 2, 29),
    "29/02/2023": None,
    "2024": None,
    "2024-01": None,
    "junk": None,
    "a-b-c": None,
    "--": None,
    "": None,
    None: None,
}


def parsed_dates(spark, values, **options):
    frame = spark.createDataFrame([(v,) for v in values], "order_date string")
    parsed = cleaning.parse_dates(frame, **options)
    return {r["order_date_raw"]: r["order_date"] for r in parsed.collect()}


def test_mixed_dates(spark):
    assert parsed_dates(spark, DATES) == DATES


def test_day_first_turns_only_ambiguous_dates(spark):
    parsed = parsed_dates(spark, DATES, day_first=True)
    turned = {k for k in DATES if parsed[k] != DATES[k]}
    assert turned == {"05-01-2024", "1-5-2024", "03/04/2024", "05-01-2024 10:00"}
    assert parsed["05-01-2024"] == date(2024, 1, 5)
    assert parsed["01-25-2024"] == date(2024, 1, 25)


def test_bad_text_never_fails_the_job_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    frame = one_column(spark, ["abc", "", "2.0", "1e2", "99999999999", None])
    numbers_ = frame.select(numbers.parse_int("v"), numbers.parse_double("v"))
    assert len(numbers_.collect()) == 6


@pytest.mark.parametrize(
    "value, whole, real",
    [
        ("3", 3, 3.0), (" 3 ", 3, 3.0), ("2.0", 2, 2.0), ("-2.7", -2, -2.7), ("2.", 2, 2.0),
        ("abc", None, None), ("", None, None), (None, None, None), ("25.99", 25, 25.99),
        ("1e2", None, 100.0), ("2147483648", None, 2147483648.0), ("n/a", None, None),
        ("1.2.3", None, None),
    ],
)
def test_numbers(spark, value, whole, real):
    frame = one_column(spark, [value])
    row = frame.select(numbers.parse_int("v"), numbers.parse_double("v")).first()
    assert tuple(row) == (whole, real)


def test_numbers_agree_with_lenient_casts(spark, settings):
    values = ["3", " 3 ", "2.0", "abc", "", "25.99", "1e2", "-2.7", "+4", "2.", "1.x", "inf",
              "2147483648.5", "\t7\n", "- 3", "0x1", "1.5 ", "NaN", "1.0d", "3-", None]
    frame = one_column(spark, values)
    ours = frame.select(numbers.parse_int("v"), numbers.parse_double("v")).collect()
    settings(spark__sql__ansi__enabled="false")
    lenient = frame.select(F.col("v").cast("int"), F.col("v").cast("double")).collect()
    assert list(map(repr, map(tuple, ours))) == list(map(repr, map(tuple, lenient)))


@pytest.mark.parametrize(
    "broken, right",
    [
        ("Oâ€™Neil", "O'Neil"), ("â€œhiâ€", '"hi"'), ("JosÃ©", "José"),
        ("a\x00b", "ab"), ("Ã©â€™Ã©", "é'é"), ("plain", "plain"), ("São", "São"),
        ("âge", "âge"), ("", ""), (None, None),
    ],
)
def test_encoding_repair(spark, broken, right):
    assert one_column(spark, [broken]).select(text.repair_encoding("v")).first()[0] == right


def test_padding_and_case(spark):
    frame = one_column(spark, ["  Foo Ã© ", "\tBAR ", "CAFÃ©"])
    row = frame.select(text.trimmed("v").alias("t"), text.trimmed_lower("v").alias("l")).collect()
    assert [tuple(r) for r in row] == [
        ("Foo é", "foo é"),
        ("\tBAR", "\tbar"),
        ("CAFé", "café"),
    ]


def measured(spark, quantity, price, total):
    frame = spark.createDataFrame(
        [(quantity, price, total)], "quantity int, unit_price double, total_amount double"
    )
    return fact.with_metrics(frame).first()


@pytest.mark.parametrize(
    "quantity, size",
    [(0, "single"), (1, "single"), (2, "small"), (5, "small"), (6, "medium"), (20, "medium"),
     (21, "large")],
)
def test_order_sizes(spark, quantity, size):
    assert measured(spark, quantity, 1.0, 1.0)["order_size_bucket"] == size


@pytest.mark.parametrize(
    "total, band, high",
    [(49.99, "low", False), (50.0, "medium", False), (499.99, "medium", False),
     (500.0, "high", False), (500.01, "high", True), (4999.99, "high", True),
     (5000.0, "enterprise", True)],
)
def test_revenue_bands(spark, total, band, high):
    row = measured(spark, 1, 1.0, total)
    assert (row["revenue_band"], row["is_high_value"]) == (band, high)


def test_discounts(spark):
    row = measured(spark, 3, 25.99, 70.17)
    assert (row["revenue"], row["discount_amount"], row["discount_rate"]) == (77.97, 7.8, 0.1)
    assert row["avg_unit_price"] == 23.39
    nothing_sold = measured(spark, 0, 10.0, 30.0)
    assert nothing_sold["discount_rate"] == 0.0
    assert nothing_sold["discount_amount"] == -30.0
    assert nothing_sold["avg_unit_price"] == 30.0


def test_rounding_is_half_up_on_the_written_number(spark):
    assert measured(spark, 1, 1.005, 0.0)["revenue"] == 1.01
    assert measured(spark, 1, 10.075, 0.0)["revenue"] == 10.08


def test_mismatch_needs_more_than_a_cent(spark):
    frame = spark.createDataFrame(
        [(2, 5.0, 10.0), (2, 5.0, 10.02), (2, 5.0, 9.0)],
        "quantity int, unit_price double, total_amount double",
    )
    flags = [r["total_amount_mismatch"] for r in cleaning.flag_amount_mismatch(frame).collect()]
    assert flags == [False, True, True]


def test_sum_of_cents_is_exact_and_total(spark):
    frame = one_column(spark, [0.1] * 10 + [0.2] * 10 + [None], "double")
    assert frame.select(numbers.sum_cents("v")).first()[0] == 3.0
    huge = one_column(spark, [1e25, 1.25], "double")
    assert huge.select(numbers.sum_cents("v")).first()[0] == 1e25
    assert one_column(spark, [None], "double").select(numbers.sum_cents("v")).first()[0] is None


def test_date_key(spark):
    frame = one_column(spark, [date(2024, 2, 9), None], "date")
    assert [r[0] for r in frame.select(dates.date_key("v")).collect()] == [20240209, None]


def test_metric_columns_are_all_there(spark):
    assert set(metrics.METRIC_COLUMNS) <= set(measured(spark, 1, 1.0, 1.0).asDict())
