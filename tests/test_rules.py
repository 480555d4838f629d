"""Business rules on single values, with figures worked out by hand."""

from __future__ import annotations

from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cauce.context import RunContext
from cauce.functions import masking, rules
from cauce.functions.numbers import percentage, repaired_int


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def lit(x, kind):
    return F.lit(x).cast(kind)


@pytest.mark.parametrize(("yearly", "monthly"), [("28.84", "2.1341"), ("0", "0")])
def test_monthly_rate(spark, yearly, monthly):
    assert value(spark, rules.monthly_rate(lit(yearly, "decimal(6,2)"))) == D(monthly)


@pytest.mark.parametrize(("pesos", "dollars"), [("842700", "208.07"), ("19824.75", "4.90"), ("20.25", "0.01")])
def test_dollars(spark, pesos, dollars):
    assert value(spark, rules.in_dollars(lit(pesos, "decimal(16,2)"), D("4050.0"))) == D(dollars)


@pytest.mark.parametrize(
    ("days", "bucket", "rating", "share"),
    [(0, "Al día", "A", "0.01"), (1, "Rango 1", "B", "0.032"), (30, "Rango 1", "B", "0.032"),
     (31, "Rango 2", "C", "0.1"), (60, "Rango 2", "C", "0.1"), (61, "Rango 3", "D", "0.2"),
     (90, "Rango 3", "D", "0.2"), (91, "Deteriorado", "E", "1"), (-1, "Deteriorado", "E", "1"),
     (None, "Deteriorado", "E", "1")],
)
def test_arrears(spark, days, bucket, rating, share):
    d = lit(days, "int")
    assert value(spark, rules.arrears_bucket(d)) == bucket
    assert value(spark, rules.regulatory_rating(d)) == rating
    assert value(spark, rules.provision_share(d)) == D(share)


def test_age_counts_calendar_years(spark):
    assert value(spark, rules.age_in_years(F.lit(date(1990, 12, 31)), F.lit(date(2026, 1, 1)))) == 36


@pytest.mark.parametrize(
    ("day", "clock", "expected"),
    [(date(2026, 8, 24), "07:00:00", True), (date(2026, 8, 28), "20:59:59", True),
     (date(2026, 8, 28), "21:00:00", False), (date(2026, 8, 28), "06:59:59", False),
     (date(2026, 8, 29), "12:00:00", False), (date(2026, 8, 30), "12:00:00", False)],
)
def test_business_hours(spark, day, clock, expected):
    assert value(spark, rules.business_hours(F.lit(day), F.lit(clock))) is expected


def test_labels(spark):
    assert [value(spark, rules.segment_label(lit(c, "string"))) for c in ("STD", "XXX", None)] == [
        "Estándar", "Sin clasificar", "Sin clasificar"]
    assert [value(spark, rules.product_family(lit(c, "string"))) for c in
            ("TARJETA_DIGITAL", "CUENTA_AHORRO_DIGITAL", "RECARGA", None)] == [
        "CREDITO", "AHORRO", "TRANSACCIONAL", "TRANSACCIONAL"]


def test_account_number(spark):
    assert value(spark, rules.account_number(F.lit("CLI000123"), F.lit("PRD7"))) == "8000123007"
    assert value(spark, rules.account_number(F.lit("CLI1234567"), F.lit("PRD0012"))) == "812345670012"
    assert value(spark, rules.account_number(lit(None, "string"), F.lit("PRD001"))) is None


@pytest.mark.parametrize(
    ("amount", "mean", "deviation", "expected"),
    [("100", 10.0, 29.9, True), ("100", 10.0, 30.0, False), ("100", 10.0, 0.0, False),
     ("100", 10.0, None, False), ("100", None, None, False)],
)
def test_suspicious(spark, amount, mean, deviation, expected):
    got = rules.suspicious_amount(lit(amount, "decimal(16,2)"), lit(mean, "double"), lit(deviation, "double"))
    assert value(spark, got) is expected


def test_masking(spark):
    assert value(spark, masking.masked(F.lit("abc"), "")) == (
        "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad")
    assert value(spark, masking.masked(lit(None, "string"), "s")) is None
    assert value(spark, masking.masked_full_name(F.lit("a"), lit(None, "string"))) is None


def test_salt_is_required(monkeypatch):
    monkeypatch.delenv("CAUCE_PII_SALT", raising=False)
    with pytest.raises(ValueError):
        RunContext(as_of=date(2025, 1, 1), run_ts="2025-01-01 00:00:00")


def test_clock(spark):
    assert value(spark, rules.checked_clock(F.lit("23:59:59"))) == "23:59:59"
    assert value(spark, rules.checked_clock(lit(None, "string"))) is None
    with pytest.raises(PySparkException):
        value(spark, rules.checked_clock(F.concat(F.lit("24:00:0"), F.col("id").cast("string"))))


@pytest.mark.parametrize(
    ("part", "whole", "expected"),
    [(1, 8, "12.50"), (498748, 501500, "99.45"), (5, 0, None), (1, 3, "33.33"), (2, 3, "66.67"),
     (1989, 2000, "99.45"), (19891, 20000, "99.46"), (0, 7, "0.00"), (99454999999, 100000000000, "99.45")],
)
def test_percentage(spark, part, whole, expected):
    got = value(spark, percentage(lit(part, "bigint"), lit(whole, "bigint")))
    assert got == (None if expected is None else D(expected))


def test_repaired_int(spark):
    got = [value(spark, repaired_int(lit(x, "string"))) for x in ("44.0", "44", "n/a", "", None)]
    assert got == [44, 44, None, None, None]


def test_dollars_in_table_have_two_digits(spark):
    df = spark.range(1).select(rules.in_dollars(lit("100", "decimal(16,2)"), D("4050.0")).alias("x"))
    assert df.schema["x"].dataType.scale == 2
