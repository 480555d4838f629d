"""Business rules of the bank, as column expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes, labels, limits and rates that reports rely on.
SEGMENT_LABELS = {"BAS": "Básico", "STD": "Estándar", "PRM": "Premium", "ELT": "Elite"}
NO_SEGMENT = "Sin clasificar"
CREDIT_TYPES = ("CRED_LIBRE_INVERSION", "CRED_ROTATIVO", "TARJETA_DIGITAL")
SAVINGS_TYPE = "CUENTA_AHORRO_DIGITAL"
INTEREST_MOVEMENTS = ("AVANCE_EFECTIVO", "COMPRA_TARJETA")
CHARGED = "EXITOSO"
BALANCE_TOLERANCE = Decimal("1.05")
# last day of arrears of the range, bucket, regulatory rating, provision share
ARREARS = (
    (0, "Al día", "A", Decimal("0.01")),
    (30, "Rango 1", "B", Decimal("0.032")),
    (60, "Rango 2", "C", Decimal("0.10")),
    (90, "Rango 3", "D", Decimal("0.20")),
)
WORST_ARREARS = ("Deteriorado", "E", Decimal("1.00"))


def segment_label(code: Column) -> Column:
    labels = F.create_map(*[F.lit(x) for pair in SEGMENT_LABELS.items() for x in pair])
    return F.coalesce(F.try_element_at(labels, code), F.lit(NO_SEGMENT))


def product_family(kind: Column) -> Column:
    return (
        F.when(kind.isin(*CREDIT_TYPES), "CREDITO")
        .when(kind == SAVINGS_TYPE, "AHORRO")
        .otherwise("TRANSACCIONAL")
    )


def monthly_rate(yearly_percent: Column) -> Column:
    """Monthly percentage equivalent to an effective yearly percentage, to 4 digits."""
    growth = F.pow(F.lit(1.0) + yearly_percent.cast("double") / 100, F.lit(1.0 / 12))
    return F.round((growth - 1) * 100, 4).cast("decimal(10,4)")


def age_in_years(birth: Column, as_of: Column) -> Column:
    """Calendar years between the two dates: the birthday itself plays no part."""
    return F.year(as_of) - F.year(birth)


def month_of(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def _by_arrears(days: Column, position: int) -> Column:
    low, result = 0, None
    for limit, *outcome in ARREARS:
        inside = days.between(low, limit)
        value = F.lit(outcome[position])
        result = F.when(inside, value) if result is None else result.when(inside, value)
        low = limit + 1
    # negative and unknown days fall through to the worst range
    return result.otherwise(F.lit(WORST_ARREARS[position]))


def arrears_bucket(days: Column) -> Column:
    return _by_arrears(days, 0)


def regulatory_rating(days: Column) -> Column:
    return _by_arrears(days, 1)


def provision_share(days: Column) -> Column:
    return _by_arrears(days, 2).cast("decimal(5,3)")


def in_dollars(pesos: Column, cop_per_usd: Decimal) -> Column:
    """Decimal division, so that ties round the same everywhere."""
    return F.round(pesos / F.lit(cop_per_usd), 2)


def business_hours(day: Column, clock: Column) -> Column:
    """Monday to Friday, from 07:00:00 to 20:59:59."""
    return F.dayofweek(day).between(2, 6) & F.substring(clock, 1, 2).cast("int").between(7, 20)


def checked_clock(clock: Column) -> Column:
    """A time of day as HH:mm:ss text; anything else fails the job, as a cast to TIME would."""
    valid = clock.rlike("^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$")
    return F.when(clock.isNull() | valid, clock).otherwise(
        F.raise_error(F.concat(F.lit("not a time of day: "), clock))
    )


def valid_date(day: Column, first: Column, last: Column) -> Column:
    return day.between(first, last)


def balance_within_tolerance(balance: Column, approved: Column) -> Column:
    return balance <= approved * F.lit(BALANCE_TOLERANCE)


def suspicious_amount(amount: Column, mean: Column, deviation: Column) -> Column:
    """More than three deviations above the trailing mean; False without a usable history."""
    above = amount.cast("double") > mean + 3 * deviation
    return F.coalesce((deviation > 0) & above, F.lit(False))


def account_number(client: Column, product: Column) -> Column:
    """'8', the first run of digits of the client (6 wide) and of the product (3 wide).

    A longer run of digits is kept whole.
    """

    def digits(code: Column, width: int) -> Column:
        found = F.regexp_extract(code, "([0-9]+)", 1)
        return F.when(F.length(found) >= width, found).otherwise(F.lpad(found, width, "0"))

    return F.concat(F.lit("8"), digits(client, 6), digits(product, 3))
