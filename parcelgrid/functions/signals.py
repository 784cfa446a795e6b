"""Signal columns (E1, E3-E5, E7-E9, E12): native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the reference's rules.
SQM_TO_SQFT = 10.764            # divisor from price per m2 to price per ft2
FLAT_RATE_PER_UNIT = 350        # est. value = floor_area * 350
FOOTFALL_BASE = 1_000_000       # footfall proxy base
FOOTFALL_PER_LINE = 500_000     # footfall proxy per serving line
UNKNOWN_LENDER = "UNKNOWN LENDER"
DEFAULT_CHARGE_DESCRIPTION = "Fixed Charge over Property"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sale_psf(price, area) -> Column:
    """Price / area / 10.764 when area is known and > 0, else NULL."""
    price, area = _c(price), _c(area)
    return F.when(area.isNotNull() & (area > 0), price / area / F.lit(SQM_TO_SQFT))


def price_k(price) -> Column:
    """Price in thousands, half-even to 0 decimals (Python format)."""
    return F.bround(_c(price) / 1000.0, 0).cast("bigint")


def size_label(area) -> Column:
    """int(area) when area > 0 else 'N/A'."""
    area = _c(area)
    return F.when(area.isNotNull() & (area > 0), area.cast("bigint").cast("string")).otherwise(F.lit("N/A"))


def risk_band(band) -> Column:
    """F/G critical, E high, anything else low."""
    band = _c(band)
    return (F.when(band.isin("F", "G"), "critical")
             .when(band == "E", "high").otherwise("low"))


def flat_value(area, rate: float = FLAT_RATE_PER_UNIT) -> Column:
    """E5: floor_area * rate, as coded (the area is in m2 but labelled ft2)."""
    return _c(area) * F.lit(rate)


def flat_value_sqft(area, rate: float = FLAT_RATE_PER_UNIT) -> Column:
    """E5, unit-correct twin: m2 -> ft2 before applying the per-ft2 rate."""
    return _c(area) * F.lit(SQM_TO_SQFT) * F.lit(rate)


def footfall_score(lines) -> Column:
    """1,000,000 + 500,000 per line; missing list counts as empty."""
    n = F.size(F.coalesce(_c(lines), F.array()))
    return (F.lit(FOOTFALL_BASE) + F.lit(FOOTFALL_PER_LINE) * n).cast("int")


def active_officers(officers, n: int = 3) -> Column:
    """Officers whose record has no ``resigned_on`` key, first n names
    ('Unknown' when the name key is absent), joined with ', '.  ``officers``
    is an array of maps so key presence is exact (a key with a null value
    still counts as present, as in a Python ``in`` test)."""
    active = F.filter(F.coalesce(_c(officers), F.array().cast("array<map<string,string>>")),
                      lambda o: ~F.map_contains_key(o, "resigned_on"))
    names = F.transform(F.slice(active, 1, n),
                        lambda o: F.when(F.map_contains_key(o, "name"), o["name"]).otherwise(F.lit("Unknown")))
    return F.array_join(names, ", ")


def outstanding(charges) -> Column:
    return F.filter(F.coalesce(_c(charges), F.array()), lambda c: c["status"] == "outstanding")


def charges_label(n) -> Column:
    """E9: '<n> CHARGES' or 'CLEAR'."""
    n = _c(n)
    return F.when(n > 0, F.concat(n.cast("string"), F.lit(" CHARGES"))).otherwise(F.lit("CLEAR"))


def debt_label(n) -> Column:
    n = _c(n)
    return F.when(n > 0, F.lit("MATURING DEBT DETECTED")).otherwise(F.lit("NO CHARGES FILED"))


def first_lender(charge) -> Column:
    """First entitled person's name or 'UNKNOWN LENDER'."""
    name = F.get(_c(charge)["persons_entitled"], 0)["name"]
    return F.coalesce(F.nullif(name, F.lit("")), F.lit(UNKNOWN_LENDER))  # JS ||: '' falls back too


def short_address(address) -> Column:
    """Text before the first ',' or 'Unknown Address' when empty."""
    a = _c(address)
    return F.when(a.isNull() | (a == ""), F.lit("Unknown Address")).otherwise(F.split(a, ",", 2)[0])


def title_line(company_name, property_type) -> Column:
    """Company, else property type, else 'Commercial Asset' (JS ||)."""
    return F.coalesce(F.nullif(_c(company_name), F.lit("")), F.nullif(_c(property_type), F.lit("")),
                      F.lit("Commercial Asset"))
