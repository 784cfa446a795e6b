"""Declared schemas of the conformed tables.

``TABLES`` names every table with its columns, key and layout; ``conformed`` brings a frame to the declared form before it is written,
``checked`` compares what lies in a folder with the declaration before it is read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Table:
    """Columns, the key (never null), and the column that bucketed copies are dealt by."""

    columns: str
    key: tuple[str, ...]
    bucket: str | None = None

    @property
    def schema(self) -> T.StructType:
        fields = T.StructType.fromDDL(self.columns)
        return T.StructType([T.StructField(f.name, f.dataType, f.name not in self.key) for f in fields])


# Table and column names as declared by the sources' schema.
TABLES = {
    "master_properties": Table("uprn string, title_number string, address_line_1 string, postcode string, latitude double, longitude double, "
                               "local_authority_code string", ("uprn",), "uprn"),
    "corporate_registry": Table("company_number string, company_name string, incorporation_country string, company_category string, company_status string, "
                                "last_accounts_date date, sic_codes string", ("company_number",), "company_number"),
    "ownership_records": Table("id long, title_number string, company_number string, proprietor_name string, proprietor_address string, date_registered date, "
                               "price_paid decimal(15,2)", ("id",), "title_number"),
    "epc_assessments": Table("certificate_id string, uprn string, inspection_date date, asset_rating int, asset_rating_band string, floor_area double, "
                             "property_type string, is_latest boolean", ("certificate_id",), "uprn"),
    "transaction_history": Table("transaction_id string, title_number string, transfer_date date, price_paid decimal(15,2), property_type string, "
                                 "new_build_flag string", ("transaction_id",), "title_number"),
    "lease_registry": Table("unique_lease_id string, title_number string, tenure string, lease_date date, lease_term_years int, lease_expiry_date date, "
                            "lessee_name string, alienation_clause boolean", ("unique_lease_id",), "title_number"),
    "covenant_registry": Table("title_number string, has_covenant boolean, last_updated date", ("title_number",), "title_number"),
    "postcode_index": Table("postcode string, latitude double, longitude double, eastings int, northings int, district_code string", ("postcode",)),
    "voa_ratings": Table("billing_authority_ref string, uprn string, address string, postcode string, description string, rateable_value_2023 int, "
                         "rateable_value_2026 int, scat_code string, effective_date date, list_year int", ("billing_authority_ref",)),
    "planning_history": Table("application_id string, uprn string, address string, description string, status string, decision_date date, expiry_date date, "
                              "is_lapsing_soon boolean, url string", ("application_id",), "uprn"),
    "mobility_metrics": Table("location_id string, name string, latitude double, longitude double, annual_footfall int, metric_type string, last_updated date",
                              ("location_id",)),
    "fsa_ratings": Table("fsa_id long, business_name string, address_line_1 string, postcode string, rating_value string, rating_date date, latitude double, "
                         "longitude double, local_authority_code string", ("fsa_id",)),
    "connectivity_metrics": Table("uprn string, max_download_speed int, max_upload_speed int, fiber_availability boolean, five_g_availability boolean", ("uprn",), "uprn"),
    "raw_ppd_staging": Table("transaction_id string, price_paid long, transfer_date date, postcode string, property_type string, full_address string, paon string, "
                             "saon string, street string", ("transaction_id",)),
}


def conformed(df: DataFrame, table: str) -> DataFrame:
    """The frame with exactly the declared columns, in order and of the declared types.  Absent columns are null; a column that is not declared,
    an absent key and a type that cannot be cast are errors, as is a null key or a value that does not fit, when the rows are made."""
    spec = TABLES[table]
    unknown = [c for c in df.columns if c not in spec.schema.names]
    absent = [c for c in spec.key if c not in df.columns]
    if unknown or absent:
        raise ValueError(f"{table}: " + "; ".join([f"not declared: {', '.join(unknown)}"] * bool(unknown) + [f"key missing: {', '.join(absent)}"] * bool(absent)))
    out = []
    for f in spec.schema:
        c = F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        if f.name in spec.key:
            c = F.coalesce(c, F.raise_error(F.lit(f"{table}.{f.name} is null")).cast(f.dataType))
        out.append(c.alias(f.name))
    return df.select(*out)


def checked(found: T.StructType, table: str) -> T.StructType:
    """The declared schema, if the found columns have its names and types (nullability aside); else an error that says which differ."""
    declared = TABLES[table].schema
    have, want = {f.name: f.dataType for f in found}, {f.name: f.dataType for f in declared}
    wrong = [f"{n} is {have[n].simpleString() if n in have else 'missing'}, declared {want[n].simpleString()}" for n in want if have.get(n) != want[n]]
    wrong += [f"{n} is not declared" for n in have if n not in want]
    if wrong:
        raise ValueError(f"{table}: " + "; ".join(wrong))
    return declared
