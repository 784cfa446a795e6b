"""Company intelligence over landed company payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelgrid.functions.signals import (DEFAULT_CHARGE_DESCRIPTION, active_officers, charges_label,
                                          debt_label, first_lender, outstanding)
from parcelgrid.operators.linkage import resolve_company
from parcelgrid.operators.merge import update_by_key
from parcelgrid.plans.distress import enrichment_targets

TOP_N = 5                 # officers and owners shown per company
DEFAULT_OWNER_KIND = "INDIVIDUAL"


def officer_summary(parsed: DataFrame, n: int = 3) -> DataFrame:
    """First ``n`` active directors per company, ', '-joined."""
    return parsed.select("company_number", active_officers(F.col("officers"), n).alias("directors"))


def charge_summary(parsed: DataFrame) -> DataFrame:
    """Outstanding charges, labels, first lender and description."""
    o = outstanding(F.col("charges"))
    first = F.get(o, 0)
    return parsed.select(
        "company_number", F.size(o).alias("n_outstanding"),
        charges_label(F.size(o)).alias("charges_label"), debt_label(F.size(o)).alias("debt_label"),
        F.when(F.size(o) > 0, first_lender(first)).alias("first_lender"),
        F.when(F.size(o) > 0, F.coalesce(F.nullif(first["particulars"]["description"], F.lit("")),
                                         F.lit(DEFAULT_CHARGE_DESCRIPTION)))
         .alias("first_description"),
        F.when(F.size(o) > 0, first["created_on"]).alias("first_created_on"))


def corporate_tree(profiles: DataFrame, parsed: DataFrame, n: int = TOP_N) -> DataFrame:
    """Profile (name, status and address as its payload says) + first n officers (resigned kept, as coded) + first n
    owners (kind defaults to INDIVIDUAL); no profile -> no row."""
    officers = F.transform(F.slice("officers", 1, n), lambda o: F.coalesce(o["name"], F.lit("")))
    owners = F.transform(F.slice("owners", 1, n), lambda o: F.concat(
        F.coalesce(o["name"], F.lit("")), F.lit(" ("),
        F.coalesce(F.nullif(o["kind"], F.lit("")), F.lit(DEFAULT_OWNER_KIND)), F.lit(")")))
    return (profiles.select("company_number", "company_name", "company_status", "address").join(parsed, "company_number")
            .select("company_number", "company_name", "company_status", "address",
                    F.array_join(officers, "; ").alias("officers_top"),
                    F.array_join(owners, "; ").alias("owners_top"),
                    F.size("officers").alias("n_officers"), F.size("owners").alias("n_owners")))


def company_search(index: DataFrame, q: str, threshold: float = 0.85) -> DataFrame:
    """Best company for one name: exact normalised name (lowest
    number), else the best fuzzy match (levenshtein ratio >= threshold)
    among all titles;
    empty ``q`` -> no rows.  A filter over the index, no join."""
    from parcelgrid.functions.text import levenshtein_ratio, normalize_address
    reg = index.select("company_number", F.col("title").alias("company_name"), "company_status")
    if not q:
        return reg.limit(0)
    key = F.lit(q)
    nk = normalize_address(key)
    k = normalize_address(F.col("company_name"))
    exact = reg.where(k == nk).select(F.lit(0).alias("_p"), F.lit(-1.0).alias("_nr"), *reg.columns)
    fuzzy = (reg.where(F.length(k) > 0)
                .withColumn("_r", levenshtein_ratio(k, nk)).where(F.col("_r") >= threshold)
                .select(F.lit(1).alias("_p"), (-F.col("_r")).alias("_nr"), *reg.columns))
    # exact hits rank first (lowest number), then fuzzy by ratio: one global min
    best = exact.unionByName(fuzzy).groupBy().agg(F.min(F.struct("_p", "_nr", *reg.columns)).alias("_m"))
    return best.where(F.col("_m").isNotNull()).select(*[F.col(f"_m.{c}").alias(c) for c in reg.columns])


def enrich_companies(companies: DataFrame, owners: DataFrame, props: DataFrame, epc: DataFrame,
                     index: DataFrame, limit: int | None = None) -> DataFrame:
    """Companies owning F/G assets with missing status/country are
    resolved by name against the landed company index (C9); matched rows
    get status (default 'active'), country 'United Kingdom' and the official
    name (B5).  Unmatched rows are unchanged.  ``limit`` mirrors the
    reference's 10-company batch when wanted; default is all targets."""
    targets = enrichment_targets(companies, owners, props, epc, limit=limit)
    reg = index.select("company_number", F.col("title").alias("company_name"), "company_status")
    hits = resolve_company(targets.select(F.col("company_name").alias("owner_name")), reg)
    changes = (targets.join(hits.select("owner_name", F.col("company_name").alias("official_name"),
                                        F.col("company_status").alias("new_status")),
                            targets.company_name == F.col("owner_name"))
               .select("company_number",
                       F.coalesce("new_status", F.lit("active")).alias("company_status"),
                       F.lit("United Kingdom").alias("incorporation_country"),
                       F.col("official_name").alias("company_name")))
    return update_by_key(companies, changes, ["company_number"],
                         ["company_status", "incorporation_country", "company_name"])

