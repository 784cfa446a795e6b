"""CSV feed loaders (scan -> conform -> dedup).

Each feed has a reader (``read_*``: ``spark.read.csv`` with an explicit
all-string schema plus a file-order key) and a loader (``load_*``) that takes
the raw DataFrame and returns conformed batches ready for the merge rules
of ``operators.merge``.  Loaders are pure DataFrame transformations, so the
same code serves files, streams (foreachBatch) and tests.

The file-order key ``_seq`` replaces the reference's row order: a struct of
(file path, split start, row id within the split) taken in the same scan,
before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelgrid.functions.geo import add_latlng
from parcelgrid.functions.text import PY_WHITESPACE_CLASS
from parcelgrid.operators.merge import conform, dedup_first, dedup_last
from parcelgrid.session import written

# Feed column names as published by the sources.
OWNERSHIP_COLUMNS = [
    "Title Number", "Property Address", "Postcode", "Price Paid", "Proprietor Name (1)",
    "Company Registration No. (1)", "Proprietorship Category (1)", "Proprietor (1) Address (1)",
    "Proprietor (1) Address (2)", "Proprietor (1) Address (3)", "Date Proprietor Added",
]
SALES_COLUMNS = ["id", "price", "date", "postcode", "type", "old_new", "duration", "paon", "saon",
                 "street", "locality", "city", "district", "county", "ppd_cat", "status"]
CERTIFICATE_COLUMNS = ["uprn", "address", "postcode", "local_authority", "lmk_key", "inspection_date",
                       "asset_rating", "asset_rating_band", "floor_area", "property_type"]
UNKNOWN_COUNTRY = "Unknown"
OWNERSHIP_DATE_FORMAT = "dd-MM-yyyy"
SALES_DATE_FORMAT = "yyyy-MM-dd HH:mm"


def file_order(df: DataFrame) -> Column:
    """Row order key of a file scan; must be taken before any shuffle."""
    return F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
                    F.monotonically_increasing_id().alias("i"))


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None, header: bool = True,
             n_columns: int | None = None) -> DataFrame:
    """Read a CSV feed as all strings, with ``_seq`` (file order) and ``_file``.

    With a header, ``columns`` are picked by name, in any order and among others; a missing one is
    an error.  Quotes inside a quoted field are doubled."""
    r = (spark.read.option("header", header).option("mode", "PERMISSIVE").option("encoding", "UTF-8")
         .option("quote", '"').option("escape", '"'))
    if columns and header:
        df = r.csv(path)
        missing = [c for c in columns if c not in df.columns]
        if missing:
            raise ValueError(f"columns missing in {path}: {', '.join(missing)}")
        return df.select(*[F.col(f"`{c}`") for c in columns], file_order(df).alias("_seq"), F.col("_metadata.file_name").alias("_file"))
    if columns:
        r = r.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    elif n_columns:
        r = r.schema(T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(n_columns)]))
    df = r.csv(path)
    return df.select("*", file_order(df).alias("_seq"), F.col("_metadata.file_name").alias("_file"))


# a field behind its comma: quoted (doubled quotes inside) or without a comma
_FIELD = r',("(?:[^"]++|"")*+"|[^,]*+)'


def _fields(line: Column) -> tuple[Column, Column]:
    """Fields of a CSV line (an empty unquoted one is null), and whether its quotes are sound."""
    line = F.concat(F.lit(","), line)
    raw = F.regexp_extract_all(line, F.lit(_FIELD), F.lit(1))
    whole = F.aggregate(F.regexp_extract_all(line, F.lit(_FIELD), F.lit(0)), F.lit(0), lambda n, x: n + F.length(x)) == F.length(line)
    quoted = lambda x: x.startswith('"')
    closed = ~F.exists(raw, lambda x: x.contains('"') & ~(quoted(x) & x.endswith('"') & (F.length(x) > 1)))
    value = lambda x: F.when(quoted(x), F.replace(x.substr(F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(F.nullif(x, F.lit("")))
    return F.transform(raw, value), whole & closed


def read_files(spark: SparkSession, path: str, columns: list[str] | None = None, min_columns: int = 1,
               ignore_case: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, verdicts) of a folder of CSV files, each judged for itself: one that cannot be read is set aside whole,
    and the rest load (the file rule of A2 and A4; rows of readable files go on to ``quarantine``).

    With ``columns`` each file has a header of its own, in any order and among others; without, rows have
    no header and columns ``_c0``, ``_c1``, ...  A file is set aside, for the first of these reasons, when it is "empty", "not UTF-8",
    has a "malformed line" (unsound quotes), "missing columns" (header) or "too few columns" (first line under
    ``min_columns``), or "too many fields" (a line longer than the first).  Shorter lines are filled up with nulls, blank lines skipped.

    The folder is scanned once: lines and their fields are written to the shared folder, and verdicts and rows come from there.
    Verdicts: file, reason (null: loaded), n_lines (without the header), n_bad (lines that gave a reason of their own)."""
    text = spark.read.option("recursiveFileLookup", "true").text(path)
    one_form = lambda c: F.regexp_replace(c, r"^(\w+):/+", "$1:/")  # noqa: E731  file:/ and file:/// are one place
    lines = text.select(one_form(F.col("_metadata.file_path")).alias("_path"), file_order(text).alias("_seq"), F.is_valid_utf8("value").alias("utf8"),
                        F.regexp_replace("value", "^\ufeff|\r$", "").alias("line"))
    fields, sound = _fields(F.col("line"))
    lines = written(lines.where(F.trim("line") != "")
                    .select("_path", "_seq", "utf8", F.when(F.col("utf8"), fields).alias("fields"), F.when(F.col("utf8"), sound).alias("sound")), "feed-lines")
    fold = F.lower if ignore_case else (lambda c: c)
    first = lines.groupBy("_path").agg(F.min(F.struct("_seq", "fields")).alias("_f"), F.count(F.lit(1)).alias("n_lines"))
    first = first.select("_path", F.col("_f._seq").alias("_first"), F.transform("_f.fields", lambda c: fold(F.coalesce(c, F.lit("")))).alias("header"),
                         "n_lines")
    judged = lines.join(first.select("_path", F.size("header").alias("width")), "_path").groupBy("_path").agg(
        F.bool_and("utf8").alias("utf8"), F.bool_and("sound").alias("sound"), F.max(F.size("fields") - F.col("width")).alias("over"),
        F.count_if(~F.col("utf8") | ~F.col("sound") | (F.size("fields") > F.col("width"))).alias("n_bad"))
    if columns:
        wanted = F.array(*[fold(F.lit(c)) for c in columns])
        narrow, why = F.size(F.array_except(wanted, F.col("header"))) > 0, "missing columns"
    else:
        narrow, why = F.size("header") < min_columns, "too few columns"
    reason = (F.when(F.col("n_lines").isNull(), "empty").when(~F.col("utf8"), "not UTF-8").when(~F.col("sound"), "malformed line")
               .when(narrow, why).when(F.col("over") > 0, "too many fields"))
    # the reader's own list of files; a scan has no row for one without bytes
    files = spark.createDataFrame([(f,) for f in text.inputFiles()], "_path string").select(one_form(F.col("_path")).alias("_path"))
    verdicts = written(files.join(first, "_path", "left").join(judged, "_path", "left").withColumn("reason", reason), "feed-files")

    good = lines.join(verdicts.where(F.col("reason").isNull()).select("_path", "_first", "header"), "_path")
    if columns:
        good = good.where(F.col("_seq") != F.col("_first"))
        picked = [F.get("fields", (F.array_position("header", fold(F.lit(c))) - 1).cast("int")).alias(c) for c in columns]
    else:
        picked = [F.get("fields", F.lit(i)).alias(f"_c{i}") for i in range(min_columns)]
    rows = good.select(*picked, "_seq", F.element_at(F.split("_path", "/"), -1).alias("_file"), "_path")
    n = F.coalesce("n_lines", F.lit(0)) - (F.when(F.col("n_lines") > 0, 1).otherwise(0) if columns else F.lit(0))
    return rows, verdicts.select(F.col("_path").alias("file"), "reason", n.cast("long").alias("n_lines"), F.coalesce("n_bad", F.lit(0)).cast("long").alias("n_bad"))


def strip_py(c: Column) -> Column:
    """Python str.strip(): all whitespace at both ends."""
    c = F.regexp_replace(c, "^" + PY_WHITESPACE_CLASS + "+", "")
    return F.regexp_replace(c, PY_WHITESPACE_CLASS + "+$", "")


def lower_headers(df: DataFrame, space_to_underscore: bool = False) -> DataFrame:
    def fix(c):
        if c.startswith("_"):
            return c
        c = c.lower()
        return c.replace(" ", "_") if space_to_underscore else c
    return df.toDF(*[fix(c) for c in df.columns])


# ------------------------------------------------------------------ A1

def load_ownership(raw: DataFrame, seq: str = "_seq") -> tuple[DataFrame, DataFrame, DataFrame]:
    """A1: ownership feed -> (companies, ownership rows, property stubs).

    companies: first row per company number (file order), country 'Unknown';
    ownership: rows with title and company, owner address = 3 parts joined
    by ' ' with NULL -> '', price as decimal(15,2), date parsed (bad -> NULL);
    stubs: first row per title (NULL titles dropped)."""
    c = conform(raw, {"company_number": "Company Registration No. (1)", "company_name": "Proprietor Name (1)",
                      "company_category": "Proprietorship Category (1)", "_seq": seq},
                required=["company_number"], constants={"incorporation_country": UNKNOWN_COUNTRY})
    companies = dedup_first(c, ["company_number"], "_seq")
    addr = F.concat(F.coalesce(F.col("Proprietor (1) Address (1)"), F.lit("")), F.lit(" "),
                    F.coalesce(F.col("Proprietor (1) Address (2)"), F.lit("")), F.lit(" "),
                    F.coalesce(F.col("Proprietor (1) Address (3)"), F.lit("")))
    ownership = conform(raw, {
        "title_number": "Title Number", "company_number": "Company Registration No. (1)",
        "proprietor_name": "Proprietor Name (1)", "proprietor_address": addr,
        "price_paid": F.col("Price Paid").try_cast("decimal(15,2)"),
        "date_registered": F.try_to_date(F.col("Date Proprietor Added"), OWNERSHIP_DATE_FORMAT),
        "_seq": seq}, required=["title_number", "company_number"])
    s = conform(raw, {"title_number": "Title Number", "address_line_1": "Property Address",
                      "postcode": "Postcode", "_seq": seq}, required=["title_number"])
    stubs = dedup_first(s, ["title_number"], "_seq")
    return companies, ownership, stubs


# ------------------------------------------------------------------ A2

def load_certificates(raw: DataFrame, seq: str = "_seq") -> tuple[DataFrame, DataFrame]:
    """A2: certificate feed (any header case) -> (properties, assessments).
    Properties: first row per uprn; assessments: last row per certificate,
    is_latest = true as coded."""
    df = lower_headers(raw)
    p = conform(df, {"uprn": "uprn", "address_line_1": "address", "postcode": "postcode",
                     "local_authority_code": "local_authority", "_seq": seq}, required=["uprn"])
    props = dedup_first(p, ["uprn"], "_seq")
    a = conform(df, {
        "certificate_id": "lmk_key", "uprn": "uprn",
        "inspection_date": F.try_to_date(F.col("inspection_date")),
        "asset_rating": F.col("asset_rating").try_cast("int"),
        "asset_rating_band": "asset_rating_band",
        "floor_area": F.col("floor_area").try_cast("double"),
        "property_type": "property_type", "_seq": seq},
        required=["certificate_id"], constants={"is_latest": True})
    return props, dedup_last(a, ["certificate_id"], "_seq")


# ------------------------------------------------------------------ A3

def load_sales(raw: DataFrame, min_year: int | None = None, feed_rank: int = 0,
               seq: str = "_seq") -> DataFrame:
    """A3: headerless 16-column sales feed.  Optional ``year >= min_year``
    (unparsable dates drop out, as in the reference); full_address =
    upper(strip(paon + ' ' + saon + ' ' + street)) with NULL -> ''.
    ``_seq`` becomes (feed_rank, seq) so a later feed wins in keep-last."""
    df = raw.toDF(*[SALES_COLUMNS[int(c[2:])] if c.startswith("_c") else c for c in raw.columns])
    ts = F.try_to_timestamp(F.col("date"), F.lit(SALES_DATE_FORMAT))
    ts = F.coalesce(ts, F.try_to_timestamp(F.col("date")))
    addr = F.upper(strip_py(F.concat(F.coalesce("paon", F.lit("")), F.lit(" "), F.coalesce("saon", F.lit("")),
                                     F.lit(" "), F.coalesce("street", F.lit("")))))
    out = df.select(
        F.col("id").alias("transaction_id"), F.col("price").try_cast("bigint").alias("price_paid"),
        F.to_date(ts).alias("transfer_date"), "postcode", F.col("type").alias("property_type"),
        addr.alias("full_address"), "paon", "saon", "street", F.col("status").alias("record_status"),
        F.struct(F.lit(feed_rank).alias("rank"), F.col(seq).alias("row")).alias("_seq"))
    if min_year is not None:
        out = out.where(F.year("transfer_date") >= min_year)
    return out


def baseline_plus_update(baseline: DataFrame, update: DataFrame, apply_deletes: bool = False) -> DataFrame:
    """F2 (batch form): baseline then monthly upsert, the update wins; with
    ``apply_deletes`` an update row with record status 'D' removes the key."""
    from parcelgrid.operators.merge import dedup_last as last
    both = baseline.unionByName(update)
    out = last(both, ["transaction_id"], "_seq")
    if apply_deletes:
        out = out.where(F.coalesce(F.col("record_status"), F.lit("")) != "D")
    return out.drop("record_status")


# ------------------------------------------------------------------ A4

def load_postcodes(raw: DataFrame, min_columns: int = 9) -> DataFrame:
    """A4: headerless postcode file; columns 0, 2, 3, 8 = postcode,
    eastings, northings, district.  A file needs >= 9 columns (the
    reference's guard is >= 4 but then reads column 8).  Lat/lng by E14."""
    data_cols = [c for c in raw.columns if c.startswith("_c")]
    if len(data_cols) < min_columns:
        raise ValueError(f"postcode feed has {len(data_cols)} columns, needs >= {min_columns}")
    keep = [c for c in ("_file", "_seq") if c in raw.columns]
    base = raw.select(F.col("_c0").alias("postcode"), F.col("_c2").try_cast("int").alias("eastings"),
                      F.col("_c3").try_cast("int").alias("northings"), F.col("_c8").alias("district_code"), *keep)
    out = add_latlng(base, "eastings", "northings")
    return out.select("postcode", "latitude", "longitude", "eastings", "northings", "district_code", *keep)


# ------------------------------------------------------------ A10-A13

def load_rates(raw_2023: DataFrame, raw_2026: DataFrame, seq: str = "_seq") -> DataFrame:
    """A10: two rating lists -> one row per billing reference with both
    years' rateable values (full outer join; last row per ref and year)."""
    def one(df, year):
        d = lower_headers(df, space_to_underscore=True)
        c = conform(d, {"billing_authority_ref": "ba_reference", "address": "address", "postcode": "postcode",
                        "description": "description",
                        "rateable_value": F.col("rateable_value").try_cast("int"),
                        "effective_date": F.try_to_date(F.col("effective_date")), "_seq": seq},
                    required=["billing_authority_ref"])
        c = dedup_last(c, ["billing_authority_ref"], "_seq")
        return c.select("billing_authority_ref", *[F.col(x).alias(f"{x}_{year}") for x in
                                                   ("address", "postcode", "description", "rateable_value",
                                                    "effective_date")])
    a, b = one(raw_2023, 2023), one(raw_2026, 2026)
    j = a.join(b, "billing_authority_ref", "full")
    return j.select(
        "billing_authority_ref",
        F.coalesce("address_2026", "address_2023").alias("address"),
        F.coalesce("postcode_2026", "postcode_2023").alias("postcode"),
        F.coalesce("description_2026", "description_2023").alias("description"),
        F.col("rateable_value_2023"), F.col("rateable_value_2026"),
        F.coalesce("effective_date_2026", "effective_date_2023").alias("effective_date"),
        F.when(F.col("rateable_value_2026").isNotNull() | F.col("effective_date_2026").isNotNull()
               | F.col("address_2026").isNotNull(), F.lit(2026)).otherwise(F.lit(2023)).alias("list_year"))


def load_leases(raw: DataFrame, seq: str = "_seq", date_format: str = "dd-MM-yyyy") -> DataFrame:
    """Drop rows with no start date or term; expiry = start + term years."""
    start = F.try_to_date(F.col("Date of Lease"), date_format)
    term = F.col("Term").try_cast("int")
    c = conform(raw, {"unique_lease_id": "Unique Identifier", "title_number": "Title Number",
                      "lease_date": start, "lease_term_years": term, "lessee_name": "Lessee Name", "_seq": seq},
                required=["unique_lease_id", "lease_date", "lease_term_years"])
    c = c.withColumn("lease_expiry_date", F.add_months("lease_date", F.col("lease_term_years") * 12))
    return dedup_last(c, ["unique_lease_id"], "_seq").withColumn("tenure", F.lit("Leasehold"))


def load_covenants(raw: DataFrame, as_of: str | None = None) -> DataFrame:
    """Titles named in the covenant file, flagged."""
    out = (raw.select(F.col("Title Number").alias("title_number")).where(F.col("title_number").isNotNull())
              .distinct().withColumn("has_covenant", F.lit(True)))
    if as_of:
        out = out.withColumn("last_updated", F.to_date(F.lit(as_of)))
    return out


def _flag(c: Column) -> Column:
    u = F.upper(F.trim(c))
    return (F.when(u.isin("Y", "YES", "TRUE", "1"), F.lit(True))
             .when(u.isin("N", "NO", "FALSE", "0"), F.lit(False)))


def load_connectivity(raw: DataFrame, seq: str = "_seq") -> DataFrame:
    """Uprn, download, upload, fibre, 5G; last row per uprn."""
    d = lower_headers(raw)
    c = conform(d, {"uprn": "uprn", "max_download_speed": F.col("max_down").try_cast("int"),
                    "max_upload_speed": F.col("max_up").try_cast("int"),
                    "fiber_availability": _flag(F.col("fttp_availability")),
                    "five_g_availability": _flag(F.col("5g_outdoor")), "_seq": seq}, required=["uprn"])
    return dedup_last(c, ["uprn"], "_seq")
