"""Names, types and codes of the star schema.

Everything in this module is a fixed value: files and queries that exist
outside of this package depend on these names, types, codes and formats.
"""

from __future__ import annotations

from pyspark.sql.types import BinaryType, DateType, DoubleType, IntegerType, LongType, StringType, StructType

_TYPES = {
    "INT": IntegerType(), "LONG": LongType(), "STRING": StringType(), "DOUBLE": DoubleType(), "DATE": DateType(),
    "BINARY": BinaryType(),
}


def table(columns: str) -> StructType:
    """Schema from ``name TYPE, name TYPE``; needs no session, unlike a DDL string."""
    schema = StructType()
    for column in columns.split(", "):
        name, kind = column.split()
        schema.add(name, _TYPES[kind])
    return schema


# --- fixed values: raw monthly extract, in file order -------------------------
EXTRACT = table(
    "cicid INT, i94yr INT, i94mon INT, i94cit INT, i94res INT, i94port STRING, "
    "arrdate INT, i94mode INT, i94addr STRING, depdate INT, i94bir INT, i94visa INT, "
    "count INT, dtadfile STRING, visapost STRING, occup STRING, entdepa STRING, "
    "entdepd STRING, entdepu STRING, matflag STRING, biryear INT, dtaddto STRING, "
    "gender STRING, insnum STRING, airline STRING, admnum DOUBLE, fltno STRING, "
    "visatype STRING"
)

# --- fixed values: staged reference files, `;` separated with a header --------
COUNTRY_MAPPING = table("i94_code INT, i94_desc STRING, iso_code STRING")
VISA_CATEGORIES = table(
    "visa_category STRING, visa_group STRING, visa_desc STRING, visa STRING, visa_id INT"
)
US_STATES = table("state_id STRING, state_name STRING")
COUNTRIES = table("country_id STRING, country_name STRING, continent_name STRING")
# The month is a whole number, so that it can be compared with the month of the fact.
TEMPERATURE = table(
    "country_id STRING, month INT, temperature_mean DOUBLE, "
    "temperature_min DOUBLE, temperature_max DOUBLE"
)

# --- fixed values: fact and date tables, partitioned by year and month ---------
FACT = table(
    "i94_id LONG, cit_country_id STRING, res_country_id STRING, state_id STRING, mode_id INT, "
    "purpose_id INT, visa_id INT, arrival_date DATE, cic_id INT, gender STRING, count INT, "
    "duration INT, age INT, year INT, month INT"
)
DATES = table("date DATE, day INT, week INT, year INT, month INT")
PERIOD = ("year", "month")

# --- fixed values: literal dimensions -----------------------------------------
MODE = table("mode_id INT, mode_desc STRING")
MODE_ROWS = ((1, "Air"), (2, "Sea"), (3, "Land"), (9, "Not reported"))
PURPOSE = table("purpose_id INT, purpose_desc STRING")
PURPOSE_ROWS = ((1, "Business"), (2, "Pleasure"), (3, "Student"), (9, "Not reported"))

# --- fixed values: codes that stand for "unknown" -----------------------------
UNKNOWN_COUNTRY = "99"
UNKNOWN_STATE = "99"
UNKNOWN_VISA = 1
NOT_REPORTED = 9
KNOWN_GENDERS = ("M", "F")
UNKNOWN_GENDER = "U"
UNKNOWN_COUNTRY_ROW = {
    "country_id": "99",
    "country_name": "Unknown Country",
    "continent_name": "Unknown Continent Name",
}
UNKNOWN_STATE_ROW = {"state_id": "99", "state_name": "Unknown State"}
UNKNOWN_VISA_ROW = {
    "visa_category": "Unknown Visa Categories",
    "visa_group": "Unknown Visa",
    "visa_desc": "Unknown",
    "visa": "",
}

# --- fixed values: country labels ---------------------------------------------
LABEL_COUNTRIES = "i94cntyl"
LABEL_STATES = "i94addrl"
INVALID_LABELS = ("No Country", "INVALID", "should not show")
COUNTRY_ALIASES = (
    ("ST.", "SAINT"),
    ("SAINT KITTS-NEVIS", "SAINT KITTS"),
    ("NORTH KOREA", "KOREA, Democratic"),
    ("SOUTH KOREA", "KOREA, Republic"),
    ("SAINT MAARTEN", "MAARTEN"),
    ("SAINT VINCENT-GRENADINES", "SAINT VINCENT"),
)

# --- fixed values: visa pages --------------------------------------------------
VISA_TABLE_CLASS = "grid"
VISA_CAPTION_TAG = "h4"
VISA_CAPTION_CLASS = "tsg-rwd-accordion-header-name-frame"
VISA_CODE = r"([A-Z]{1,5}-?[A-Z0-9]{0,3}[A-Za-z\s\-]*)"
VISA_SEPARATORS = r"[,\n/]"

# --- fixed values: data quality report and the fields tested -------------------
REPORT = table(
    "year STRING, month STRING, path STRING, test STRING, result STRING, "
    "field STRING, num_recs STRING"
)
NOT_NULL = {
    "i94": (
        "i94_id", "cic_id", "cit_country_id", "res_country_id", "mode_id", "purpose_id",
        "visa_id", "state_id", "arrival_date", "gender",
    ),
    "visa_categories": ("visa_id",),
    "us_states": ("state_id",),
    "countries": ("country_id",),
    "temperature": ("country_id", "month"),
    "mode": ("mode_id",),
    "purpose": ("purpose_id",),
    "dates": ("date",),
}

# --- fixed values: file layout -------------------------------------------------
MODEL_TABLES = {
    "i94": FACT,
    "dates": DATES,
    "visa_categories": VISA_CATEGORIES,
    "us_states": US_STATES,
    "countries": COUNTRIES,
    "temperature": TEMPERATURE,
    "mode": MODE,
    "purpose": PURPOSE,
}
PERIOD_TABLES = ("i94", "dates")
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
PERIOD_FILE = r"i94_([A-Za-z]{3})(\d{2})_sub"

# Tables that a published model keeps beside those above. Counts of rows per date: by the period of the fact, and in
# all by the period of the date. Sums of people by some keys of the fact, for queries that need no others. What a
# period's rows say of each column of the fact, in a form that can be added up; dates are days since 1970.
DATE_COUNTS = table("date DATE, rows LONG, year INT, month INT")
SUMS = {
    "sums_by_place": ("cit_country_id", "res_country_id", "state_id", "purpose_id"),
    "sums_by_kind": ("mode_id", "purpose_id", "visa_id"),
}
PROFILES = table(
    "field STRING, rows LONG, nulls LONG, total DOUBLE, squares DOUBLE, least DOUBLE, largest DOUBLE, "
    "least_text STRING, largest_text STRING, distinct BINARY, year INT, month INT"
)
# Keys of the fact that may be kept unique over all periods: digests of their values, and filters over these.
KEYS = ("cic_id",)
KEY_DIGESTS = table("field STRING, digest LONG, year INT, month INT")
KEY_FILTERS = table("field STRING, blocks LONG, block LONG, w0 LONG, w1 LONG, w2 LONG, w3 LONG, year INT, month INT")
KEPT_KEYS = {"key_digests": KEY_DIGESTS, "key_filters": KEY_FILTERS}
PUBLISHED_TABLES = MODEL_TABLES | KEPT_KEYS | {
    "date_counts": DATE_COUNTS, "date_totals": DATE_COUNTS, "profiles": PROFILES} | {
    name: StructType([FACT[c] for c in keys] + [*table("count LONG"), FACT["year"], FACT["month"]])
    for name, keys in SUMS.items()
}
PUBLISHED_PERIODS = (*PERIOD_TABLES, "date_counts", "date_totals", "profiles", *KEPT_KEYS, *SUMS)
