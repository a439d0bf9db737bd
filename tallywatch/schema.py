"""Record layouts shared by batch and streaming jobs."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import types as T

# --- Fixed values: names on the wire, in wire order ---------------------------------------------
COMMON_FIELDS = ("source", "timestamp")

UK_FIELDS = (
    "category", "location_type", "location", "context", "outcome_status",
    "persistent_id", "id", "location_subtype", "month", "location_name",
)

CHICAGO_FIELDS = (
    "case_number", "date", "block", "iucr", "primary_type", "description",
    "location_description", "arrest", "domestic", "beat", "district", "ward",
    "community_area", "fbi_code", "x_coordinate", "y_coordinate", "latitude", "longitude",
)

NYC_FIELDS = (
    "cmplnt_num", "cmplnt_fr_dt", "cmplnt_fr_tm", "cmplnt_to_dt", "cmplnt_to_tm",
    "addr_pct_cd", "rpt_dt", "ky_cd", "ofns_desc", "pd_cd", "pd_desc",
    "crm_atpt_cptd_cd", "law_cat_cd", "boro_nm",
)

LA_FIELDS = (
    "dr_no", "date_rptd", "date_occ", "time_occ", "area", "area_name", "rpt_dist_no",
    "crm_cd", "crm_cd_desc", "status", "status_desc", "weapon_used_cd", "weapon_desc",
    "mocodes", "vict_age", "vict_sex", "vict_descent", "premis_cd", "premis_desc",
    "cross_street",
)

MAP_FIELDS = ("location", "outcome_status")

TOPIC = "crime-incidents"

# Coordinates polled for the UK source, and the place each one stands for.
CITIES = (
    (Decimal("51.5074"), Decimal("-0.1278"), "London"),
    (Decimal("52.4862"), Decimal("-1.8904"), "Birmingham"),
    (Decimal("53.4808"), Decimal("-2.2426"), "Manchester"),
    (Decimal("55.9533"), Decimal("-3.1883"), "Edinburgh"),
    (Decimal("53.8008"), Decimal("-1.5491"), "Leeds"),
)
UNKNOWN_CITY = "Unknown"
# --- End of fixed values ------------------------------------------------------------------------

MODEL_NAME = "hourly-anomalies"


@dataclass(frozen=True)
class Source:
    """Where one agency keeps the values that all agencies share."""

    name: str
    type_field: str
    place_field: str
    id_field: str
    date_field: str


UK = Source("uk_police", "category", "location_name", "id", "month")
CHICAGO = Source("chicago", "primary_type", "district", "case_number", "date")
NYC = Source("nyc", "ofns_desc", "boro_nm", "cmplnt_num", "cmplnt_fr_dt")
LA = Source("la", "crm_cd_desc", "area_name", "dr_no", "date_rptd")

SOURCES = (UK, CHICAGO, NYC, LA)
SOURCE_NAMES = tuple(s.name for s in SOURCES)


def _field(name: str) -> T.StructField:
    if name == "timestamp":
        # Seconds since the epoch; long, so that instants after January 2038 survive.
        return T.StructField(name, T.LongType())
    if name in MAP_FIELDS:
        return T.StructField(name, T.MapType(T.StringType(), T.StringType()))
    return T.StructField(name, T.StringType())


ENVELOPE = T.StructType(
    [_field(n) for n in COMMON_FIELDS + UK_FIELDS + CHICAGO_FIELDS + NYC_FIELDS + LA_FIELDS]
)

# What the unified records need. Spark parses every field of the schema it is handed, so jobs that
# never touch the rest hand over this one.
NARROW_ENVELOPE = T.StructType(
    [_field(n) for n in COMMON_FIELDS]
    + [_field(f) for s in SOURCES for f in (s.type_field, s.place_field)]
)

# What tells records apart.
ID_ENVELOPE = T.StructType([_field(n) for n in (*COMMON_FIELDS, *(s.id_field for s in SOURCES))])

CITY_SCHEMA = T.StructType(
    [
        T.StructField("lat", T.DecimalType(9, 4)),
        T.StructField("lng", T.DecimalType(9, 4)),
        T.StructField("city", T.StringType()),
    ]
)

HOURLY_KEY = ("window_start", "source", "location_name", "crime_type")

HOURLY = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("source", T.StringType()),
        T.StructField("location_name", T.StringType()),
        T.StructField("crime_type", T.StringType()),
        T.StructField("incident_count", T.LongType()),
    ]
)

SCORE_REQUEST = T.StructType(
    [
        T.StructField("request_id", T.LongType()),
        T.StructField("location_name", T.StringType()),
        T.StructField("crime_type", T.StringType()),
        T.StructField("incident_count", T.LongType()),
        T.StructField("additional_features", T.MapType(T.StringType(), T.DoubleType())),
    ]
)

# Requests as they are written: a number may come as text, and what is no number must not cost the whole field.
SCORE_REQUEST_TEXT = T.StructType(
    [
        T.StructField("request_id", T.LongType()),
        T.StructField("location_name", T.StringType()),
        T.StructField("crime_type", T.StringType()),
        T.StructField("incident_count", T.StringType()),
        T.StructField("additional_features", T.MapType(T.StringType(), T.StringType())),
    ]
)

SCORED = T.StructType(
    [
        T.StructField("location_name", T.StringType()),
        T.StructField("crime_type", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("incident_count", T.LongType()),
        T.StructField("anomaly_score", T.DoubleType()),
        T.StructField("is_anomaly", T.BooleanType()),
    ]
)
