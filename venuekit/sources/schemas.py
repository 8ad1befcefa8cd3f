"""Read schemas.

Fixed values: the field names and types of the published input files.  Giving
them to the reader spares the extra pass that schema inference would make.
"""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_STR, _LONG, _DOUBLE = T.StringType(), T.LongType(), T.DoubleType()

# --- raw JSON lines -----------------------------------------------------------
RAW_BUSINESS = _struct(
    address=_STR,
    attributes=_STR,
    business_id=_STR,
    categories=_STR,
    city=_STR,
    hours=_STR,
    is_open=_LONG,
    latitude=_DOUBLE,
    longitude=_DOUBLE,
    name=_STR,
    postal_code=_STR,
    review_count=_LONG,
    stars=_DOUBLE,
    state=_STR,
)
RAW_PROVINCE = _struct(code=_STR)
RAW_REVIEW = _struct(
    review_id=_STR,
    user_id=_STR,
    business_id=_STR,
    date=_STR,
    stars=_DOUBLE,
    text=_STR,
    useful=_LONG,
)
RAW_CHECKIN = _struct(business_id=_STR, date=_STR)
RAW_USER = _struct(
    user_id=_STR,
    name=_STR,
    useful=_LONG,
    funny=_LONG,
    cool=_LONG,
    review_count=_LONG,
    yelping_since=_STR,
    average_stars=_DOUBLE,
)

# --- lexicon of the sentiment model ---------------------------------------------
LEXICON = _struct(token=_STR, valence=_DOUBLE)

# --- statistic files, after ``normalise_headers(squeeze=True)`` ----------------
LABOUR_COUNTS = (
    "TotalPopulation",
    "LabourForceCategory",
    "InLabourForce",
    "Unemployed",
    "NotinLabourForce",
)

# --- population groups of the ethnicity file -----------------------------------
POPULATION_GROUPS = (
    "Chinese",
    "South Asian",
    "Black",
    "Filipino",
    "Latin American",
    "Southeast Asian",
    "Arab",
    "West Asian",
    "Korean",
    "Japanese",
    "Not a Visible Minority",
)
