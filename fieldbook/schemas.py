"""Fixed schemas of the catalogue entities.

Types are settled once here and applied on read (``spark.read.schema``) or by
``load.conform``; incoming payloads never decide a column's type.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The strain identity columns, in the order of the compared tuple.
STRAIN_KEYS = [
    "bcs_code",
    "sp_code",
    "strain_name",
    "scientific_name",
    "vendor_name",
    "genus_species",
    "amt_of_active_ingredients",
    "formulation_type",
    "physical_state",
    "formulated_or_wholebroth",
    "product_type",
    "synonyms",
    "ncbi_id",
    "chem_catlg_id",
    "mo_catlg_id",
    "requestor_cwid",
    "strain_alias",
]

# Fields of one element of the nested ``formulation`` array.
FORMULATION_FIELDS = [
    "amt_of_active_ingredients",
    "formulation_type",
    "physical_state",
    "formulated_or_wholebroth",
    "product_type",
]

AUDIT_COLUMNS = ["created_date", "last_updated_timestamp"]

STRAIN_BATCH = T.StructType([T.StructField(c, T.StringType(), True) for c in STRAIN_KEYS])

STRAIN_TABLE = T.StructType(
    [T.StructField("id", T.LongType(), True)]
    + [T.StructField(c, T.StringType(), True) for c in STRAIN_KEYS]
    + [
        T.StructField("created_date", T.DateType(), True),
        T.StructField("last_updated_timestamp", T.TimestampNTZType(), True),
    ]
)

_PARENT_FIELDS = [c for c in STRAIN_KEYS if c not in FORMULATION_FIELDS]

STRAIN_NESTED = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in _PARENT_FIELDS]
    + [
        T.StructField(
            "formulation",
            T.ArrayType(T.StructType([T.StructField(f, T.StringType(), True) for f in FORMULATION_FIELDS])),
            True,
        )
    ]
)

OBSERVATION = T.StructType([
    T.StructField("product_id", T.LongType(), True),
    T.StructField("product_name", T.StringType(), True),
    T.StructField("pest_name", T.StringType(), True),
    T.StructField("observation_name", T.StringType(), True),
    T.StructField("observation_value", T.DoubleType(), True),
    T.StructField("observation_unit", T.StringType(), True),
    T.StructField("date_created", T.DateType(), True),
    T.StructField("date_expired", T.DateType(), True),
])

RUN_LOG = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType(), True),
    T.StructField("file_path", T.StringType(), True),
    T.StructField("rows_loaded", T.LongType(), True),
    T.StructField("error_message", T.StringType(), True),
])

# The placeholder master schema of the truncate-and-load job.
MASTER_SCHEMA = T.StructType([
    T.StructField("col1", T.StringType(), True),
    T.StructField("col2", T.LongType(), True),
])

USER_ACCESS = T.StructType([
    T.StructField("CWID", T.StringType(), True),
    T.StructField("user_name", T.StringType(), True),
    T.StructField("email", T.StringType(), True),
    T.StructField("access_group", T.StringType(), True),
])

# The four comma-list columns of a raw document and the
# dimension each one feeds (column -> (dimension, name column, id column)).
DOCUMENT_LISTS = {
    "Product_names": ("Product", "Product_Name", "Product_ID"),
    "crop": ("Crop", "Crop_Name", "Crop_ID"),
    "Diseases": ("Disease", "Disease_Name", "Disease_ID"),
    "pest": ("Pest", "Pest_Name", "Pest_ID"),
}

# The bridge tables (name, list a, list b, id column).
BRIDGES = [
    ("productcrop", "Product_names", "crop", "product_crop_ID"),
    ("productdisease", "Product_names", "Diseases", "product_disease_ID"),
    ("productpest", "Product_names", "pest", "product_pest_ID"),
]

# Document columns the document-details query returns.
DOCUMENT_DETAIL_COLUMNS = [
    "Title",
    "Filetype",
    "Modified",
    "Year",
    "Country",
    "Classification",
    "Category_for_one_page",
    "Application_type",
    "Path",
    "Filesize",
    "Language",
]
