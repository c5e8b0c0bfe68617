"""Column names, types and rule constants shared by the three layers.

Operators take column names as parameters; these are the visit-domain defaults.
"""

from pyspark.sql import types as T

# The visit record, in file order (delimited files bind by position).
VISIT_SCHEMA = T.StructType(
    [
        T.StructField("patient_id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("diagnosis", T.StringType()),
        T.StructField("visit_date", T.DateType()),
        T.StructField("billing_amount", T.DoubleType()),
    ]
)

# Columns each layer adds to the one below.
LOADED_AT = "ingestion_timestamp"
SOURCE_FILE = "source_file"
SILVER_AT = "silver_processed_timestamp"
GOLD_AT = "gold_processed_timestamp"

BRONZE_SCHEMA = T.StructType(
    VISIT_SCHEMA.fields
    + [
        T.StructField(LOADED_AT, T.TimestampType()),
        T.StructField(SOURCE_FILE, T.StringType()),
    ]
)
SILVER_SCHEMA = T.StructType(BRONZE_SCHEMA.fields + [T.StructField(SILVER_AT, T.TimestampType())])

# Cleaning rules.
FILL_DEFAULTS = {"billing_amount": 0.0, "age": 0, "diagnosis": "Unknown", "name": "Unknown"}
AGE_RANGE = (0, 150)
REQUIRED_FIELDS = ("patient_id", "name", "diagnosis", "visit_date")
