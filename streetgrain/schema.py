"""Fixed schemas and vocabularies of the address data model."""

from pyspark.sql import types as T

# The canonical address columns, in output order.
ADDRESS_COLUMNS = [
    "LON", "LAT", "NUMBER", "STREET", "UNIT", "CITY",
    "DISTRICT", "REGION", "POSTCODE", "ID", "HASH",
]

ADDRESS_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ADDRESS_COLUMNS])

# Reserved column names of extracted source rows.
X_COLUMN = "OA:x"
Y_COLUMN = "OA:y"
GEOM_COLUMN = "OA:geom"
SOURCE_COLUMN = "OA:Source"

# Attribute tags a conform specification may set.
ATTRIBUTES = ["street", "number", "unit", "city", "postcode", "district", "region", "id"]

# Keys allowed in the state document of a run.
RUN_STATE_KEYS = [
    "source", "cache", "sample", "geometry type", "address count", "version",
    "fingerprint", "cache time", "processed", "output", "process time",
    "website", "skipped", "license", "share-alike", "attribution required",
    "attribution name", "attribution flag", "process hash", "preview",
    "slippymap", "source problem", "code version", "tests passed", "run id",
]

# Columns of the published run table, in output order.
STATE_TABLE_COLUMNS = [
    "source", "cache", "sample", "geometry type", "address count", "version",
    "fingerprint", "cache time", "processed", "process time", "process hash",
    "output", "attribution required", "attribution name", "share-alike",
    "code version",
]

# Published collection names and licence classes.
COLLECTIONS = [
    "global", "us_northeast", "us_midwest", "us_south", "us_west",
    "europe", "asia", "south_america", "north_america",
]
LICENSE_CLASSES = {"": "Freely Shareable", "sa": "Share-Alike Required"}


def state_column(key: str) -> str:
    """Column name for a state key: blanks and dashes become underscores."""
    return key.replace(" ", "_").replace("-", "_")
