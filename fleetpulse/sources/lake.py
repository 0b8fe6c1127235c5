"""The JSON lake of typed events and results.

Records are JSON lines with camelCase field names and instants as ISO-8601
text in UTC with milliseconds ("2020-01-01T00:00:00.000Z").  Schemas are
fixed (never inferred) and every field is required: a record with a missing
field, a wrong type or no valid instant fails the job, as the reference's
typed decoder does, whether or not the job uses that field.  Instants may have
0 to 9 fraction digits and any offset; they are kept in milliseconds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import DRIVER_STATS, LAKE_NAMES, TYPED_SCHEMA, lake_schema

# Folder of each record type under the lake root.
LAKE_DIRS = {"rated": "driver-rated", "tipped": "driver-tipped",
             "journey": "journey-finished", "stats": "stats"}
# Instants: written with millis and 'Z'; read in any ISO-8601 instant form.
WRITE_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"
INSTANT_PATTERN = r"^\d{4}-\d\d-\d\dT\d\d:\d\d(:\d\d([.]\d{1,9})?)?(Z|[+-]\d\d:\d\d)$"

SCHEMA_OF = dict(TYPED_SCHEMA, stats=DRIVER_STATS)


def lake_path(root: str, kind: str) -> str:
    return f"{root.rstrip('/')}/{LAKE_DIRS[kind]}"


def write_lake(df: DataFrame, path: str, kind: str, mode: str = "errorifexists") -> None:
    """Write rows of one record type (snake_case columns) as JSON lines."""
    cols = [F.col(f.name).alias(LAKE_NAMES[f.name]) for f in SCHEMA_OF[kind].fields]
    (df.select(*cols).write.mode(mode)
       .option("timestampFormat", WRITE_TS_FORMAT).option("timeZone", "UTC")
       .option("ignoreNullFields", "true")
       .json(path))


def read_lake(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """S3: read one record type back, snake_case columns, fixed schema.

    Lines are parsed once, whole (FAILFAST), and checked in one filter that names
    every field, so that column pruning cannot leave a field unchecked.  A
    JSON reader turns any value into text for a string field; the pattern on
    the line refuses such values.
    """
    schema = SCHEMA_OF[kind]
    names = [LAKE_NAMES[f.name] for f in schema.fields]
    instants = {LAKE_NAMES[f.name] for f in schema.fields if isinstance(f.dataType, T.TimestampType)}
    texts = [LAKE_NAMES[f.name] for f in schema.fields
             if isinstance(f.dataType, (T.StringType, T.TimestampType))]
    raw = T.StructType([T.StructField(n, T.StringType() if n in instants else f.dataType)
                        for n, f in zip(names, schema.fields)])
    r = F.from_json("value", raw, {"mode": "FAILFAST"})
    # The generator is a fence: without it the optimizer would put a from_json
    # into every field's check and into every column.
    lines = (spark.read.text(path).where(F.length(F.trim("value")) > 0)
             .select("value", F.explode(F.array(r)).alias("r")).select("value", "r.*"))
    not_text = F.col("value").rlike(r'"(' + "|".join(texts) + r')"\s*:\s*[^"\s]')
    bad = not_text
    for n in names:
        bad = bad | F.col(n).isNull()
        if n in instants:
            bad = bad | ~F.col(n).rlike(INSTANT_PATTERN) | F.col(n).try_cast("timestamp").isNull()
    checked = lines.where(F.when(F.coalesce(bad, F.lit(True)), F.raise_error(F.concat(
        F.lit(f"lake record of kind {kind} is not complete and well-typed: "), F.col("value"))).cast("boolean"))
        .otherwise(F.lit(True)))
    value = lambda n: (F.timestamp_millis(F.unix_millis(F.col(n).try_cast("timestamp")))
                       if n in instants else F.col(n))
    return checked.select(*[value(n).alias(f.name) for n, f in zip(names, schema.fields)])
