"""Sources and sinks (S1-S10): explicit schemas, Parquet at rest.

Nothing is inferred: the telemetry and request schemas are declared, and a
missing input path raises Spark's own PATH_NOT_FOUND error.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltwatch.functions.columns import as_timestamp, nan_to_null
from voltwatch.plans.featureset import TELEMETRY_SENSORS

D = T.DoubleType()

# The raw telemetry layout of the reference (13 columns).
TELEMETRY_SCHEMA = T.StructType(
    [T.StructField("Timestamp", T.TimestampNTZType(), False),
     T.StructField("Module_ID", T.StringType(), False),
     T.StructField("Rack_ID", T.StringType(), False)]
    + [T.StructField(c, D, True) for c in TELEMETRY_SENSORS]
    + [T.StructField("Hazard_Label", T.IntegerType(), False)]
)
EXPECTED_COLUMNS = [f.name for f in TELEMETRY_SCHEMA.fields]

# The 30 model features of a scoring request, in order.
FEATURES_30 = (
    list(TELEMETRY_SENSORS)
    + [f"Delta_1_{c}" for c in ("Module_Avg_Surface_Temp_C", "Module_Voltage_V", "Module_SoC_percent")]
    + [f"Rolling_{s}_{w}_{c}" for c in ("Module_Avg_Surface_Temp_C", "Module_Voltage_V", "Module_Current_A")
       for w in (6, 30, 60) for s in ("mean", "std")]
)
READING_SCHEMA = T.StructType([T.StructField("Module_ID", T.StringType(), True)]
                              + [T.StructField(c, D, True) for c in FEATURES_30])
REQUEST_SCHEMA = T.StructType([T.StructField("readings", T.ArrayType(READING_SCHEMA), True)])

# Text form of times in CSV: microseconds kept, fraction optional on read.
CSV_NTZ_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
CSV_TS_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]XXX"

LEDGER_SCHEMA = T.StructType([
    T.StructField("experiment", T.StringType()), T.StructField("run_id", T.StringType()),
    T.StructField("kind", T.StringType()), T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()), T.StructField("ts", T.TimestampNTZType())])


def read_telemetry(spark: SparkSession, path: str, schema: T.StructType | None = TELEMETRY_SCHEMA,
                   fmt: str = "parquet", time_col: str = "Timestamp") -> DataFrame:
    """S1 + C1: read with an explicit schema, make the time column a
    timestamp, and turn NaN into NULL in double columns.  CSV columns are
    found by the names in the header, in any order; a declared column that the
    file lacks is NULL, one that is not declared is left out, and files whose
    headers differ are an error."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        if schema is not None:
            declared = {f.name: f for f in schema.fields}
            names = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
            reader = spark.read.option("enforceSchema", False).schema(
                T.StructType([declared.get(n, T.StructField(n, T.StringType())) for n in names]))
        df = (reader.option("header", True).option("timestampNTZFormat", CSV_NTZ_FORMAT)
              .option("timestampFormat", CSV_TS_FORMAT).csv(path))
        if schema is not None:
            df = df.select(*[F.col(f"`{f.name}`") if f.name in names else F.lit(None).cast(f.dataType).alias(f.name)
                             for f in schema.fields])
    else:
        df = reader.format(fmt).load(path)
    if time_col in df.columns:
        df = as_timestamp(df, time_col)
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[nan_to_null(c, types[c]).alias(c) if isinstance(types[c], (T.DoubleType, T.FloatType))
                       else F.col(c) for c in df.columns])


def write_processed(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None,
                    sort_within=None, mode: str = "overwrite") -> None:
    """Write the table (optionally partitioned, e.g. by scenario and
    run, or by day for partition pruning), rows sorted inside each file."""
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        (w.option("header", True).option("timestampNTZFormat", CSV_NTZ_FORMAT)
         .option("timestampFormat", CSV_TS_FORMAT).csv(path))
    else:
        w.format(fmt).save(path)


def read_requests(spark: SparkSession, path: str, schema: T.StructType = REQUEST_SCHEMA,
                  array_col: str = "readings", keep=(), multi_line: bool = True) -> DataFrame:
    """Nested JSON requests to one row per reading with ``inline``.
    ``multi_line`` for one (pretty-printed) document per file, False for
    JSON lines."""
    df = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    return df.select(*keep, F.inline(F.col(array_col)))


#: Holds the text of a record that could not be parsed.
CORRUPT = "_vw_corrupt"


def with_corrupt(schema: T.StructType) -> T.StructType:
    """The schema of a permissive read, also of a stream (with ``CORRUPT_OPTIONS``)."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


CORRUPT_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def read_rescued(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json",
                 rules: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine) of JSON lines or of CSV with a header.

    A line that does not parse under the schema (cut off, wrong type, wrong
    number of fields) goes to quarantine with the reason ``malformed`` and its
    text in ``CORRUPT``, a parsed row that breaks a rule with the rule's name.
    The files are read once, into a checkpoint, so valid + quarantine are all
    lines whatever happens to the files in between.  A CSV header must name
    the schema's columns, in its order.
    """
    from voltwatch.operators import validate as V
    from voltwatch.plans.layout import materialize

    if fmt == "csv":
        df = (spark.read.schema(with_corrupt(schema)).options(**CORRUPT_OPTIONS).option("header", True)
              .option("timestampNTZFormat", CSV_NTZ_FORMAT).option("timestampFormat", CSV_TS_FORMAT).csv(path))
    elif fmt == "json":  # by line, because the JSON reader drops a line that holds an empty array
        lines = spark.read.text(path).where(F.trim("value") != "")
        parsed = lines.select("value", F.from_json("value", with_corrupt(schema), CORRUPT_OPTIONS).alias("r"))
        bad = F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull() | ~F.col("value").rlike(r"^\s*\{")
        df = parsed.select(*[F.when(~bad, F.col(f"r.{c}")).alias(c) for c in schema.names], F.when(bad, F.col("value")).alias(CORRUPT))
    else:
        raise ValueError(f"no rescue for {fmt}")
    df = materialize(df)
    every = {**V.well_formed(CORRUPT), **(rules or {})}
    # a malformed row breaks rules by its missing fields; only the cause is named
    reasons = V.failed_rules(every)
    tagged = df.withColumn("reasons", F.when(F.col(CORRUPT).isNotNull(), F.array(F.lit("malformed"))).otherwise(reasons))
    return tagged.where(F.size("reasons") == 0).drop("reasons", CORRUPT), tagged.where(F.size("reasons") > 0)


def empty_like(df: DataFrame) -> DataFrame:
    """An empty frame with the same schema."""
    return df.limit(0)


def ledger_rows(spark: SparkSession, experiment: str, run_id: str, params: dict | None = None,
                metrics: dict | None = None, tags: dict | None = None) -> DataFrame:
    """Long-form ledger rows for one run (driver-side values only:
    parameters, a handful of metrics, tags)."""
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    rows = []
    for kind, d in (("param", params), ("metric", metrics), ("tag", tags)):
        for k, v in (d or {}).items():
            rows.append((experiment, run_id, kind, str(k), None if v is None else str(v), now))
    return spark.createDataFrame(rows, LEDGER_SCHEMA)


def log_run(df: DataFrame, path: str) -> None:
    """Append ledger rows (partitioned by experiment)."""
    df.write.mode("append").partitionBy("experiment").parquet(path)


def metrics_to_ledger(metrics_long: DataFrame, experiment: str, run_id: str) -> DataFrame:
    """A (metric, value) frame from ``metrics.evaluate`` as ledger rows,
    without collecting it."""
    return metrics_long.select(
        F.lit(experiment).alias("experiment"), F.lit(run_id).alias("run_id"), F.lit("metric").alias("kind"),
        F.col("metric").alias("key"), F.col("value").cast("string").alias("value"),
        F.localtimestamp().alias("ts"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the session's shared checkpoint folder (never a
    machine-local temp folder)."""
    from voltwatch.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/voltwatch/{name}-{uuid.uuid4().hex[:12]}"
