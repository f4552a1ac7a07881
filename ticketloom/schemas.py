"""Table schemas and conformance. Nested records, arrays and nullability are declared here once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {
    "STRING": T.StringType(),
    "INTEGER": T.LongType(),
    "FLOAT": T.DoubleType(),
    "TIMESTAMP": T.TimestampType(),
    "DATE": T.DateType(),
    "BOOLEAN": T.BooleanType(),
    "JSON": T.StringType(),
}


def from_config(fields: list[dict]) -> T.StructType:
    """Schema from field records ``{name, type, mode, fields}``; REPEATED gives arrays, ``fields`` nested records."""

    def build(field: dict) -> T.StructField:
        mode = field.get("mode", "NULLABLE").upper()
        kind = field["type"].upper()
        if field.get("fields"):
            base: T.DataType = T.StructType([build(f) for f in field["fields"]])
        elif kind in _TYPES:
            base = _TYPES[kind]
        else:
            raise ValueError(f"unknown type {kind} of field {field['name']}")
        if mode == "REPEATED" or kind == "REPEATED":
            base = T.ArrayType(base, containsNull=False)
        return T.StructField(field["name"], base, nullable=mode != "REQUIRED")

    return T.StructType([build(f) for f in fields])


def _schema(text: str) -> T.StructType:
    """``name TYPE!`` items, ``!`` marks a required column."""
    fields = []
    for item in text.split(","):
        name, kind = item.split()
        required = kind.endswith("!")
        kind = kind.rstrip("!")
        if kind == "VECTOR":
            fields.append(T.StructField(name, T.ArrayType(T.DoubleType(), containsNull=False), True))
        elif kind == "STRINGS":
            fields.append(T.StructField(name, T.ArrayType(T.StringType()), True))
        else:
            fields.append(T.StructField(name, _TYPES[kind], not required))
    return T.StructType(fields)


# The columns of the tables.
INCIDENTS = _schema(
    "number STRING!, sys_created_on TIMESTAMP!, description STRING, short_description STRING, business_service STRING"
)
TEAM_SERVICES = _schema(
    "business_service STRING!, TechCenter STRING!, TeamDepartment STRING, Area STRING, Unit STRING"
)
PREPROCESSED_INCIDENTS = _schema(
    "number STRING!, sys_created_on TIMESTAMP!, combined_incidents_summary STRING, embedding VECTOR,"
    "created_timestamp TIMESTAMP, processing_version STRING, business_service STRING, tech_center STRING"
)
TRAINING_DATA = _schema(
    "incident_number STRING!, tech_center STRING!, description_summary STRING, embedding VECTOR,"
    "training_version STRING!, created_timestamp TIMESTAMP!"
)
CLUSTER_RESULTS = _schema(
    "number STRING!, sys_created_on TIMESTAMP!, combined_incidents_summary STRING, tech_center STRING!,"
    "cluster_id INTEGER!, cluster_label STRING, cluster_description STRING, domain_id INTEGER, domain_name STRING,"
    "umap_x FLOAT, umap_y FLOAT, model_version STRING!, model_hash STRING!, prediction_timestamp TIMESTAMP!"
)
CLUSTERS = _schema(
    "cluster_id INTEGER!, tech_center STRING!, cluster_size INTEGER, representative_incidents STRINGS,"
    "cluster_keywords STRINGS, cluster_centroid VECTOR, cluster_description STRING, domain STRING,"
    "quality_score FLOAT, created_at TIMESTAMP"
)
VERSIONED_TRAINING_RESULTS = _schema(
    "incident_number STRING!, cluster_id INTEGER!, cluster_label STRING, domain_id INTEGER, domain_name STRING,"
    "umap_x FLOAT, umap_y FLOAT, tech_center STRING!, model_version STRING!, confidence_score FLOAT,"
    "created_timestamp TIMESTAMP!"
)
INCIDENT_PREDICTIONS = _schema(
    "incident_id STRING!, predicted_cluster_id INTEGER!, predicted_cluster_label STRING, confidence_score FLOAT,"
    "predicted_domain_id INTEGER, predicted_domain_name STRING, tech_center STRING!, prediction_timestamp TIMESTAMP!,"
    "model_table_used STRING, blob_model_path STRING"
)
MODEL_REGISTRY = _schema(
    "model_version STRING!, tech_center STRING!, model_type STRING!, training_data_start DATE!, training_data_end DATE!,"
    "blob_path STRING!, created_timestamp TIMESTAMP!, model_params JSON, cluster_count INTEGER, silhouette_score FLOAT,"
    "model_hash STRING, model_status STRING, training_date TIMESTAMP, updated_at TIMESTAMP, incidents_count INTEGER,"
    "metrics JSON"
)
TRAINING_CYCLES = _schema(
    "training_cycle_id STRING!, tech_center STRING!, tech_center_slug STRING!, training_month INTEGER!,"
    "training_year INTEGER!, training_completed_date TIMESTAMP!, umap_artifact_path STRING!,"
    "clusterer_artifact_path STRING!, metadata_artifact_path STRING!, cluster_results_table STRING!,"
    "embeddings_source_table STRING!, model_version STRING!, model_hash STRING!, clusters_count INTEGER,"
    "domains_count INTEGER, incidents_count INTEGER, silhouette_score FLOAT, noise_ratio FLOAT,"
    "training_status STRING!, error_message STRING, created_timestamp TIMESTAMP!"
)
TRAINING_LOGS = _schema(
    "run_id STRING!, timestamp TIMESTAMP!, pipeline_stage STRING, tech_center STRING, model_version STRING,"
    "log_level STRING!, message STRING!, details JSON"
)
WATERMARKS = _schema(
    "pipeline_name STRING!, tech_center STRING!, last_processed_timestamp TIMESTAMP, last_processed_id STRING,"
    "updated_at TIMESTAMP!"
)
RUN_LOG = _schema("run_id STRING!, stage STRING!, time_trigger TIMESTAMP!, preprocessed_rows INTEGER!, seconds FLOAT!")
RUN_WATERMARKS = _schema("preprocessed_rows INTEGER!, time_trigger TIMESTAMP!, run_details JSON")
PREDICTION_WATERMARKS = _schema(
    "tech_center STRING!, prediction_timestamp TIMESTAMP!, last_processed_incident_time TIMESTAMP,"
    "processed_incident_count INTEGER"
)
PROCESSING_FAILURES = _schema(
    "number STRING!, stage STRING!, error_class STRING, message STRING, tech_center STRING, time_trigger TIMESTAMP!"
)
ARTEFACTS = _schema(
    "tech_center STRING!, model_version STRING!, model_hash STRING!, kind STRING!, path STRING!,"
    "last_modified TIMESTAMP!, payload JSON"
)

ALL = {
    "incidents": INCIDENTS,
    "team_services": TEAM_SERVICES,
    "preprocessed_incidents": PREPROCESSED_INCIDENTS,
    "training_data": TRAINING_DATA,
    "cluster_results": CLUSTER_RESULTS,
    "clusters": CLUSTERS,
    "versioned_training_results": VERSIONED_TRAINING_RESULTS,
    "incident_predictions": INCIDENT_PREDICTIONS,
    "model_registry": MODEL_REGISTRY,
    "training_cycle_metadata": TRAINING_CYCLES,
    "training_logs": TRAINING_LOGS,
    "watermarks": WATERMARKS,
    "preprocessing_watermarks": RUN_WATERMARKS,
    "run_log": RUN_LOG,
    "prediction_watermarks": PREDICTION_WATERMARKS,
    "processing_failures": PROCESSING_FAILURES,
    "artefacts": ARTEFACTS,
}

PARTITIONS = {
    "cluster_results": ["model_version", "model_hash", "tech_center"],
    "versioned_training_results": ["model_version", "tech_center"],
    "training_data": ["training_version"],
    "training_cycle_metadata": ["model_version", "model_hash", "tech_center"],
    "model_registry": ["model_version", "model_hash", "tech_center"],
    "artefacts": ["model_version", "model_hash", "tech_center"],
}


def get(name: str) -> T.StructType:
    if name not in ALL:
        raise KeyError(f"no schema called {name!r}")
    return ALL[name]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bring a frame to a schema: missing columns are added (arrays empty, others null), others cast, extras dropped."""

    def column(field: T.StructField):
        if field.name in df.columns:
            return F.col(field.name).cast(field.dataType).alias(field.name)
        if isinstance(field.dataType, T.ArrayType):
            return F.array().cast(field.dataType).alias(field.name)
        return F.lit(None).cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in schema])


def required_violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows that lack a required value, with the names of the missing columns."""
    missing = F.array_compact(F.array(*[F.when(F.col(f.name).isNull(), f.name) for f in schema if not f.nullable]))
    return df.withColumn("missing", missing).where(F.size("missing") > 0)


def create_database(spark: SparkSession, database: str, retention_days: int = 730) -> None:
    """Create a database; the retention in days is kept as a property for the expiry job."""
    spark.sql(
        f"CREATE DATABASE IF NOT EXISTS {database} WITH DBPROPERTIES ('retention_days' = '{int(retention_days)}')"
    )


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    day_of: str | None = None,
    cluster_by: list[str] | None = None,
    buckets: int = 8,
) -> None:
    """Create a Parquet table if it is absent, partitioned by the day of a time column and bucketed on columns."""
    fields = list(schema)
    if day_of:
        fields = [*fields, T.StructField("dt", T.DateType(), True)]
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in fields
    )
    parts = " PARTITIONED BY (dt)" if day_of else ""
    clusters = f" CLUSTERED BY ({', '.join(cluster_by)}) INTO {int(buckets)} BUCKETS" if cluster_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{parts}{clusters}")


def create_all(spark: SparkSession, database: str) -> list[str]:
    """Create every table of the engine in a database."""
    create_database(spark, database)
    for name, schema in ALL.items():
        create_table(spark, f"{database}.{name}", schema)
    return sorted(ALL)
