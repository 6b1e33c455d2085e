"""Table access: the driver's parquet tables, CSV tables with declared
schemas, temp-view registration, DDL-style tables with computed columns and
create-table-as-select."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table.  Parquet: the scan gets column pruning and
    predicate pushdown from whatever the caller selects and filters, and the
    splits the files have."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType | str,
                   sep: str = ",", header: bool = False, mode: str = "FAILFAST") -> DataFrame:
    """CSV file table with a declared schema (no inference).  FAILFAST is the
    reference's behaviour on a malformed number; PERMISSIVE gives NULLs."""
    return (spark.read.schema(schema).option("sep", sep).option("header", header)
            .option("mode", mode).csv(path))


def register(df: DataFrame, name: str) -> DataFrame:
    """``createTemporaryTable`` / ``tEnv.from``: name a DataFrame for SQL."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def checked(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Columns as declared: a NULL in a ``not null`` column and a text longer
    than its ``varchar`` or ``char`` fail the query (columns that a query does
    not use are pruned, and not checked)."""
    out = []
    for f in declared.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.VarcharType, T.CharType)):
            long = F.raise_error(F.concat(F.lit(f"{f.name}: longer than {f.dataType.length}: "), c)).cast("string")
            c = F.when(F.char_length(c) > f.dataType.length, long).otherwise(c)
        if not f.nullable:
            c = F.coalesce(c, F.raise_error(F.lit(f"{f.name}: null in a column declared not null")).cast(c_type(f)))
        out.append(c.alias(f.name))
    return df.select(*out)


def c_type(field: T.StructField) -> T.DataType:
    """The type a declared column has as data."""
    return T.StringType() if isinstance(field.dataType, (T.VarcharType, T.CharType)) else field.dataType


def create_csv_table_ddl(spark: SparkSession, name: str, path: str, columns: str,
                         computed: dict[str, str] | None = None,
                         watermark: tuple[str, str] | None = None,
                         stream: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """SQL DDL form of a CSV file table with computed columns.

    ``columns`` is a DDL column list (``"id varchar(20) not null, ts bigint, temperature double"``);
    declared lengths and ``not null`` are checked as lines are read (:func:`checked`),
    ``computed`` maps a new column to a SQL expression (``rt`` ->
    ``to_timestamp(from_unixtime(ts))``, ``pt`` -> ``current_timestamp()``).
    Batch: the raw table is declared with ``CREATE TEMPORARY VIEW ... USING
    csv`` and the computed columns are a projection view on top.  Stream
    (``stream=True``): the folder is read as a CSV file stream with the same
    schema, the computed columns are added and ``watermark`` (column, delay)
    is applied - the ``WATERMARK FOR rt AS rt - INTERVAL '1' SECOND`` clause.
    """
    declared = T.StructType.fromDDL(columns)
    plain = T.StructType([T.StructField(f.name, c_type(f)) for f in declared.fields])
    if stream:
        reader = spark.readStream.schema(plain).option("sep", ",").option("mode", "FAILFAST")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        df = checked(reader.csv(path), declared).selectExpr("*", *[f"{expr} AS {col}" for col, expr in (computed or {}).items()])
        if watermark:
            df = df.withWatermark(*watermark)
        df.createOrReplaceTempView(name)
        return df
    raw = f"{name}__raw"
    spark.sql(f"DROP VIEW IF EXISTS {raw}")
    listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.fields)
    spark.sql(f"CREATE TEMPORARY VIEW {raw} ({listed}) USING csv "
              f"OPTIONS (path '{path}', header 'false', mode 'FAILFAST')")
    df = checked(spark.table(raw), declared).selectExpr("*", *[f"{expr} AS {col}" for col, expr in (computed or {}).items()])
    df.createOrReplaceTempView(name)
    return df


def create_table_as_select(spark: SparkSession, name: str, query: str | DataFrame) -> DataFrame:
    """CTAS: materialise the query as parquet under the shared scratch
    folder and register it.  Later joins read the written table instead of
    recomputing the query (the lineage is cut)."""
    df = spark.sql(query) if isinstance(query, str) else query
    path = scratch_path(spark, f"ctas/{name}")
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    out.createOrReplaceTempView(name)
    return out
