"""Scans and sinks: CSV, Parquet, JSON, catalog tables, fitted models.

All readers are lazy.  CSV is read with an explicit schema where one is given: with
``DROPMALFORMED`` Spark's column pruning skips parsing, so ``count()`` and
``collect()`` can disagree.  Malformed rows are therefore kept in a corrupt-record
column under ``PERMISSIVE`` (wrong field counts) and every field is read as text and
validated with ``try_cast`` by a predicate that references all columns - so no
pruning can skip the check and every action sees the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

_CORRUPT = "_corrupt_record"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    header: bool = True,
    drop_malformed: bool = True,
    **options,
) -> DataFrame:
    """CSV with a header (S1).  Without ``schema`` the types are inferred (one extra job)."""
    reader = spark.read.option("header", header)
    for k, v in options.items():
        reader = reader.option(k, v)
    if schema is None:
        # infer first, then take the validated path: every action sees the same rows
        schema = reader.option("inferSchema", True).csv(path).schema
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if not drop_malformed:
        return reader.schema(schema).option("mode", "FAILFAST").csv(path)
    # Every field is read as text and validated explicitly: the predicate references
    # every column, so no pruning can skip the parse and all actions agree.
    as_text = StructType(
        [StructField(f.name, StringType(), True) for f in schema.fields] + [StructField(_CORRUPT, StringType(), True)]
    )
    raw = (
        reader.schema(as_text)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .csv(path)
    )
    ok = F.col(_CORRUPT).isNull()
    typed = []
    for f in schema.fields:
        if isinstance(f.dataType, StringType):
            typed.append(F.col(f.name))
            continue
        cast = F.col(f.name).try_cast(f.dataType)
        ok = ok & (F.col(f.name).isNull() | cast.isNotNull())
        typed.append(cast.alias(f.name))
    return raw.where(ok).select(*typed)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", header: bool = True) -> None:
    """CSV sink (S2); unlike the original the header row is written."""
    df.write.option("header", header).mode(mode).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table (S3); lazy, so later filters and projections reach the scan.

    A writer that stopped between the two renames of an overwrite leaves the table under
    ``<name>__old``: readers go on with that whole version until the next write mends it."""
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(f"{name}__old"):
        return spark.table(f"{name}__old")
    return spark.table(name)


def recover_table(spark: SparkSession, name: str) -> None:
    """Finish an overwrite that stopped half-way: the old version gets its name back."""
    old = f"{name}__old"
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(old):
        spark.sql(f"ALTER TABLE {old} RENAME TO {name}")


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by=None,
    bucket_by: tuple[int, list[str]] | None = None,
) -> None:
    """Catalog sink.

    Overwriting a table that ``df`` itself reads fails in Spark, so an overwrite goes
    through ``<name>__stage`` followed by two renames and a drop.  ``bucket_by=(n, cols)``
    writes a bucketed table so later joins on ``cols`` need no shuffle.
    """
    spark = df.sparkSession
    old = f"{name}__old"
    # After a stop between the renames ``df`` may read the old version: it stays until the end.
    stopped = not spark.catalog.tableExists(name) and spark.catalog.tableExists(old)
    exists = stopped or spark.catalog.tableExists(name)
    if stopped and mode != "overwrite":
        recover_table(spark, name)
    target = f"{name}__stage" if (exists and mode == "overwrite") else name
    w = df.write.mode("overwrite" if target != name else mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if bucket_by:
        n, cols = bucket_by
        w = w.bucketBy(n, *cols).sortBy(*cols)
    w.saveAsTable(target)
    if target != name:
        # the old table keeps existing under another name until the new one has its place
        if not stopped:
            spark.sql(f"DROP TABLE IF EXISTS {old}")
            spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
        try:
            spark.sql(f"ALTER TABLE {target} RENAME TO {name}")
        except Exception:
            recover_table(spark, name)
            raise
        spark.sql(f"DROP TABLE {old}")


_READERS = {
    "csv": lambda spark, path, schema: read_csv(spark, path, schema=schema),
    "parquet": lambda spark, path, schema: read_parquet(spark, path),
    "json": lambda spark, path, schema: read_json(spark, path, schema=schema),
}


def file_to_table(spark: SparkSession, kind: str, path: str, table: str, schema=None) -> DataFrame:
    """Load a file into a catalog table (S5); unknown kinds are an error."""
    if kind not in _READERS:
        raise ValueError(f"unsupported file type {kind!r}; expected one of {sorted(_READERS)}")
    df = _READERS[kind](spark, path, schema)
    write_table(df, table)
    return spark.table(table)


def save_model(model, path: str) -> None:
    """Persist an estimator / fitted model (S7); overwrites."""
    model.write().overwrite().save(path)


def load_model(path: str):
    """Load what ``save_model`` wrote: a fitted model or pipeline, or an unfitted estimator."""
    from pyspark import SparkContext
    from pyspark.ml.util import DefaultParamsReader

    return DefaultParamsReader.loadParamsInstance(path, SparkContext.getOrCreate())
