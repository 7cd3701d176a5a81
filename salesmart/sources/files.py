"""File sources and sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"


def load_table(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    """Header CSV read with an explicit schema; malformed rows keep their text in ``_corrupt``."""
    with_corrupt = T.StructType([*contract.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(with_corrupt).options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT).csv(path)


def write_partitioned(df: DataFrame, path: str, by: list[str]) -> None:
    """Partitioned Parquet write that replaces only the partitions it touches.

    ``rebalance`` gathers each partition value into few files and lets adaptive
    execution split a value that holds much of the data over several tasks.
    """
    missing = [b for b in by if b not in df.columns]
    if missing:
        raise ValueError(f"partition columns not in the frame: {missing}")
    (
        df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by).parquet(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def listing(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of what lies directly in a folder: it changes when a table there is replaced or gets files."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in found))


def folder_numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the folders below ``path`` named ``prefix`` and a number, ascending."""
    if not path_exists(spark, path):
        return []
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)]
    return sorted(int(n[len(prefix) :]) for n in names if n.startswith(prefix) and n[len(prefix) :].isdigit())


def schema_drift(spark: SparkSession, found: T.StructType, contract: T.StructType, dataset: str) -> DataFrame:
    """Contract differences by name and type; the rows come from two schemas, not from data."""
    have = {f.name: f.dataType.simpleString() for f in found.fields}
    want = {f.name: f.dataType.simpleString() for f in contract.fields}
    rows = [(dataset, "missing_column", n, want[n], None) for n in want if n not in have]
    rows += [(dataset, "extra_column", n, None, have[n]) for n in have if n not in want]
    rows += [(dataset, "type_drift", n, want[n], have[n]) for n in want if n in have and want[n] != have[n]]
    return spark.createDataFrame(rows, "dataset string, check string, column_name string, expected string, found string")


def first_available(spark: SparkSession, key: str, candidates: list[tuple[str, str]]) -> tuple[DataFrame | None, dict]:
    """First existing ``(layer, path)`` of the candidates, with where it came from."""
    for layer, path in candidates:
        if path_exists(spark, path):
            return spark.read.parquet(path), {"key": key, "file": path.rsplit("/", 1)[-1], "layer": layer, "status": "loaded"}
    return None, {"key": key, "file": None, "layer": None, "status": "file_missing"}


def source_catalog(spark: SparkSession, sources: dict[str, list[tuple[str, str]]]) -> DataFrame:
    """Provenance table (key, file, layer, status, rows) over several sources."""
    parts = []
    for key, candidates in sources.items():
        df, origin = first_available(spark, key, candidates)
        columns = [F.lit(v).cast("string").alias(k) for k, v in origin.items()]
        if df is None:
            parts.append(spark.range(1).select(*columns, F.lit(0).cast("long").alias("rows")))
        else:
            parts.append(df.agg(F.count("*").alias("rows")).select(*columns, "rows"))
    return reduce(DataFrame.unionByName, parts)


def export_columns(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, so that any frame fits a flat file."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema.fields])


def export_dataset(datasets: dict[str, DataFrame], name: str, order: list[str], cap: int = 25_000) -> DataFrame:
    """A named, allow-listed dataset in export form, the first ``cap`` rows in order."""
    if name not in datasets:
        raise ValueError(f"unknown dataset {name}")
    return export_columns(datasets[name]).orderBy(*order).limit(cap)
