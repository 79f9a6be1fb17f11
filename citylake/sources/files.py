"""Files as Spark lists them and Arrow opens them."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Hadoop's names of stores, and what Arrow calls them; Databricks mounts its store as /dbfs.
SCHEMES = {"s3a": "s3", "s3n": "s3", "viewfs": "hdfs"}
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


def arrow_uri(uri: str) -> str:
    """A Hadoop URI as Arrow reads it."""
    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme:
        return uri
    if scheme in ("file", "dbfs"):
        path = "/" + rest.lstrip("/")
        return f"file:///dbfs{path}" if scheme == "dbfs" else f"file://{path}"
    return f"{SCHEMES.get(scheme, scheme)}:{rest}"


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI that all machines can reach."""
    found = arrow_uri(uri)
    if found.startswith("file://"):  # Spark escapes what a URI may not hold
        return fs.LocalFileSystem(), unquote(found.removeprefix("file://"))
    return (fs.LocalFileSystem(), found) if found.startswith("/") else fs.FileSystem.from_uri(found)


def parquet_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the Parquet files below a folder; no file is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return reader.load(path).select("path", "length")


def with_schemas(files: DataFrame) -> DataFrame:
    """`files` (path, length) with the schema that each footer states, as Spark's JSON.

    Footers are read by tasks, a file at a time; a file that Spark did not write gets the schema
    that Arrow sees in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import parquet
        from pyspark.sql.pandas.types import from_arrow_schema

        for batch in batches:
            schemas = []
            for uri in batch.column(0).to_pylist():
                system, name = opened(uri)
                found = parquet.read_schema(name, filesystem=system)
                known = (found.metadata or {}).get(SPARK_SCHEMA)
                schemas.append(known.decode() if known else from_arrow_schema(found).json())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(schemas, pa.string())], ["path", "length", "schema"])

    spread = files.repartition(F.xxhash64("path"))
    return spread.mapInArrow(run, "path string, length long, schema string")


def schema_groups(spark: SparkSession, path: str) -> list[tuple[T.StructType, list[str]]]:
    """Distinct schemas below a folder and the files of each, in order of the schema.

    The driver receives one name per file, as for any scan, and each distinct schema once."""
    import json

    named = with_schemas(parquet_files(spark, path)).groupBy("schema").agg(F.array_sort(F.collect_list("path")).alias("paths"))
    rows = named.orderBy("schema").collect()
    return [(T.StructType.fromJson(json.loads(r["schema"])), r["paths"]) for r in rows]
