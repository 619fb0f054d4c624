"""Plain files next to datasets: tables of several files, outside annotations, exports."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsvar.functions.naming import column
from obsvar.model import DatasetError
from obsvar.operators.collection import FILE, Collection, Part


def matching_files(spark: SparkSession, patterns: Sequence[str], extension: str = "") -> list[str]:
    """Paths matched by any of the globs (``*``, ``?``, ``[...]``), each once, sorted.

    The listing is Spark's own, on any file system it can read; no content is read.
    """
    found: set[str] = set()
    for pattern in patterns:
        try:
            rows = spark.read.format("binaryFile").load(pattern).select("path").collect()
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            rows = []
        found |= {r.path for r in rows}
    other = sorted(p for p in found if not p.endswith(extension))
    if other:
        raise DatasetError(f"matched files that are not {extension}: {', '.join(other[:5])}")
    if not found:
        raise DatasetError(f"No files found that match {', '.join(patterns)}")
    return sorted(found)


#: Footers that one task reads.
FOOTERS = 64


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The schema of each file as text, from its footer alone; null where only Spark can open it."""
    for batch in batches:
        found = []
        for uri in batch.column(0).to_pylist():
            try:
                system, path = pafs.FileSystem.from_uri(uri)
                schema = pq.read_schema(path, filesystem=system)
            except (OSError, pa.ArrowException, ImportError):
                found.append(None)
                continue
            kept = (schema.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata", b"").decode()
            found.append(f"{schema.remove_metadata().to_string(show_field_metadata=False)}\n{kept}")
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["path", "schema"])


def schema_texts(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """A text for each Parquet file that tells its schema; equal texts mean equal schemas.

    One job reads the footers, a group of files per task. Only files on a system that the Python
    workers cannot open are asked for one by one.
    """
    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths) // FOOTERS))
    found = {r.path: r.schema for r in listed.mapInArrow(_footers, "path string, schema string").collect()}
    return {p: text or spark.read.parquet(p).schema.json() for p, text in found.items()}


def read_tables(
    spark: SparkSession, patterns: Sequence[str] | str, renames: dict[str, dict[str, str]] | None = None
) -> Collection:
    """Parquet files as the ``obs`` tables of a collection: one part per distinct schema.

    ``renames`` gives, per file name, own column names to shared ones.
    """
    paths = matching_files(spark, [patterns] if isinstance(patterns, str) else patterns, ".parquet")
    seen = Counter(p.rsplit("/", 1)[-1] for p in paths)
    twice = sorted(n for n, k in seen.items() if k > 1)
    if twice:  # the file name is part of the key of every row
        raise DatasetError(f"several files are called {', '.join(twice[:5])}")
    grouped: dict[str, list[str]] = {}
    schemas = schema_texts(spark, paths)
    for path in paths:
        own = (renames or {}).get(path.rsplit("/", 1)[-1], {})
        grouped.setdefault(schemas[path] + repr(sorted(own.items())), []).append(path)
    parts = []
    for same in grouped.values():
        names = tuple(p.rsplit("/", 1)[-1] for p in same)
        rows = spark.read.parquet(*same).withColumnsRenamed((renames or {}).get(names[0], {}))
        parts.append(
            Part(rows.select(F.col("_metadata.file_name").alias(FILE), *map(column, rows.columns)), names)
        )
    members = tuple(sorted(n for p in parts for n in p.members))
    return Collection(members, {("obs", None): parts})


def export_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """The rows of any view as Parquet."""
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)


def read_annotation(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """An outside CSV table; the schema is given, never inferred by a scan.

    The header must name the schema's columns in order, and a row that does not fit it raises.
    """
    return spark.read.schema(schema).options(header=True, enforceSchema=False, mode="FAILFAST").csv(path)
