"""Facts of files of any size as a Spark data source: size, content hash, Parquet signature, footer columns.

A file is streamed through the hash in blocks and its ends are read by offset, so a task holds one block, never a file. Files are
dealt by size. A path may be a file or a folder, local or of any store that pyarrow opens by its address.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Readers run in tasks; they travel with the job, so executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: the four bytes a Parquet file begins and ends with.
MAGIC = b"PAR1"
BLOCK_BYTES = 8 << 20
DEAL_BYTES = 256 << 20
SCHEMA = ("path string, bytes bigint, sha256 string, parquet_signature boolean, "
          "columns array<struct<name: string, type: string>>")
ARROW = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("sha256", pa.string()), ("parquet_signature", pa.bool_()),
                   ("columns", pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())])))])


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The store of a path and the path in it."""
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path.removeprefix("file:")


def listed(path: str) -> list[tuple[str, int]]:
    """Files at or below a path with their sizes; names that begin with ``.`` or ``_`` are a writer's own."""
    store, inner = opened(path)
    info = store.get_file_info(inner)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.is_file else store.get_file_info(pafs.FileSelector(inner, recursive=True))
    base = len(inner.rstrip("/"))
    shown = [f for f in found if f.is_file and (f is info or not any(p[:1] in (".", "_") for p in f.path[base:].split("/") if p))]
    return sorted((f.path, f.size) for f in shown)


def content_hash(file: pa.NativeFile, block_bytes: int) -> str:
    digest = hashlib.sha256()
    file.seek(0)
    while block := file.read(block_bytes):
        digest.update(block)
    return digest.hexdigest()


def footer_columns(file: pa.NativeFile) -> list[dict] | None:
    """Names and types by the footer, which alone is read; nothing if it is no Parquet footer."""
    try:
        schema = pq.ParquetFile(file).schema_arrow
    except (pa.ArrowInvalid, OSError):
        return None
    return [{"name": f.name, "type": str(f.type)} for f in schema]


@dataclass
class Deal(InputPartition):
    files: tuple[tuple[str, int], ...]


class FactsReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.wanted = set(options.get("facts", "hash,columns").split(","))
        self.block_bytes = int(options.get("block_bytes", BLOCK_BYTES))
        self.deal_bytes = int(options.get("deal_bytes", DEAL_BYTES))

    def partitions(self) -> list[Deal]:
        """Runs of files of about ``deal_bytes``; a larger file is a partition of its own."""
        deals, now, held = [], [], 0
        for file in listed(self.path):
            if now and held + file[1] > self.deal_bytes:
                deals.append(Deal(tuple(now)))
                now, held = [], 0
            now.append(file)
            held += file[1]
        return [*deals, Deal(tuple(now))] if now or not deals else deals

    def read(self, partition: Deal) -> Iterator[pa.RecordBatch]:
        store, _ = opened(self.path)
        for path, size in partition.files:
            with store.open_input_file(path) as file:
                ends = size >= 2 * len(MAGIC) and (file.read_at(len(MAGIC), 0), file.read_at(len(MAGIC), size - len(MAGIC)))
                columns = footer_columns(file) if "columns" in self.wanted else None
            sha256 = None
            if "hash" in self.wanted:
                with store.open_input_file(path) as file:
                    sha256 = content_hash(file, self.block_bytes)
            row = {"path": path, "bytes": size, "sha256": sha256, "parquet_signature": ends == (MAGIC, MAGIC), "columns": columns}
            yield pa.RecordBatch.from_pylist([row], ARROW)


class FileFacts(DataSource):
    @classmethod
    def name(cls) -> str:
        return "file_facts"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FactsReader:
        return FactsReader(dict(self.options))


def file_facts(spark: SparkSession, path: str, facts: str = "hash,columns", block_bytes: int = BLOCK_BYTES,
               deal_bytes: int = DEAL_BYTES) -> DataFrame:
    """One row per file at or below ``path``; ``facts`` says whether contents are hashed and footers read."""
    spark.dataSource.register(FileFacts)
    options = {"path": path, "facts": facts, "block_bytes": str(block_bytes), "deal_bytes": str(deal_bytes)}
    return spark.read.format("file_facts").options(**options).load()


def file_fingerprint(spark: SparkSession, path: str, min_bytes: int = 12, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Hash, size and Parquet signature per file, files of any size."""
    return file_facts(spark, path, "hash", block_bytes).select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"), "bytes", "sha256", "parquet_signature",
        (F.col("bytes") >= min_bytes).alias("large_enough"))


# --- schema drift ------------------------------------------------------------

# Fixed value: how a monthly trip file, or a folder of one period, is named.
NAMED_PERIOD = r"(?i)(?:(yellow|green|fhvhv|fhv)_tripdata_(\d{4})-(\d{2})\.parquet)|(?:service=(\w+)/year=(\d+)/month=(\d+))"


def canonical_columns(columns: Column) -> Column:
    """``name:type`` of each column in the order of names; names that differ in case only are one."""
    return F.array_sort(F.transform(columns, lambda c: F.concat(F.lower(c["name"]), F.lit(":"), c["type"])))


def schema_hash(columns: Column) -> Column:
    """Hash of a schema that neither the order of its columns nor the case of their names changes."""
    return F.sha2(F.concat_ws("\n", canonical_columns(columns)), 256)


def file_schemas(facts: DataFrame) -> DataFrame:
    """service, year, month, path, schema_hash and columns (``name:type``) of each trip file whose footer can be read."""
    def part(group: int) -> Column:
        return F.coalesce(*[F.nullif(F.regexp_extract("path", NAMED_PERIOD, g), F.lit("")) for g in (group, group + 3)])

    return facts.filter("columns is not null").select(
        F.lower(part(1)).alias("service"), part(2).try_cast("int").alias("year"), part(3).try_cast("int").alias("month"), "path",
        schema_hash(F.col("columns")).alias("schema_hash"), canonical_columns(F.col("columns")).alias("columns"),
    ).filter("service is not null and year is not null and month is not null")


def schema_history(schemas: DataFrame) -> DataFrame:
    """The periods in which a service's schema changes, its first one among them, with what came, went and changed type.

    Files are first brought together by period and schema, so the window orders a service's periods, not its files. Where one
    period has several schemas they follow each other by hash, and ``schemas_in_period`` tells how many there are.
    """
    each = schemas.groupBy("service", "year", "month", "schema_hash").agg(F.first("columns").alias("columns"), F.count("*").alias("files"))
    in_order = Window.partitionBy("service").orderBy("year", "month", "schema_hash")
    in_period = Window.partitionBy("service", "year", "month")

    def names(columns: str) -> Column:
        return F.transform(columns, lambda c: F.regexp_extract(c, r"^(.*?):", 1))

    def of_names(columns: str, wanted: Column) -> Column:
        return F.filter(columns, lambda c: F.array_contains(wanted, F.regexp_extract(c, r"^(.*?):", 1)))

    before = each.withColumns({
        "schemas_in_period": F.count("*").over(in_period), "previous_hash": F.lag("schema_hash").over(in_order),
        "previous": F.coalesce(F.lag("columns").over(in_order), F.array().cast("array<string>"))})
    changed = before.filter(~F.col("schema_hash").eqNullSafe(F.col("previous_hash")))
    both = F.array_intersect(names("previous"), names("columns"))
    return changed.select(
        "service", "year", "month", "files", "schemas_in_period", "schema_hash", "previous_hash",
        F.size("columns").alias("n_columns"), F.array_except(names("columns"), names("previous")).alias("added"),
        F.array_except(names("previous"), names("columns")).alias("removed"),
        F.array_except(of_names("columns", both), F.col("previous")).alias("retyped"))
