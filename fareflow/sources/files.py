"""Readers: trip files, reference CSV, event logs, manifests and file facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.functions.clean import resolve
from fareflow.session import prepare
from fareflow.spec import AIRPORT_ZONES

# Fixed value: how a monthly trip file is named.
TRIP_FILE = r"(?i)(yellow|green|fhv|fhvhv)_tripdata_(\d{4})-(\d{2})\.parquet"


def scan_trips(spark: SparkSession, *paths: str) -> DataFrame:
    """All monthly files at once; the period comes from the file (or folder) name, record order from the file.

    ``source_record`` is unique per row and sorts in file order.
    """
    raw = prepare(spark).read.parquet(*paths)
    path, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    return raw.select(
        "*",
        F.lower(F.regexp_extract(path, TRIP_FILE, 1)).alias("source_service"),
        F.regexp_extract(path, TRIP_FILE, 2).try_cast("int").alias("source_year"),
        F.regexp_extract(path, TRIP_FILE, 3).try_cast("int").alias("source_month"),
        F.regexp_extract(path, TRIP_FILE, 0).alias("source_file"),
        F.concat_ws(":", path, F.lpad(row.cast("string"), 15, "0")).alias("source_record"),
    )


def scan_partitioned(spark: SparkSession, root: str, predicate: Column | None = None) -> DataFrame:
    """Hive-partitioned dataset; a filter on partition columns prunes whole folders."""
    df = spark.read.option("basePath", root).parquet(root)
    return df if predicate is None else df.filter(predicate)


def scan_union_by_name(spark: SparkSession, root: str) -> DataFrame:
    """Every file of a dataset, columns merged by name across files."""
    return spark.read.option("mergeSchema", True).option("basePath", root).parquet(root)


def empty_like(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], df.schema)


def _named(df: DataFrame, aliases: Sequence[str], required: bool = False) -> Column:
    spaced = {c.replace(" ", "_"): c for c in df.columns}
    found = resolve(spaced, [a.replace(" ", "_") for a in aliases])
    if required and found is None:
        raise ValueError(f"no column {aliases[0]} among {df.columns}")
    return F.lit(None).cast("string") if found is None else F.trim(F.col(f"`{spaced[found]}`"))


def _one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key, the smallest by all other columns, so a rerun keeps the same row."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row")).select(key, "_row.*")


def reference_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV, every column as text."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def normalize_zones(raw: DataFrame) -> DataFrame:
    picked = raw.select(
        _named(raw, ["LocationID", "location_id"], True).try_cast("int").alias("location_id"),
        _named(raw, ["Borough"], True).alias("borough"),
        _named(raw, ["Zone"], True).alias("zone_name"),
        _named(raw, ["service_zone"], True).alias("service_zone"),
    ).filter("location_id IS NOT NULL")
    # Airport names by zone.
    airport = F.col("location_id")
    return _one_per_key(picked, "location_id").withColumns({
        "is_airport": airport.isin(*AIRPORT_ZONES),
        "airport_name": F.when(airport == 1, "Newark Liberty International Airport")
        .when(airport == 132, "John F. Kennedy International Airport")
        .when(airport == 138, "LaGuardia Airport"),
    })


def normalize_bases(raw: DataFrame) -> DataFrame:
    license_number = F.upper(_named(raw, ["License Number", "base_license_number", "base_license"], True))
    picked = raw.select(
        license_number.alias("base_license_number"),
        _named(raw, ["Base Name", "name"]).alias("base_name"),
        _named(raw, ["DBA", "doing_business_as"]).alias("doing_business_as"),
        _named(raw, ["Type", "base_type", "license_type", "base_license_type"]).alias("base_type"),
        _named(raw, ["Status", "base_status"]).alias("status"),
        _named(raw, ["Base Telephone Number", "telephone"]).alias("telephone"),
    ).filter("length(base_license_number) > 0")
    return _one_per_key(picked, "base_license_number")


def dataset_inventory(df: DataFrame, dataset: str, layer: str) -> DataFrame:
    """Files, bytes and rows behind a file-based frame; rows are counted before files are merged."""
    per_file = df.groupBy(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
    ).agg(F.count(F.lit(1)).alias("rows"))
    return per_file.agg(
        F.count(F.lit(1)).alias("parquet_files"),
        F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes_on_disk"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.max("modified_at").alias("latest_modified_at"),
    ).select(F.lit(layer).alias("layer"), F.lit(dataset).alias("dataset_name"), "*")


def with_provenance(reference: DataFrame, url: str, facts: DataFrame, at: Column | None = None) -> DataFrame:
    """Address, content hash and time of refresh on each row of a reference table; ``facts`` are of the file it was read from."""
    hashed = facts.agg(F.max("sha256")).scalar()
    return reference.withColumns({
        "source_url": F.lit(url), "source_sha256": hashed, "refreshed_at": F.localtimestamp() if at is None else at})


RUN_EVENT = (
    "event_id bigint, execution_id string, parent_execution_id string, layer string, execution_type string, "
    "status string, started_at timestamp_ntz, finished_at timestamp_ntz, duration_seconds double, "
    "attempt_number int, selection map<string,string>, metrics map<string,double>, written_at timestamp_ntz"
)


def read_event_log(spark: SparkSession, root: str, schema: str = RUN_EVENT, newest: int | None = None) -> DataFrame:
    """JSON lines of all layers; malformed lines are skipped and the source file is kept."""
    log = (
        spark.read.schema(schema).option("mode", "DROPMALFORMED").option("recursiveFileLookup", True).json(root)
        .withColumn("source_file", F.col("_metadata.file_path"))
    )
    return log if newest is None else log.orderBy(F.desc("written_at"), F.desc("event_id")).limit(newest)


def read_manifests(spark: SparkSession, root: str, schema: str, one_per_file: bool = True) -> DataFrame:
    """Nested run manifests, one JSON document per file or per line."""
    return (
        spark.read.schema(schema).option("multiLine", one_per_file).option("recursiveFileLookup", True).json(root)
        .withColumn("manifest_path", F.col("_metadata.file_path"))
    )


_HREF = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
# Character references as they occur in addresses.
_REFERENCES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&#39;": "'", "&#x27;": "'", "&#38;": "&", "&#x26;": "&", "&amp;": "&"}


def _without_dots(path: Column) -> Column:
    """An absolute path with its ``.`` and ``..`` segments resolved."""
    kept = F.aggregate(
        F.slice(F.split(path, "/"), 2, F.greatest(F.size(F.split(path, "/")) - 1, F.lit(0))), F.array().cast("array<string>"),
        lambda done, part: F.when(part == ".", done).when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(part))))
    folder = F.when(path.rlike(r"/\.\.?$") & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit(""))
    return F.when(path.rlike(r"(?:^|/)\.\.?(?:/|$)"), F.concat(F.lit("/"), F.array_join(kept, "/"), folder)).otherwise(path)


def links_from_pages(pages: DataFrame, hosts: Sequence[str] = ()) -> DataFrame:
    """Links of HTML pages resolved against the page address; ``hosts`` restricts the targets.

    Values may be quoted or not; character references are decoded and dot segments of relative links resolved.
    """
    hrefs = F.regexp_extract_all("html", F.lit(_HREF), F.lit(1))
    found = pages.select("page_id", "url", F.posexplode_outer(hrefs).alias("position", "href")).filter("href is not null")
    href = F.regexp_extract("href", r"""(?s)^["']?(.*?)["']?$""", 1)
    for reference, char in _REFERENCES.items():
        href = F.replace(href, F.lit(reference), F.lit(char))
    found = found.withColumn("href", F.trim(href))
    href = F.col("href")
    origin = F.regexp_extract("url", r"^(https?://[^/?#]+)", 1)
    folder = F.regexp_extract("url", r"^https?://[^/?#]+(/(?:[^?#]*/)?)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    path, rest = F.regexp_extract(href, r"^([^?#]*)", 1), F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    target = (
        F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract("url", r"^(https?:)", 1), href))
        .when(href.startswith("/"), F.concat(origin, _without_dots(path), rest))
        .when(href.startswith("#"), F.concat(F.regexp_extract("url", r"^([^#]*)", 1), href))
        .when(href.startswith("?"), F.concat(F.regexp_extract("url", r"^([^?#]*)", 1), href))
        .when(href == "", F.col("url"))
        .otherwise(F.concat(origin, _without_dots(F.concat(folder, path)), rest))
    )
    links = found.select("page_id", "position", target.alias("link")).withColumn(
        "host", F.lower(F.regexp_extract("link", r"^https?://([^/:?#]+)", 1))
    )
    return links.filter(F.col("host").isin(*hosts)) if hosts else links.filter("host <> ''")


def trip_file_candidates(links: DataFrame) -> DataFrame:
    """Links that name a monthly trip file, the last one per service and period."""
    path = F.regexp_extract("link", r"^([^?#]*)", 1)
    parsed = links.filter(path.rlike(TRIP_FILE + "$")).select(
        F.lower(F.regexp_extract(path, TRIP_FILE, 1)).alias("service"),
        F.regexp_extract(path, TRIP_FILE, 2).cast("int").alias("year"),
        F.regexp_extract(path, TRIP_FILE, 3).cast("int").alias("month"),
        F.col("link").alias("url"),
        F.element_at(F.split(path, "/"), -1).alias("file_name"),
        "page_id",
        "position",
    )
    keys = ["service", "year", "month"]
    last = F.max_by(F.struct("url", "file_name"), F.struct("page_id", "position"))
    return parsed.groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.*")
