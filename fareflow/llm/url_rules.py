"""URL rules: a sort-merge range join on reversed hosts, swept with a stack of active nested rules.

A host reversed by labels, each label ended by ``\\x01`` (``net\\x01example\\x01``), turns "this host and all subdomains" into the
interval of keys that begin with the rule's key. In key order a sweep meets a rule before every host it covers, and the
rules that cover a host are nested: they are the stack. At each level of the stack the rule's paths are kept; a url's rule
is the longest whose path its own path starts with.

Distribution: rows are swept in blocks, a block being the first two labels of the reversed host, dealt out over ``salts`` by the
row's hash, so that a host with a third of all rows has as many tasks. Rules go to each (block, salt) that has urls: rules of
two labels and more have one block, rules of one label join the blocks below it. Within a block rows arrive sorted from
Spark's sort (which spills) and are streamed; only the stack is held.

Order of preference: longest host plus path, then longest host, then block before allow. The default is for urls no rule fits.

Defined cases. A null url or one without ``://`` has an empty host and path and no rule. Repeated rows are judged each.
Repeated rules count once. Rules with a null or empty host fit nothing. Null paths of rules are empty and fit every path.
Columns named like the ones added (``host``, ``path``, ``rule``, ``verdict``) are replaced. Empty tables are fine on
either side.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.llm.store import without

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
END = "\x01"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def range_key(host: Column) -> Column:
    """Labels from last to first, each ended by a mark below every character of a host."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), END), F.lit(END))


def _block(key: Column) -> Column:
    return F.substring_index(key, END, 2)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url", salts: int = 64) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (host and path of the rule that won, else null) and ``verdict``.

    ``rules`` has host, path and verdict (allow or block).
    """
    pages = without(pages, "host", "path", "rule", "verdict")
    fields = [F.col(f"`{c}`") for c in pages.columns]
    salt = F.pmod(F.xxhash64(*[c for c, t in zip(fields, pages.dtypes) if "map" not in t[1]]), F.lit(salts)).cast("int")
    urls = (pages.select(F.struct(*fields).alias("page"), F.col(f"`{url}`").alias("url"), salt.alias("salt"))
            .select("page", "salt", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
            .withColumn("key", range_key(F.col("host"))).withColumn("block", _block(F.col("key"))))
    known = (rules.select(F.translate(F.col("host"), UPPER, LOWER).alias("host"),
                          F.coalesce(F.col("path"), F.lit("")).alias("path"), F.col("verdict"))
             .filter("host is not null and host != ''")
             .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block sorts after allow
             .withColumn("key", range_key(F.col("host"))).withColumn("block", _block(F.col("key"))))
    cells = urls.select("block", "salt").distinct().withColumn("top", F.substring_index("block", END, 1))
    narrow = known.filter(F.col("host").contains("."))
    wide = known.filter(~F.col("host").contains(".")).withColumn("top", F.substring_index("key", END, 1)).drop("block")
    dealt = (narrow.join(cells.drop("top"), "block").select("block", "salt", "key", "host", "path", "verdict")
             .unionByName(wide.join(cells, "top").select("block", "salt", "key", "host", "path", "verdict")))
    both = (urls.select("block", "salt", "key", F.lit(1).alias("side"), "host", "path", F.lit(None).cast("string").alias("verdict"),
                        "page")
            .unionByName(dealt.withColumn("side", F.lit(0)).withColumn("page", F.lit(None).cast(urls.schema["page"].dataType)))
            .repartition("block", "salt").sortWithinPartitions("block", "salt", "key", "side"))
    schema = T.StructType([urls.schema["page"], T.StructField("host", T.StringType()), T.StructField("path", T.StringType()),
                           T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, stack = None, []
        for batch in batches:
            keep, found, verdicts = [], [], []
            columns = [batch.column(n).to_pylist() for n in ("block", "salt", "key", "side", "host", "path", "verdict")]
            for i, (block, salt, key, side, host, path, verdict) in enumerate(zip(*columns)):
                if (block, salt) != cell:
                    cell, stack = (block, salt), []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if side == 0:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, host, {}))
                    stack[-1][2][path] = verdict
                    continue
                best = longest(stack, path)
                keep.append(i)
                found.append(best and best[0])
                verdicts.append(best[1] if best else default)
            if keep:
                out = batch.take(pa.array(keep))
                yield pa.RecordBatch.from_arrays(
                    [out.column("page"), out.column("host"), out.column("path"), pa.array(found, pa.string()),
                     pa.array(verdicts, pa.string())], names=schema.names)

    swept = both.mapInArrow(sweep, schema)
    return swept.select("page.*", "host", "path", "rule", "verdict")


def longest(stack: list[tuple[str, str, dict[str, str]]], path: str) -> tuple[str, str] | None:
    """Rule and verdict of the longest host plus path among the active rules; longer hosts win ties."""
    best, size = None, (-1, -1)
    for _, host, paths in stack:
        for length in sorted({len(p) for p in paths}, reverse=True):
            verdict = paths.get(path[:length]) if length <= len(path) else None
            if verdict is not None:
                if (len(host) + length, len(host)) > size:
                    best, size = (host + path[:length], verdict), (len(host) + length, len(host))
                break
    return best
