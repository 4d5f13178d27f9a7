"""Threshold-scaled document fingerprints, built-in functions only.

A fingerprint holds every hash of a text's five-word shingles that lies below a fixed fraction (1/8) of the hash range. Whatever
the texts' lengths, a hash below the fraction is kept in all of them or in none, so fingerprints of very unequal documents
compare directly and the fingerprint of a union is the union of fingerprints. So that short texts have a usable one,
the ``FLOOR`` smallest hashes are kept in any case; ``reach`` says up to which hash a fingerprint is complete, and two of them
compare up to the smaller reach.

Words are runs outside ``[\\x20\\x09-\\x0D]``, lower-cased; fewer than five are one shingle.

Defined cases. Null and empty texts have an empty fingerprint; two empty ones are alike (1), an empty and another one are not (0).
Equal texts have equal fingerprints. In ``edited_by_next`` the order is that of distinct ids; of rows that repeat an id one,
picked by its text's hash, stands for it, and each row is fingerprinted. Rows without id have no next document: the second half goes and nothing follows.
Columns other than id and text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from fareflow.llm import native
from fareflow.llm.store import written

WORDS = 5
FLOOR = 16
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
BELOW = LOWEST + (1 << 64) // 8


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: struct of ``hashes`` (ascending) and ``reach``."""
    words, hashes, windows, kept, low = (f"{out}_{x}" for x in ("words", "hashes", "windows", "kept", "low"))
    df = df.withColumn(hashes, native.hashed(native.words_of(F.lower(F.col(text)))))
    df = native.with_windows(df, hashes, windows, WORDS)
    short = F.when(F.size(hashes) > 0, F.array(F.xxhash64(F.col(hashes)))).otherwise(F.slice(F.col(hashes), 1, 0))
    df = df.withColumn(windows, F.when(F.size(hashes) < WORDS, short).otherwise(F.col(windows))).drop(hashes)
    df = df.withColumn(low, F.array_distinct(F.filter(windows, lambda h: h < BELOW)))
    df = df.withColumn(kept, F.when(F.size(low) >= FLOOR, F.sort_array(low))
                       .otherwise(F.sort_array(F.array_distinct(windows)))).drop(windows)
    full = F.size(low) >= FLOOR
    reach = (F.when(full, F.lit(BELOW - 1)).when(F.size(kept) <= FLOOR, F.lit(HIGHEST))
             .otherwise(F.element_at(F.slice(kept, 1, FLOOR), -1)))
    hashes_out = F.when(full, F.col(kept)).otherwise(F.slice(kept, 1, FLOOR))
    return df.withColumn(out, F.struct(hashes_out.alias("hashes"), reach.alias("reach"))).drop(low, kept)


def _upto(one: Column, reach: Column) -> Column:
    return F.when(one["reach"] <= reach, one["hashes"]).otherwise(F.filter(one["hashes"], lambda h: h <= reach))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard of two fingerprints' texts."""
    reach = F.least(a["reach"], b["reach"])
    x, y = _upto(a, reach), _upto(b, reach)
    both = F.size(F.array_intersect(x, y))
    union = F.size(x) + F.size(y) - both
    return F.when((F.size(a["hashes"]) == 0) & (F.size(b["hashes"]) == 0), F.lit(1.0)).when(union == 0, F.lit(0.0)).otherwise(
        both / union)


def containment(a: Column, b: Column) -> Column:
    """Estimated part of the first text's shingles that the second one has."""
    reach = F.least(a["reach"], b["reach"])
    x, y = _upto(a, reach), _upto(b, reach)
    return F.when(F.size(a["hashes"]) == 0, F.lit(1.0)).when(F.size(x) == 0, F.lit(0.0)).otherwise(
        F.size(F.array_intersect(x, y)) / F.size(x))


def merged(a: Column, b: Column) -> Column:
    """Fingerprint of the union of two texts' shingles."""
    reach = F.least(a["reach"], b["reach"])
    hashes = F.sort_array(F.array_union(_upto(a, reach), _upto(b, reach)))
    return F.struct(hashes.alias("hashes"), reach.alias("reach"))


def as_text(one: Column) -> Column:
    """Hashes in hexadecimal, comma-joined, in ascending order."""
    return F.array_join(F.transform(one["hashes"], lambda h: F.lower(F.hex(h))), ",")


def following(docs: DataFrame) -> DataFrame:
    """(doc_id, before, n_before): the id after which each id comes in descending order, the first one coming after
    the last; with that document's length.

    Ids are cut into ranges; neighbours within a range come from a window per range, those across ranges from each range's
    first id.
    """
    ids = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.max("n_chars").alias("n_chars"))
    ranged = written(ids.repartitionByRange("doc_id").withColumn("part", F.spark_partition_id()), "ranges")
    heads = ranged.groupBy("part").agg(F.min_by(F.struct("doc_id", "n_chars"), "doc_id").alias("head"))
    later = F.lead("head").over(Window.orderBy("part"))  # one row per range
    first = F.first("head").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("part", F.coalesce(later, first).alias("after_part"))
    inside = F.lead(F.struct("doc_id", "n_chars")).over(Window.partitionBy("part").orderBy("doc_id"))
    placed = ranged.withColumn("inside", inside).join(heads, "part").withColumn("to", F.coalesce("inside", "after_part"))
    return placed.select("doc_id", F.col("to.doc_id").alias("before"), F.col("to.n_chars").alias("n_before"))


def edited_by_next(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited, own, changed and next_own: each text whose last floor(n/2) code points are replaced by as many
    first ones of the next document in descending id, with the fingerprints of the text, the edited text and the next text."""
    # A name of its own: Catalyst drops an alias to the same name on one side of a self-join only, and the two sides'
    # exchanges would then not be seen to be the same.
    docs = docs.select(F.col(f"`{doc}`").cast("long").alias("own_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    known = docs.filter("own_id is not null")
    lengths = known.select(F.col("own_id").alias("doc_id"), F.length("text").cast("long").alias("n_chars"))
    order = written(following(lengths), "order")
    sent = known.join(order, F.col("own_id") == F.col("doc_id")).select(
        "before", "text", F.floor(F.col("n_before") / 2).cast("int").alias("half"))
    sent = (with_fingerprint(sent, "text", "next_own").withColumn("head", F.expr("substring(text, 1, half)"))
            .groupBy("before").agg(F.min_by(F.struct("head", "next_own"), F.xxhash64("text")).alias("next")))
    half = F.floor(F.length("text") / 2).cast("int")
    both = known.join(sent, F.col("own_id") == F.col("before"), "left").select("own_id", "text", "next")
    both = both.unionByName(docs.filter("own_id is null").withColumn("next", F.lit(None).cast(sent.schema["next"].dataType)))
    both = both.withColumnRenamed("own_id", "doc_id")
    both = both.withColumn("edited", F.concat(
        F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 2) as int))"),
        F.coalesce(F.substring(F.col("next.head"), F.lit(1), half), F.lit(""))))
    both = with_fingerprint(with_fingerprint(both, "text", "own"), "edited", "changed")
    return both.select("doc_id", F.length("text").cast("long").alias("n_chars"), "edited", "own", "changed",
                       F.col("next.next_own").alias("next_own"))
