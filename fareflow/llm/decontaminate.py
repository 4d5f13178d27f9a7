"""Benchmark decontamination by template windows, built-in functions only.

Numbers, units after numbers, and names become typed placeholders; case, punctuation and the kind of white space go. Whether a
capitalised word is a name can't be told for sure, so each window is read three ways: with all capitalised words but stop words as names, at
every place; with the capitalised words inside a sentence as names; and without names, so other capitals don't hide a verbatim copy.
Documents and benchmark items are cut into windows of ``window`` template words, hashed and joined by hash, so a question
whose numbers or names were exchanged still meets its original. For windows with placeholders the values are then aligned: a
set of windows is consistent if each value of the item stands for one value in the document throughout. Texts that only share
a template by chance use the same slot differently and are not reported.

A document is contaminated by an item when some consistent set of windows numbers at least ``run`` (``run + window - 1`` words) or covers at
least ``share`` of the item. Chance matches of a single window report nothing. The sets looked at are all windows of the pair, those of each
alignment (one distance between the places in document and item), those of neighbouring alignments at most ``window`` words
apart (words put in or left out), and all windows whose values are equal. The figures are those of the largest consistent set.

Windows are built only where a text has as many words in a row as a window, each a placeholder or a word of some item; a bitmap of
the items' words (128 kB) tells. No other window can match.

The join's sides are left to Spark's size check: the benchmark's windows are broadcast while small and shuffled beyond.
Windows are pre-counted per document and item before anything is regrouped, and only documents with a matched
placeholder are read again.

Defined cases. Null and empty texts match nothing, items shorter than ``window`` template words match
where a document holds all their words and values in a row, but for items under ``SHORTEST`` words, which chance would find anywhere. Rows of one
id are one document (or item), each aligned by itself. Rows without id are not reported, and kept by ``drop_contaminated``. Empty tables are fine
on either side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareflow.llm import native
from fareflow.llm.store import written

# A name inside a sentence, a unit, a capitalised word elsewhere, and a capitalised stop word inside a sentence.
NUMBER, NAME, UNIT, OPENING, INNER, AFTER = "\ue001", "\ue002", "\ue003", "\ue004", "\ue005", "\ue006"
NAMES = NAME + OPENING + INNER
MARKS = NAMES + NUMBER + UNIT
# The ways to read a window, by the marks that stand for names.
READINGS = ((NAME, OPENING), (NAME, INNER), ())
BIT_WORDS = 1 << 14  # longs of the bitmap of the items' words
SHORTEST = 5  # words of the shortest item looked for
# Words that are capitalised without being names.
STOPS = ("a an and as at but by can could did do does each every find for from given had has have he her his how i if in is it its let "
         "many much no not of on one or our she should so some suppose that the their then there these they this those to two was we "
         "were what when where which while who whose why will with would you your").split()
# Units as they are written after a number.
UNITS = ("km", "m", "cm", "mm", "kg", "g", "mg", "lb", "oz", "l", "ml", "s", "ms", "min", "h", "hours", "hour", "minutes",
         "minute", "seconds", "second", "days", "day", "weeks", "years", "miles", "mile", "meters", "metres", "feet", "ft",
         "inches", "kmh", "mph", "dollars", "euros", "cents", "percent", "usd", "eur", "w", "kw", "v", "hz", "k")


def template_words(text: Column) -> Column:
    """Lower-cased words; numbers, names and units carry a mark of their type in front of their value."""
    # Each pattern looks at a place's own character first, so nearly all places fail at once.
    marked = F.regexp_replace(text, r"(?=\p{Nd})(?<![\p{L}\p{N}])(\p{Nd}+(?:[.,:/]\p{Nd}+)*)", f"{NUMBER}$1 ")
    marked = F.regexp_replace(marked, rf"({NUMBER}[^ ]* )\s*((?i:{'|'.join(UNITS)}))(?![\p{{L}}\p{{N}}])", f"$1{UNIT}$2 ")
    marked = F.regexp_replace(marked, r"(?U)(?:\s{2,}|[\s&&[^ ]])", " ")
    capital = r"(\p{Lu}\p{Ll}+)"
    marked = F.regexp_replace(marked, rf"(?=\p{{Lu}})(?<=[\p{{L}}\p{{N}},;:] )(?!(?i:{'|'.join(STOPS)})(?![\p{{L}}\p{{N}}])){capital}", f"{NAME}$1")
    marked = F.regexp_replace(marked, rf"(?=\p{{Lu}})(?<=[\p{{L}}\p{{N}},;:] ){capital}", f"{INNER}$1")
    marked = F.regexp_replace(
        marked, rf"(?=\p{{Lu}})(?<![\p{{L}}\p{{N}}{MARKS}])(?!(?i:{'|'.join(STOPS)})(?![\p{{L}}\p{{N}}]))(\p{{Lu}}\p{{L}}+)", f"{OPENING}$1")
    return F.regexp_extract_all(F.lower(marked), F.lit(rf"{NUMBER}[^ ]+|[{NAMES}{UNIT}]?[\p{{L}}\p{{N}}]+"), 0)


def _is_slot(word: Column) -> Column:
    return (word >= NUMBER) & (word < AFTER)


def _bare(word: Column) -> Column:
    """A word as it reads without name marks."""
    return F.when(_is_slot(word), F.translate(word, NAMES, "")).otherwise(word)


def _read(words: Column, names: tuple[str, ...]) -> Column:
    """Hashes of words as one of ``READINGS`` has them: all names of a reading are one placeholder."""
    def one(word: Column) -> Column:
        mark = F.substring(word, 1, 1)
        out = F.when(mark.isin(NUMBER, UNIT), mark)
        return F.xxhash64((out.when(mark.isin(*names), F.lit(NAME)) if names else out).otherwise(_bare(word)))
    return F.transform(words, one)


def _bits(items: DataFrame) -> Column:
    """Bitmap of the words of (words) rows as an array of ``BIT_WORDS`` longs, a scalar."""
    held = items.select(F.explode(F.transform("words", _bare)).alias("word")).select(F.xxhash64("word").alias("h"))
    bits = held.select(
        F.shiftrightunsigned("h", 6).bitwiseAND(F.lit(BIT_WORDS - 1)).alias("i"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("bit"))
    every = items.sparkSession.range(BIT_WORDS).select(F.col("id").alias("i"), F.lit(0).cast("long").alias("bit"))
    dense = bits.unionByName(every).groupBy("i").agg(F.bit_or("bit").alias("bits"))
    return dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "bits"))), lambda x: x["bits"])).scalar()


def _hopeful(texts: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """(id, row, start, words) of the runs of ``window`` words at least in ``texts`` (id, row, words) that could stand in an item: each
    word must be a placeholder or a word of some item, as a bitmap tells, which may be wrong only in keeping a word."""
    def foreign(word: Column) -> Column:
        h = F.xxhash64(word)
        bits = F.get("bits", F.shiftrightunsigned(h, 6).bitwiseAND(F.lit(BIT_WORDS - 1)).cast("int"))
        there = F.call_function("shiftrightunsigned", bits, h.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1
        return ~_is_slot(word) & ~there

    def cut(i: Column) -> Column:
        return F.get("cuts", i)

    n = F.size("words")
    places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    cuts = F.concat(F.array(F.lit(-1)), F.filter(places, lambda i: foreign(F.get("words", i))), F.array(n))
    gaps = F.filter(F.sequence(F.lit(0), F.size("cuts") - 2), lambda i: cut(i + 1) - cut(i) > window)
    held = F.transform(gaps, lambda i: F.struct((cut(i) + 1).alias("start"), F.slice("words", cut(i) + 2, cut(i + 1) - cut(i) - 1).alias("words")))
    runs = texts.withColumn("bits", _bits(items)).withColumn("cuts", cuts).select("id", "row", F.explode_outer(held).alias("run"))
    return runs.select("id", "row", F.col("run.start").alias("start"), F.coalesce("run.words", F.array().cast("array<string>")).alias("words"))


def _windows(texts: DataFrame, window: int) -> DataFrame:
    """(id, row, pos, key, n_windows) of (id, row, start, words), ``start`` being the first word's place."""
    df = texts.select("id", "row", "start", "words")
    for k, names in enumerate(READINGS):
        df = df.withColumn(f"h{k}", _read(F.col("words"), names))
    df = df.drop("words")
    for k in range(len(READINGS)):
        df = native.with_windows(df, f"h{k}", f"w{k}", window)
    # Most windows read the same in every way.
    keys = F.zip_with(F.zip_with("w0", "w1", lambda a, b: F.array(a, b)), F.col("w2"), lambda ab, c: F.array_distinct(F.concat(ab, F.array(c))))
    cut = df.select("id", "row", "start", F.size("h0").alias("n_words"), keys.alias("w"))
    # The inner form would have Catalyst filter on the array's size below it, and compute the windows there once more.
    return (cut.select("id", "row", "start", (F.col("n_words") - window + 1).alias("n_windows"), F.posexplode_outer("w").alias("pos", "keys"))
            .select("id", "row", "n_windows", (F.col("start") + F.col("pos")).alias("pos"), F.explode_outer("keys").alias("key")).filter("key is not null"))


def _verbatim_short(texts: DataFrame, items: DataFrame, window: int) -> DataFrame | None:
    """Pairs of documents and items shorter than a window that they hold word by word; None without such items."""
    n = F.size("words")
    short = items.filter((n >= SHORTEST) & (n < window)).select(
        F.col("id").alias("item_id"), n.alias("n"), F.xxhash64(F.transform("words", _bare)).alias("key"),
        F.size(F.filter("words", _is_slot)).cast("long").alias("n_slots"))
    lengths = sorted(r["n"] for r in short.select("n").distinct().collect())  # window - SHORTEST at most
    if not lengths:
        return None
    texts = _hopeful(texts, items, lengths[0]).select("id", F.transform("words", _bare).alias("words"))

    def runs(size: int) -> Column:
        starts = F.when(n >= size, F.sequence(F.lit(1), n - size + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.struct(F.lit(size).alias("n"), F.xxhash64(F.slice("words", i, F.lit(size))).alias("key")))

    keys = texts.select("id", F.explode_outer(F.array_distinct(F.concat(*[runs(s) for s in lengths]))).alias("k"))
    found = keys.select(F.col("id").alias("doc_id"), "k.n", "k.key").filter("key is not null").join(short, ["n", "key"])
    one = F.lit(1).cast("long")
    return found.groupBy(*PAIR).agg(F.max("n_slots").alias("n_slots")).select(
        *PAIR, one.alias("n_matched"), one.alias("n_windows"), "n_slots", F.lit(False).alias("reparameterised"))


PAIR = ["doc_id", "item_id"]
ALIGNED = [*PAIR, "row", "part", "shift"]  # rows of a document's and an item's id, and the distance of their places


def matches(docs: DataFrame, benchmark: DataFrame, window: int = 8, run: int = 6, share: float = 0.5, doc: str = "doc_id",
            text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, n_matched, n_windows, n_slots and reparameterised of each contaminated pair."""
    source, items = _rows(docs, doc, text), _rows(benchmark, item, item_text)
    items = items.select("id", "row", template_words(F.col("text")).alias("words"))
    short = _verbatim_short(source.select("id", "row", template_words(F.col("text")).alias("words")), items, window)
    long = _aligned_matches(source, items, window, run, share)
    return long if short is None else long.unionByName(short)


def _rows(table: DataFrame, key: str, body: str) -> DataFrame:
    return table.select(F.col(f"`{key}`").alias("id"), F.xxhash64(F.col(f"`{body}`")).alias("row"),
                        F.col(f"`{body}`").alias("text")).filter("id is not null")


def _aligned_matches(source: DataFrame, items: DataFrame, window: int, run: int, share: float) -> DataFrame:
    """The pairs of items that have a window."""
    known = _windows(items.withColumn("start", F.lit(0)), window).select(F.col("id").alias("item_id"), F.col("row").alias("part"), F.col("pos").alias("at"), "key",
                                           F.col("n_windows").alias("n_item")).distinct()
    texts = source.select("id", "row", template_words(F.col("text")).alias("words"))
    windows = _windows(_hopeful(texts, items, window), window)
    met = written(windows.select(F.col("id").alias("doc_id"), "row", "pos", "key").join(known, "key")
                  .select(*PAIR, "row", "part", "at", "n_item", (F.col("pos") - F.col("at")).alias("shift")).distinct(), "windows")
    enough = (F.col("n_matched") >= run) | (F.col("n_matched") >= F.col("n_windows") * share)
    counted = written(met.groupBy(*PAIR).agg(F.count_distinct("at").alias("n_matched"), F.max("n_item").alias("n_windows"))
                      .filter(enough), "counted")
    met = met.join(counted.select(*PAIR), PAIR, "left_semi")

    # Slots of the item that a matched window holds, with the document's value at the same place.
    slots = (items.select(F.col("id").alias("item_id"), F.col("row").alias("part"), F.posexplode("words").alias("slot", "value"))
             .filter(_is_slot(F.col("value"))).withColumn("value", _bare(F.col("value"))).distinct())
    inside = (F.col("slot") >= F.col("at")) & (F.col("slot") < F.col("at") + window)
    placed = written(met.join(slots, ["item_id", "part"]).filter(inside).select(*ALIGNED, "slot", "value").distinct(), "slots")
    if placed.isEmpty():  # nothing to align: no text is read again
        return counted.select(*PAIR, F.col("n_matched").cast("long"), F.col("n_windows").cast("long"),
                              F.lit(0).cast("long").alias("n_slots"), F.lit(False).alias("reparameterised"))
    texts = source.join(placed.select(F.col("doc_id").alias("id"), "row").distinct(), ["id", "row"], "left_semi")
    texts = texts.dropDuplicates(["id", "row"]).select(F.col("id").alias("doc_id"), "row", template_words(F.col("text")).alias("words"))
    valued = written(placed.join(texts, ["doc_id", "row"])
                     .select(*ALIGNED, "slot", "value",
                             F.coalesce(_bare(F.get("words", F.col("slot") + F.col("shift"))), F.lit("")).alias("found")),
                     "values")

    by_shift = Window.partitionBy(*PAIR, "row", "part").orderBy("shift")
    far = F.coalesce(F.col("shift") - F.lag("shift").over(by_shift) > window, F.lit(True)).cast("int")
    sets = (met.select(*ALIGNED).distinct().withColumn("far", far).withColumn("near", F.sum("far").over(by_shift))
            .select(*ALIGNED, F.explode(F.array(F.lit(0).cast("long"), F.xxhash64(F.lit("near"), "row", "part", "near"),
                                                F.xxhash64(F.lit("one"), "row", "part", "shift"))).alias("set")))
    covered = met.join(sets, ALIGNED).groupBy(*PAIR, "set").agg(F.count_distinct("at").alias("n_matched"))
    uses = valued.join(sets, ALIGNED).groupBy(*PAIR, "set").agg(
        F.count_distinct("slot").alias("n_slots"), F.count_distinct("value").alias("n_values"),
        F.count_distinct("value", "found").alias("n_pairs"),
        F.max((F.col("value") != F.col("found")).cast("int")).alias("changed"))
    aligned = (covered.join(uses, [*PAIR, "set"], "left").filter("n_pairs is null or n_pairs = n_values")
               .select(*PAIR, "n_matched", F.coalesce("n_slots", F.lit(0)).alias("n_slots"), F.coalesce("changed", F.lit(0)).alias("changed")))

    keys = [F.col(f"m.{c}") == F.col(f"v.{c}") for c in ALIGNED]
    held = (F.col("v.slot") >= F.col("m.at")) & (F.col("v.slot") < F.col("m.at") + window)
    other = valued.filter("value != found").alias("v")
    same = met.alias("m").join(other, [*keys, held], "left_anti")
    verbatim = (same.alias("m").join(valued.alias("v"), [*keys, held], "left").groupBy("m.doc_id", "m.item_id")
                .agg(F.count_distinct("m.at").alias("n_matched"), F.count_distinct("v.slot").alias("n_slots"), F.lit(0).alias("changed")))
    best = F.max(F.struct("n_matched", "n_slots", "changed"))
    return (aligned.unionByName(verbatim).join(counted.select(*PAIR, "n_windows"), PAIR).filter(enough)
            .groupBy(*PAIR).agg(best.alias("x"), F.max("n_windows").alias("n_windows"))
            .select(*PAIR, F.col("x.n_matched").cast("long").alias("n_matched"), F.col("n_windows").cast("long"),
                    F.col("x.n_slots").cast("long").alias("n_slots"), (F.col("x.changed") > 0).alias("reparameterised")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", **how) -> DataFrame:
    """``docs`` less those contaminated by any item."""
    bad = matches(docs, benchmark, doc=doc, **how).select(F.col("doc_id").alias("contaminated_doc")).distinct()
    return docs.join(bad, F.col(f"`{doc}`") == F.col("contaminated_doc"), "left_anti")
