"""Secret scan: patterns of known forms, and a battery of randomness tests for all other tokens; built-in functions only.

Known forms (``assign``, ``access``, ``hex``) are matched leftmost and without overlap, each form by itself.

Other tokens: runs of at least ``SHORTEST`` characters of ``[A-Za-z0-9+/_=-]``. Each gets the encoding its
characters allow (hex, lower, upper or mixed letters, base32, lower or upper with digits, base64). Under "independent, uniform over that alphabet" three tests
are made: chi-squared of the character counts, number of runs above and below the alphabet's middle, and serial correlation;
Fisher's method combines them, and a token that fails at ``MISFIT`` is not random. Under "ordinary text" the token's
p-value is the bound 1 / likelihood ratio (uniform against a model in which characters follow their class and letters their usual
frequency), which falls with length by itself. Benjamini and Hochberg's procedure at ``FDR`` then decides among all tokens
of one length class (powers of two) in the whole table, those with a digit and those without by themselves, so many long words don't
raise the bar for the others; the counts it needs are a histogram of bounded size.

Positions are code points, ends exclusive. Tokens that overlap a known form are left to that form.

Defined cases. Null and empty texts have no span. Each row is scanned by itself, whether it repeats another one or not.
Columns other than the id and the text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.llm.store import written

# The known forms.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
SHORTEST_VALUE = 6
KINDS = ("assign", "access", "hex", "random")

SHORTEST = 16
TOKEN = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{SHORTEST},}}+"
MISFIT = 0.01
FDR = 0.01
BINS_PER_UNIT, LAST_BIN = 4, 800
# Alphabets by encoding, and letters from frequent to rare in ordinary text.
ALPHABETS = {
    "^[0-9a-f]+$": "0123456789abcdef",
    "^[0-9A-F]+$": "0123456789ABCDEF",
    "^[a-z]+$": "abcdefghijklmnopqrstuvwxyz",
    "^[A-Z]+$": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "^[A-Za-z]+$": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "^[A-Z2-7]+=*$": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "^[a-z0-9]+$": "abcdefghijklmnopqrstuvwxyz0123456789",
    "^[A-Z0-9]+$": "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
    "": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
LETTERS = "etaoinsrhldcumfpgwybvkxjqz"
SPAN = "array<struct<start:bigint,rank:int,end:bigint>>"
TESTED = "array<struct<start:bigint,end:bigint,grade:int,bin:int>>"


def running(lengths, block: int = 256) -> Column:
    """Sum of the values before each one, in blocks so that long arrays stay cheap."""
    def add(sums: Column, value: Column) -> Column:
        return F.concat(sums, F.array(F.element_at(sums, -1) + value))
    zero = F.array(F.lit(0).cast("long"))
    count = F.ceil(F.size(lengths) / block).cast("int")
    parts = F.transform(F.sequence(F.lit(1), count), lambda b: F.aggregate(F.slice(lengths, (b - 1) * block + 1, block), zero, add))
    return F.flatten(F.transform(F.array(parts), lambda p: F.flatten(F.zip_with(
        p, F.slice(F.aggregate(p, zero, lambda s, x: add(s, F.element_at(x, -1))), 1, F.size(p)),
        lambda x, before: F.transform(F.slice(x, 1, F.size(x) - 1), lambda v: v + before)))))


def places(text: Column, pattern: str, found: Column) -> Column:
    """Starts of the matches ``found`` of a pattern: the text between matches is what splitting leaves."""
    between = F.transform(F.split(text, pattern, -1), lambda x: F.length(x).cast("long"))
    steps = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda gap, match: gap + F.length(match))
    return F.zip_with(running(steps), F.slice(between, 1, F.size(found)), lambda before, gap: before + gap)


def _spans(text: Column, pattern: str, found: Column, rank: int, good: Column | None = None) -> Column:
    flags = good if good is not None else F.transform(found, lambda m: F.lit(True))
    spans = F.zip_with(places(text, pattern, found), F.arrays_zip(found.alias("m"), flags.alias("ok")), lambda start, x: F.struct(
        start.alias("start"), F.lit(rank).alias("rank"), (start + F.length(x["m"])).alias("end"), x["ok"].alias("ok")))
    kept = F.transform(F.filter(spans, lambda s: s["ok"]), lambda s: F.struct(
        s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end")))
    return F.when(F.size(found) > 0, kept).otherwise(F.array().cast(SPAN))


def _normal_tail(z: Column) -> Column:
    """Upper tail of the normal distribution, by a logistic curve."""
    return 1 / (1 + F.exp(F.lit(1.5976) * z + F.lit(0.070566) * z * z * z))


def _two_sided(z: Column) -> Column:
    return F.least(2 * _normal_tail(F.abs(z)), F.lit(1.0))


def _alphabet(token: Column) -> Column:
    out = F.lit(ALPHABETS[""])
    for shape, letters in reversed([x for x in ALPHABETS.items() if x[0]]):
        out = F.when(token.rlike(shape), F.lit(letters)).otherwise(out)
    return out


def _with(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _class_of(char: Column) -> Column:
    return F.when(char < "0", 3).when(char <= "9", 0).when(char < "A", 3).when(char <= "Z", 1).when(char < "a", 3).otherwise(2)


def graded(token: Column) -> Column:
    """struct(grade, bin): twice the length class, one more with a digit, and 4 times minus the log of the p-value under ordinary text; bin 0 if not random."""
    plain = F.translate(F.rtrim(token, F.lit("=")), "-_", "+/")
    packed = F.struct(F.split(plain, "").alias("chars"), _alphabet(plain).alias("alphabet"))

    def with_marks(x: Column) -> Column:
        marks = F.transform(x["chars"], lambda c: F.position(c, x["alphabet"]).cast("double"))
        return F.struct(x["chars"].alias("chars"), marks.alias("marks"), F.size(x["chars"]).cast("double").alias("n"),
                        F.length(x["alphabet"]).cast("double").alias("size"))

    def tests(x: Column) -> Column:
        n, size, marks, chars = x["n"], x["size"], x["marks"], x["chars"]
        squares = F.aggregate(F.array_distinct(marks), F.lit(0.0), lambda s, m: s + F.pow(
            F.size(F.filter(marks, lambda o: o == m)).cast("double"), F.lit(2.0)))
        chi = size / n * squares - n
        chi_z = (F.pow(F.greatest(chi, F.lit(1e-9)) / (size - 1), F.lit(1 / 3)) - (1 - 2 / (9 * (size - 1)))) / F.sqrt(2 / (9 * (size - 1)))
        high = F.size(F.filter(marks, lambda m: m > size / 2)).cast("double")
        low = n - high
        before, after = F.slice(marks, 1, F.size(marks) - 1), F.slice(marks, 2, F.size(marks) - 1)
        changes = F.aggregate(F.zip_with(before, after, lambda a, b: ((a > size / 2) != (b > size / 2)).cast("int")), F.lit(0),
                              lambda s, v: s + v)
        mean_runs = 2 * high * low / n + 1
        spread = F.sqrt(F.greatest((mean_runs - 1) * (mean_runs - 2) / (n - 1), F.lit(1e-9)))
        runs_z = F.when((high == 0) | (low == 0), F.lit(9.0)).otherwise((changes + 1 - mean_runs) / spread)
        middle, width = (size + 1) / 2, (size * size - 1) / 12
        serial = F.aggregate(F.zip_with(before, after, lambda a, b: (a - middle) * (b - middle)), F.lit(0.0), lambda s, v: s + v)
        serial_z = serial / width / F.sqrt(n - 1)
        least = F.lit(1e-12)
        h = -(F.log(F.greatest(_normal_tail(chi_z), least)) + F.log(F.greatest(_two_sided(runs_z), least))
              + F.log(F.greatest(_two_sided(serial_z), least)))
        fits = F.exp(-h) * (1 + h + h * h / 2) >= MISFIT  # Fisher: chi-squared with six degrees of freedom
        kinds = F.transform(chars, _class_of)
        switches = F.aggregate(F.zip_with(F.slice(kinds, 1, F.size(kinds) - 1), F.slice(kinds, 2, F.size(kinds) - 1),
                                          lambda a, b: (a != b).cast("int")), F.lit(0), lambda s, v: s + v).cast("double")
        # Ordinary text: the class changes once in eight characters; the k-th letter has a share like 1 / (k + 4).
        letters = F.aggregate(chars, F.lit(0.0), lambda s, c: s + F.when(
            _class_of(c).isin(1, 2), -F.log(F.position(F.lower(c), F.lit(LETTERS)).cast("double") + 4) - F.lit(0.6466))
            .when(_class_of(c) == 0, F.lit(-2.302585)).otherwise(F.lit(-2.0)))
        ordinary = letters + switches * F.lit(-3.178054) + (n - 1 - switches) * F.lit(-0.133531)
        ratio = n * -F.log(size) - ordinary
        bin_ = F.when(fits, F.least(F.greatest(F.floor(ratio * BINS_PER_UNIT), F.lit(0)), F.lit(LAST_BIN))).otherwise(0).cast("int")
        digit = F.exists(chars, lambda c: _class_of(c) == 0).cast("int")
        return F.struct((F.floor(F.log2(n)).cast("int") * 2 + digit).alias("grade"), bin_.alias("bin"))

    return _with(packed, lambda p: _with(with_marks(p), tests))


def scan(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, known (spans of the known forms) and tested (graded tokens) of each row."""
    body = docs.select(F.col(f"`{doc}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    t = F.col("text")
    body = body.select("doc_id", "text", F.regexp_extract_all(t, F.lit(ASSIGN), 0).alias("assign"),
                       F.regexp_extract_all(t, F.lit(ACCESS), 0).alias("access"), F.regexp_extract_all(t, F.lit(HEX), 0).alias("hex"),
                       F.regexp_extract_all(t, F.lit(TOKEN), 0).alias("tokens"))
    values = F.regexp_extract_all(t, F.lit(ASSIGN), 2)
    long_enough = F.transform(values, lambda v: F.length(v) >= SHORTEST_VALUE)
    known = F.concat(_spans(t, ASSIGN, F.col("assign"), 0, long_enough), _spans(t, ACCESS, F.col("access"), 1),
                     _spans(t, HEX, F.col("hex"), 2))
    tested = F.when(F.size("tokens") > 0, F.zip_with(places(t, TOKEN, F.col("tokens")), F.col("tokens"), lambda start, token: _with(
        graded(token), lambda g: F.struct(start.alias("start"), (start + F.length(token)).alias("end"), g["grade"].alias("grade"),
                                          g["bin"].alias("bin"))))).otherwise(F.array().cast(TESTED))
    free = F.filter("tested", lambda c: ~F.exists("known", lambda k: (k["start"] < c["end"]) & (c["start"] < k["end"])))
    return (body.select("doc_id", F.sort_array(known).alias("known"), tested.alias("tested"))
            .select("doc_id", "known", free.alias("tested")))


def cutoffs(tested: DataFrame) -> dict[int, int]:
    """By length class the smallest bin that Benjamini and Hochberg's procedure accepts; at most some 60 classes."""
    counts = (tested.select(F.explode_outer("tested").alias("c")).filter("c is not null")
              .groupBy("c.grade", "c.bin").agg(F.count("*").alias("n")).collect())  # a histogram of at most 62 * 801 rows
    by_grade: dict[int, dict[int, int]] = {}
    for r in counts:
        by_grade.setdefault(r["grade"], {})[r["bin"]] = r["n"]
    out = {}
    for grade, bins in by_grade.items():
        total, seen = sum(bins.values()), 0
        for b in sorted(bins, reverse=True):
            seen += bins[b]
            # The weakest p-value of the bin is exp(-bin / 4).
            if b > 0 and 2.718281828459045 ** (-b / BINS_PER_UNIT) <= FDR * seen / total:
                out[grade] = b
    return out


def find_secrets(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, known and added: arrays of struct(start, rank, end), rank as in ``KINDS``, in order."""
    seen = written(scan(docs, doc, text), "scanned")
    least = cutoffs(seen)
    accept = F.lit(LAST_BIN + 1)
    passed = F.filter("tested", lambda c: c["bin"] >= _cut(c["grade"], least, accept))
    added = F.transform(passed, lambda c: F.struct(c["start"].alias("start"), F.lit(3).alias("rank"), c["end"].alias("end")))
    return seen.select("doc_id", "known", added.alias("added"))


def _cut(grade: Column, least: dict[int, int], otherwise: Column) -> Column:
    out = otherwise
    for g, b in least.items():
        out = F.when(grade == g, F.lit(b)).otherwise(out)
    return out


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(
        ":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, rank: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("long")
