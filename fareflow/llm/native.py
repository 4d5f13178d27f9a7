"""Column expressions over arrays of word hashes, all built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_SPACE = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """Words of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_SPACE), "")


def hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _joined(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: F.xxhash64(a, b))


def paired(hashes: Column, n: Column, width: int) -> Column:
    """Hashes of twice ``width`` neighbours from ``n`` hashes of ``width`` neighbours each."""
    rest = F.greatest(n - width, F.lit(0))
    return _joined(F.slice(hashes, 1, rest), F.slice(hashes, 1 + width, rest))


def with_windows(df: DataFrame, hashes: str, out: str, width: int) -> DataFrame:
    """``out``: hashes of all windows of ``width`` words, in order, from the words' hashes; empty for shorter texts.

    Windows double from one to two to four words and so on; what is left over is added word by word. Each step is a
    column of its own, so no step is computed twice.
    """
    df = df.withColumn(f"{out}_1", F.col(hashes))
    have = 1
    while have * 2 <= width:
        n = F.size(f"{out}_{have}")
        df = df.withColumn(f"{out}_{have * 2}", paired(F.col(f"{out}_{have}"), n, have))
        have *= 2
    last = F.col(f"{out}_{have}")
    for extra in range(have, width):
        rest = F.greatest(F.size(hashes) - extra, F.lit(0))
        last = _joined(F.slice(last, 1, rest), F.slice(F.col(hashes), 1 + extra, rest))
    return df.withColumn(out, last).drop(*[f"{out}_{2 ** k}" for k in range(have.bit_length())])
