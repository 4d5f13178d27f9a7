import re

import pytest

SMALL = "/root/testdata/sf0.001"
SPACE = "[\x20\x09-\x0D]+"
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def plain_words(text):
    return [w for w in re.split(SPACE, (text or "").translate(LOWER)) if w]


def plain_shingles(text, k=5):
    w = plain_words(text)
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def rows(documents):
    return documents.orderBy("doc_id").collect()
