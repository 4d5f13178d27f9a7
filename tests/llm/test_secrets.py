import base64
import hashlib
import random
import re
import string

from fareflow.llm import queries, secrets
from tests.llm.conftest import SMALL

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def test_known_forms_on_documents(spark, rows):
    out = {r.doc_id: r for r in queries.op9_secret_scan(spark, SMALL).collect()}
    for row in rows:
        spans = plain(row.text)
        listed = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        got = out[row.doc_id]
        assert got.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert (got.n_assign, got.n_access, got.n_hex) == tuple(sum(k == kind for _, k, _ in spans) for kind in range(3))


def test_known_forms_on_hand_made_texts(spark):
    rng = random.Random(4)
    parts = ["password=hunter22", "Token: 'abc'", "secret = \"x.y-z/12\"", "API_KEY:abcdef", "apikey=token=abcdefgh", "password: token: abcdef",
             "AKIA" + "A1" * 8, "AKIAAKIA" + "B2" * 8, "AKIASHORT", "deadbeef" * 3, "0" * 23, "f" * 24, "é", "😀", " ", "\n", "word", "x" * 30]
    texts = [None, "", *["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(200)], " ".join(parts * 400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in secrets.scan(df).collect():
        assert [tuple(s) for s in r.known] == plain(texts[r.doc_id])


def test_random_tokens_are_added_and_others_are_not(spark):
    rng = random.Random(3)
    make = [lambda n: "".join(rng.choices(string.ascii_letters + string.digits, k=n)), lambda n: rng.randbytes(n // 2).hex().upper(),
            lambda n: "".join(rng.choices(string.ascii_lowercase + string.digits, k=n)), lambda n: base64.b64encode(rng.randbytes(n)).decode()]
    tokens = [make[i % 4](rng.choice([24, 32, 40, 64])) for i in range(80)]
    plain_ones = ["version20190101release", "internationalization2", "user_account_name_12", "order-number-17-of-the-day", "a" * 30 + "1",
                  "1234567890123456789", "2024-01-01-12-00-00-1111", "path/to/file1/name2/other3"]
    rows = [(i, f"é some text {t} and more") for i, t in enumerate(tokens)] + [(1000 + i, f"text {t} more") for i, t in enumerate(plain_ones * 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    added = {r.doc_id: [tuple(s) for s in r.added] for r in secrets.find_secrets(df).collect()}
    caught = [i for i in range(80) if any(rows[i][1][a:b].startswith(tokens[i].rstrip("=")) for a, _, b in added[i])]
    assert len(caught) >= 70
    assert not any(added[1000 + i] for i in range(len(plain_ones) * 5))


def test_tokens_without_a_digit(spark):
    rng = random.Random(5)
    tokens = ["".join(rng.choices(string.ascii_letters, k=n)) for n in (16, 20, 24, 32, 40, 64) for _ in range(10)]
    words = ["internationalization", "incomprehensibilities", "counterrevolutionary", "state-of-the-art-thing", "path/to/some/other/file", "a" * 30]
    rows = [(i, f"some text {t} and more") for i, t in enumerate(tokens)] + [(1000 + i, f"text {t} more") for i, t in enumerate(words * 10)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    added = {r.doc_id: [tuple(s) for s in r.added] for r in secrets.find_secrets(df).collect()}
    assert sum(added[i] == [(10, 3, 10 + len(t))] for i, t in enumerate(tokens)) >= 50
    assert not any(added[1000 + i] for i in range(len(words) * 10))


def test_empty_table_and_other_columns(spark):
    df = spark.createDataFrame([(1, "token=abcdef", "x")], "doc_id long, text string, known string")
    assert secrets.find_secrets(df).count() == 1
    assert secrets.find_secrets(df.limit(0)).count() == 0


def test_running_sums_of_long_arrays(spark):
    lengths = [i % 7 for i in range(1000)]
    got = spark.createDataFrame([(lengths,)], "x array<long>").select(secrets.running("x").alias("s")).first().s
    assert got == [sum(lengths[:i]) for i in range(1000)]
