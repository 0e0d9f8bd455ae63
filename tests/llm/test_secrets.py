"""Secret scans: fixed patterns against a plain reading, the lexer on samples of source and configuration."""

import hashlib
import random
import re
import time

import pytest

from loomwright.llm.queries import QUERIES
from loomwright.llm.secret_scan import KINDS, find_secrets, named_spans, spans_of

LETTERS = {c: f"[{c}{c.upper()}]" for c in "abcdefghijklmnopqrstuvwxyz"}


def plain_base(text):
    """The three patterns with their letters spelt out, one after another."""
    words = "|".join("".join(LETTERS.get(c, c) for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    out = [(m.start(), 0, m.end()) for m in re.finditer("(%s)[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)" % words, text) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


def expected(text):
    base = plain_base(text)
    kinds = [s.split(":")[0] for s in base.split(",")]
    return *(kinds.count(k) for k in KINDS[:3]), hashlib.sha256(base.encode()).hexdigest()


def scrambled(n):
    pick = random.Random(3)
    parts = ["password", "PassWD", "secret", "ſecret", "to", "token", "toKen", "api_key", "APIKEY", " ", "  ", ":", "=", '"', "'", "AKIA", "ABC123", "0123456789ab", "f" * 12, "é", "\U0001f9ff", "\n", "x=", "-", "hunter2"]
    return ["".join(pick.choices(parts, k=pick.randint(1, 30))) for _ in range(n)]


def rows_of(df):
    return sorted(tuple(map(str, r)) for r in df.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256").collect())


def write(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_base_spans_equal_the_patterns(spark, sf, tmp_path):
    texts = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = list(enumerate([*texts, *scrambled(800)]))
    got = QUERIES["op11_secret_scan"](spark, write(spark, tmp_path, rows))
    assert rows_of(got) == sorted(tuple(map(str, (k, *expected(t)))) for k, t in rows)
    for r in got.collect():  # the method adds spans, base ones stay
        kept = [s for s in r["spans"].split(",") if not s.startswith("named")] if r["spans"] else []
        assert ",".join(kept) == plain_base(rows[r["doc_id"]][1])


def test_odd_texts(spark, odd_docs, odd_rows, no_docs):
    got = find_secrets(odd_docs)
    assert got.count() == len(odd_rows)
    assert sorted((str(r["doc_id"]), ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in r["spans"])) for r in got.collect()) == sorted((str(r[0]), plain_base(r[1] or "")) for r in odd_rows)
    assert find_secrets(no_docs).count() == 0
    assert got.columns == ["doc_id", "spans"]


@pytest.mark.parametrize(
    "text,found",
    [
        ('x = "hunter2hunter2"\ndb_pwd = x\n', {"hunter2hunter2": "db_pwd"}),
        ("a = 'q1w2e3r4'\nb = a\nc = b\nsigningKey = c + '-Tail99'\n", {"q1w2e3r4": "signingKey", "-Tail99": "signingKey"}),
        ("a = 'old1old1'\na = 'new2new2'\npassphrase = a\n", {"new2new2": "passphrase"}),
        ('{"clientCredential": "Zx9!kkQp0"}', {"Zx9!kkQp0": "clientCredential"}),
        ("<privateKey>MIIEvQIBADANBg</privateKey>", {"MIIEvQIBADANBg": "privateKey"}),
        ("base=Tr0ub4dor\nDB_PWD=${base}x9\n", {"Tr0ub4dor": "DB_PWD"}),
        ("base = 'Tr0ub4dor'\nDB_PWD = \"${base}-x9\"\n", {"Tr0ub4dor": "DB_PWD", "${base}-x9": "DB_PWD"}),
        ("cfg['pwd'] = 'Tr0ub4dor'", {"Tr0ub4dor": "pwd"}),
        ("export DB_PWD=abc123XYZ # local", {"abc123XYZ": "DB_PWD"}),
        ("bearer => 'eyJhbGci0iJ'", {"eyJhbGci0iJ": "bearer"}),
        ("val pwd: String = \"s3cr3tValue\"", {"s3cr3tValue": "pwd"}),
        ("self.pw = 'q1w2e3r4t5'\nconnect(passphrase=pw, user='bob')", {"q1w2e3r4t5": "passphrase"}),
        ("pwd = 'changeme'\npwd_file = '/etc/abc123'\npwd = os.environ['X']\nurl = 'http://a.b/c1'", {}),
        ("if pwd == 'abc123def': pass\nThe pin: mountain. Note: he said so.", {}),
        ("token = 'abc123def456'", {}),  # a pattern's span already
    ],
)
def test_literals_by_the_names_they_reach(text, found):
    got = {text[a:b]: name for kind, a, b, name, _ in spans_of(text) if kind == "named"}
    assert got == found


def test_prose_is_left_alone(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    named = [r["doc_id"] for r in rows if any(s[0] == "named" for s in spans_of(r["text"] or ""))]
    assert not named


def test_a_name_reaches_all_literals_of_a_long_chain():
    n = 3000
    text = "".join(f"v{k} = v{k - 1} + 'part{k}Aa'\n" if k else "v0 = 'part0Aa'\n" for k in range(n)) + f"pwd = v{n - 1}\n"
    assert len(named_spans(text)) == n


@pytest.mark.parametrize(
    "text",
    ["a" * 2_000_000, "a=" * 500_000, '"' * 500_000 + ":", "password" + " " * 500_000 + "x", "<a" * 300_000, "a-" * 500_000 + ":", "a='b=\"" * 100_000, ("0" * 23 + " ") * 50_000, "x:" * 500_000, 'a["' * 300_000],
)
def test_time_is_in_proportion_to_the_text(text):
    began = time.time()
    spans_of(text)
    assert time.time() - began < 5
