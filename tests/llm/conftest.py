import random

import pytest

#: Nulls, empty and very long texts, ties, repeated rows, odd characters.
ODD = [None, "", " ", "a", "a b", " a\n\nb  c ", "x" * 9000, "y " * 4000, "é è é", "\U0001f9ff 日本 ▁a▁ b", "\x00\x01\ta\r\n", "<|endoftext|> a<|endo", "aaaa" * 200]


@pytest.fixture(scope="session")
def odd_rows():
    rows = [(k, t, "en", k) for k, t in enumerate(ODD)]
    return [*rows, rows[4], rows[5], (None, "a b", None, None), (None, None, None, None)]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """Extra columns have names that operators use inside."""
    return spark.createDataFrame(odd_rows, "doc_id long, text string, lang string, rid long").selectExpr("*", "1 as `_rank`", "2 as `a.b`").coalesce(2)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def prose():
    """Documents of a few words of made-up prose with shared passages, copies and edits."""
    pick = random.Random(11)
    words = ["w%d" % k for k in range(80)] + ["toxicword", "é", "ß,"]
    passages = [" ".join(pick.choices(words, k=pick.randint(20, 90))) for _ in range(8)]
    out = []
    for _ in range(160):
        text = ""
        for _ in range(pick.randint(1, 4)):
            p = pick.choice(passages)
            kind = pick.random()
            if kind < 0.4:
                text += " ".join(pick.choices(words, k=pick.randint(1, 60))) + "\n"
            elif kind < 0.8:
                text += p + " "
            else:
                at = pick.randint(0, len(p))
                text += p[:at] + "Q" + p[at + 1 :]
        out.append(text)
    return out + out[:12]
