import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASHING = "key rid th n_words kept d0 d1 _row size target block fp start text_ words rest _plan n found kind"


def _messy():
    rng = random.Random(5)
    stock = "the of and to in that is it was for on with as by at from der die und que la el word".split()
    names = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 7))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choice(stock if rng.random() < 0.4 else names) for _ in range(n))

    passage, base = prose(70), prose(260)
    rows = []
    for i in range(40):
        text = prose(rng.randint(3, 220))
        if i % 4 == 0:
            text = f"{text}\n{passage} {prose(9)}"
        if i % 9 == 0:
            at = rng.randrange(200)
            text = base[: at * 4] + f" changed{i} " + base[at * 4 + 8 :]
        rows.append((i, text, f"s{i % 5}"))
    rows += [
        (100, None, "s1"),
        (101, "", "s2"),
        (102, " \t\n\x0b\x0c\r ", None),
        (103, "one", None),
        (104, "Two words", "s1"),
        (105, base, "hot"),
        (106, base, "hot"),
        (106, base, "hot"),
        (None, base, "s1"),
        (None, None, "s1"),
        (107, "ab" * 900, "s2"),
        (108, "same line again\n" * 60, "s3"),
        (109, "### $$$ %%% | < > & * " * 30, "s3"),
        (110, "\x1c\x1d é İSTANBUL ΣΑΣ   x<|endoftext|>y \U0001f600 it's 3² " * 9, "é"),
        (111, prose(12_000), "s4"),
        (-5, "A" * 3_000 + " tail", "s4"),
    ]
    return rows


MESSY = _messy()


@pytest.fixture(scope="session")
def messy():
    return MESSY


@pytest.fixture(scope="session")
def table(spark):
    """Rows (doc_id, text, source) as documents, with columns of clashing names."""
    from pyspark.sql import functions as F

    def make(rows):
        data = [(d, t, "en", s, None if t is None else len(t)) for d, t, s in rows]
        df = spark.createDataFrame(data, SCHEMA)
        return df.select("*", *(F.lit(7).alias(c) for c in CLASHING.split()))

    return make
