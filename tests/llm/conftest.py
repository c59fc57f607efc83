import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    """Build a documents table from (doc_id, text) or (doc_id, text, source) rows."""

    def build(*rows, extra=""):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        return df.selectExpr("*", extra) if extra else df

    return build


WORDS = [f"w{i}" for i in range(400)]


def prose(seed: int, n: int) -> str:
    """Invented prose: sentences of 3 to 12 words."""
    random_ = random.Random(seed)
    out, left = [], n
    while left > 0:
        size = min(left, random_.randint(3, 12))
        out.append(" ".join(random_.choice(WORDS) for _ in range(size)) + ".")
        left -= size
    return " ".join(out)


# Nulls, empty texts, white space only, a long text, ties and repeated rows.
AWKWARD = [
    (None, None), (None, "null id"), (1, None), (2, ""), (3, " \n\t "), (4, prose(1, 300)), (4, prose(1, 300)),
    (5, prose(1, 300)), (6, prose(2, 20_000)), (7, "é" * 3000), (8, " ".join(["same words"] * 3000)), (9, "x"),
]
