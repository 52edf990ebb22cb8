from __future__ import annotations

import pytest

from goldrow.session import share_package


@pytest.fixture(autouse=True, scope="session")
def importable(spark):
    share_package(spark)


#: Texts that operators must take: absent, empty, blank, repeated, tied, odd and very long.
TEXTS = [
    None,
    "",
    " ",
    "\n\t \x0b",
    "one",
    "one two",
    "One  two\nthree",
    "One  two\nthree",
    "été ▁ 日本語 😀 \x00 <s> <|endoftext|> it's 12.",
    "the cat sat on the mat " * 40,
    "the cat sat on the mat " * 40,
    "word%d " * 3 + "x" * 300,
    " ".join(f"w{i % 977}" for i in range(120_000)),
]


@pytest.fixture
def texts(spark):
    """The texts, with columns named like those that operators add."""
    rows = [(i, t, "en" if i % 2 else None, "s", i) for i, t in enumerate(TEXTS)]
    rows.append((None, "no id at all", None, None, None))
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(rows, kinds)
    clashing = ("id", "fp", "ids", "row", "key", "kept", "score", "shard", "slot", "rank", "size")
    return df.selectExpr("*", *[f"'mine' AS `{c}`" for c in clashing], "'dot' AS `a.b`")


@pytest.fixture
def nothing(texts):
    return texts.where("false")
