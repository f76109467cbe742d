import random

import pytest

# Columns that clash with names the operators make.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, size long, m string, shard int, `key` long, target double, label long, part int"


def prose(seed, n, vocabulary=300):
    draw = random.Random(seed)
    words = [f"{draw.choice(('', 'Ä', 'x'))}word{int(draw.paretovariate(0.8)) % vocabulary}" for _ in range(n)]
    return "".join(w + draw.choice((" ", " ", " ", "\n", ". ")) for w in words)


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, len(text or ""), True, 5, "clash", 1, 2, 3.0, 4, 5)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and long texts, ties, repeated rows."""
    rows = [
        row(1, None),
        row(2, ""),
        row(3, " \n\t "),
        row(4, "one two"),
        row(5, "one two"),
        row(None, "a text without an id " * 20, None, None),
        row(None, None, None, None),
        (9, prose(9, 200), None, None, None, None, None, None, None, None, None, None, None),
        row(10, prose(10, 40_000)),
        row(11, "x" * 200_000),
        row(12, "! " * 3000),
        row(13, "same line here\n" * 50 + prose(13, 100)),
        row(13, "same line here\n" * 50 + prose(13, 100)),
    ]
    base = prose(1, 300).split(" ")
    for i in range(40):
        copy = list(base)
        for k in range(i % 5):
            copy[(7 * i + 60 * k) % len(copy)] = f"changed{i}"
        rows.append(row(100 + i, " ".join(copy), source="b" if i % 3 else "c"))
    rows += [row(200 + i, prose(200 + i, 60 + 5 * i), ("en", "de", None)[i % 3], ("a", "b", "ü")[i % 3]) for i in range(60)]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(5).persist()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
