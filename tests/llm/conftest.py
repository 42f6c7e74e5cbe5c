import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rep long, size long, part int, _text_hash string, `a.b` string"


def prose(rng, n, words=400):
    return " ".join("".join(rng.choice("aeioumnrst") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Documents with nulls in every column, empty and long texts, copies, near copies, repeated rows and repeated ids."""
    rng = random.Random(5)
    base = prose(rng, 120)
    near = base.split()
    near[60] = "changed"
    texts = [base, base, " ".join(near), None, "", " \n\t ", "one", "one two three", "one two three", "x" * 20000, prose(rng, 6000), "a\u2581b \u2581", "\u00e9\u4e2d\U0001f600 tail", "\n\n line\r\n  two  ", base.upper()]
    rows = [(i, t, "en", "s%d" % (i % 3) if i % 4 else None, len(t or ""), None, i, None, "clash", "dot") for i, t in enumerate(texts)]
    rows.append(rows[2])  # a repeated row
    rows.append((6, "another text under a used id", None, "s1", None, 1, 1, 1, None, None))
    rows.append((None, "no id here at all today", None, None, None, None, None, None, None, None))
    return rows


@pytest.fixture(scope="session")
def edges(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
