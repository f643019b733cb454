from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, KEPT string, Size string"


def edge_rows():
    """Documents with nulls anywhere, empty and very long texts, ties, copies and repeated rows, and clashing columns."""
    rnd = random.Random(7)
    words = ["".join(rnd.choice("abcdefghé") for _ in range(rnd.randint(1, 9))) for _ in range(400)]

    def text(n):
        return " ".join(rnd.choice(words) for _ in range(n))

    base = [text(120) for _ in range(6)]
    rows = [(k, base[k], "en", f"s{k % 2}", 1) for k in range(6)]
    rows += [(10, None, "en", "s0", None), (11, "", None, "s0", 0), (12, " \n\t ", "en", None, 3), (13, "one two", "de", "s1", 7)]
    rows += [(14, text(30000), "en", "s0", 5), (15, "x" * 300000, "en", "s1", 5)]
    rows += [(16, base[0], "en", "s1", 1), (17, base[0], "en", "s1", 1), (None, base[1], "en", "s0", 1), (None, None, None, None, None)]
    rows += [(18, base[2], "en", "s0", 1)] * 3 + [(19, None, "en", "s0", 1)] * 2
    for k in range(20, 40):
        own = base[k % 6].split()
        own[rnd.randrange(len(own))] = "zzz"
        rows.append((k, " ".join(own), "en", f"s{k % 3}", 1))
    rows += [(40, "same line here\n" * 60 + "end", "en", "s2", 1), (41, "## $$ %% && " * 30, "en", "s2", 1), (42, "word " * 60, "en", "s2", 1)]
    rows += [(43, "été naïve café \U0001f600 " * 20, "fr", "s2", 1)]
    return [(*r, "clash", "clash") for r in rows]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
