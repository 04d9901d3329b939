import os
import random

import pytest

ROWS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and river stone light under paper window seven green carry often music garden letter silver morning bridge answer".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", "", ",", "."]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, repeated rows, near copies, and rows of one id with two texts."""
    rng = random.Random(5)
    texts = [prose(rng, n) for n in (1, 4, 5, 6, 30, 80, 120, 200, 400, 40_000)]
    near = texts[6].split(" ")
    near[60] = "changed"
    rows = [(i, t, "en", "src0", len(t)) for i, t in enumerate(texts)]
    rows += [(20, texts[6], "en", "src1", 5), (21, " ".join(near), "en", "src1", 5), (22, texts[7], None, None, None), (22, texts[7], None, None, None)]
    rows += [(30, None, None, None, None), (31, "", "en", "src0", 0), (32, " \n\t ", "en", "src0", 4), (33, "...!!!", "en", "src0", 6), (None, texts[5], None, None, None), (34, "x" * 50_000, "en", "s", 50_000), (35, "é ß Σ İ 你好 \U0001f600 á", "xx", "s", 1)]
    rows += [(40, "mail me at ann@b.example or +49 30 1234567 now", "en", "s", 1), (40, "another text with the id of a different one", "en", "s", 1)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, ROWS).repartition(3)


@pytest.fixture(scope="session")
def clashing(odd):
    """The same rows with columns named as the operators' own."""
    from pyspark.sql import functions as F

    names = "k label part n node component block token local c cls score words keys f1 f2 base codes item_id _bad_id _copy_id _toxic_id train sequence_id key first_key start".split()
    return odd.select("*", *[F.lit("x").alias(n) for n in names])


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], ROWS)


@pytest.fixture(scope="session")
def small(sf_dir):
    return os.environ.get("TEST_LLM_DIR", sf_dir)


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)
