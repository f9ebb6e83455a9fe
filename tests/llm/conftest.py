"""Small tables that hold every awkward case at once."""

import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names the operators use inside.
    "size long, n long, part int, token string, kept boolean, fragment int, component long, data binary"
)


def make(spark, rows):
    """Documents from (doc_id, text, source), with other columns of clashing names."""
    full = [(i, t, "xx", s, -1, 7, 8, 9, "tok", True, 3, 4, bytearray(b"x")) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(r, words, vocabulary=400):
    return " ".join(f"{r.choice('abcdefgh')}{r.randrange(vocabulary)}é" for _ in range(words))


def awkward_rows():
    """(doc_id, text, source): nulls, empty and very long texts, copies, near copies, ties, repeated rows."""
    r = random.Random(7)
    base, passage = prose(r, 120), prose(r, 60)
    edited = base.split()
    edited[50] = "changed"
    rows = [
        (1, None, "a"),
        (2, "", "a"),
        (3, " \t\n\x0b\x0c\r ", None),
        (4, "one", "a"),
        (5, "One  two\nthree", "b"),
        (6, base, "b"),
        (7, base.upper().replace("É", "é"), "b"),
        (8, " ".join(edited), "c"),
        (9, base.replace(" ", "\n", 30), None),
        (10, prose(r, 80) + "\n" + passage, "c"),
        (11, passage + "\n" + prose(r, 90), "c"),
        (12, prose(r, 3000), "hot"),
        (13, "word " * 4000, "hot"),
        (14, "\n".join(prose(random.Random(k % 5), 6) for k in range(40)), "hot"),
        (15, "\n".join(prose(random.Random(k % 5), 6) for k in range(1, 9)), "hot"),
        (16, base, "hot"),
        (16, base, "hot"),
        (17, "x\x85y\xa0z qİ", "a"),
        (18, "日本語のテキスト、空白なし" * 9, "a"),
        (-5, "a b c d e f g h i j k l", "b"),
        (20, "***### $$$ %%% <|endoftext|> & | < >", "a"),
    ]
    rows += [(100 + k, base, "hot") for k in range(30)]
    rows += [(200 + k, prose(random.Random(k), 30), "hot") for k in range(30)]
    return rows


@pytest.fixture(scope="session")
def awkward(spark):
    return make(spark, awkward_rows())


@pytest.fixture(scope="session")
def none(spark):
    return make(spark, [])


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(200 + k, 1, 0) for k in range(20)] + [(13, 0, 0), (20, 0, 0), (6, 1, 0), (6, 0, 0), (None, 1, 0), (9999, 1, 0)]
    return spark.createDataFrame([*rows, (7, None, 0)], "doc_id long, quality int, toxic int")
