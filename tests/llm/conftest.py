from __future__ import annotations

import random

import pytest

from lateline.llm.shipping import ship

SCHEMA = """doc_id long, text string, lang string, source string, n_chars long, size int, score string, part array<int>,
row string, `a b.c` string"""


def prose(seed: int, count: int) -> str:
    rng = random.Random(seed)
    stems = ["ka", "lor", "mi", "ten", "sur", "pado", "vel", "ri", "ost", "um"]
    words = ["".join(rng.choices(stems, k=rng.randint(1, 4))) for _ in range(count)]
    return " ".join(w + ("." if k % 9 == 8 else "") for k, w in enumerate(words))


def messy_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows and near copies."""
    base, long = prose(1, 120), prose(2, 30_000)
    near = base.split()
    near[60] = "changed"
    texts = [
        (10, base), (11, base), (12, base), (12, base), (13, " ".join(near)), (14, base.replace(" ", "  \t", 3)),
        (None, base), (None, None), (None, None), (15, None), (16, ""), (17, ""), (18, " \n\t \n"), (19, long),
        (20, long + " tail"), (21, "one"), (22, "ONE."), (23, "two words"), (24, "12345 !!! ..."),
        (25, "日本語の文章 ñandú naïve wide \r\n\x0b end "), (26, "x" * 200_000), (27, "Line 7 of the same kind here\nother"),
    ]
    texts += [(30 + k, f"Page {k} of the common footer text\n" + prose(100 + k, 30 + k)) for k in range(6)]
    texts += [(40 + k, prose(200 + k, 40)) for k in range(20)]
    out = []
    for k, (doc_id, text) in enumerate(texts):
        out.append((doc_id, text, [None, "en", "xx"][k % 3], [None, "b", "a", "é"][k % 4],
                    None if k % 5 == 0 else len(text or ""), k, None, [k] if k % 2 else None, None, "z"))
    return out


@pytest.fixture(scope="session")
def shipped(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def messy(shipped):
    return shipped.createDataFrame(messy_rows(), SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def nothing(shipped):
    return shipped.createDataFrame([], SCHEMA)
