from __future__ import annotations

import random

import pytest

COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    # Names that operators use inside.
    " fp long, data string, found string, edges int, target string, kept string, toxic string, u int, v int, n_tokens string"
)


def make_docs(spark, rows):
    """``(doc_id, text, lang, source)`` rows with the clashing columns filled."""
    full = [(i, t, lang, src, None if t is None else len(t), 1, "x", "y", 2, "z", "k", "t", 3, 4, "n") for i, t, lang, src in rows]
    return spark.createDataFrame(full, COLUMNS)


def sentence(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Copies, near copies, shared passages, a long text, nulls, empties, repeated rows, ties."""
    rng = random.Random(3)
    words = [a + b for a in ("ka", "lo", "mi", "ru", "te", "so") for b in ("n", "ra", "st", "vel", "dor", "é")]
    passage = sentence(rng, 70, words)
    rows = []
    for i in range(60):
        text = sentence(rng, rng.randint(5, 160), words)
        if i % 5 == 1:
            text += "\n" + passage + " " + sentence(rng, 20, words)
        rows.append((i, text, "xx" if i % 3 else "yy", f"s{i % 4}"))
    for i in range(60, 75):  # copies
        rows.append((i, rows[i - 60][1], "xx", "s0"))
    for i in range(75, 85):  # near copies
        parts = rows[i - 60][1].split(" ")
        parts[len(parts) // 2] = "CHANGED"
        rows.append((i, " ".join(parts), None, None))
    rows.append((85, sentence(rng, 9000, words) + " " + passage + " " + passage, "xx", "s0"))
    rows += [(86, None, "xx", "s1"), (87, "", None, None), (88, " \n\t ", "xx", "s1"), (89, "éa", "yy", "s2"), (90, "12 34 !", "xx", "s2")]
    rows += [(None, passage, "xx", "s0"), (None, None, None, None), rows[1], rows[1], rows[85]]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return make_docs(spark, corpus).repartition(5).cache()


@pytest.fixture(scope="session")
def none(spark):
    return make_docs(spark, [])
