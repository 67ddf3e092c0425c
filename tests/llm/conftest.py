import random

import pytest

WORDS = [a + b + c for a in ("ka", "lo", "mi", "ru", "te", "so") for b in ("n", "r", "st", "l") for c in ("a", "e", "o", "um")]


@pytest.fixture
def prose():
    """prose(n, seed): n invented words with sentences and lines."""

    def write(n, seed=0):
        rng, out = random.Random(seed), []
        for i in range(n):
            out.append(rng.choice(WORDS) + ("." if i % 9 == 8 else ""))
        text = " ".join(out)
        return "\n".join(text[i : i + 400] for i in range(0, len(text), 400))

    return write


@pytest.fixture
def table(spark):
    """table(rows): documents with these (doc_id, text, source); a column of a name that operators might use is added."""

    def make(rows, more="__id"):
        full = [(*r, *(None,) * (3 - len(r)), "kept") for r in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, source string, `{more}` string")

    return make


@pytest.fixture
def awkward(prose):
    """Nulls, empty and very long texts, ties and repeated rows."""
    long = prose(30_000, 5)
    return [(1, None), (2, ""), (3, " \t"), (4, long), (5, long + " end"), (None, "alone"), (7, prose(60, 1)), (7, prose(60, 1)), (8, prose(60, 1)), (9, "x" * 50_000), (10, "ünï 日本 🙂")]
