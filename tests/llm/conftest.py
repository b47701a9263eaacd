import random

import pytest

EXTRA = ("score", "kept", "piece", "print", "name", "length", "key", "h", "n", "row", "problem", "at", "__id", "class", "size", "doc", "mark")


@pytest.fixture(scope="session")
def make(spark):
    """(doc_id, text) pairs to a table of documents with further columns whose names clash."""

    def build(rows, kind="long"):
        schema = f"doc_id {kind}, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in EXTRA)
        return spark.createDataFrame([(i, t, None, None, None, *EXTRA) for i, t in rows], schema)

    return build


@pytest.fixture(scope="session")
def prose():
    """Invented sentences, the same on every run."""
    rng = random.Random(11)
    words = ["".join(rng.choice(("ba", "ne", "to", "ri", "su", "la")) for _ in range(rng.randint(1, 4))) for _ in range(400)]

    def text(n, seed):
        r = random.Random(seed)
        return " ".join(r.choice(words) for _ in range(n))

    return text
