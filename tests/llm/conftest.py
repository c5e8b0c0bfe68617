"""Small tables with the odd cases: nulls, empty and long texts, repeats, clashing names."""

import pytest

LONG = " ".join(f"word{k % 977}x{k}" for k in range(4000))
PASSAGE = "The quick grey heron crossed the river before dawn and nobody saw it land. " * 6


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [
        (1, "one two three four five six seven", "en", "a", 1),
        (2, "one two three four five six seven", "en", "a", 1),
        (3, "ONE two three four five six seven", "en", None, 1),
        (4, None, None, "b", None),
        (5, "", "en", "b", 0),
        (6, " \n\t ", "en", "b", 4),
        (7, "short text", "en", "a", 10),
        (8, LONG, "en", "a", len(LONG)),
        (9, LONG + " tail", "en", "a", len(LONG) + 5),
        (10, "in front " + PASSAGE + "behind", "en", "c", 1),
        (11, PASSAGE + "ähnlich — 中文  zwei\n\n drei", "de", "c", 1),
        (12, "a a a a a a a a a a a a a a a a a a a a", "en", "c", 1),
        (12, "a a a a a a a a a a a a a a a a a a a a", "en", "c", 1),
        (None, "one two three four five six eight", "en", "c", 1),
        (None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def clashing(odd_docs):
    """The same with columns named like outputs and like inner columns."""
    from pyspark.sql import functions as F

    names = [
        "score", "kept", "shard", "slot", "copy", "position", "ids", "n_tokens", "block", "part",
        "payload", "n", "cid", "t", "component_id", "k0", "held_out", "predicted", "words", "a.b",
        "host", "rule", "said", "at", "parts", "num", "own", "failed", "x", "left", "sha",
        "__host", "__score", "__at", "__slot", "__quality", "__rate", "__t", "__whole",
    ]
    return odd_docs.withColumns({c: F.lit(f"own {c}") for c in names})
