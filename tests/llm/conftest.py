import random

import pytest

WORDS = ("the of river stone light over under cold warm green table window paper music garden winter summer "
         "north south silver copper letter answer question market harbour bridge forest engine signal").split()

#: doc_id, text and columns whose names the operators use themselves.
SCHEMA = ("doc_id long, text string, lang string, fp string, grams string, bands string, length string, kept string, "
          "sequence_id string, copy string, letter string, n string, of string, _dropped string")


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows):
        """Documents from (doc_id, text) or (doc_id, text, lang)."""
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, *(["x"] * 11)) for r in rows]
        return spark.createDataFrame(full, SCHEMA)
    return make


@pytest.fixture(scope="session")
def sentence():
    def make(rng: random.Random, n: int) -> str:
        return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", "."]) for _ in range(n))
    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, one word, punctuation, other scripts, very long."""
    return [None, "", " \n\t ", "word", "... !!", "日本語のテキスト", "É́ßẞ Ωμέγα", "long " * 30000, "x" * 50000]
