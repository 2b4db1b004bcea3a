import random
import re

import pytest

SF = "/root/testdata/sf0.001"
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text) or (doc_id, text, lang) tuples."""
    def make(*rows):
        full = [(i, t, (rest or ["en"])[0], "s", None if t is None else len(t)) for i, t, *rest in rows]
        return spark.createDataFrame(full, DOCUMENT)
    return make


@pytest.fixture
def prose():
    """Texts of n random words, the same for the same seed."""
    def make(n, seed):
        draw = random.Random(seed)
        return " ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 6))) for _ in range(n))
    return make


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_words(text):
    return re.findall(rb"[A-Za-z0-9_\x80-\xff]+", (text or "").lower().encode())


def grams(text, n=5):
    own = plain_words(text)
    return {tuple(own[p:p + n]) for p in range(max(1, len(own) - n + 1))} if own else set()
