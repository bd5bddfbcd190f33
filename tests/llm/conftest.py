import re
import zlib

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {i: i + 32 for i in range(65, 91)}


def lowered(text):
    return (text or "").translate(_LOWER)


def spaced_words(text):
    return SPACED.findall(text or "")


def remainder(key):
    return zlib.crc32(str(key).encode()) % 5


@pytest.fixture(scope="session")
def ready(spark):
    from ledgerloom.llm.queries import prepared

    prepared(spark)
    return spark


@pytest.fixture(scope="session")
def odd_rows():
    """Null and empty texts, a null key, repeated rows, a very long text, words beyond ASCII."""
    poem = "the quick brown fox jumps over the lazy dog while nine wizards box seven quilts"
    return [
        (1, None), (2, ""), (3, " \t\n\n"), (4, poem), (4, poem), (5, poem), (None, poem), (None, None),
        (6, "Élan é ñandú " * 30), (7, "one two"), (8, ("alpha beta gamma " * 9 + "\n") * 400),
        (9, "x" * 5000), (10, poem.upper() + "\n" + poem), (11, poem + " mail bob@example.org +1 (555) 123-4567"),
    ]


@pytest.fixture(scope="session")
def odd_docs(ready, odd_rows):
    """The odd rows with further columns that are named like intermediate ones."""
    extra = "row string, fp string, _key string, n_words string, line string, doc string, words string, kept string"
    rows = [(key, text, *"abcdefgh") for key, text in odd_rows]
    return ready.createDataFrame(rows, f"doc_id long, text string, {extra}").repartition(3)


@pytest.fixture(scope="session")
def no_docs(ready):
    return ready.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(ready, sf):
    return ready.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="session")
def texts(documents):
    return {row.doc_id: row.text for row in documents.collect()}
