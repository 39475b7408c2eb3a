import pytest

COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    # Names that operators use for columns of their own.
    " size long, name string, row_id long, path string, shard int, block string, tokens int, __copy int"
)


def rows(texts, start=0):
    """Rows of documents; each text may be a pair of id and text."""
    pairs = [t if isinstance(t, tuple) else (start + i, t) for i, t in enumerate(texts)]
    return [(i, t, None, f"s{(i or 0) % 3}" if i != 4 else None, None, 7, "n", 1, "p", 0, "b", 2, 3) for i, t in pairs]


@pytest.fixture(scope="session")
def documents(spark):
    def make(texts):
        return spark.createDataFrame(rows(texts), COLUMNS)

    return make


#: Null and empty texts, a null id, a row repeated in full, one id with two texts, a very
#: long text and one beyond ASCII.
AWKWARD = [
    (1, "one two three four five six seven"), (1, "one two three four five six seven"), (2, None), (3, ""), (4, " \t\n"),
    (None, "one two three four five six seven"), (5, "word " * 30_000), (6, "Über 漢字 \U0001f600 é"), (6, "another text"),
    (None, None), (7, "one two three four five six seven"), (8, "x" * 50_000),
]


@pytest.fixture(scope="session")
def awkward(documents):
    return documents(AWKWARD).cache()


@pytest.fixture(scope="session")
def nothing(documents):
    return documents([])
