import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    from branchledger.llm.common import ship

    ship(spark)


@pytest.fixture(scope="session")
def odd_rows():
    """Ids and texts: null, empty, blank, short, very long, equal, nearly equal, repeated rows."""
    base = " ".join(f"w{i * 7919 % 997}" for i in range(120))
    near = base.replace("w0 ", "other ", 1)
    far = " ".join(f"v{i * 31 % 1009}" for i in range(90))
    passage = " ".join(f"p{i}" for i in range(60))
    long = " ".join(f"x{i * i % 30011}" for i in range(40_000))
    return [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "One two three"), (6, "one  two\nthree"), (7, base), (8, base), (9, near),
        (10, base.upper()), (11, far), (12, far + " tail"), (13, far + " " + passage), (14, passage + " " + near[::-1]), (15, long),
        (16, long), (17, "é à ü " * 80), (18, "é à ü " * 80 + "ß"), (19, "a" * 5000), (20, "#$%& " * 40), (21, base), (21, base), (22, None),
        (None, far), (None, None), (23, "x y  z  q\x1c r"), (24, "the cat <|endoftext|> sat's  on \r\n\r\n the   mat."),
    ]


@pytest.fixture
def odd(spark, odd_rows):
    """The odd rows as documents with null languages and columns whose names operators use inside."""
    rows = [(i, t, None if k % 3 else "en", None, None, k, "key", b"r", 1.5) for k, (i, t) in enumerate(odd_rows)]
    return spark.createDataFrame(rows, COLUMNS + ", id int, key string, rest binary, score double").repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], COLUMNS)
