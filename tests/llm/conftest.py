import pytest

SCHEMA = "doc_id long, text string, lang string, source string, key string, run long, row long"
BASE = " ".join(f"word{i} of the long passage number {i * i}," for i in range(60))


def rows_of(texts, first=0):
    return [(first + i, t, "en", "s", "k", 1, 2) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def base():
    return BASE


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    texts = [
        BASE, BASE, BASE + " and one more", BASE.replace("word7 ", "wordx "), "", None, " \n\t ", "a", "two words", "Two WORDS",
        "three short words", "12 345 !?", "ß Straße ñandú 漢字    ", "x" * 3000, "ab " * 2000, BASE * 40, "<|endoftext|> " + BASE[:200],
        "prefix " + BASE[300:900] + " suffix", BASE[300:900], "́ combining", "A  b   c \n d",
    ]
    rows = rows_of(texts)
    rows += [rows[0], rows[4], (None, BASE, None, None, None, None, None), (None, "no id", None, None, None, None, None), (None, None, None, None, None, None, None)]
    rows += [(3, "another text of id three", "en", "s", None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def unique(odd):
    """The same without null and repeated identifiers."""
    return odd.where("doc_id is not null").dropDuplicates(["doc_id"]).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def crowd(spark):
    """A third of all rows are one text, a third near copies of another, the rest is dealt from few words."""
    rows = []
    for i in range(300):
        if i % 3 == 0:
            text = BASE[:500]
        elif i % 3 == 1:
            words = BASE[400:1400].split()
            words[i * 7 % len(words)] = f"w{i}"
            text = " ".join(words)
        else:
            text = " ".join(f"t{i * j % 97}" for j in range(5 + i % 50)) + " " + BASE[100:260]
        rows.append((i, text, "en", "s", "k", 1, 2))
    return spark.createDataFrame(rows, SCHEMA).repartition(7).cache()
