import pytest


@pytest.fixture(scope="session")
def path():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, and
    extra columns whose names clash with the operators' own."""
    long_text = " ".join(f"w{i % 700}" for i in range(9000)) + " " + "x" * 40_000
    rows = [
        (1, "Hello World, this is a text of some words.", "en", "s", 1, 5, "a"),
        (2, "hello world, this is a text of some words.", None, None, None, 6, "b"),
        (2, "hello world, this is a text of some words.", None, None, None, 6, "b"),
        (3, None, "en", "s", 0, None, None),
        (4, "", "en", "s", 0, 1, "c"),
        (None, "no id here", "en", "s", 9, 2, "d"),
        (None, None, None, None, None, None, None),
        (5, long_text, "en", "s", 8, 3, "e"),
        (6, long_text + " tail", "en", "s", 8, 3, "e"),
        (7, "  \n\t \n", "en", "s", 6, 3, "f"),
        (8, 'token = "9f8e7d6c5b4a39281706f5e4d3c2b1a0" é 中文 😀', "en", "s", 6, 3, "f"),
        (9, "\x00\x1c odd <|endoftext|> İstanbul ΑΣ é", "en", "s", 6, 3, "f"),
    ]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, row long, digest string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


@pytest.fixture(scope="session")
def labels(spark):
    """Labels for made documents 1000-1119: good prose and bad ones, toxic or not."""
    return spark.createDataFrame(
        [(1000 + i, int(i % 3 != 0), int(i % 5 == 0)) for i in range(120)] + [(None, 1, 0), (1, None, None)],
        "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def labelled_docs(spark):
    rows = []
    for i in range(120):
        words = [f"{a}{b}" for a, b in zip("the and of to in that it is was for".split() * 4, "a e i o u".split() * 8)]
        words = words[i % 7:] + words[:i % 7]
        if i % 5 == 0:
            words[7] = "moron"
        text = ". ".join([" ".join(words[:20]), " ".join(words[20:])]) + ".\n" + " ".join(words[5:30]) + "."
        if i % 3 == 0:
            text = "\n".join(line.replace(" ", " | ").upper() + "!!!" for line in text.split("\n"))
        rows.append((1000 + i, text))
    return spark.createDataFrame(rows, "doc_id long, text string")
