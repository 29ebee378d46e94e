"""Small tables for the text operators: planted cases and the awkward ones."""

import random

import pytest

VOCABULARY = [f"w{i:03d}" for i in range(400)]


def prose(rng: random.Random, n: int) -> list[str]:
    return [rng.choice(VOCABULARY) for _ in range(n)]


def planted(seed: int = 7) -> list[tuple[int | None, str | None]]:
    """Copies, near copies, shared passages and lines, and every awkward text."""
    rng = random.Random(seed)
    docs: list[list[str]] = [prose(rng, rng.randint(30, 200)) for _ in range(24)]
    passage = prose(rng, 60)
    for at in (2, 5, 9):  # a passage in three documents, at different places
        docs[at][at:at] = passage
    copies = [list(docs[3]), list(docs[3]), list(docs[7])]
    for near in range(6):  # near copies of one document, each with another word
        changed = list(docs[11])
        changed[near * 5] = f"x{near}"
        copies.append(changed)
    rows = []
    for words in docs + copies:
        text, line = "", []
        for word in words:
            line.append(word)
            if len(line) == 12:
                text += " ".join(line) + rng.choice(["\n", " ", "\n\n"])
                line = []
        rows.append(text + " ".join(line))
    awkward = [None, "", " ", "\n", "\t \n", "one", "One ONE one", "a b c d e",
               "é è ê 漢字 ümlaut", "no break   x", "same same " * 40,
               rows[0].upper(), rows[1] + "\n" + rows[1], "long " + "y" * 5000,
               " ".join(prose(rng, 6000))]
    return [*enumerate(rows), *((100 + i, t) for i, t in enumerate(awkward))]


@pytest.fixture(scope="session")
def corpus(spark):
    """``(DataFrame, {id: text})`` with clashing extra columns; ids are unique."""
    rows = planted()
    frame = spark.createDataFrame(
        [(i, t, "en" if i % 2 else None, f"h{i % 3}", i, "x") for i, t in rows],
        "doc_id long, text string, lang string, source string, n_words long, row string")
    return frame.repartition(3), {i: t or "" for i, t in rows}


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame(
        [], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def repeats(spark):
    """Rows without an id, rows that repeat another one, and an id with two texts."""
    text = " ".join(f"v{i}" for i in range(40))
    rows = [(None, text), (None, None), (1, text), (1, text), (2, "other words here now yes"),
            (2, text + " end"), (3, None), (3, None)]
    return spark.createDataFrame([(i, t, None, None, None) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, "
                                 "n_chars long")
