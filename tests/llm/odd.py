"""Documents that no operator may trip over."""

import random

WORDS = "the and ledge orchard stone river wing candle paper salt iron mill feather cloud harbor".split()

CLASHING = "kept string, found long, statistics string, size string, copy string, mix_size string, layout string, x0 long"


def prose(seed, count):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(count))


def documents():
    """(doc_id, text, lang, source, n_chars): nulls, empty and long texts, repeated rows, a
    missing id, and copies."""
    plain = prose(1, 60)
    rows = [
        (1, plain, "en", "a", 1), (2, None, "en", "a", None), (3, "", None, None, 0), (4, " \t\n ", "en", "b", 1),
        (5, plain, "en", "b", 1), (5, plain, "en", "b", 1), (None, plain, "en", "c", 1), (None, prose(2, 40), None, None, 1),
        (6, prose(3, 30_000), "en", "a", 1), (7, "Ünïcode " * 30 + "中文 🎉", "fr", "a", 1), (8, "one two", "en", "a", 1),
        (9, plain.upper(), "en", "c", 1), (10, prose(4, 30), "en", "c", 1),
    ]
    return rows


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def odd_documents(spark):
    """The same with further columns, named like those that operators add."""
    names = ["kept", "found", "statistics", "size", "copy", "mix_size", "layout", "x0"]
    rows = [(*row, "k", 7, "s", "z", "c", "m", "l", i) for i, row in enumerate(documents())]
    assert len(names) == len(CLASHING.split(","))
    return spark.createDataFrame(rows, f"{DOCS}, {CLASHING}").repartition(3)


def empty_documents(spark):
    return spark.createDataFrame([], DOCS)


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)
