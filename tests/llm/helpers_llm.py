"""A small table with every awkward row, and words to make texts of."""

import random

SCHEMA = ("doc_id long, text string, lang string, id string, text_key string, row string, set_id string, score string, "
          "shard string, slot string, words string, host string, label string, branch string, cell string")
EXTRA = tuple("x" for _ in range(12))
LONG = " ".join(f"w{i % 977}q{i % 13}" for i in range(30_000))


def rows(pairs):
    return [(i, t, lang, *EXTRA) for i, t, lang in pairs]


def awkward():
    """Null ids and texts, empty, blank and very long texts, ties, repeated rows, repeated ids."""
    return rows([
        (1, "the cat sat on the mat and the dog ran off to the far green hill", "en"),
        (2, "the cat  sat on the mat and\tthe dog ran off to the far green hill", "en"),
        (3, "thecatsatonthematandthedogranofftothefargreenhill", None),
        (3, "thecatsatonthematandthedogranofftothefargreenhill", None),
        (None, "the cat sat on the mat and the dog ran off to the far green hill", "en"),
        (None, None, None), (4, None, "en"), (5, "", "de"), (6, " \n\t ", "fr"),
        (7, LONG, "en"), (8, LONG, "en"), (9, LONG + " end", None), (9, "another text under the same id", "en"),
        (10, "12345 67890", "en"), (11, "a", "en"), (12, "ß▁梦😀 é", "de"), (13, "x\x00y", "en"),
    ])


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def words(seed, n, size=400):
    rng = random.Random(seed)
    return [rng.choice("bcdfgklmnprst") + rng.choice("aeiou") + str(rng.randrange(size)) for _ in range(n)]
