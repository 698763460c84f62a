"""Small tables with the awkward rows that every operator has to put up with."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns whose names operators also use for their own.
CLASHES = "mark long, cut string, counts int, fp long, digests int, graded string, predicted string, p_top double, n_tokens string"
CLASH_VALUES = (1, "c", 2, 3, 4, "g", "p", 0.25, "n")


def prose(seed, words, vocabulary=400):
    draw = random.Random(seed)
    names = ["".join(draw.choice("aeioubcdfglmnprst") for _ in range(draw.randint(2, 9))) for _ in range(vocabulary)]
    out, left = [], words
    while left > 0:
        n = min(left, draw.randint(4, 14))
        sentence = " ".join(draw.choice(names) for _ in range(n))
        out.append(sentence.capitalize() + ".")
        left -= n
    return " ".join(out)


def awkward_documents():
    """Nulls in any column, empty and very long texts, repeated ids and rows."""
    long_text = prose(5, 20_000)
    return [
        (1, prose(1, 80), "en", "a", 1),
        (2, prose(1, 80), "en", "a", 1),
        (3, None, None, None, None),
        (4, "", "en", None, 0),
        (5, "   \n\t ", "fr", "b", 5),
        (6, long_text, "en", "b", len(long_text)),
        (7, "one", "en", "b", 3),
        (7, "one", "en", "b", 3),
        (8, prose(2, 90) + " " + prose(3, 60), "de", "c", None),
        (9, prose(4, 50) + "\n" + prose(3, 60) + "\n" + prose(6, 40), "de", "c", None),
        (None, prose(7, 70), None, "c", None),
        (None, None, None, None, None),
        (10, "x" * 200_000, "en", "d", 200_000),
        (11, "漢字 \U0001f600 ́ \x85\x1c é  \n\n z", "xx", "d", 9),
        (11, "another text under the same id", "en", "d", 30),
    ]


def documents(spark, rows=None, clashes=False):
    rows = awkward_documents() if rows is None else rows
    if clashes:
        return spark.createDataFrame([(*r, *CLASH_VALUES) for r in rows], f"{DOCS}, {CLASHES}")
    return spark.createDataFrame(rows, DOCS)
