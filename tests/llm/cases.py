"""Small tables with the awkward rows every operator must take, and helpers for brute-force comparisons."""

import random

WORDS = ("the of and to river stone light under winter carries small bright signal harbour north engine letters "
         "quiet morning across paper between window yellow garden seven walking").split()
LAYOUT = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, digest string, uid int"


def prose(seed: int, words: int) -> str:
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + str(pick.randrange(40)) for _ in range(words))


def awkward_rows() -> list[tuple]:
    """Nulls, empty and long texts, copies, ties, repeated rows; columns that clash with names used inside."""
    base = prose(1, 120)
    edited = base.split()
    edited[60] = "changed"
    texts = [base, base, base.replace(" ", "  "), " ".join(edited), None, "", " \t\n", "one", "ONE", "one two three",
             prose(2, 6000), prose(2, 6000) + " tail", "é" * 50, "a\x00b", prose(3, 80), prose(3, 79), "x" * 3000,
             base.upper(), prose(4, 300), prose(5, 300)]
    rows = [(i, t, "en", "src0", None, "k", "d", 7) for i, t in enumerate(texts)]
    return rows + [rows[0], rows[18], (None, base, None, None, None, None, None, None), (None, None) + (None,) * 6]


def table(spark, rows, layout=LAYOUT):
    return spark.createDataFrame(rows, layout)
