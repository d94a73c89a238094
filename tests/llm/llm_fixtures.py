"""Small tables with nulls, empty and very long texts, ties, repeated rows and clashing column names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h long, fp long, size string, copies int"


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def odd_rows():
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    texts = [
        (1, base, "s1"),
        (2, " ".join(near), "s1"),
        (3, base, None),
        (3, base, None),
        (4, None, "s2"),
        (5, "", "s2"),
        (6, " \t\r\n\x0b\x0c ", "s2"),
        (7, "one", "s3"),
        (8, "One two\x1cthree four", "s3"),
        (9, prose(2, 20000, 5000), "s3"),
        (10, "same " * 300, "s3"),
        (None, prose(3, 60), "s1"),
        (None, None, None),
        (11, prose(4, 30) + "\n" + prose(1, 120)[:300] + "\n\n" + prose(4, 30), "s4"),
        (12, "é ñ ü ### $$ İ ΣΑΣ 日本 don't <|endoftext|> x9", "s4"),
        (13, prose(5, 13), "s5"),
        (14, prose(5, 13) + " end", "s5"),
        (15, "start " + prose(5, 13), "s5"),
    ]
    return [(i, t, "en", s, None if t is None else len(t), 7, 8, "x", 2) for i, t, s in texts]


def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
