"""Rows that every text operator has to take: nulls, empty, white, tied, repeated and long texts, clashing columns."""

import random

SCHEMA = "doc_id bigint, text string, norm string, key string, n bigint, id string, count int"


def texts(seed: int = 1, n: int = 60) -> list[tuple]:
    r = random.Random(seed)
    vocab = ["alpha", "Beta", "gamma", "délta", "the", "of", "a", "ß", "x1", "end,", "日本"]
    rows = [(i, " ".join(r.choice(vocab) for _ in range(r.randint(1, 30)))) for i in range(n)]
    rows += [(n, None), (n + 1, ""), (n + 2, " \n\t"), (n + 3, rows[0][1]), (n + 4, rows[0][1].replace(" ", " \n ")), (n + 5, rows[5][1] + " tail"), rows[7], (None, rows[3][1]), (None, None)]
    rows += [(n + 10, "word " * 20_000), (n + 11, "y" * 30_000), (n + 12, "The of the of")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", "k", 1, "z", 2) for r in rows], SCHEMA)
