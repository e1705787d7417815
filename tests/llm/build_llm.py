"""Small tables for the tests of this folder."""

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, extra=True):
    """Rows (doc_id, text[, lang[, source]]); with columns whose names clash with those of operators."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src1",
             None if r[1] is None else len(r[1])) for r in rows]
    found = spark.createDataFrame(full, DOCUMENTS)
    if not extra:
        return found
    return found.selectExpr(
        "*", "7 AS n_words", "'x' AS kept", "8 AS component", "9 AS digest", "'y' AS node", "1 AS token",
        "2 AS term", "3 AS words", "4 AS key", "5 AS ratio", "6 AS host", "0 AS likelihood", "1 AS phrase")


def sentence(rng, n, words=2000):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def near_copies(seed=5, families=12, copies=9, length=120):
    """Texts in families whose members differ from their base by a few words, and some unrelated ones."""
    rng = random.Random(seed)
    texts = []
    for _ in range(families):
        base = sentence(rng, length).split()
        for k in range(copies):
            text = list(base)
            for _ in range(rng.randrange(0, 7)):
                text[rng.randrange(len(text))] = f"x{rng.randrange(10 ** 6)}"
            if k % 4 == 3:
                text = text[: rng.randrange(length // 2, length)]
            texts.append(" ".join(text))
    texts += [sentence(rng, rng.randrange(1, 80)) for _ in range(30)]
    texts += texts[:15]
    rng.shuffle(texts)
    return texts


EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (None, "two words"), (None, None),
         (5, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 3), (6, "word " * 60000), (7, "é!? ß"),
         (8, "the same text of nine words stands here twice"), (9, "the same text of nine words stands here twice")]
