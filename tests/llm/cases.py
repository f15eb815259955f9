"""Small tables that every operator must get right."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ["kept", "n_words", "size", "_row", "key", "digest", "uid", "value", "block", "_stays", "label", "_id", "spans", "_verdict"]


def documents(spark, rows):
    """``rows`` are (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def edge_rows():
    """Null, empty, blank, very long and repeated texts, ties, null identifiers and sources."""
    prose = " ".join(f"w{i}" for i in range(120))
    long = " ".join(f"x{i % 977}y{i}" for i in range(30_000))
    return [
        (1, None, "a"), (2, "", "a"), (3, " \t\n\x0b\x0c\r", None), (4, prose, "b"), (5, prose, None), (6, prose + " tail", "c"),
        (7, long, "d"), (8, long + "é", "d"), (9, "one", "a"), (9, "one", "a"), (None, prose, "b"), (None, None, None),
        (10, "Ünï cödé\nline " + "z" * 50 + "\nline " + "z" * 50, "c"),
    ]


def with_clashing_columns(frame):
    from pyspark.sql import functions as F

    return frame.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)])


def prose(seed, n_documents=60, n_words=90, vocabulary=400):
    """Documents that copy passages from each other."""
    rnd = random.Random(seed)
    words = [f"{rnd.choice('abcdefgh')}{rnd.randrange(vocabulary)}" for _ in range(vocabulary)]
    made = []
    for i in range(n_documents):
        body = [rnd.choice(words) for _ in range(rnd.randrange(n_words * 2))]
        if made and rnd.random() < 0.6:
            other = rnd.choice(made)[1].split()
            at = rnd.randrange(len(other) + 1)
            body[len(body) // 2 : len(body) // 2] = other[at : at + rnd.randrange(1, n_words)]
        made.append((i * 3 + 1, " ".join(body)))
    rnd.shuffle(made)
    return made
