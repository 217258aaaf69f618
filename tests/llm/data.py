"""Small tables with awkward rows."""

from __future__ import annotations

import random

WORDS = [a + b for a in ("an", "er", "in", "on", "th", "wh", "ou", "re") for b in ("", "s", "ed", "ing", "ly", "tion", "able", "est")]
DOCUMENTS = "doc_id long, text string, lang string, kept boolean, n long, chunk long, spans string, words long, `__row` string"
CLASHES = (False, 7, 3, "x", 5, "y")


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + (rng.choice(".,!") if rng.random() < 0.1 else "") for _ in range(n))


def edited(text: str, seed: int, n: int) -> str:
    rng, words = random.Random(seed), text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice(WORDS) + "x"
    return " ".join(words)


def texts() -> list[tuple[int | None, str | None]]:
    shared, base = prose(1, 80), prose(2, 300)
    rows: list[tuple[int | None, str | None]] = [
        (1, None),
        (2, ""),
        (3, " \t\n\r\x0b\x0c "),
        (4, "one"),
        (5, "One two"),
        (6, "one  two"),
        (7, "one two"),
        (7, "one two"),
        (8, "a " * 200),
        (9, "aaaaaaaaaa" * 30),
        (10, base),
        (11, base.replace(" ", "\n ")),
        (12, base.upper()),
        (None, base),
        (None, None),
        (13, prose(3, 100) + " " + shared),
        (14, shared + " " + prose(4, 100)),
        (14, prose(5, 60)),
        (15, prose(6, 40) + " " + shared + " " + prose(7, 40) + " " + shared),
        (16, "ünïcødé   naïve 日本語   x\x00y <|endoftext|> don't 12.5% ###"),
        (17, prose(8, 30_000)),
        (-5, prose(6, 40)),
    ]
    rows += [(100 + i, edited(base, i, i % 40)) for i in range(80)]
    rows += [(300 + i, "License: free to use. " * 6 + prose(100 + i, 20)) for i in range(30)]
    return rows


def documents(spark, rows=None):
    """Rows with columns whose names the operators use themselves."""
    rows = texts() if rows is None else rows
    return spark.createDataFrame([(d, t, "en", *CLASHES) for d, t in rows], DOCUMENTS)
