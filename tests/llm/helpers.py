"""Small tables with the awkward rows every operator must take."""

import hashlib
import random

WORDS = [f"word{k}" for k in range(400)]

DOC_SCHEMA = "doc_id long, text string, id string, hash string, component int, lang string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def texts():
    """Null, empty, blank, short, tied, repeated, near and very long texts, many scripts."""
    base = prose(1, 120)
    near = base.replace(" ", "  ", 3) + " tail"
    return [
        None, "", "  \t\n", "a", "A b", "a\nB", base, base.upper(), near, base + " tail other",
        prose(2, 3000), "\x85\xa0 naïve … “quoted” 漢字 \u2028 \x1c x", "Ünï\u0301 cafe\u0301 ﬁ Ⅳ", prose(3, 60), prose(3, 60),
        "x" * 5000, "▁ literal ▁mark", "<|endoftext|> <|ENDOFTEXT|> don't I'LL end.,;", "é" * 40 + " \U0001f600 ok",
    ]


def documents(spark, rows=None):
    """Documents with extra columns whose names the operators use themselves."""
    if rows is None:
        rows = list(enumerate(texts(), start=5))
    data = [(i, t, "x", "h", 1, None, len(t) if t else None) for i, t in rows]
    return spark.createDataFrame(data, DOC_SCHEMA)


def found(df, key="id"):
    return {row[key]: row for row in df.collect()}
