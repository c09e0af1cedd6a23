"""Small frames with the awkward cases, and plain-Python helpers."""

import random
import re

#: Extra columns whose names clash with those the operators work with.
EXTRA = "a long, b long, component string, bands string, score string, shard int, block int, n long, label_ string"


def documents(spark, rows):
    """``rows`` of (doc_id, text); the other columns are null or clash."""
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
    data = [(d, t, None, "src0" if d else None, None if t is None else len(t), 1, 2, "x", "y", "z", 3, 4, 5, None) for d, t in rows]
    return spark.createDataFrame(data, schema)


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def prose(rng: random.Random, n: int, size: int = 400) -> str:
    return " ".join("w" + str(rng.randrange(size)) for _ in range(n))


def awkward():
    """Null, empty, blank, one word, very long, repeated, null id."""
    long_text = prose(random.Random(9), 30_000)
    return [
        (1, None), (2, ""), (3, " \t\n \x0b"), (4, "word"), (5, long_text), (6, "a b c\na b c\n\na b c"), (6, "a b c\na b c\n\na b c"),
        (None, "no id here"), (7, "Tab\tand\x0cfeed  double  space \n end "), (8, "中文 テスト – “quotes” é"), (9, "x" * 3000),
        (10, "word"),
    ]


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
