"""Small awkward tables, and brute-force versions to compare with."""

import re
from collections import Counter
from math import log

BLANK = re.compile("[\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, run string, row string, tokens string"


def awkward(spark, extra=()):
    """Nulls, empty and blank texts, a very long text, ties, repeated rows, clashing column names."""
    long_text = " ".join(f"word{k % 977} number{k}." for k in range(30000))
    texts = [(1, "a  b\tc"), (2, "a b c"), (3, None), (4, ""), (5, " \n "), (6, long_text), (7, long_text), (7, long_text),
             (None, "a b c"), (None, "alone with no name"), (8, "x"), (8, "x"), (9, "é 🙂 ▁ ü"), *extra]
    return spark.createDataFrame([(i, t, None if i == 2 else "en", None, None, "r", "s", "t") for i, t in texts], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [w for w in BLANK.split(low) if w]


def shingle_weights(text):
    w = words(text)
    found = Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()
    return {k: 1 + log(n) for k, n in found.items()}


def probability_jaccard(a, b):
    if not a or not b:
        return float(not a and not b)
    total = 0.0
    for i in a.keys() & b.keys():
        total += 1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in a.keys() | b.keys())
    return total
