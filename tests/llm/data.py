"""Small tables with every kind of awkward row."""

import random

from pyspark.sql import functions as F

CLASHING = "id bucket block size key name bin found row low keys score query_id rank host paths kind level target component found_at".split()


def texts(seed=3, n=40):
    """Documents of a few words from a small vocabulary: many ties, copies, near copies and shared passages."""
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "bdfgklmnprst" for b in ("a", "e", "io", "ou", "É")]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    out = []
    for i in range(n):
        kind = i % 8
        words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 5, 40, 90]))]
        if kind == 3 and out:
            out.append(out[rng.randrange(len(out))])
        elif kind == 4 and out:
            old = out[rng.randrange(len(out))].split(" ")
            old[rng.randrange(len(old))] = "Changed"
            out.append(" ".join(old))
        elif kind == 5:
            at = rng.randrange(len(words) + 1)
            out.append(" ".join([*words[:at], passage, *words[at:]]))
        else:
            out.append(rng.choice([" ", "\n", "  "]).join(words))
    return out


def documents(spark, rows=None, extra=True):
    """(doc_id, text, source) and columns whose names the operators use inside."""
    if rows is None:
        rows = [(i * 3, t, f"s{i % 3}") for i, t in enumerate(texts())]
        rows += [(None, "a b c d e f", "s1"), (None, None, None), (7, None, "s0"), (8, "", "s0"), (9, " \n\t ", None), (10, "word", "s2")]
        rows += [rows[5], rows[5]]
        rows += [(500, "long Text É " * 4000, "s1"), (501, "long Text É " * 4000 + "end", "s1"), (502, "x" * 100000, "s2")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    if extra:
        df = df.select("*", *(F.lit(i).alias(n) for i, n in enumerate(CLASHING)))
    return df.repartition(3)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
