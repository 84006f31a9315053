"""Small tables with all that a document table may hold, and plain versions of what operators compute."""

import random
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
#: Columns that a table may have beside the usual ones, with names that operators use within.
CLASHING = ["id", "row", "rank", "score", "token", "node", "label", "chunk", "key", "count", "size", "range", "h", "n", "bucket", "u", "v", "_text", "mark"]
SYLLABLES = "the of and thion ereat ing to was a on re ed ou lyan wh st onble".split()


def words(text):
    return WORDS.findall((text or "").translate(LOWER))


def prose(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(n))


def edited(rng, text, changes):
    parts = text.split(" ")
    for _ in range(changes):
        parts[rng.randrange(len(parts))] = rng.choice(SYLLABLES) + str(rng.randint(0, 999))
    return " ".join(parts)


def corpus(seed=1, n=60):
    """(doc_id, text, lang, source, n_chars): copies, near copies, shared passages, nulls, blanks, a very long word and text."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randint(1, 150)) for _ in range(n)]
    passage = prose(rng, 40)
    for k in range(0, n, 5):
        texts[k] = f"{texts[k]} {passage}\n{texts[(k * 7 + 1) % n]}"
    base = prose(rng, 120)
    texts += [edited(rng, base, rng.randint(0, 8)) for _ in range(25)] + [base] * 4
    texts += [None, None, "", " \n\t", "!!! 123 ---", "a", "A b", "É à Ü ß Σίσυφος 漢字", "x" * 3000, prose(rng, 6000), "the the the the the the the the", "ab" * 400, "ab" * 400]
    return [(k * 3 % len(texts) if len(texts) % 3 else k, t, None if k % 11 == 0 else ["en", "fr"][k % 2], f"s{k % 3}", len(t or "")) for k, t in enumerate(texts)]


def frame(spark, rows, extra=True):
    """The rows as documents; extra: with columns of clashing names."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING]) if extra else df


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=lambda r: tuple((x is None, str(type(x)), x) if not isinstance(x, (bytes, bytearray)) else (False, "b", bytes(x)) for x in r))
