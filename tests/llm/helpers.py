"""Small inputs and brute-force versions shared by the operator tests."""

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(30)) for _ in range(n))


def corpus():
    """Documents with exact copies, near copies, chains, nulls, empties, repeated rows and a hot text."""
    docs = [(i, prose(i, 20 + i % 60)) for i in range(60)]
    docs += [(100 + i, docs[3][1]) for i in range(40)]  # a hot text
    docs += [(200 + i, docs[5][1].replace(" ", "\n\t", 1 + i)) for i in range(4)]  # equal but for blanks
    base = prose(999, 120).split()
    for i in range(12):  # near copies: a few words changed each
        words = list(base)
        words[(7 * i) % 120] = f"changed{i}"
        docs.append((300 + i, " ".join(words)))
    chain = prose(500, 90).split()
    for i in range(6):  # neighbours are alike, the ends are not
        docs.append((400 + i, " ".join(chain[i * 5 : i * 5 + 60])))
    docs += [(500, None), (501, ""), (502, "  \n"), (503, "one two"), (504, "one  two"), (505, "ONE two three"), (506, "É é É é É é É"), (507, "é é é é é é é")]
    docs += [(600, "word " * 30000), (601, prose(77, 9000))]  # very long
    docs += [(7, docs[7][1])]  # a repeated row
    return docs


def frame(spark, rows, schema="doc_id bigint, text string", extra=True):
    df = spark.createDataFrame(rows, schema)
    if extra:  # columns whose names clash with the operators' own
        from pyspark.sql import functions as F

        for name in ("kept", "n", "sha", "print", "words", "bucket", "cid", "batch", "score", "host", "ids"):
            df = df.withColumn(name, F.lit("x"))
    return df.repartition(5)


def got(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())
