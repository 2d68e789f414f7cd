"""Small awkward tables shared by the operators' tests."""


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omikron pi rho sigma tau".split()


def story(n, seed=0):
    """n words without repeated passages."""
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 16) % len(WORDS)] + str((x >> 8) % 97))
    return out


#: Column names that the operators use inside, as columns of the input.
CLASHING = "text string, doc_id bigint, source string, row string, id string, rid int, n int, size int, copies int, shard int"


def documents(spark, rows):
    """rows: (doc_id, text[, source])."""
    full = [(r[1], r[0], r[2] if len(r) > 2 else "s", "r", "i", 1, 2, 3, 4, 5) for r in rows]
    return spark.createDataFrame(full, CLASHING)


