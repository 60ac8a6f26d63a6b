"""Small fixtures shared by the operator tests."""

DOC_DDL = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    """Words drawn by a fixed rule, a full stop after every eighth."""
    out, x = [], seed * 7919 + 13
    for i in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[(x >> 8) % len(WORDS)] + str((x >> 16) % 90) + ("." if i % 8 == 7 else ""))
    return " ".join(out)


def documents(spark, texts, ids=None, sources=None):
    ids = list(range(len(texts))) if ids is None else ids
    sources = ["s"] * len(texts) if sources is None else sources
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in zip(ids, texts, sources)], DOC_DDL)


def ascii_lower(t: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
