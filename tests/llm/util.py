import random

WORDS = "alpha beta gamma delta Épsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def corpus(n=60, seed=3):
    """Small documents with copies, near copies, blanks and a null."""
    r = random.Random(seed)
    texts = [" ".join(r.choice(WORDS) for _ in range(r.randint(1, 120))) for _ in range(n)]
    texts += [texts[0], texts[0], texts[1] + " tail", "", "  \n\t ", None, "one", "one two", "x" * 5000, "é" * 700]
    return [(i, t) for i, t in enumerate(texts)]


def frame(spark, rows, extra=True):
    if extra:  # columns whose names the operators use themselves
        return spark.createDataFrame([(i, t, "en", "a", "b", 1) for i, t in rows], "doc_id long, text string, lang string, fp string, part string, component_id int")
    return spark.createDataFrame(rows, "doc_id long, text string")


def thue_morse(k):
    """Two unlike words of 2^k letters that agree under any polynomial hash modulo 2^64 from k = 11 on, or earlier."""
    x = [0]
    for _ in range(k):
        x += [1 - b for b in x]
    return "".join("ab"[b] for b in x), "".join("ba"[b] for b in x)
