"""Sample texts under a name of their own, as ``conftest`` is the tests' shared one."""

import random

WORDS = [a + b for a in ("the", "on", "er", "th", "st", "ha", "re", "wh") for b in ("", "in", "an", "ed", "ou", "ly")]


def prose(seed: int, n: int) -> str:
    """``n`` invented words, lines of about twelve."""
    r = random.Random(seed)
    words = ["".join(r.choices(WORDS, k=r.choice((1, 1, 2)))) for _ in range(n)]
    return "".join(w + ("\n" if i % 12 == 11 else " ") for i, w in enumerate(words)).strip()


#: Rows that every operator must take: NULLs, empty and blank texts, one word, repeated rows, a long text.
ODD = [
    (1, prose(1, 80)), (2, None), (3, ""), (4, " \n\t "), (5, "word"), (None, prose(2, 70)), (None, None),
    (6, prose(1, 80)), (6, prose(1, 80)), (7, prose(3, 4000)), (8, "É naïve ﬁ 日本語 ́x \x85 y"),
    (9, "x" * 30_000),
]
SCHEMA = "doc_id long, text string"
