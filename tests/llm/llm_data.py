"""Small documents for the operator tests."""

import random
import re

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def low(text):
    """A-Z in lower case, nothing else."""
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def documents(seed=3, n=60):
    """Invented prose with copies, near copies, repeated lines, junk and odd rows."""
    rnd = random.Random(seed)
    stems = ["the", "of", "and", "to", "rain", "Stone", "river", "Wind", "älter", "größe", "niño", "tree,", "light.", "7", "a1b2"]
    stems += ["".join(rnd.choice("aeioustrnl") for _ in range(rnd.randint(3, 9))) for _ in range(200)]

    def prose(count):
        out = []
        for i in range(count):
            out.append(rnd.choice(stems))
            out.append("\n" if rnd.random() < 0.08 else "  " if rnd.random() < 0.1 else " ")
        return "".join(out)

    texts = [prose(rnd.randint(1, 160)) for _ in range(n)]
    texts += [texts[4]] * 4 + [texts[5].replace("the", "rain", 1), texts[5] + " more"]
    texts += [None, "", " \n\t ", "x", "### $$$ " * 80, "same line of words here\n" * 30, prose(6000), "\0\x01 odd\x7f \u2028\u00a0é"]
    rows = [(i, t, "en" if i % 3 else "de", f"s{i % 4}", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[7], rows[7], (None, texts[8], "en", None, None), (500, texts[9], None, "s", 1), (501, None, None, None, None)]
    return rows
