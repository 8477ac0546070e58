"""Small corpora with planted cases."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}x{rng.randrange(7)}" for _ in range(n))


def rows(texts, source=lambda i: f"s{i % 3}"):
    return [(i, t, "en", source(i), len(t or "")) for i, t in enumerate(texts)]


def corpus(seed=1, n=60):
    """Prose with exact copies, near copies, a shared passage, nulls, empty and very long texts."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randrange(1, 200)) for _ in range(n)]
    passage = prose(rng, 55)
    texts += [prose(rng, 20) + " " + passage + "\n" + prose(rng, 30) for _ in range(4)]
    base = prose(rng, 300).split()
    for i in range(5):
        near = list(base)
        near[10 + i] = "changed"
        texts.append(" ".join(near))
    texts += [texts[3], texts[3], texts[7] + "\n", None, "", " \n\t ", "one", "one two three four", "a " * 80, "é ü \x0b x\x1cy", prose(rng, 9000)]
    return rows(texts)
