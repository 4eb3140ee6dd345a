"""Small documents with every awkward case, and plain versions of what the operators compute."""

import random
import re

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
WORDS = "alpha beta gamma delta über façade naïve 東京 мир word line text data spark of the and to in it".split()
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng: random.Random, n: int, words=WORDS) -> str:
    return " ".join(rng.choice(words) + (str(rng.randrange(900)) if rng.random() < 0.6 else "") for _ in range(n))


def odd_documents(seed: int = 5) -> list[tuple]:
    """Nulls, empty and blank texts, copies, near copies, a very long text, repeated rows and shared passages."""
    rng = random.Random(seed)
    base, shared = prose(rng, 300), prose(rng, 80)
    lines = "\n".join(prose(rng, 6) for _ in range(8))
    texts = [
        (1, None), (2, ""), (3, " \n\t \r\n"), (4, "one"), (5, "one two three four"), (6, base), (7, base), (8, base.upper()),
        (9, base.replace("alpha", "omega", 3)), (10, shared + " " + prose(rng, 60)), (11, prose(rng, 40) + " " + shared + " " + prose(rng, 20)),
        (12, lines), (13, prose(rng, 5) + "\n" + lines + "\nend"), (14, "same\nsame\nsame\nsame\nsame"), (15, "a  b   c\n\n\n  d e　f \x85g 'tis it's 12 ½ <|endoftext|> x"),
        (16, prose(rng, 30_000)), (17, "word " * 400), (18, "x" * 50_000), (19, "The Word\nthe word"), (20, "One Two three FOUR"), (4, "one"), (6, base), (None, base), (None, None),
    ]
    near = prose(rng, 200)
    for i in range(30):
        w = near.split(" ")
        for _ in range(rng.randrange(0, 6)):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
        texts.append((100 + i, " ".join(w)))
    return [(d, t, "en", "s", None if t is None else len(t)) for d, t in texts]


def shingles(text, k=5):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def union_components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def remove_lines(docs):
    """doc -> kept text, by three-line windows seen before in the order of doc_id and place."""
    seen, out = set(), {}
    for d, t in sorted(docs):
        lines = (t or "").split("\n")
        gone, own = set(), []
        for i in range(len(lines) - 2):
            w = tuple(lines[i : i + 3])
            if not WORD.search("".join(w)):
                continue
            if w in seen or w in own:
                gone |= {i, i + 1, i + 2}
            own.append(w)
        seen |= set(own)
        out[d] = t if not gone else "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out
