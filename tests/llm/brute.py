"""Plain, slow versions of the operators, and small inputs with every odd case."""

import random
import re

WORD = re.compile("[^\x20\x09-\x0d]+")
#: Names that the operators use inside.
CLASHING = ("size", "count", "group", "part", "key", "shard", "slot", "rank", "value", "hits", "starts", "kept", "copies")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(
    f"{name} string" for name in CLASHING
)


def words(text):
    return WORD.findall(text or "")


def document(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), *(["x"] * len(CLASHING)))


def random_text(rng, count, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(count))


def odd_documents():
    """Nulls in every column, empty and very long texts, ties, repeated rows, shared passages."""
    rng = random.Random(5)
    passage, copy = random_text(rng, 70), random_text(rng, 120)
    rows = [
        document(1, None), document(2, ""), document(3, " \n\t "), document(4, "one"), document(5, "One two"),
        document(6, copy), document(7, copy), document(8, copy + " end"), document(8, copy + " end"),
        document(9, passage + " " + random_text(rng, 40)), document(10, random_text(rng, 33) + "\n" + passage),
        document(11, random_text(rng, 60) + " " + passage + " " + random_text(rng, 7), lang=None, source=None),
        document(12, "é ü ß 漢字   x", source="b"), document(13, "ab " * 300, source="b"),
        document(14, "x" * 5000, source="c"), document(15, random_text(rng, 30_000), source="c"),
        document(16, None, lang=None, source=None), document(-17, passage.upper(), source=""),
        document(18, "a b c\na b c\n\na b c\n#*$ %&|<>", source="a"), document(19, "same", source="b"),
        document(20, "same", source="b"), document(21, "\x1c \x85 \xa0 y\x0bz", source="b"),
    ]
    rows += [document(30 + i, random_text(rng, rng.randrange(1, 200)), source=rng.choice("abc")) for i in range(60)]
    return rows


def roots(count, pairs):
    """Smallest index reachable, by union and find."""
    parent = list(range(count))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(count)]
