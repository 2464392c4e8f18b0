import random
import re

import pytest
from brute import SCHEMA, document, odd_documents, random_text

from matchlive.llm import decontamination

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain(documents, items, window=10):
    looked_for = {}
    for item, text in items:
        own = words(text)
        for start in range(max(len(own) - window + 1, 1) if own else 0):
            looked_for.setdefault(tuple(own[start : start + window]), set()).add(item)
    out = []
    for doc_id, text in documents:
        own, hit, found = words(text), set(), set()
        for length in {len(key) for key in looked_for}:
            for start in range(len(own) - length + 1):
                if (key := tuple(own[start : start + length])) in looked_for:
                    hit |= set(range(start, start + length))
                    found |= looked_for[key] - {None}
        out.append((doc_id, len(own), len(hit), sorted(map(str, found)), bool(hit)))
    return sorted(out, key=repr)


def found(spark, rows, items, **settings):
    frame = spark.createDataFrame(items, "item_id long, text string, words string, k1 int")
    got = decontamination.contaminated(spark.createDataFrame(rows, SCHEMA).repartition(3), frame, **settings)
    return sorted((tuple(row) for row in got.collect()), key=repr)


def benchmark():
    """Long and short items, one of a single word, shared passages, repeated and missing ids, no words."""
    rng = random.Random(3)
    long = random_text(rng, 40)
    return long, [
        (1, long), (2, " ".join(long.split()[5:30])), (3, "Alpha, BETA gamma"), (4, "unique"), (5, None), (6, " .,- "),
        (7, "é ü ß 漢字 É"), (8, "the same again"), (8, "yet another one"), (None, "nobody's item at all"), (9, "two words"),
        (10, "w1 " * 30), (11, "not in any document whatsoever, here or there, now or then"), (100, long.upper()),
    ]


def contaminated_documents():
    rng = random.Random(4)
    long, _ = benchmark()
    parts = long.split()
    texts = [
        long, "x " + ", ".join(parts[3:14]) + " y", " ".join(parts[:9]), "ALPHA-beta.gamma! alpha beta", "so unique, is it",
        "é ü ß 漢字 É", "É ü ß 漢字 É", "the same again yet another one", "Nobody's  item at all.", "two words two words",
        "w1 " * 25, " ".join(parts[::-1]), (random_text(rng, 200) + " " + long + " ") * 4, " ".join(parts[:10]) + " " + " ".join(parts[:10]),
    ]
    rows = [document(1000 + place, text) for place, text in enumerate(texts)]
    return rows + [rows[0], rows[0], document(None, texts[1]), document(None, texts[1]), document(None, None), document(None, long)]


@pytest.mark.parametrize("settings", [{}, {"block_windows": 7}, {"window": 4, "shingle": 2}, {"shingle": 1}, {"shingle": 10}])
def test_equals_plain_search(spark, settings):
    rows, (_, items) = odd_documents() + contaminated_documents(), benchmark()
    want = plain([row[:2] for row in rows], items, settings.get("window", 10))
    assert found(spark, rows, [(*item, "x", 1) for item in items], **settings) == want


def test_no_items_and_no_documents(spark):
    rows = odd_documents()
    assert found(spark, rows, []) == plain([row[:2] for row in rows], [])
    assert found(spark, [], [(1, "some words", "x", 1)]) == []


def test_window_shared_by_many_items_and_documents(spark):
    rng = random.Random(8)
    shared = random_text(rng, 12)
    items = [(place, shared + " " + random_text(rng, 3), "x", 1) for place in range(300)]
    rows = [document(place, shared) for place in range(300)] + [document(1000, "w " * 5)]
    assert found(spark, rows, items) == plain([row[:2] for row in rows], [item[:2] for item in items])


def test_tokens_are_rarest_shingles(spark):
    items = spark.createDataFrame([(1, "a b c d e"), (2, "p q r s")], "item_id long, text string")
    docs = spark.createDataFrame([("a b c d e",), ("a b c x b c d y",), ("p q r",)], "text string")
    docs = decontamination.with_words(docs, docs.text, "words")
    windows, _ = decontamination.with_item_sets(decontamination.windows_of(items, 10, 3))
    rows = decontamination.prefix_tokens(docs, windows, 3).collect()
    assert [(row["words"], row["offset"]) for row in rows] == [(list("abcde"), 2)]  # nobody holds "q r s"


def test_no_python_in_the_plan(spark):
    items = spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    plan = decontamination.contaminated(docs, items)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|MapIn", plan)
