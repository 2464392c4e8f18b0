import random
import re

import pyarrow as pa
import pytest
from brute import SCHEMA, document, odd_documents

from matchlive.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least=30, top=50):
    langs = {}
    for _, text, lang, source, *_ in rows:
        langs.setdefault(lang or "", []).append((source or "", TERM.findall((text or "").translate(LOWER))))
    out = []
    for lang, documents in langs.items():
        holding = {}
        for _, terms in documents:
            for term in set(terms):
                holding[term] = holding.get(term, 0) + 1
        kept = sorted(term for term, number in holding.items() if number >= least)
        counts = {source: dict.fromkeys(kept, 0) for source, _ in documents}
        for source, terms in documents:
            for term in terms:
                if term in counts[source]:
                    counts[source][term] += 1
        whole = {term: sum(own[term] for own in counts.values()) for term in kept}
        share = lambda own: {t: 1 + 1_000_000_000 * (n + 5) // (sum(own.values()) + 5 * len(kept)) for t, n in own.items()}
        p, q = {source: share(own) for source, own in counts.items()}, share(whole)
        for source in counts:
            far = [(sum(abs(p[source][t] - p[other][t]) for t in kept), other) for other in counts if other != source]
            above = [(p[source][t] - q[t], t) for t in kept if counts[source][t] and p[source][t] > q[t]]
            for part, found, most in (("pair", far, len(far)), ("term", above, top)):
                found.sort(key=lambda row: (-row[0], row[1].encode()))
                out += [(lang, source, part, item, value, rank) for rank, (value, item) in enumerate(found[:most], 1)]
    return sorted(out)


def found(spark, rows, **settings):
    return sorted(tuple(row) for row in divergence.audited(spark.createDataFrame(rows, SCHEMA).repartition(5), **settings).collect())


def sourced(seed=1, documents=400, sources=9, vocabulary=60):
    """Sources that favour different terms, one with a third of all rows, one without terms."""
    rng = random.Random(seed)
    rows = []
    for place in range(documents):
        source = rng.choice([0] * 4 + list(range(sources)))
        names = [chr(97 + x % 26) * (x // 26 + 1) for x in range(vocabulary)]
        text = " ".join(rng.choice(names[source:] if rng.random() < 0.7 else names) for _ in range(rng.randrange(0, 40)))
        rows.append(document(place, text, rng.choice(["en", "en", "de", None, ""]), f"s{source}" if source else None))
    rows += [document(1000, "12 34 --", "en", "silent"), document(1001, None, "en", "null"), document(1002, "once", "fr", "alone")]
    return rows


@pytest.mark.parametrize("settings", [{}, {"least_documents": 1}, {"least_documents": 5, "top_terms": 3}])
def test_equals_plain_sums(spark, settings):
    rows = sourced()
    assert found(spark, rows, **settings) == plain(rows, *[settings.get(name, 30 if name[0] == "l" else 50) for name in ("least_documents", "top_terms")])


def test_odd_documents(spark):
    rows = odd_documents() + [document(None, "Élan éLAN naïve İx ſ K a1b2c"), document(None, "Élan éLAN naïve İx ſ K a1b2c", source="b")]
    assert found(spark, rows, least_documents=2) == plain(rows, 2)
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == []


def test_ties_are_ranked_by_item(spark):
    rows = [document(place, "é z a", "en", source) for place in range(3) for source in ("é", "z", "a", "Z")]
    rows += [document(9, "é a", "en", "a")]
    assert found(spark, rows, least_documents=1) == plain(rows, 1)


def test_counts_in_parts(spark, monkeypatch):
    monkeypatch.setattr(divergence, "TEXT_BYTES", 200)
    monkeypatch.setattr(divergence, "COUNTED_ROWS", 20)
    monkeypatch.setattr(divergence, "TREE_ENTRIES", 30)
    rows = sourced(seed=2, documents=120)
    assert found(spark, rows, least_documents=2) == plain(rows, 2)


def path(*entries):
    return [{"source": source, "share": share, "base": 10 * source} for source, share in entries]


def test_nodes_are_corrected_once(monkeypatch):
    """Four rows with one prefix and two that leave it: the shared nodes are met once, with their multiplicity."""
    rows = [path((1, 50), (2, 60))] * 2 + [path((1, 50), (2, 60), (3, 70))] * 2 + [path((1, 50), (2, 61), (3, 70)), path((2, 60), (3, 70))]
    kind = pa.list_(pa.struct([("source", pa.int32()), ("share", pa.int64()), ("base", pa.int64())]))
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 5 + ["de"]), pa.array(rows, kind)], names=["lang", "path"])
    met = []
    real = divergence.np.broadcast_to
    monkeypatch.setattr(divergence.np, "broadcast_to", lambda x, shape: met.append(shape) or real(x, shape))
    sums = {}
    for out in divergence.corrections([batch]):
        for row in out.to_pylist():
            key = row["lang"], row["a"], row["b"]
            sums[key] = sums.get(key, 0) + row["value"]
    want = {}
    for lang, row in zip(batch.column(0).to_pylist(), rows, strict=True):
        for place, b in enumerate(row):
            for a in row[:place]:
                p, p0, q, q0 = a["share"], a["base"], b["share"], b["base"]
                key = lang, a["source"], b["source"]
                want[key] = want.get(key, 0) + abs(p - q) - abs(p - q0) - abs(p0 - q) + abs(p0 - q0)
    assert sums == {key: value for key, value in want.items() if value}
    # nodes at depth 1: (2,60), (2,61) of "en" and (3,70) of "de"; at depth 2: (3,70) below either
    assert {shape for shape in met} == {(3, 1), (2, 2)}
