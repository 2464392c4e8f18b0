import random
import zlib

import numpy as np
import tokenizers
from brute import odd_documents

from matchlive.llm import packing, tokens


def brute_ids(text):
    full = tokens.tokenizer(tokens.VOCABULARY).full
    return [*full.encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_ids_equal_the_whole_text_at_once():
    texts = [row[1] or "" for row in odd_documents()]
    texts += ["ǰ J̌ İST ΑΣ don't A's l'été x's¿qué «hé» Ÿ ÿ µm ª1ª", "<|endoftext|> a<|startoftext|>b it's we'll\x0bx\x1cy"]
    texts += ["'s 's't ''S a''b $'$ --'re 12ab3 ½x ÀÖØöøÿ×÷ Straße,,, ﬁ éx"]
    for text in texts:
        assert tokens.tokenizer(tokens.VOCABULARY).ids(text.encode()) == np.array(brute_ids(text)[:-1], "<u4").tobytes()


def check(rows, packed, most):
    want = []
    for row in rows:
        ids = brute_ids(row[1])
        for piece, low in enumerate(range(0, len(ids), most)):
            part = ids[low : low + most]
            want.append((row[0], piece, low, len(part), crc(part)))
    got = [tuple(row) for row in packed]
    assert sorted(row[:5] for row in got) == sorted(want)
    sequences = {}
    for row in got:
        sequences.setdefault(row[5], []).append((row[6], row[3]))
    for inside in sequences.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= most
    total = sum(row[3] for row in got)
    return len(sequences), -(-total // most)


def test_odd_documents_are_packed_whole(odd):
    count, least = check(odd_documents(), packing.pack(odd, 64).collect(), 64)
    assert count <= 1.02 * least + 1
    check(odd_documents(), packing.pack(odd).collect(), 4096)


def test_sequences_hold_the_ids(odd):
    packed = packing.pack(odd, 128, ids=True)
    rows = {row["sequence_id"]: row for row in packing.sequences(packed).collect()}
    pieces = {}
    for row in packed.collect():
        pieces.setdefault(row["sequence_id"], []).append((row["offset"], bytes(row["ids"])))
    assert all(bytes(rows[key]["ids"]) == b"".join(ids for _, ids in sorted(own)) for key, own in pieces.items())


def test_no_documents(none):
    assert packing.pack(none).collect() == []


def test_plan_uses_each_piece_once():
    rng = random.Random(2)
    for most in (10, 100, 1000):
        counts = np.zeros(most + 1, np.int64)
        for _ in range(300):
            counts[rng.randrange(1, most + 1)] += rng.choice([1, 1, 1, 2, 50])
        used = np.zeros(most + 1, np.int64)
        for times, lengths in packing.plan(counts, most):
            assert times > 0 and sum(length * fit for length, fit in lengths.items()) <= most
            for length, fit in lengths.items():
                used[length] += times * fit
        assert np.array_equal(used, counts)


def test_two_replace_the_smallest_where_that_fills_the_gap():
    # greedy: 6 + 3 leaves a gap of 1; 2 + 2 instead of 3 closes it
    counts = np.zeros(11, np.int64)
    counts[[6, 3, 2]] = 1, 1, 2
    assert packing.plan(counts, 10)[0].lengths == {6: 1, 2: 2}


def test_one_length_in_a_third_of_the_rows(spark):
    frame = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'a b c', repeat('word ', id % 50)) AS text")
    count, least = check([tuple(r) for r in frame.collect()], packing.pack(frame, 60).collect(), 60)
    assert count <= 1.02 * least + 1


def test_marks_of_the_vocabulary_are_single_ids():
    """As the library has them by default, from a tokenizer of the test's own."""
    full = tokenizers.Tokenizer.from_file(tokens.VOCABULARY)
    texts = ["a <|endoftext|> b", "A<|endoftext|>B<|startoftext|>", "<|ENDOFTEXT|> <|Endoftext|>x", "é<|endoftext|>É <|start <|endoftext|>|>"]
    assert full.encode(texts[0], add_special_tokens=False).ids == [320, 49407, 321]
    known = tokens.WordTokenizer(tokens.VOCABULARY)
    for text in [*texts, "Plain WORDS", *texts, *[row[1] or "" for row in odd_documents()]]:
        assert known.ids(text.encode()) == np.array(full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
