import random

import numpy as np
import pyarrow as pa
from brute import odd_documents, words

from matchlive.llm import words as W

TEXTS = [row[1] for row in odd_documents()]


def test_words_of_odd_texts():
    found = []
    for low, high, part in W.chunks(pa.array(TEXTS), 300):
        data = part.bytes.tobytes()
        spans = [data[a:b].decode() for a, b in zip(part.start, part.end, strict=True)]
        found += [spans[part.first[i] : part.first[i + 1]] for i in range(high - low)]
        kept, begin = part.spaced(np.ones(len(part.start), bool))
        assert kept.decode().split(" ")[:-1] == spans and begin[-1] == len(kept)
    assert found == [words(text) for text in TEXTS]


def test_hashes_agree_with_equality():
    listed = sorted({word for text in TEXTS for word in words(text)} | {"x" * 64, "x" * 65, "x" * 128 + "y", "y" + "x" * 128})
    hashes = W.split(*W.string_buffers(pa.array(listed))).hashes()
    assert len(set(hashes.tolist())) == len(listed)
    again = W.split(*W.string_buffers(pa.array(["  ".join(listed)]))).hashes()
    assert np.array_equal(hashes, again)


def test_windows_agree_with_equality():
    rng = random.Random(3)
    listed = [f"v{rng.randrange(3)}" for _ in range(3000)]
    hashes = W.split(*W.string_buffers(pa.array([" ".join(listed)]))).hashes()
    for size in (2, 3, 7, 25):
        found = W.windows(hashes, size)
        by_words = {}
        for i, value in enumerate(found.tolist()):
            assert by_words.setdefault(tuple(listed[i : i + size]), value) == value
        assert len(set(by_words.values())) == len(by_words)
    assert len(W.windows(hashes[:5], 7)) == 0


def test_slices_of_arrays_and_nulls():
    array = pa.array(["ab c", None, "", "d"])[1:]
    (_, _, part), = W.chunks(array)
    assert part.first.tolist() == [0, 0, 0, 1]
