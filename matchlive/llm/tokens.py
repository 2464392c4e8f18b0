"""Token ids of whole documents from a public BPE vocabulary, with an end mark, cut into pieces."""

import re
import struct
import sys
import types
import zlib
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlive.llm.common import small_batches, text_of
from matchlive.llm.words import release

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
#: Words whose ids a worker remembers, and those it keeps when there are more, and between tasks.
CACHED_WORDS, KEPT_WORDS = 300_000, 150_000
#: Latin letters in composed form, then ASCII marks without the apostrophe of contractions:
#: the vocabulary cuts between the two, and its normal form only changes case.
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)")


def byte_letters() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in plain]
    return {byte: chr(byte) for byte in plain} | {byte: chr(256 + n) for n, byte in enumerate(others)}


BYTE_LETTERS = byte_letters()


class WordTokenizer:
    """Ids per run of non-white-space, remembered.

    The vocabulary drops white space and never joins what it separates, so the
    ids of a text are those of its runs in order. Where a run is a word and marks,
    its ids are those of the two as runs of their own.
    """

    def __init__(self, path: str) -> None:
        self.full = tokenizers.Tokenizer.from_file(path)
        self.model = self.full.model
        self.known: dict[bytes, bytes] = {}

    def ids(self, text: bytes) -> bytes:
        """Ids of the text as little-endian unsigned 32-bit numbers."""
        # marks such as <|endoftext|> are one id, but not in other case
        runs = (text.lower() if text.isascii() and b"<|" not in text else text).split()
        found = list(map(self.known.get, runs))
        if None not in found:
            return b"".join(found)
        fresh = {run for run, ids in zip(runs, found, strict=True) if ids is None}
        if len(self.known) > CACHED_WORDS:
            self.forget()
        here = {run: self._run(run) for run in fresh}
        self.known.update(here)
        return b"".join([here[run] if ids is None else ids for run, ids in zip(runs, found, strict=True)])

    def forget(self) -> None:
        """Keeps the words seen first, as common words are."""
        self.known = dict(islice(self.known.items(), KEPT_WORDS))

    def _run(self, run: bytes) -> bytes:
        text = run.decode()
        if text.isascii() and text.isalpha():
            return self._word(text.lower())
        plain = PLAIN.fullmatch(text)
        if plain is None:
            return self._pack(self.full.encode(text, add_special_tokens=False).ids)
        core, marks = plain[1].lower(), plain[2]
        if not marks:
            return self._word(core)
        return self._part(core, self._word) + self._part(marks, self._marks)

    def _part(self, text: str, ids_of: Callable[[str], bytes]) -> bytes:
        key = text.encode()
        ids = self.known.get(key)
        if ids is None:
            ids = self.known[key] = ids_of(text)
        return ids

    def _word(self, core: str) -> bytes:
        letters = core if core.isascii() else core.encode().decode("latin-1").translate(BYTE_LETTERS)
        return self._pack([token.id for token in self.model.tokenize(letters)])

    def _marks(self, marks: str) -> bytes:
        return self._pack(self.full.encode(marks, add_special_tokens=False).ids)

    @staticmethod
    def _pack(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)


def tokenizer(path: str) -> WordTokenizer:
    """One per worker process, kept between its tasks.

    A worker gets this function anew with every task, so what it keeps lies in a
    module object of its own among those of the process.
    """
    kept = sys.modules.setdefault("matchlive_kept_tokenizers", types.ModuleType("matchlive_kept_tokenizers"))
    if path not in vars(kept):
        setattr(kept, path, WordTokenizer(path))
    return getattr(kept, path)


def cut(documents: DataFrame, most: int, path: str = VOCABULARY, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document, in pieces of ``most`` tokens.

    Null text counts as empty and has the end mark only, so every row gives a
    piece. ``ids`` adds the ids as little-endian unsigned 32-bit numbers.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * ids

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last = tokenizer(path).ids, np.array([end_id], "<u4").tobytes()
        for batch in batches:
            row, piece, size, check, data = [], [], [], [], []
            for at, text in enumerate(batch.column("text")):
                whole = encode(text.as_buffer().to_pybytes()) + last
                for number, low in enumerate(range(0, len(whole), 4 * most)):
                    part = whole[low : low + 4 * most]
                    row.append(at)
                    piece.append(number)
                    size.append(len(part) // 4)
                    check.append(zlib.crc32(part))
                    if ids:
                        data.append(part)
            columns = {
                "doc_id": batch.column("doc_id").take(pa.array(row, pa.int32())),
                "piece": pa.array(piece, pa.int32()),
                "start": pa.array(np.array(piece, np.int64) * most),
                "length": pa.array(size, pa.int64()),
                "ids_crc32": pa.array(check, pa.int64()),
            }
            yield pa.RecordBatch.from_pydict(columns | ({"ids": pa.array(data, pa.binary())} if ids else {}))
        tokenizer(path).forget()
        release()

    rows = small_batches(documents).select("doc_id", text_of("text").alias("text"))
    return rows.mapInArrow(pieces, schema)
