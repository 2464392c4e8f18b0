"""Arrays read by ranges of any length against Python's reader of whole files."""

import io
import json
import random

import pytest

from matchlive.sources import json_ranges
from matchlive.sources.match_files import read_match_documents

AWKWARD = [
    {"id": "a", "text": 'brackets ]}[{ and a comma, "quoted"', "list": [1, [2, [3]], {}]},
    {"id": "b\\", "text": "\\\\\\\"], [\"", "deep": {"x": {"y": [{"z": "],"}]}}},
    {"id": "ü", "text": "🎉,é" * 40},
    7, "plain, text]", [], {}, [[1], [2]], True,
]


class Bytes:
    def __init__(self, data):
        self.data = io.BytesIO(data)

    def read_at(self, length, place):
        self.data.seek(place)
        return self.data.read(length)


def by_ranges(data, width):
    """What the two passes give, without Spark."""
    source, size = Bytes(data), len(data)
    quoted, depth, found = 0, 0, []
    for start in range(0, size, width):
        end = min(start + width, size)
        found += list(json_ranges.elements(source, start, end, size, quoted, depth))
        quotes, *change = json_ranges.summary(source, start, end)
        depth += change[quoted]
        quoted = (quoted + quotes) % 2
    return [json.loads(text) for text in found if text]


@pytest.mark.parametrize("chunk", [3, 64, 1 << 20])
def test_every_cut(monkeypatch, chunk):
    monkeypatch.setattr(json_ranges, "CHUNK_BYTES", chunk)
    for indent in (None, 2):
        data = json.dumps(AWKWARD, indent=indent, ensure_ascii=indent is None).encode()
        for width in (*range(1, 40), len(data) // 2, len(data)):
            assert by_ranges(data, width) == AWKWARD, (indent, width)


def test_random_arrays(monkeypatch):
    draw = random.Random(5)

    def value(depth):
        kind = draw.randrange(4 if depth else 2)
        if kind == 0:
            return "".join(draw.choices('\\"[]{},a:', k=draw.randrange(9)))
        if kind == 1:
            return draw.randrange(100)
        if kind == 2:
            return [value(depth - 1) for _ in range(draw.randrange(4))]
        return {str(n): value(depth - 1) for n in range(draw.randrange(4))}

    for _ in range(300):
        monkeypatch.setattr(json_ranges, "CHUNK_BYTES", draw.randrange(1, 50))
        rows = [value(3) for _ in range(draw.randrange(12))]
        data = json.dumps(rows, indent=draw.choice([None, 1])).encode()
        assert by_ranges(data, draw.randrange(1, 60)) == rows


def test_files(spark, tmp_path):
    files = {
        "events_1": json.dumps(AWKWARD * 30), "events_2": json.dumps(AWKWARD, indent=3), "events_3": "[]",
        "events_4": " \n[ null , {\"id\": 1} ]\n", "events_5": '{"id": [1, 2], "n": 3}', "events_6": "",
        "events_7": '[{"id": 1}, {"id": 2}, {"id"', "odd": '﻿[{"id": 9}]', "events_8": " " * 5000 + "[1]",
    }
    for name, text in files.items():
        (tmp_path / f"{name}.json").write_text(text)
    for width in (17, 400, json_ranges.RANGE_BYTES):
        rows = read_match_documents(spark, str(tmp_path), range_bytes=width).collect()
        got = {}
        for row in rows:
            payload = None if row.payload is None else json.loads(row.payload)
            got.setdefault(row.match_id, []).append(json.dumps(payload))
        want = {1: AWKWARD * 30, 2: AWKWARD, 4: [None, {"id": 1}], 7: [{"id": 1}, {"id": 2}], None: [{"id": 9}], 8: [1]}
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(map(json.dumps, v)) for k, v in want.items()}


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path):
    rows = [{"id": str(n), "text": "x" * (n % 500)} for n in range(20_000)]
    (tmp_path / "events_5.json").write_text(json.dumps(rows))
    found = read_match_documents(spark, str(tmp_path), range_bytes=200_000)
    assert sorted(json.loads(r.payload)["id"] for r in found.collect()) == sorted(r["id"] for r in rows)
    tasks = found.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert sum(1 for n in tasks if n) >= 4 and max(tasks) < len(rows) / 2


def test_a_folder_without_files(spark, tmp_path):
    assert read_match_documents(spark, str(tmp_path)).collect() == []
