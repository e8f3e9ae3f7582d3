"""Spans, copies and bundles of tiny files."""

import json
import random
import zlib

import pytest
from foliant.operators import compaction as op
from pyspark.sql import functions as F

FILES = "file_id long, content string, same string, crc int"


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ('{"a":1}\n{"b":"}{"}\n', 2),
        ('﻿{"a":1}\r\n\r\n{"a":[{"x":1},2]}', 2),
        ('[{"a":1},\n {"b":[{}]}]', 2),
        ('{"a":1}\n{"b":"cut\n{"c":3}', 2),
        ('{"a":1,\n{"c":3}', 1),
        ('{"a":\n {"x": 2},\n "b": 3}\n{"c":3}', 2),
        ('{"a":1}{"b":2},{"c":3}', 3),
        ('[{"a":1},{"b":', 1),
        ('"text"\n5\nnull\n', 0),
        ("", 0),
        ("}}]]{", 0),
        ('{"a":1,"b":\n{"c":3}\n{"d":4}', 2),
        ('{"a":[\n{"c":3}\n{"d":4}', 2),
        ('{"a":[\n {"c":3}\n', 0),
        ('[{"a":1},\n{"b":\n{"c":3},{"d":4}]', 3),
        ('{"a":\n{"b":{"c":\n{"d":1}\n{"e":2}', 2),
    ],
)
def test_spans(text, found):
    data = text.encode()
    spans = list(op.record_spans(data))
    assert len(spans) == found and all(isinstance(json.loads(data[a:b]), dict) for a, b in spans)


def test_fingerprints():
    f = lambda s: op.fingerprint(s.encode())
    assert f('{"a":1754.0,"b":"\\u00e9"}') == f('{"b":"é", "a": 1754}')
    assert len({f(x) for x in ('{"a":1}', '{"a":true}', '{"a":"1"}', '{"a":null}', "{}", '{"a":1.5}')}) == 6
    assert f("[1]") != f("{}") and f('{"a":NaN}') is None and f('{"a":}') is None


def files(rng, n):
    base = [json.dumps({"k": rng.randrange(9), "t": rng.choice(["x", "y z", "ü\n"])}, ensure_ascii=False) for _ in range(n)]
    out = []
    for k in range(n):
        rows = [rng.choice(base[: k + 1]) for _ in range(rng.randrange(5))]
        if rng.random() < 0.2:
            rows.append('{"cut": "of')
        out.append((k, rng.choice(["", "﻿"]) + rng.choice(["\n", "\r\n"]).join(rows) if rng.random() < 0.7 else "[" + ",".join(r for r in rows if "cut" not in r) + "]", "s", 1))
    return [*out, (n, None, "s", 1), (n + 1, "", "s", 1), (n + 2, '{"big":"' + "x" * 300_000 + '"}', "s", 1)]


def test_copies_and_bundles(spark, tmp_path):
    rows = files(random.Random(3), 60)
    df = spark.createDataFrame(rows, FILES)
    seen, extra, kept = set(), [], []
    for k, text, *_ in rows:
        data = (text or "").encode()
        n = 0
        for a, b in op.record_spans(data):
            if (f := op.fingerprint(data[a:b])) is None:
                continue
            extra += [(k, n)] if f in seen else []
            kept += [] if f in seen else [f]
            seen.add(f)
            n += 1
    assert sorted(map(tuple, op.redundant_copies(op.record_index(df, "file_id", "content")).collect())) == extra
    got = op.bundles(df, "file_id", "content", target_bytes=200).collect()
    lines = [x for r in got for x in bytes(r.content).splitlines()]
    assert sorted(map(op.fingerprint, lines)) == sorted(kept) and len(got) > 1
    assert all(r.n_bytes == len(r.content) and r.crc32 == zlib.crc32(bytes(r.content)) and r.n_records == bytes(r.content).count(b"\n") for r in got)
    assert op.bundles(df.limit(0), "file_id", "content").collect() == []
    for frames in (False, True):
        written = op.write_bundles(op.bundles(df, "file_id", "content", target_bytes=200), str(tmp_path / str(frames)), frames, 50)
        assert {r.path for r in written.collect()} == {str(p) for p in (tmp_path / str(frames)).glob("bundle-*")}
        assert sorted(op.fingerprint(r.record.encode()) for r in op.read_bundles(written).collect()) == sorted(kept)
        assert written.where("n_frames > 1").count() > 0 or not frames
    spoiled = next((tmp_path / "False").glob("bundle-*"))
    spoiled.write_bytes(spoiled.read_bytes()[:-2] + b"?\n")
    with pytest.raises(Exception, match="is not what was written"):
        op.read_bundles(written.withColumns({"path": F.regexp_replace(F.regexp_replace("path", "/True/", "/False/"), ".zst$", ""), "n_frames": F.lit(0)})).count()


def test_frames_and_lines():
    zstandard = pytest.importorskip("zstandard")
    c = zstandard.ZstdCompressor(write_checksum=True)
    joined = op.join_frames([c.compress(b"a\n"), b"", c.compress(b"b\n")])
    assert zstandard.ZstdDecompressor().stream_reader(joined, read_across_frames=True).read() == b"a\nb\n"
    with pytest.raises(ValueError):
        op.join_frames([c.compress(b"a") + b"x"])
    with pytest.raises(ValueError):
        op.join_frames([b"plain"])
    assert op.join_lines([op.BOM + b"a\r\nb", b"\n\nc\rd"]) == b"a\nb\nc\nd\n"
