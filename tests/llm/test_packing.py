"""Containers of tokens."""

import random

import pytest
from foliant.llm import packing as op


def naive(sizes, capacity):
    room, out = [], []
    for s in sizes:
        k = next((i for i, r in enumerate(room) if r >= s), len(room))
        if k == len(room):
            room.append(capacity)
        room[k] -= s
        out.append(k)
    return out


def test_first_fit_is_first_fit():
    rng = random.Random(1)
    for n in (0, 1, 2, 7, 100, 513):
        sizes = [rng.randrange(1, 41) for _ in range(n)]
        assert op.first_fit(sizes, 40) == naive(sizes, 40)
    with pytest.raises(ValueError):
        op.first_fit([41], 40)
    with pytest.raises(ValueError):
        op.first_fit([0], 40)


def test_pack(spark):
    rng = random.Random(2)
    counts = [(k, k, rng.choice([0, 1, 5, 30, 63, 64, 65, 128, 300])) for k in range(500)] + [(7, 1000, 30), (7, 1001, 30)]
    df = spark.createDataFrame(counts, "doc_id long, row long, n_tokens long")
    rows = op.pack(df, capacity=64, group_rows=60).collect()
    bins, pieces = {}, {}
    for r in rows:
        bins[r.container_id] = bins.get(r.container_id, 0) + r.n_tokens
        pieces.setdefault(r.doc_id, []).append((r.first_token, r.n_tokens))
    assert max(bins.values()) <= 64 and sum(bins.values()) == sum(n for *_, n in counts)
    for doc, _, n in counts:
        if doc != 7:
            got = sorted(pieces.get(doc, []))
            assert sum(x for _, x in got) == n and [a for a, _ in got] == [sum(x for _, x in got[:k]) for k in range(len(got))]
            assert len(got) == -(-n // 64)
    small = [sum(1 for b in bins.values() if b <= 32)]
    assert small[0] <= 2 * 9  # no two half-empty containers in a group, but for one
    assert op.pack(df.limit(0)).collect() == []


def test_tokens(spark, tmp_path):
    pytest.importorskip("tiktoken")
    texts = [(1, "a b"), (2, None), (3, ""), (3, "x" * 50_000), (4, "ไทย 日本語")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_tokens) for r in op.token_counts(df, "doc_id", "text").collect())
    enc = op.encoder(op.TOKENIZER)
    assert got == sorted((k, len(enc.encode_ordinary(t)) if t else 0) for k, t in texts)
