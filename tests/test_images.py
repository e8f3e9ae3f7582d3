"""Kernels over rows of images, and ids from tokens."""

import numpy as np
from foliant.functions import kernels as k
from foliant.operators import images, tokens
from pyspark.sql import functions as F

IMAGE = "id int, height int, width int, n_channels int, data binary"


def test_features_and_censoring(spark):
    rng = np.random.default_rng(3)
    a = rng.integers(0, 256, (64, 80)).astype(np.uint8)
    c = rng.integers(0, 256, (30, 40, 3)).astype(np.uint8)
    data = [(1, 64, 80, 1, a.tobytes()), (2, 30, 40, 3, c.tobytes()), (3, 5, 5, 1, b"short"), (4, 5, 5, 1, None)]
    df = spark.createDataFrame(data, IMAGE)
    got = {r.id: r for r in images.features(df, ["id"]).collect()}
    assert got[1].hash == k.phash(a) and got[2].crc == k.checksum(c) and got[1].n_black == k.black_pixels(a) and got[3].hash is None and got[4].n_black is None
    quad = [[{"x": 0.0, "y": 0.0}, {"x": 9.0, "y": 0.0}, {"x": 9.0, "y": 4.0}, {"x": 0.0, "y": 4.0}]]
    q = spark.createDataFrame([(*r, quad if r[0] == 1 else None) for r in data], IMAGE + ", quads array<array<struct<x:double,y:double>>>")
    out = {r.id: r.censored for r in images.censor(q, ["id"]).collect()}
    b = np.frombuffer(out[1], np.uint8).reshape(64, 80)
    assert (b[:5, :10] == 0).all() and (b[5:] == a[5:]).all() and bytes(out[2]) == c.tobytes() and out[3] is None
    assert images.features(df.limit(0), ["id"]).collect() == []


def test_alignment(spark):
    page = np.random.default_rng(4).integers(0, 256, (120, 160)).astype(np.uint8)
    t = page[43:63, 52:92]
    row = (1, 120, 160, 1, page.tobytes(), 20, 40, t.tobytes(), 50, 40)
    df = spark.createDataFrame([row, (*row[:7], bytes(800), 50, 40)], IMAGE + ", t_height int, t_width int, t_data binary, left int, top int")
    got = images.align(df, ["id"]).collect()
    assert (got[0].found, got[0].shift_x, got[0].shift_y) == (True, 2.0, 3.0) and not got[1].found


def test_special_ids(spark):
    box = lambda page, pos, text, left, top, conf=90.0: (page, pos, text, conf, left, top, 60, 20)
    data = [
        box(1, 1, "1234567", 0, 0), box(1, 2, "123456", 0, 50), box(1, 3, "9", 300, 50), box(1, 4, "7", 70, 52), box(1, 5, "8", 10, 50),
        box(2, 1, "1234567", 0, 0), box(2, 2, "7654321", 0, 50), box(2, 3, "123456", 90, 9), box(2, 4, "5", 10, 9), box(3, 1, "1234567", 0, 0), box(4, 1, None, 0, 0), box(4, 2, "x1", 0, 0),
    ]
    df = spark.createDataFrame(data, "page int, pos int, text string, conf double, left int, top int, width int, height int")
    assert {r.page: r.id for r in tokens.special_ids(df).collect()} == {1: "1234567", 2: "7654321"}
    unsure = df.withColumn("conf", F.when(df.text.isin("1234567", "7654321"), df.conf).otherwise(50.0))
    assert {r.page: r.id for r in tokens.special_ids(unsure).collect()} == {2: "7654321"}
    assert tokens.numeric(df.withColumn("conf", df.conf - 39.5)).count() == 0
