"""Operators on invented rows with nulls, ties, repetitions and clashing names."""

import math
import os
from datetime import date

import numpy as np
import pytest
from foliant.functions import geometry as g
from foliant.functions import kernels as k
from foliant.functions import text as t
from foliant.operators import annotations, boxes, cohort, manifest, matching, page_matching, reconcile, runs, selection, training
from foliant.plans import manifests, pages
from pyspark.sql import functions as F


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_clean_manifest(spark):
    data = [("a.b.pdf", "1"), ("a.b.pdf", "1"), ("a.b.tif", "1"), ("c.pdf", "1"), ("c.tif", "2"), (None, "3"), ("d.pdf", None), ("e", "4")]
    df = spark.createDataFrame(data, "name string, id string").withColumn("used", F.lit(5))
    assert [r[:2] for r in rows(manifest.clean(df, "name", "id"))] == [("a.b", "1"), ("e", "4")]
    audit = dict(map(tuple, manifest.audit(df, "name", "id").collect()))
    assert audit["rows"] == 8 and audit["repeated_rows"] == 1 and audit["names_with_more_subjects"] == 0 and audit["other_names"] == 1
    assert dict(map(tuple, manifest.audit(df.limit(0), "name", "id").collect()))["rows"] == 0
    assert manifest.clean(df.limit(0), "name", "id").collect() == []


def test_reconcile(spark):
    a, b = spark.createDataFrame([("1",), ("2",), (None,)], "k string"), spark.createDataFrame([("2",), ("2",), ("3",)], "k string")
    held = reconcile.presence({"a": (a, F.col("k")), "b": (b, F.col("k"))})
    assert rows(reconcile.differences(held, ["a", "b"])) == [("a", "b", 2, 2, 1, 1, "1"), ("b", "a", 2, 2, 1, 1, "3")]
    assert rows(reconcile.append_new(a, F.col("k"), b, F.col("k"))) == [("3", False)]
    assert rows(reconcile.name_mismatches(a.dropna(), b, "k")) == [("1", "right"), ("3", "left")]


def test_transfer(spark):
    """All keys that the ledger lacks, or the first of each wave."""
    new = [(f"{k:03}", q) for q in (1, 2, 5) for k in range(60 if q == 1 else 3)]
    files = spark.createDataFrame([*new, *new[:5], (None, 1), ("900", 2)], "id string, q int")
    ledger = spark.createDataFrame([("900", 2)], "id string, q int")
    assert rows(reconcile.transfer(files, ledger, ["id", "q"])[1]) == sorted([*new, ("900", 2)])
    kept, longer = reconcile.transfer(files, ledger, ["id", "q"], 2, ["q"])
    assert rows(longer) == [("000", 1), ("000", 2), ("000", 5), ("001", 1), ("001", 2), ("001", 5), ("900", 2)]
    assert rows(kept.distinct()) == rows(longer)[:-1]


@pytest.mark.skipif(not os.path.exists(SMALL), reason="no test tables")
def test_transfer_ledger_has_all_new_keys(spark):
    key = manifests.subject_key(F.col("e3n_id_hand")).alias("id")
    scans, ledger = (spark.read.parquet(f"{SMALL}/{name}.parquet").select(key, "q").distinct() for name in ("manifest", "combined_success_ids"))
    want = scans.dropna().subtract(ledger)
    assert want.count() > 50
    assert manifests.transfer_ledger(spark, SMALL).count() == ledger.count() + want.count()


def test_days_and_codes(spark):
    df = spark.createDataFrame([("05JAN1990",), ("05jan1990 ",), ("31FEV1990",), ("00JAN2000",), ("5JAN1990",), (None,)], "d string")
    assert [r[0] for r in df.select(cohort.day(F.col("d"))).collect()] == [date(1990, 1, 5)] * 2 + [None] * 4
    w = spark.createDataFrame([("First stage",), ("OCR stage, 1/2",), (None,), ("x",), ("Second stage",)], "w string")
    assert [r[0] for r in w.select(cohort.ordering_code(F.col("w"))).collect()] == [0, 3, 2, 2, 1]


def people(spark):
    """Cases 1 and 2; candidates by columns, age and follow-up."""
    def person(i, case, exit_, waves, etud=1, year=1940):
        dates = [date(1990 + 2 * q, 1, 1) if q in waves else None for q in range(13)]
        return (str(i), case, etud, 0, date(year, 1, 1), exit_, *dates)

    late = date(2015, 1, 1)
    data = [
        person(1, 1, date(1995, 1, 1), {0, 1, 2}), person(2, 1, date(1989, 1, 1), {0}),
        person(3, 0, late, {0, 1, 2, 5}), person(4, 0, late, {0, 1}), person(5, 0, late, {0, 1, 2}, etud=2), person(6, 0, date(1994, 1, 1), {0, 1, 2}),
        person(7, 0, None, {0, 1, 2}), person(8, 0, late, {0, 1, 2}, year=1942), person(9, 0, late, {0, 1, 2, 3}, year=1941), person(10, 0, late, {0, 1, 2}, etud=None),
    ]
    kind = "id string, is_case int, etudegp int, profq2 int, birth_date date, exit_date date, " + ", ".join(f"dateq{q} date" for q in range(1, 14))
    return matching.with_risk_time(spark.createDataFrame([*data, data[3]], kind))


def test_matching(spark):
    c = people(spark)
    by = {r.id: r for r in c.collect()}
    assert (by["1"].last_q, by["2"].last_q, by["4"].last_q, by["1"].available) == (3, 0, 2, 7) and by["8"].relative_age == 2
    got = matching.match(c, 10, "exact", 1).collect()
    assert {r.member_id for r in got if not r.case_control} == {"3", "9"} and {r.match_group for r in got} == {1}
    assert {r.member_id for r in matching.match(c, 10, "exact", 2).collect() if not r.case_control} == {"3", "8", "9"}
    assert len(matching.match(c, 1, "at_least", -1).collect()) == 2
    assert rows(matching.failed(c, matching.match(c, 10, "exact", 1))) == [("2", "no_questionnaires")]
    assert matching.match(c.where("id = '1'"), 3, "exact_w_fallback").select("member_id", "n_left").collect() == [("1", 0)]
    with pytest.raises(ValueError):
        matching.match(c, 1, "other")


def test_splits(spark):
    ids = spark.createDataFrame([(str(i),) for i in range(100)] + [(None,), ("5",)], "id string")
    count = lambda df: {r[0]: r[1] for r in df.groupBy("split").count().collect()}
    assert count(training.assign_groups(ids, "id")) == {"train": 81, "val": 9, "test": 10}
    assert count(training.assign_sized(ids, "id", 50, 20, 10)) == {"train": 50, "val": 20, "test": 10, None: 20}
    assert count(training.single_split(ids, "id")) == {"val": 8, "test": 21, "train": 71}
    with pytest.raises(Exception, match="more keys"):
        training.assign_sized(ids, "id", 90, 20, 10).collect()
    df = spark.createDataFrame([("a", 0, 1, "test"), ("a", 1, 2, "val"), ("b", 0, 3, "test"), ("b", 0, 2, "train"), ("c", None, 1, None)], "s string, c int, g int, split string")
    assert rows(training.one_split_per_subject(df, "s", "c", "g").select("s", "split").distinct()) == [("a", "val"), ("b", "train"), ("c", None)]


def test_runs(spark):
    df = spark.createDataFrame([("g", "2", "2"), ("g", "1", "2"), ("h", None, "x"), (None, "1", "1")], "g string, a string, b string")
    assert rows(runs.mode_accuracy(df, "g", "a", "b")) == [(2, 0.0)]
    assert df.select(runs.accuracy(F.col("a"), F.col("b"))).first()[0] == 0.5
    assert rows(runs.mode_accuracy(df.limit(0), "g", "a", "b")) == [(0, 0.0)]
    n = spark.createDataFrame([("1", "1"), ("ISP", "1"), ("x", "2")], "a string, b string")
    assert rows(runs.numbers_only(n, ["a", "b"])) == [(1.0, 1.0)]


def test_selection(spark):
    df = spark.createDataFrame([("u_1", "0110000000001", 3), ("v", None, None)], "unique_id string, p string, last int")
    pick = lambda *a, **kw: [r[0] for r in df.select(selection.select_waves(F.col("p"), F.col("last"), *a, **kw)).collect()]
    assert pick("all")[0] == [2, 3, 13] and pick("all")[1] == list(range(1, 14))
    assert pick("upto_last_avail", inclusive=False)[0] == [2] and pick("after_last_avail")[0] == [13] and pick("after_last_avail", inclusive=False)[0] == [3, 13] and pick("last_available") == [[13], [13]] and pick("custom", custom=[9, 1, 9, 0, 99])[0] == [1, 9]
    assert [tuple(r) for r in df.select(selection.subject_of(F.col("unique_id")), selection.group_of(F.col("unique_id"))).collect()] == [("u", "1"), ("v", "")]
    m = spark.createDataFrame([("g", s, c) for s, c in (("3", 0), ("1", 0), ("2", 0), ("9", 1), ("8", None))], "g string, s string, c int")
    assert [r.s for r in selection.select_group(m, "g", "s", "c").orderBy("position").collect()] == ["9", "1", "2"]
    assert len(selection.select_group(m, "g", "s", "c", control_ids=["3"]).collect()) == 2 and len(selection.select_group(m, "g", "s", "c", n_controls=None).collect()) == 5


def test_text(spark):
    df = spark.createDataFrame([("Ｆé  Ab!", "fé ab"), ("", ""), ("a", ""), (None, "x"), ("x" * 5000, "y")], "a string, b string")
    got = [r[0] for r in df.select(t.compare(F.col("a"), F.col("b"))).collect()]
    assert got[0].norm_a == "fé ab" and got[0].sequence == 1.0 and (got[1].jaccard, got[1].containment) == (1.0, 1.0) and (got[2].jaccard, got[2].containment) == (0.0, 0.0)
    assert got[3].sequence is None
    n = spark.createDataFrame([("no 123456  7 x",), ("12 and 34 and 5",), ("none",), (None,)], "a string")
    assert [r[0] for r in n.select(t.target_number(F.col("a"))).collect()] == ["1234567", "12", None, None]


def test_assignment_and_cascade(spark):
    costs = spark.createDataFrame([("d", p, q, float(abs(p - q) * 10)) for p in range(3) for q in range(2)] + [("e", 0, 0, 40.0), ("d", None, 0, 1.0)], "doc string, page int, template int, cost double")
    got = rows(page_matching.assign_pages(costs))
    assert got == [("d", 0, 0, 0.0), ("d", 1, 1, 0.0), ("e", 0, 0, 40.0)]
    report = {(r.doc, r.page): r for r in page_matching.report(costs, page_matching.assign_pages(costs)).collect()}
    assert report["d", 0].ok and not report["e", 0].ok and report["e", 0].second_best == page_matching.NO_SECOND
    d = costs.where("doc = 'd' AND page IS NOT NULL")
    pages, templates = d.select("doc", "page").distinct(), d.select("doc", "template").distinct()
    verified = spark.createDataFrame([("d", 1, 1)], "doc string, page int, template int")
    out = rows(page_matching.cascade(pages, templates, verified, d, d.withColumn("cost", F.col("cost") / 40)).select("page", "template", "stage", "warned"))
    assert out == [(0, 0, 3, False), (1, 1, 1, False)]
    assert page_matching.assign_pages(costs.limit(0)).collect() == []


def test_expected_pages(spark):
    files = spark.createDataFrame([("a", 4, "x", 3), ("a", 4, "y", 3), ("a", 4, "s1", 1), ("a", 4, "s2", 1), ("b", 3, "m", 2), ("b", 3, "s", 1), ("c", 3, "z", 0)], "doc string, q int, file string, n_pages int")
    got = rows(page_matching.expected_pages(files, page_matching.questionnaires(spark)))
    assert got == [("a", 1, "y", 2), ("a", 2, "y", 1), ("a", 3, "y", 0), ("a", 4, "s2", 0), ("a", 5, "s1", 0), ("b", 1, "m", 0), ("b", 2, "m", 1)]


def test_geometry(spark):
    df = spark.range(1)
    one = lambda c: df.select(c.alias("v")).first().v
    b = g.box(F.lit(10), F.lit(20), F.lit(30), F.lit(60))
    assert tuple(one(g.rescale(b, (F.lit(100), F.lit(100)), (F.lit(150), F.lit(50))))) == (15, 10, 45, 30)
    assert tuple(one(g.enlarge(b, F.lit(2.0), (F.lit(100), F.lit(70))))) == (0, 0, 40, 70)
    pts = one(g.similarity(b, g.point(F.lit(10), F.lit(20)), F.lit(1.0), F.lit(0.0), F.lit(0.0), F.lit(-90.0)))
    assert [(round(p.x), round(p.y)) for p in pts] == [(10, 20), (10, 40), (-30, 40), (-30, 20)]
    eye = [F.lit(float(v)) for v in (1, 0, 5, 0, 1, 7, 0, 0, 1)]
    assert [(p.x, p.y) for p in one(g.homography(b, eye))][0] == (15.0, 27.0)
    square = lambda *p: F.array(*(g.point(F.lit(x), F.lit(y)) for x, y in p))
    verdict = lambda p: one(g.validity(p, F.lit(10), F.lit(10)))
    assert [verdict(square(*p)) for p in (((0, 0), (10, 0), (10, 10), (0, 10)), ((0, 0), (30, 0), (30, 30), (0, 30)), ((0, 0), (10, 10), (10, 0), (0, 10)), ((0, 0), (10, 0), (14, 10), (4, 10)), ((1, 1),) * 4)] == ["ok", "area", "convex", "angle", "area"]
    assert [(p.x, p.y) for p in one(g.ordered_quad(square((9, 9), (0, 1), (8, 0), (1, 8))))] == [(0, 1), (8, 0), (9, 9), (1, 8)]
    pair = lambda s, c: F.struct(g.point(*map(F.lit, s)).alias("shift"), g.point(*map(F.lit, c)).alias("center"))
    m = one(g.alignment(F.array(pair((2, 3), (10, 10)), pair((2, 3), (50, 90)))))
    assert (m.scale, m.shift_x, m.shift_y, round(m.degrees, 9)) == (1.0, 2.0, 3.0, 0.0) and one(g.alignment(F.array(pair((2, 3), (1, 1))))).shift_x == 0
    assert tuple(one(g.stretch(b, F.lit(0.5), F.lit(-4), F.lit(6)))) == (6, 20, 30, 66)
    assert tuple(one(g.xyxy(F.array().cast("array<double>"), F.array(*map(F.lit, (10.0, 10.0, 4.0, 2.0)))))) == (8, 9, 12, 11)


def test_box_joins(spark):
    make = lambda data: spark.createDataFrame(data, "page int, no int, l double, t double, r double, b double, partial boolean").select("page", "no", g.box(*map(F.col, "ltrb")).alias("box"), "partial")
    inner = make([(1, 1, 0.0, 0.0, 10.0, 10.0, False), (1, 2, 5.0, 5.0, 5.0, 9.0, False), (2, 1, 0.0, 0.0, 4.0, 4.0, False)])
    outer = make([(1, 1, 0.0, 0.0, 20.0, 20.0, True), (1, 2, 0.0, 0.0, 10.0, 10.0, False), (1, 3, 0.0, 0.0, 10.0, 5.0, True), (1, 4, 0.0, 0.0, 10.0, 4.9, True)])
    assert rows(boxes.smallest_containing(inner, outer, ["page"])) == [(1, 1, 2), (1, 2, 2), (2, 1, None)]
    assert [r[:3] for r in rows(boxes.covering(inner, outer, ["page"]))] == [(1, 1, 1), (1, 1, 2), (1, 1, 3)]
    assert boxes.censor_boxes(inner, outer, ["page"]).count() == 3


@pytest.mark.skipif(not os.path.exists(SMALL), reason="no test tables")
def test_single_boxes_of_all_lines(spark):
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet").select("l_orderkey", "l_linenumber").distinct()
    assert lines.where("l_linenumber % 2 = 0").count() > 0
    for query in (pages.box_columns, pages.box_transforms):
        assert rows(query(spark, SMALL).select("page", "no")) == rows(lines)


def test_annotations(spark):
    body = '[{"image":"x/page_3.png","roi_type":["a","b"],"censor_type":"partial","label":[{"rectanglelabels":["roi"],"x":1},{"rectanglelabels":["censor"]},{"rectanglelabels":"roi"},{"rectanglelabels":["roi"]},{}]},{"image":"y/page_3.png"},{"image":"z"}]'
    df = spark.createDataFrame([(1, body), (2, "{bad"), (3, None)], "id int, body string")
    pages = annotations.pages(df, "body", ["id"])
    assert [(r.page, r.image, r.image_type) for r in pages.collect()] == [(3, "x/page_3.png", "")]
    got = [(r.label, r.sub_attribute) for r in annotations.regions(pages, ["id"]).orderBy("box_no").collect()]
    assert got == [("roi", "a"), ("censor", "partial"), ("roi", "b"), ("roi", None), (None, None)]
    task = '{"data":{"image":"a%5Cb%5Cc.png"},"annotations":[{"result":[{"type":"rectanglelabels","value":{"x":10,"y":20,"width":20,"height":40,"rectanglelabels":["k"]}},{"type":"choices"}]}]}'
    tasks = spark.createDataFrame([(1, task), (2, '[{"data":{"image":"b%5Cc.jpg"}}]')], "id int, body string")
    assert rows(annotations.label_rows(tasks, "body", "id", {"k": 2})) == [("b_c", 0, "2 0.200000 0.400000 0.200000 0.400000"), ("b_c_1", None, None)]


def test_xml(spark, tmp_path):
    from foliant.sources import files

    (tmp_path / "a.xml").write_text('<annotations><image id="1" name="p" width="10" height="20"><box label="roi" xtl="1" ytl="2" xbr="3"><attribute name="blank">yes</attribute><attribute name="no"></attribute></box><box label="align" xtl="1" ytl="1" xbr="2" ybr="2"/></image></annotations>')
    b = annotations.xml_boxes(files.annotation_xml(spark, str(tmp_path / "a.xml")))
    got = {r.label: r for r in b.collect()}
    assert got["roi"].ybr == 0.0 and got["roi"].attributes["blank"] == "yes" and "no" not in {n for n, v in got["roi"].attributes.items() if v is None}
    assert {r.label: r.attributes.get("blank") for r in annotations.set_attribute(b, "blank", "set", F.col("label") == "align").collect()} == {"roi": "yes", "align": "set"}
    assert annotations.image_summaries(b).first().labels == {"roi": 1, "align": 1}


def test_tar(spark, tmp_path):
    import io
    import tarfile

    from foliant.sources import files

    with tarfile.open(tmp_path / "s.tar", "w") as tar:
        for name, data in (("./Q3/page_1.PNG", b"one"), ("q12/sub/Grid_2.png", b"two"), ("detections.json", b"{}")):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    files.register(spark)
    m = spark.read.format("tar").option("path", str(tmp_path / "*.tar")).load()
    assert {(r.member, bytes(r.content)) for r in m.collect()} == {("q3/page_1.png", b"one"), ("q12/sub/grid_2.png", b"two"), ("detections.json", b"{}")}
    assert files.find_members(m, "grid_2.png").first().member == "q12/sub/grid_2.png" and files.waves_in(m).first().qs == [3, 12]
    assert [(r.page, r.member) for r in files.page_members(m).orderBy("page").collect()] == [(1, "q3/page_1.png"), (2, "q12/sub/grid_2.png")]


def test_kernels():
    rng = np.random.default_rng(1)
    flat, ramp = np.full((40, 60), 200, np.uint8), np.tile(np.linspace(0, 255, 64).astype(np.uint8), (64, 1))
    assert k.components(np.array([[1, 0, 0], [0, 1, 0], [0, 0, 0], [1, 0, 1]])) == 3 and k.components(np.zeros((3, 3))) == 0
    assert k.components(np.array([[1, 0, 1], [1, 0, 1], [1, 1, 1]])) == 1
    assert np.allclose(k.resize_area(flat, 7, 9), 200) and np.allclose(k.resize_area(np.array([[0.0, 10, 20, 30]]), 2, 1), [[5, 25]])
    assert (k.resize_lanczos(flat, 30, 20) == 200).all() and k.phash(ramp) == k.phash(ramp.copy()) and -(2**63) <= k.phash(ramp) < 2**63
    assert math.isclose(k.ncc(ramp, ramp), 1) and math.isclose(k.ncc(ramp, 255 - ramp.astype(float)), -1) and k.ncc(flat, flat) == 0
    page = rng.integers(0, 255, (80, 90)).astype(np.uint8)
    found, x, y, score = k.locate(page, page[20:40, 33:60])
    assert found and (x, y) == (33, 20) and score > 0.999
    assert k.otsu(np.array([[10] * 5 + [200] * 5])) in range(10, 200) and k.black_pixels(np.array([[0, 9, 10]])) == 2
    box = np.array([[2, 2], [7, 2], [7, 5], [2, 5]])
    assert (k.fill(flat, box) == 0).sum() == 24 and 0 < (k.stripes(flat, np.array([[0, 0], [50, 0], [50, 30], [0, 30]]), 0.1, 1.0) == 0).sum() < 51 * 31
    src = rng.random((30, 2)) * 100
    a = np.array([[0.9, -0.1, 5], [0.1, 0.9, -3]])
    dst = src @ a[:, :2].T + a[:, 2]
    dst[:6] += 50
    m, near = k.fit_affine(src, dst)
    assert np.allclose(m, a) and near.sum() == 24
    d = rng.integers(0, 256, (20, 32)).astype(np.uint8)
    assert k.match_descriptors(d, d[::-1], ratio=0.8) == [(i, 19 - i, 0) for i in range(20)] and k.match_descriptors(d[:0], d) == []
    same, _ = k.region_matches(page, page)
    assert same and not k.region_matches(page, 255 - page)[0] and k.blank_matches(100, 105, 3, 9) and not k.blank_matches(10, 105, 3, 9)
    assert k.edge_iou(page, page) == 1.0 and k.white(50, 200).shape == (100, 100) and k.crop(page, (-5, 70, 10, 200)).shape == (10, 10)


def test_ledger_stream(spark, tmp_path):
    from foliant.streaming import ledger

    src, out = str(tmp_path / "in"), str(tmp_path / "ledger")
    frame = lambda *ids: spark.createDataFrame([(i,) for i in ids], "e3n_id_hand string")
    for ids in (("1", "01", None), ("2.0", "1", "x")):
        frame(*ids).coalesce(1).write.mode("append").parquet(src)
        ledger.follow(spark.readStream.schema("e3n_id_hand string").parquet(src), out, str(tmp_path / "ck")).awaitTermination(60)
    assert rows(spark.read.parquet(out)) == [("1", False), ("2", False)]
