from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from frameloom.functions import geometry as G
from frameloom.functions import names as N
from frameloom.functions import text as T
from frameloom.operators import stats as S
from frameloom.plans.scratch import Scratch
from frameloom.params import Params

H = "0123456789abcdef0123456789ABCDEF"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("path", "dataset", "split", "base", "clip", "frame"),
    [
        (f"data/interim/a-v1/train/images/Some_f000360_t0012.50_jpg.rf.{H}.jpg", "a-v1", "train", "some_f000360_t0012.50", "some", 360),
        (rf"D:\x\a-v1\valid\images\a-v1__Pic-12_PNG.rf.{H}.png", "a-v1", "valid", "pic-12", "pic", 12),
        (f"data//b-v2//test/images/x_flip.rf.{H}.JPG", "b-v2", "test", "x", None, None),
        ("r/b-v2/test/images/x 7 flip.jpg", "b-v2", "test", "x 7", "x", 7),
        ("r/b-v2/test/images/000123.jpg", "b-v2", "test", "000123", "", 123),
        ("r/b-v2/test/images/p_100000000.jpg", "b-v2", "test", "p_100000000", "p", 100_000_000),
        ("r/b-v2/test/images/p_100000001.jpg", "b-v2", "test", "p_100000001", None, None),
        ("r/b-v2/test/images/p_20240101123456789012345.jpg", "b-v2", "test", "p_20240101123456789012345", None, None),
        ("r/b-v2/test/images/a--5.jpg", "b-v2", "test", "a--5", "a-", 5),
        ("r/b-v2/test/images/a__b__9", "b-v2", "test", "b__9", "b_", 9),
    ],
)
def test_names(spark, path, dataset, split, base, clip, frame):
    df = N.with_names(spark.createDataFrame([(path,)], "image_path string"))
    r = df.select(N.path_dataset(F.col("image_path")).alias("d"), N.path_split(F.col("image_path")).alias("s"), "__base", "__clip", "__frame").first()
    assert (r.d, r.s, r["__base"], r["__clip"], r["__frame"]) == (dataset, split, base, clip, frame)


def test_names_of_null(spark):
    r = N.with_names(spark.createDataFrame([(None,)], "image_path string")).first()
    assert r["__base"] is None and r["__clip"] is None and r["__frame"] is None


def test_export_mark(spark):
    assert one(spark, N.export_mark(F.lit(f"a.rf.{H}.jpg"))) == H.lower()
    assert one(spark, N.export_mark(F.lit("a.jpg"))) is None


@pytest.mark.parametrize(("said", "is_"), [(" Val ", "valid"), ("TESTING", "test"), ("training", "train"), ("other", None), (None, None)])
def test_split_spelling(spark, said, is_):
    assert one(spark, N.split_spelling(F.lit(said).cast("string"))) == is_


def box(x1, y1, x2, y2):
    return F.struct(*(F.lit(float(v)).alias(c) for v, c in zip((x1, y1, x2, y2), ("x1", "y1", "x2", "y2"))))


def test_box_overlaps(spark):
    a, b = box(0, 0, 2, 2), box(1, 1, 3, 3)
    assert one(spark, G.iou(a, b)) == pytest.approx(1 / 7)
    assert one(spark, G.containment(a, b)) == pytest.approx(0.25)
    assert one(spark, G.containment(box(1, 1, 1, 1), b)) == 0.0
    assert one(spark, G.iou(box(1, 1, 1, 1), box(1, 1, 1, 1))) == 0.0


def test_union_coverage(spark):
    a = box(0, 0, 1, 1)
    assert one(spark, G.union_coverage(a, F.array(box(0, 0, 0.5, 1), box(0.25, 0, 0.5, 1)))) == 0.5
    assert one(spark, G.union_coverage(a, F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>"))) == 0.0


def test_turning_and_clipping(spark):
    t = one(spark, G.rotated(box(1, 2, 3, 4), F.lit(90), F.lit(10), F.lit(20)))
    assert (t.x1, t.y1, t.x2, t.y2) == (2, 6, 4, 8)
    args = [F.lit(v) for v in (0.0, 0.5, 0.4, 0.2)]
    c = one(spark, G.clipped(*args))
    assert (c.xc, c.w) == pytest.approx((0.1, 0.2))
    assert one(spark, G.clipped(F.lit(-1.0), F.lit(0.5), F.lit(0.1), F.lit(0.1))) is None


def test_polygon(spark):
    line = F.split(F.lit("80 0.1 0.2 0.3 0.2 0.3 0.6"), " ")
    assert one(spark, G.polygon_box(line)) == ["80", "0.200000", "0.400000", "0.200000", "0.400000"]
    five = F.split(F.lit("80 0.1 0.2 0.3 0.2"), " ")
    assert one(spark, G.polygon_box(five)) == ["80", "0.1", "0.2", "0.3", "0.2"]


def test_hash_of_hex(spark):
    assert one(spark, G.hash_of_hex(F.lit("ffffffffffffffff"))) == -1
    assert one(spark, G.hamming(F.lit(-1).cast("bigint"), F.lit(0).cast("bigint"))) == 64


def test_texts(spark):
    assert one(spark, T.decimal_comma(F.lit(" 12,5 %"))) == 12.5
    assert one(spark, T.decimal_comma(F.lit("n/a"))) is None
    assert one(spark, T.percent(F.lit(1), F.lit(0))) == "-"
    m = one(spark, T.model_spec(F.lit("a=w/x.pt:3")))
    assert (m.name, m.weights, m.class_id, m.image_size) == ("a", "w/x.pt", 3, 640)
    assert one(spark, T.manual_part(F.lit("auto<!--end-->mine"), "<!--end-->")) == "mine"
    assert one(spark, T.criterion(F.lit("cheap"), F.lit(None).cast("string"))) == "cheap / (no reason)"


def _plain_groups(values, k):
    """1-D k-means as the survey words it (G15): starts at quantiles, ties to the lower, until centres stay."""
    xs = sorted(values)
    if k <= 1 or len(xs) <= k:
        return [xs]

    def at(q):
        i, f = divmod(q * (len(xs) - 1), 1)
        return xs[int(i)] * (1 - f) + xs[min(int(i) + 1, len(xs) - 1)] * f

    middle = [at((i + 0.5) / k) for i in range(k)]
    for _ in range(100):
        of = [[] for _ in middle]
        for x in xs:
            of[min(range(k), key=lambda j: (abs(x - middle[j]), j))].append(x)
        new = [sum(g) / len(g) if g else m for g, m in zip(of, middle)]
        if new == middle:
            break
        middle = new
    return [g for g in of if g]


def _plain_elbow(values, most=5):
    """G17: the greatest second difference of the sums of squares; the last k if its gain is over 15 % of the first sum."""
    different = len(set(values))
    if different < 3:
        return 1
    most = min(most, different)
    cost = {k: sum((x - sum(g) / len(g)) ** 2 for g in _plain_groups(values, k) for x in g) for k in range(1, most + 1)}
    if (cost[most - 1] - cost[most]) / cost[1] > 0.15:
        return most
    second = {k: (cost[k - 1] - cost[k]) - (cost[k] - cost[k + 1]) for k in range(2, most)}
    return max(second, key=lambda k: (second[k], -k))


@pytest.mark.parametrize("seed", range(8))
def test_grouped_values(spark, seed):
    import random

    rng = random.Random(seed)
    values = [round(rng.choice([-3.0, -1.5, 0.0]) + rng.gauss(0, 0.3), 4) for _ in range(60)] if seed < 5 else [[1.0, 1.0, 2.0], [1.0, 2.0, 3.0, 3.0], [5.0] * 4][seed - 5]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    k = _plain_elbow(values)
    want = [(len(g), min(g), max(g)) for g in _plain_groups(values, k)]
    got = [(r.n, r.least, r.most) for r in S.grouped_values(df, "v", Scratch(spark, "t")).orderBy("group").collect()]
    assert got == want
    assert [r.n for r in S.grouped_values(df, "v", Scratch(spark, "t"), k=2).orderBy("group").collect()] == [len(g) for g in _plain_groups(values, 2)]


def test_grouped_values_of_nothing(spark):
    assert S.grouped_values(spark.createDataFrame([], "v double"), "v", Scratch(spark, "t")).count() == 0


def test_elbow_and_edges():
    assert S.elbow([10.0, 9.0], 2) == 1 and S.elbow([0.0, 0.0, 0.0], 3) == 2
    assert S.elbow([100.0, 50.0, 45.0, 44.0], 9) == 2 and S.elbow([100.0, 90.0, 80.0, 60.0], 9) == 4
    assert S.elbow([100.0, 95.0, 60.0, 58.0], 9) == 3
    edges = S.log_edges(1e-3, 0.4)
    assert edges[0] == 0.0 and math.isinf(edges[-1]) and len(edges) == 11 and edges[5] == pytest.approx(0.02)


def test_quantiles_of_any_group(spark):
    import numpy as np

    rows = [(g, float(v) if v % 11 else None) for g in (None, 1, 2) for v in range(g or 5, 90, (g or 3) * 2)] + [(7, 3.0)]
    got = {r.g: r for r in S.quantiles(spark.createDataFrame(rows, "g int, v double").repartition(4), ["g"], "v", (0.0, 0.1, 0.5, 1.0), Scratch(spark, "t"), root=True).collect()}
    for g in (None, 1, 2, 7):
        of = [v for x, v in rows if x == g and v is not None]
        for i, p in enumerate((0.0, 0.1, 0.5, 1.0)):
            assert got[g][f"q_{i}"] == pytest.approx(np.quantile(of, p)) and got[g][f"r_{i}"] == pytest.approx(np.quantile(np.sqrt(of), p))


def test_params_from_env(monkeypatch):
    monkeypatch.setenv("FRAMELOOM_CLOSEUP_AREA", "0.5")
    monkeypatch.setenv("FRAMELOOM_LOOKALIKE_CLASSES", "1, 2")
    p = Params.from_env()
    assert p.closeup_area == 0.5 and p.lookalike_classes == (1, 2)


def test_three_places_as_in_c(spark):
    import random

    from frameloom.functions.text import three_places

    rng = random.Random(1)
    xs = [k / 2000 for k in range(-41, 4001)] + [k / 16 for k in range(-9, 33)] + [rng.random() for _ in range(500)] + [round(rng.random(), 9) for _ in range(500)] + [0.0625, 0.1875, 1234.5675, -0.0001, 0.0]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", three_places(F.col("x")).alias("s")).collect()
    assert [(r.x, r.s) for r in got if r.s != f"{r.x:.3f}"] == []
    assert spark.range(1).select(three_places(F.lit(None).cast("double"))).first()[0] is None
