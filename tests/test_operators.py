"""Operators against plain restatements on small random data."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from frameloom.operators import evaluation as E
from frameloom.operators import matching as M
from frameloom.operators import review as R
from frameloom.operators import sampling as H
from frameloom.operators import similarity as Sim
from frameloom.operators.curate import clip_boxes, upsert, variant_keepers
from frameloom.operators.graph import connected_components
from frameloom.operators.images import current_images
from frameloom.operators.sequences import selected_frames, thin_clips
from frameloom.plans.ranks import rank_in_groups
from frameloom.params import DEFAULTS
from frameloom.plans.scratch import Scratch
from frameloom.sources import labels as L


def bits(a, b):
    return ((a ^ b) & (2**64 - 1)).bit_count()


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def components(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("seed", range(3))
def test_connected_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(None, 1), (2, None), (3, 3), (100, 101), (101, 100)] + [(i, i + 1) for i in range(200, 230)]
    got = connected_components(spark.createDataFrame(links, "a bigint, b bigint"), Scratch(spark, "t"))
    assert {r.id: r.component for r in got.collect()} == components(links)


def test_connected_components_of_large_ids(spark):
    """Ids whose sum passes 64 bits, of both signs."""
    top, low = 2**62, -(2**62)
    links = [(top + i, top + i + 1) for i in range(8)] + [(low - i, low - i - 1) for i in range(8)]
    got = {(r.id, r.component) for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint"), Scratch(spark, "t")).collect()}
    assert got == {(top + i, top) for i in range(9)} | {(low - i, low - 8) for i in range(9)}


def test_connected_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint"), Scratch(spark, "t")).count() == 0


def hashes(rng, n):
    base = [rng.getrandbits(64) for _ in range(n // 4)]
    out = []
    for i in range(n):
        h = rng.choice(base)
        for _ in range(rng.randrange(12)):
            h ^= 1 << rng.randrange(64)
        out.append((i, signed(h) if rng.random() > 0.05 else None, signed(h ^ (rng.getrandbits(64) if rng.random() < 0.5 else 3))))
    return out


@pytest.mark.parametrize("most", [4, 8])
def test_hamming_joins(spark, most):
    rng = random.Random(most)
    rows = hashes(rng, 160)
    df = spark.createDataFrame(rows, "id bigint, phash bigint, phash_mirror bigint")
    got = {(r.a, r.b, r.distance) for r in Sim.hamming_self_pairs(df, Scratch(spark, "t"), most).collect()}
    want = {(a[0], b[0], bits(a[1], b[1])) for a in rows for b in rows if a[0] < b[0] and a[1] is not None and b[1] is not None and bits(a[1], b[1]) <= most}
    assert got == want
    left, right = df.where("id < 80"), df.where("id >= 80")
    got = {(r.a, r.b, r.distance, r.mirrored) for r in Sim.hamming_cross_pairs(left, right, Scratch(spark, "t"), most).collect()}
    want = set()
    for a in rows[:80]:
        for b in rows[80:]:
            if a[1] is not None and b[1] is not None:
                s, m = bits(a[1], b[1]), bits(a[1], b[2])
                if min(s, m) <= most:
                    want.add((a[0], b[0], min(s, m), m < s))
    assert got == want


@pytest.mark.parametrize("both", [True, False])
@pytest.mark.parametrize("threshold,hot", [(0, 20), (2, 20), (4, 20), (8, 3), (40, 60)])
def test_hot_words_are_cut(spark, threshold, hot, both):
    """Values that agree in most words, in groups cut by second words and into cells, at any threshold."""
    shift = 40
    values = Scratch(spark, "t").keep(spark.createDataFrame([(i << shift, 3 if both else i % 3 + 1) for i in range(200)], "value bigint, side int"))
    got = [(r.a >> shift, r.b >> shift, r.distance) for r in Sim.near_values(values, threshold, both, hot).collect()]
    n = range(200)
    want = {(i, j, bits(i, j)) for i in n for j in n if bits(i, j) <= threshold and (i < j if both else i % 3 + 1 in (1, 3) and j % 3 + 1 in (2, 3))}
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("threshold", [4, 8])
@pytest.mark.parametrize("both", [True, False])
def test_large_groups_lose_no_pair(threshold, both):
    import numpy as np

    rng = np.random.default_rng(threshold)
    own, earlier = Sim.words(threshold)[1], Sim.words(threshold)[:1]
    free = np.uint64(2**64 - 1 - own)
    left = np.unique(rng.integers(0, 2**63, 3000).astype(np.uint64) & free)
    near = left.copy()
    for _ in range(threshold):
        near ^= np.uint64(1) << rng.integers(0, 64, len(near)).astype(np.uint64)
    near &= free
    right = np.unique(np.concatenate([near, left[:100]]))
    left = np.unique(np.concatenate([left, right])) if both else left
    right = left if both else right
    got = [(int(a), int(b)) for x, y in Sim._compare(own, earlier, left, None if both else right, threshold) for a, b in zip(x, y)]
    d = left[:, None] ^ right[None, :]
    i, j = np.nonzero((np.bitwise_count(d) <= threshold) & ((d & np.uint64(earlier[0])) != 0))
    want = {(int(left[a]), int(right[b])) for a, b in zip(i, j)}
    if both:
        got, want = [tuple(sorted(p)) for p in got], {tuple(sorted(p)) for p in want if p[0] != p[1]}
    assert len(got) == len(set(got)) and set(got) == want


def test_thinning(spark):
    rng = random.Random(1)
    rows, h = [], 0
    for clip in ("a", "b", "c"):
        f = 0
        for i in range(4 if clip == "c" else 60):
            f += rng.choice([1, 1, 5, 70])
            if rng.random() < 0.3:
                h = rng.getrandbits(63)
            rows.append((len(rows), "d", "train", clip, f, (h ^ (1 << rng.randrange(63))) if rng.random() > 0.1 else None))
    got = {r.image_id: r.keep for r in thin_clips(spark.createDataFrame(rows, "image_id bigint, dataset string, split string, clip string, frame bigint, phash bigint")).collect()}
    want = {}
    for clip in ("a", "b", "c"):
        seq = sorted((r for r in rows if r[3] == clip), key=lambda r: (r[4], r[0]))
        last = seq[0]
        for i, r in enumerate(seq):
            drop = len(seq) >= 5 and 0 < i < len(seq) - 1 and r[5] is not None and last[5] is not None and bits(r[5], last[5]) < 10 and r[4] - last[4] <= 60
            want[r[0]] = not drop
            if not drop:
                last = r
    assert got == want


def test_selected_frames(spark):
    got = selected_frames(spark.createDataFrame([("v", 100, 25.0), ("e", 0, 25.0)], "video string, n_frames bigint, fps double"), 2.0).collect()
    assert [r.idx for r in sorted(got, key=lambda r: r.nth)] == [0, 12, 25, 38, 50, 62, 75, 88]


def test_exclusive_matches_and_precision(spark):
    rows = lambda x: [(1, 0, i, *b) for i, b in enumerate(x)]
    t = spark.createDataFrame(rows([(0.0, 0.0, 10.0, 10.0), (20.0, 0.0, 30.0, 10.0)]), "image_id bigint, class_id int, ord int, x1 double, y1 double, x2 double, y2 double")
    p = spark.createDataFrame([r + (c,) for r, c in zip(rows([(0.0, 0.0, 10.0, 9.0), (0.0, 0.0, 10.0, 10.0), (50.0, 0.0, 60.0, 10.0)]), (0.9, 0.8, 0.95))], "image_id bigint, class_id int, ord int, x1 double, y1 double, x2 double, y2 double, conf double")
    shape = lambda d: d.withColumn("b", F.struct("x1", "y1", "x2", "y2")).withColumn("pixels", F.lit(100.0))
    m = M.exclusive_matches(shape(t), shape(p))
    assert {(r.is_gt, r.ord): r.matched for r in m.collect()} == {(True, 0): True, (True, 1): False, (False, 0): True, (False, 1): False, (False, 2): False}
    assert E.average_precision(m, Scratch(spark, "t")).first().ap == pytest.approx(0.25)
    s = {r.bucket: (r.tp, r.fn, r.fp) for r in E.size_breakdown(m).collect()}
    assert s == {"small": (1, 1, 2)}


def test_greedy_ties_go_to_greater_ords(spark):
    b = F.struct(*(F.lit(v).alias(c) for v, c in zip((0.0, 0.0, 1.0, 1.0), ("x1", "y1", "x2", "y2"))))
    df = spark.createDataFrame([(1, 0, 0), (1, 0, 1)], "image_id bigint, class_id int, ord int").withColumn("b", b)
    assert M.containment_matches(df, df, ["image_id"]).first().n_matches == 2


def test_novel_top_k():
    c = [{"name": i, "phash": h} for i, h in enumerate([0, 1, 2**20 - 1, 2**40 - 1, None, 3])]
    got = [x["fate"] for x in M.novel_top_k(c, {3: 4}, 2, 4)]
    assert got == ["kept", "near_kept", "kept", "near_pool", "over_limit", "near_kept"]


def test_rank_in_groups(spark):
    rows = [(i % 3 if i % 7 else None, (i * 37) % 101, i) for i in range(100)]
    got = rank_in_groups(spark.createDataFrame(rows, "g int, o int, id int").repartition(5), ["g"], ["o", "id"], Scratch(spark, "t"), "nth").collect()
    for g in (None, 0, 1, 2):
        of = sorted((r.o, r.id) for r in got if r.g == g)
        assert [(r.o, r.id) for r in sorted((r for r in got if r.g == g), key=lambda r: r.nth)] == of
        assert sorted(r.nth for r in got if r.g == g) == list(range(len(of)))


def test_running_totals(spark):
    from frameloom.plans.ranks import running_totals

    rows = [(i % 3 if i % 7 else None, (i * 37) % 101, i % 5 if i % 4 else None) for i in range(100)]
    df = spark.createDataFrame(rows, "g int, o int, v bigint").repartition(6)
    for greatest in (False, True):
        got = {(r.g, r.o): r.x for r in running_totals(df, ["o"], "v", Scratch(spark, "t"), "x", ["g"], greatest).collect()}
        for g, o, _ in rows:
            of = [v or 0 for x, y, v in rows if x == g and (y <= o if greatest else y < o)]
            assert (got[g, o] or 0) == (max(of) if greatest else sum(of))


@pytest.mark.parametrize("n", [1, 50, 5000, 30000])
def test_sample(spark, n):
    import hashlib

    ids = range(20000)
    got = {r.id for r in H.sample(spark.range(20000), n, "id", Scratch(spark, "t"), 7).collect()}
    assert got == set(sorted(ids, key=lambda i: (hashlib.md5(f"7:{i}".encode()).hexdigest(), i))[:n])


def test_current_images(spark):
    rows = [
        (1, None, "TRAIN", "r/a-v1/train/images/x.jpg", "2024-01-01 00:00:00"),
        (1, None, "TRAIN", "r/a-v1/valid/images/x.jpg", "2024-01-02 00:00:00"),
        (1, None, "TRAIN", "r/a-v1/valid/images/x.jpg", "2024-01-02 00:00:00"),
        (2, " B-v2 ", "val", None, "2024-01-01 00:00:00"),
        (None, "b", "val", "r/a-v1/train/images/x.jpg", "2024-01-01 00:00:00"),
    ]
    df = spark.createDataFrame(rows, "image_id bigint, dataset_id string, split string, image_path string, indexed_at string").withColumn("indexed_at", F.col("indexed_at").cast("timestamp_ntz")).withColumn("dataset", F.lit("clash"))
    assert sorted((r.image_id, r.dataset, r.split) for r in current_images(df).collect()) == [(1, "a-v1", "valid"), (2, "b-v2", "valid")]


def test_label_files(spark, tmp_path):
    (tmp_path / "labels").mkdir()
    (tmp_path / "labels/a.txt").write_text("1 0.5 0.5 0.2 0.2\n1 0.5 0.5 0.2\n\n80.0 .1 .1 .1 .1\n")
    (tmp_path / "labels/b.txt").write_text("")
    lines = L.label_lines(spark, str(tmp_path / "labels"))
    assert lines.select("path").distinct().count() == 2
    lines = lines.withColumn("file", F.substring_index("path", "/", -1))
    assert [r.class_id for r in L.parse_boxes(lines, ["file"]).collect()] == [1]
    assert sorted(r.class_id for r in L.parse_boxes(lines, ["file"], "tolerant").collect()) == [1, 80]
    assert sorted(r.class_id for r in L.parse_boxes(lines, ["file"], "first").collect()) == [1, 1, 80]
    bad = L.parse_boxes(lines, ["file"], "strict")
    assert [r.error for r in bad.where("error IS NOT NULL").collect()] == ["a.txt:2"]
    with pytest.raises(Exception, match="a.txt:2"):
        L.fail_on_errors(bad).collect()


def test_lists_and_flags(spark, tmp_path):
    (tmp_path / "l.txt").write_text("# note\n a \n\nb\nb\n")
    assert [r.value for r in L.read_list(spark, str(tmp_path / "l.txt")).orderBy("ord").collect()] == ["a", "b", "b"]
    (tmp_path / "f.txt").write_text("n.jpg\tbike\tconf=0.7\tcontainment=0.9\t1 .5 .5 .1 .1\n")
    r = L.read_flags(spark, str(tmp_path / "f.txt")).first()
    assert (r.name, r.conf, r.containment) == ("n.jpg", 0.7, 0.9)


def test_eval_reports(spark):
    raw = '{"runs/a/best.pt": {"video": {"precision": 0.5, "recall": 0.4, "mAP50": 0.7, "mAP50-95": 0.5, "size_breakdown": {"recall_by_gt_size": {"small": {"tp": 13, "fn": 73}, "large": {"tp": 0, "fn": 0}}, "false_positives_by_pred_size": {"small": 5}}}}}'
    from frameloom.operators.runs import recall_table

    df = L.eval_reports(spark.createDataFrame([(raw,)], "raw string"), names=["a"])
    assert {r.bucket: r.recall for r in recall_table(df).collect()} == {"small": 13 / 86, "large": None}
    assert L.eval_reports(spark.createDataFrame([(raw,)], "raw string"), names=["b"]).count() == 0


def test_upsert(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "id string, n int, own string")
    new = spark.createDataFrame([("a", None), ("c", 3)], "id string, n int")
    assert sorted((r.id, r.n, r.own) for r in upsert(old, new, "id", ["own"]).collect()) == [("a", None, "x"), ("b", 2, "y"), ("c", 3, None)]


def test_variant_keepers(spark):
    df = spark.createDataFrame([("g", True, "a"), ("g", False, "b"), ("g", False, "c"), ("h", True, "z"), ("h", True, "y")], "g string, rotated boolean, name string")
    assert sorted(r.name for r in variant_keepers(df, ["g"], "rotated", "name").where("keep").collect()) == ["b", "y"]


def test_review_log(spark):
    log = spark.createDataFrame([(1, "move", "a", "t"), (2, "exclude", "b", "t"), (3, "undo", None, None), (4, None, "c", "v"), (5, "undo", None, None), (6, "undo", None, None), (7, "move", "d", "t")], "seq bigint, action string, name string, from_split string")
    assert {r.name: r.action for r in R.placement(log).collect()} == {"d": "move"}
    d = spark.createDataFrame([(1, "a", "select"), (2, "a", None), (3, "b", "discard")], "seq bigint, name string, decision string")
    assert {r.name: r.decision for r in R.current_decisions(d).collect()} == {"b": "discard"}


def test_clip_boxes(spark):
    df = spark.createDataFrame([(0.5, 0.5, 0.2, 0.2), (0.0, 0.5, 0.4, 0.2), (-1.0, 0.5, 0.1, 0.1)], "xc double, yc double, w double, h double")
    assert [r.action for r in clip_boxes(df).collect()] == ["kept", "clipped", "removed"]


def test_balanced_split(spark):
    df = spark.createDataFrame([(i, d, g) for i, (d, g) in enumerate([("a", 1)] * 10 + [("a", 2)] * 5 + [("a", 3)] * 5 + [("b", 1)] * 2 + [("b", 4)] * 2)], "image_id bigint, dataset string, group_id bigint")
    got = {r.group_id: r.side for r in H.balanced_split(df, Scratch(spark, "t"), 0.5).select("group_id", "side").distinct().collect()}
    assert got == {1: "train", 2: "valid", 3: "valid", 4: "valid"}
    assert H.balanced_split(df.limit(0), Scratch(spark, "t")).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_balanced_counts_are_those_of_one_by_one(seed):
    rng = random.Random(seed)
    kinds = {}
    for _ in range(12):
        k = tuple((d, rng.randrange(1, 9)) for d in sorted(rng.sample("abcd", rng.choice([1, 1, 2]))))
        kinds[k] = rng.randrange(1, 6)
    got = H.balanced_counts(kinds, 0.3)
    side: dict = {}
    for d in "abcd":
        of = sorted(((n, k, i) for k, c in kinds.items() for e, n in k if e == d for i in range(c)), key=lambda x: (-x[0], x[1], x[2]))
        want = {"valid": round(sum(x[0] for x in of) * 0.3)}
        want["train"] = sum(x[0] for x in of) - want["valid"]
        for n, k, i in of:
            if (k, i) in side:
                want[side[k, i]] -= n
        for n, k, i in of:
            if (k, i) not in side:
                side[k, i] = "valid" if want["valid"] > want["train"] else "train"
                want[side[k, i]] -= n
    assert got == {k: sum(side[k, i] == "valid" for i in range(c)) for k, c in kinds.items()}


def test_quota_subset(spark):
    rows = [(i, c) for i in range(100) for c in ([0] + ([1] if i % 10 == 0 else []))]
    got = H.quota_subset(spark.createDataFrame(rows, "image_id bigint, class_id int"), [0, 1], 20, 5, Scratch(spark, "t"))
    ids = {r.image_id for r in got.collect()}
    assert len(ids) == 20 and sum(i % 10 == 0 for i in ids) >= 5


def test_at_confidence(spark):
    c = spark.createDataFrame([(0, 0.9, 1.0, 0.2), (0, 0.5, 0.5, 0.6)], "class_id int, conf double, precision double, recall double")
    r = E.at_confidence(c, 0.7).first()
    assert (r.precision, r.recall) == pytest.approx((0.75, 0.4))


@pytest.mark.parametrize("m, threshold", [(0, 12), (3, 5), (4, 12), (7, 12), (8, 20), (5, 0)])
def test_nearest_by_words(monkeypatch, m, threshold):
    """Each value with all that are nearest, over several cells, parts and lists of ties."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(m)
    centres = rng.integers(0, 2**64, 6, dtype=np.uint64)

    def some(n):
        v = centres[rng.integers(0, 6, n)]
        for _ in range(5):
            v = v ^ (np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64))
        return np.unique(np.concatenate([v, rng.integers(0, 2**64, n, dtype=np.uint64), centres[:3]]))

    rights, cells = some(250), [some(120), some(80)]
    k = np.concatenate([np.full(len(v), 2 * c + side, np.int32) for c, left in enumerate(cells) for side, v in enumerate((left, rights))])
    value = np.concatenate([v for left in cells for v in (left, rights)]).view(np.int64)
    batches = [pa.RecordBatch.from_arrays([pa.array(k[i : i + 70]), pa.array(value[i : i + 70])], ["k", "value"]) for i in range(0, len(k), 70)]
    monkeypatch.setattr(Sim, "_n_words", lambda *_: m)
    got = {tuple(r.values()) for b in Sim._nearest_of_partition(iter(batches), threshold, at_once=100, most_ties=30) for r in b.to_pylist()}
    assert all(bits(a, b) == d <= threshold for a, b, d in got)
    want = set()
    for left in cells:
        for a in left.view(np.int64).tolist():
            each = [(bits(a, b), b) for b in rights.view(np.int64).tolist()]
            want |= {(a, b, d) for d, b in each if d == min(each)[0] <= threshold}
    assert want and want <= got


def test_nearest_compares_few_pairs(monkeypatch):
    """Of random values a fiftieth of the pairs; of values all near to each other no list of all pairs."""
    import numpy as np

    rng = np.random.default_rng(0)
    count, compared = np.bitwise_count, 0

    def counted(x):
        nonlocal compared
        compared += x.size
        return count(x)

    left, right = rng.integers(0, 2**64, 1000, dtype=np.uint64), rng.integers(0, 2**64, 200_000, dtype=np.uint64)
    monkeypatch.setattr(Sim, "_n_words", lambda *_: 4)
    monkeypatch.setattr(np, "bitwise_count", counted)
    list(Sim._nearest_in_turn(left, right, np.full(1000, 12, np.uint8), 12))
    assert 0 < compared < 1000 * 200_000 / 50


def test_nearest_values_lists_the_nearest_only(spark):
    """300 values that are all within 12 bits of 300 others, of which one is nearest: 90,000 pairs are within."""
    scratch = Scratch(spark, "t")
    left = scratch.keep(spark.range(300).select((F.col("id") * 2048).alias("value")))
    right = spark.range(300).select((F.col("id") * 2048 + F.when(F.col("id") == 0, 0).otherwise(1)).alias("value"))
    got = Sim.nearest_values(left, right, 12).collect()
    assert {r.a for r in got} == {2048 * i for i in range(300)} and len(got) < 3000
    assert all(any(r.distance == 1 and r.b == r.a + 1 for r in got if r.a == a) for a in (2048 * 3, 2048 * 299))


@pytest.mark.parametrize("least", [0.9, 0.6, 0.25])
def test_box_twins(spark, least):
    from dataclasses import replace

    rng = random.Random(9)
    rows = []
    for i in range(12):
        for k in range(5):
            r = random.Random(100 * (i // 3) + k)
            x, y, w, h = r.uniform(0.2, 0.8), r.uniform(0.2, 0.8), r.uniform(0.02, 0.3), r.uniform(0.02, 0.3)
            rows.append((i, "d", r.randrange(2), k, x + rng.uniform(-0.06, 0.06) * w, y + rng.uniform(-0.06, 0.06) * h, w * rng.uniform(0.96, 1.04), h))
    rows.append((99, "d", 0, 0, 0.5, 0.5, 0.1, 0.1))
    got = {(r.a, r.z, r.n) for r in M.box_twins(spark.createDataFrame(rows, "image_id bigint, dataset string, class_id int, ord int, xc double, yc double, w double, h double"), Scratch(spark, "t"), replace(DEFAULTS, dup_containment=least)).collect()}

    def contained(p, q):
        w = min(p[4] + p[6] / 2, q[4] + q[6] / 2) - max(p[4] - p[6] / 2, q[4] - q[6] / 2)
        h = min(p[5] + p[7] / 2, q[5] + q[7] / 2) - max(p[5] - p[7] / 2, q[5] - q[7] / 2)
        return max(w, 0) * max(h, 0) / (p[6] * p[7])

    want = set()
    for a in range(12):
        for z in range(a + 1, 12):
            pairs = sorted(((min(contained(p, q), contained(q, p)), p[3], q[3]) for p in rows if p[0] == a for q in rows if q[0] == z and p[2] == q[2]), reverse=True)
            i, j, n = set(), set(), 0
            for s_, x, y in pairs:
                if s_ >= least and x not in i and y not in j:
                    i.add(x)
                    j.add(y)
                    n += 1
            if n >= 4:
                want.add((a, z, n))
    assert got == want and want


def test_selection_marks_each_picture_once(spark, small):
    from frameloom.catalogue.more import o3_selection
    from frameloom.catalogue.views import Views

    v = Views(spark, small)
    got = o3_selection(v).collect()
    assert len(got) == v.pick().count() == len({r.image_id for r in got})
    assert {r.stage for r in got} <= {None, "cheap", "temporal", "dedup", "variety"}
    assert all(r.excluded == (r.stage is not None) for r in got)


def test_media_leaves(spark):
    from frameloom.operators import media

    df = spark.createDataFrame([(1, bytearray(b"ab")), (2, bytearray(b""))], "image_id bigint, content binary")
    found = media.detect(df, lambda: lambda xs: [[(0, 0.5, 0, 0, len(x), 1)] * len(x) for x in xs])
    assert sorted((r.image_id, r.det_ord, r.x2) for r in found.collect()) == [(1, 0, 2.0), (1, 1, 2.0)]
    h = media.hashed(df, lambda: lambda x: (len(x), -1) if x else None)
    assert sorted((r.image_id, r.phash) for r in h.collect()) == [(1, 2), (2, None)]
    rows = lambda *v: F.array(*map(F.lit, v))
    assert spark.range(1).select(media.wedge(rows(20, 30, 40, 50, 60), rows(0, 0, 0, 0, 0), F.lit(100.0)).alias("x")).first().x is True
    assert spark.range(1).select(media.wedge(rows(20, 30), rows(0, 0), F.lit(100.0)).alias("x")).first().x is False


def test_sinks(spark, tmp_path):
    from frameloom.sources import sinks

    df = spark.createDataFrame([("b", 2), ("a", 1)], "dataset string, n int")
    sinks.write_list(df, F.col("dataset"), ["n"], str(tmp_path / "l"))
    assert [r.value for r in spark.read.text(str(tmp_path / "l")).collect()] == ["a", "b"]
    sinks.write_index(df, "dataset", str(tmp_path / "i"))
    assert spark.read.json(str(tmp_path / "i")).count() == 2
    sinks.write_by_dataset(df, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).where("dataset = 'a'").first().n == 1
    names = sinks.class_map(sinks.class_map_yaml(["person", "kid's scooter"], {"train": "t"}))
    assert names == {0: "person", 1: "kid's scooter"}
    assert sinks.class_spec("1, person,person", names) == [1, 0]
    for bad in ("names: {1: a}", "names: [a]\nnc: 2", "names: {a: b}", "names:"):
        with pytest.raises(ValueError):
            sinks.class_map(bad)
    with pytest.raises(ValueError):
        sinks.class_spec("car", names)


@pytest.mark.parametrize("all_boxes", [False, True])
def test_signature_overlaps(spark, all_boxes):
    rng = random.Random(11)
    base = [[(rng.randrange(2), rng.uniform(0.2, 0.8), rng.uniform(0.2, 0.8), rng.uniform(0.1, 0.3), rng.uniform(0.1, 0.3)) for _ in range(3)] for _ in range(4)]
    rows = []
    for i in range(24):
        for k, (c, x, y, w, h) in enumerate(base[i % 4]):
            x = 1 - x if i % 3 == 0 else x
            rows.append((i, c, k, x + rng.uniform(-0.03, 0.03) * w, y, w * rng.uniform(0.97, 1.03), h, k == min(j for j, b in enumerate(base[i % 4]) if b[0] == c)))
    df = spark.createDataFrame(rows, "image_id bigint, class_id int, ord int, xc double, yc double, w double, h double, top boolean")
    got = {(r.a, r.b): (r.overlaps, round(r.iou, 9), r.mirrored) for r in M.signature_overlaps(df.where("image_id < 12"), df.where("image_id >= 12"), 0.1, all_boxes).collect()}

    def iou(p, q):
        w = min(p[2], q[2]) - max(p[0], q[0])
        h = min(p[3], q[3]) - max(p[1], q[1])
        both = max(w, 0) * max(h, 0)
        return both / ((p[2] - p[0]) * (p[3] - p[1]) + (q[2] - q[0]) * (q[3] - q[1]) - both)

    box = lambda r, m: ((1 - r[3] if m else r[3]) - r[5] / 2, r[4] - r[6] / 2, (1 - r[3] if m else r[3]) + r[5] / 2, r[4] + r[6] / 2)
    want = {}
    for a in range(12):
        for b in range(12, 24):
            mine, theirs = [r for r in rows if r[0] == a], [r for r in rows if r[0] == b]
            if {r[1] for r in mine} != {r[1] for r in theirs}:
                continue
            best = None
            for m in (False, True):
                n, total = 0, 0.0
                for c in {r[1] for r in mine}:
                    i_used, j_used = set(), set()
                    for s_, i, j in sorted(((iou(box(p, m), box(q, False)), p[2], q[2]) for p in mine if p[1] == c and (all_boxes or p[7]) for q in theirs if q[1] == c), reverse=True):
                        if s_ < 0.9:
                            break
                        if i in i_used or (all_boxes and j in j_used):
                            continue
                        i_used.add(i)
                        j_used.add(j)
                        n, total = n + 1, total + s_
                if n and (best is None or (n, total) > best[:2]):
                    best = (n, total, m)
            if best:
                want[a, b] = (best[0], round(best[1] / best[0], 9), best[2])
    assert got == want and want


def test_idle_runs(spark):
    from frameloom.streaming.ingest import idle_runs

    rows = [("a", "2024-01-01 00:00:00", 1), ("a", "2024-01-01 00:03:00", 2), ("a", "2024-01-01 00:20:00", 3)]
    df = spark.createDataFrame(rows, "run string, at string, epoch int").withColumn("at", F.col("at").cast("timestamp"))
    assert sorted((r.last_epoch, r.n) for r in idle_runs(df).collect()) == [(2, 2), (3, 1)]


def test_dataset_scan(spark, tmp_path):
    from frameloom.sources.images import list_images, scan_dataset, sha256

    for split, names in {"train": ("a", "b", "c"), "valid": ("d",)}.items():
        for kind in ("images", "labels"):
            (tmp_path / f"ds-v1/{split}/{kind}").mkdir(parents=True)
        for n in names:
            (tmp_path / f"ds-v1/{split}/images/{n}.jpg").write_bytes(b"x")
    (tmp_path / "ds-v1/train/labels/a.txt").write_text("80 .5 .5 .1 .1\n0 .5 .5 .1 .1\n")
    (tmp_path / "ds-v1/train/labels/b.txt").write_text("")
    images, boxes = scan_dataset(spark, str(tmp_path))
    got = {r.file: (r.dataset, r.split, r.has_label) for r in images.collect()}
    assert got == {"a.jpg": ("ds-v1", "train", True), "b.jpg": ("ds-v1", "train", True), "c.jpg": ("ds-v1", "train", False), "d.jpg": ("ds-v1", "valid", False)}
    assert sorted(r.class_id for r in boxes.collect()) == [0, 80]
    assert all(r.path.endswith("train/images/a.jpg") for r in boxes.collect())
    with pytest.raises(FileNotFoundError):
        list_images(spark, str(tmp_path / "ds-v1/train/labels"), must_exist=True)
    assert len(sha256(spark, str(tmp_path / "ds-v1/train/images/a.jpg")).first().sha256) == 64


def test_split_summary_of_the_fixture(spark):
    from frameloom.operators.stats import class_report, split_summary

    images = spark.createDataFrame([("train", 1), ("train", 2), ("train", 3), ("train", 4)], "split string, image_id bigint")
    boxes = spark.createDataFrame([(1, 1), (1, 1), (2, 0)], "image_id bigint, class_id int")
    labels = spark.createDataFrame([(1,), (2,), (3,)], "image_id bigint")
    r = {r.split: r for r in split_summary(images, boxes, labels).collect()}["TOTAL"]
    assert (r.images, r.background, r.missing, r["empty"], r.instances, r.max_instances) == (4, 2, 1, 1, 3, 2)
    classes = spark.createDataFrame([(0, "person"), (1, "scooter"), (2, "unused")], "class_id int, name string")
    got = {x.class_id: (x.instances, x.class_images) for x in class_report(images, boxes, classes).collect()}
    assert got == {0: (1, 1), 1: (2, 1), 2: (0, 0)}
    bag = spark.createDataFrame([("train", 1), ("train", 1), ("valid", 1)], "split string, image_id bigint")
    assert {r.split: r.instances for r in split_summary(bag, boxes).collect()} == {"train": 4, "valid": 2, "TOTAL": 6}


def test_greater_limits_of_datasets_hold(spark):
    rng = random.Random(3)
    rows = [(i, h, 10 if i % 3 else 4) for i, (_, h, _) in enumerate(hashes(rng, 160)) if h is not None]
    rows += [(1000, 0, 10), (1001, 2**10 - 1, 10), (1002, 2**9 - 1, 8)]
    df = spark.createDataFrame(rows, "id bigint, phash bigint, most int")
    want = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and bits(a[1], b[1]) <= min(a[2], b[2])}
    got = {(r.a, r.b) for r in Sim.hamming_self_pairs(df, Scratch(spark, "t"), 10, limit="most", usual=8).collect()}
    assert got == want and (1000, 1001) in got and (1000, 1002) not in got


def test_limits_of_the_catalog_are_not_cut(spark, small):
    from frameloom.catalogue.pairs import _limited
    from frameloom.catalogue.views import Views
    from frameloom.operators.curate import widest_distance

    v = Views(spark, small)
    assert widest_distance(v.cat) == 10
    assert _limited(v).agg(F.max("most")).first()[0] == 10


@pytest.mark.parametrize("clicked", [False, True])
def test_cross_split_groups(spark, clicked):
    rng = random.Random(11)
    rows = [(i, rng.choice(["a", "b", "c", None, *map(str, range(20))]), p, m) for i, p, m in hashes(rng, 200)]
    rows += [(300 + i, "z", 5, 6) for i in range(20)]  # copies
    valid, train = [r for r in rows if r[0] % 3 == 0], [r for r in rows if r[0] % 3]
    gone = {(r[0], t[0]) for r in valid for t in train if rng.random() < 0.1} | {(300, t[0]) for t in train[-8:]} | {(-1, 5)} if clicked else set()
    want = set()
    for a in valid:
        of = []
        for b in train:
            if None in (a[2], b[2], b[3]) or (a[0], b[0]) in gone:
                continue
            d = min(bits(a[2], b[2]), bits(a[2], b[3]))
            if d <= 6 or a[1] is not None and a[1] == b[1]:
                of.append((d, b[0]))
        want |= {(a[0], b, d, k, max(len(of) - 12, 0)) for k, (d, b) in enumerate(sorted(of)[:12], 1)}
    schema = "image_id bigint, base string, phash bigint, phash_mirror bigint"
    out = spark.createDataFrame(sorted(gone), "a bigint, b bigint") if clicked else None
    got = Sim.cross_split_groups(spark.createDataFrame(valid, schema), spark.createDataFrame(train, schema), Scratch(spark, "t"), 6, dismissed=out).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert any(r.distance > 6 for r in got)


@pytest.mark.parametrize("most", [3, 40, 10_000])
def test_novel_fates_of_all_candidates(spark, most):
    rng = random.Random(most)
    rows = [(i, i, h) for i, (_, h, _) in enumerate(hashes(rng, 240))]
    pool = {i for i, _, _ in rows if rng.random() < 0.2}
    want = {(r["name"], k, r["fate"]) for k, r in enumerate(M.novel_top_k([{"name": i, "phash": h} for i, _, h in rows], {i: 1 for i in pool}, most, 12))}
    df = spark.createDataFrame(rows, "image_id bigint, rank bigint, phash bigint")
    got = M.novel_fates(df, spark.createDataFrame([(i,) for i in pool], "image_id bigint"), Scratch(spark, "t"), most, 12, batch=16)
    assert {tuple(r) for r in got.collect()} == want


@pytest.mark.parametrize("undo", [0.3, 0.5, 0.6])
def test_placement_over_many_partitions(spark, undo):
    rng = random.Random(undo)
    rows = [(i * 3, rng.choice([None, "move", "exclude"]) if rng.random() > undo else "undo", f"n{rng.randrange(40)}", f"s{rng.randrange(3)}") for i in range(600)]
    stack = []
    for r in rows:
        if r[1] != "undo":
            stack.append(r)
        elif stack:
            stack.pop()
    want = {r[2]: (r[1] or "move", r[3]) for r in stack}
    df = spark.createDataFrame(rng.sample(rows, len(rows)), "seq bigint, action string, name string, from_split string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = R.placement(df, Scratch(spark, "t")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {r.name: (r.action, r.from_split) for r in got} == want


def test_placement_takes_the_whole_log(spark, small):
    from frameloom.catalogue.reports import k6_placement
    from frameloom.catalogue.views import Views

    v = Views(spark, small)
    stack = []
    for r in v.table("events").orderBy("event_id").collect():
        if r.event_type != "error":
            stack.append((f"picture_{r.user_id}", "exclude" if r.event_type == "signup" else "move"))
        elif stack:
            stack.pop()
    assert {r.name: r.action for r in k6_placement(v).collect() if r.name} == {k: a for k, a in dict(stack).items() if k != "picture_None"}


def test_average_precision_at_ten_thresholds(spark):
    rng = random.Random(5)
    t, p = [], []
    for i in range(8):
        for k in range(6):
            x, y, c = rng.uniform(0, 60), rng.uniform(0, 60), rng.randrange(2)
            t.append((i, c, k, x, y, x + 20, y + 20))
            dx, dy = rng.uniform(-5, 5), rng.uniform(-5, 5)
            p.append((i, c, k, x + dx, y + dy, x + 20 + dx, y + 20 + dy, rng.randrange(10) / 10))
    t.append((9, 7, 0, 0.0, 0.0, 5.0, 5.0))  # a class without predictions
    schema = "image_id bigint, class_id int, ord int, x1 double, y1 double, x2 double, y2 double"
    shape = lambda d: d.withColumn("b", F.struct("x1", "y1", "x2", "y2")).withColumn("pixels", F.lit(100.0))
    truth, found = shape(spark.createDataFrame(t, schema)), shape(spark.createDataFrame(p, schema + ", conf double"))
    got = {r.class_id: r for r in E.mean_average_precision(truth, found, M.matches_by_threshold(truth, found, Scratch(spark, "t"), E.IOU_THRESHOLDS), Scratch(spark, "t")).collect()}
    per = [{r.class_id: r.ap for r in E.average_precision(M.exclusive_matches(truth, found, x), Scratch(spark, "t")).collect()} for x in E.IOU_THRESHOLDS]
    assert len(per) == 10 and set(got) == set(per[0]) == {0, 1, 7}
    for c, r in got.items():
        assert r.ap50 == pytest.approx(per[0][c]) and r.ap50_95 == pytest.approx(sum(x[c] for x in per) / 10)
    assert got[0].ap50 > got[0].ap50_95 > 0


def test_average_precision_queries_have_both(spark, small):
    from frameloom.catalogue.reports import i2_average_precision, i4_curve_at_confidence
    from frameloom.catalogue.views import Views

    assert i2_average_precision(Views(spark, small)).columns == ["class_id", "positives", "ap50", "ap50_95"]
    assert i4_curve_at_confidence(Views(spark, small)).columns == ["class_id", "precision", "recall", "ap50", "ap50_95"]
