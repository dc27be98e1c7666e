"""Every query of the engine on the smallest tables: against its SQL, or that it runs."""

from __future__ import annotations

import pytest

from frameloom.catalogue import files, more, pairs, reports, rules  # noqa: F401
from frameloom.catalogue.registry import QUERIES, SQL
from tests.same import assert_same


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, small, duck, name):
    assert_same(QUERIES[name](spark, small), duck, SQL[name])


def _unique(rows, *keys):
    return len({tuple(r[k] for k in keys) for r in rows}) == len(rows)


def _ap(rows):
    return _unique(rows, "class_id") and all(0 <= r.ap50_95 <= r.ap50 + 1e-9 <= 1 + 1e-8 for r in rows)


def _one_side_per_group(rows):
    side = {}
    return _unique(rows, "image_id") and all(r.side in ("train", "valid") and side.setdefault(r.group_id, r.side) == r.side for r in rows) and 0.05 < sum(r.side == "valid" for r in rows) / len(rows) < 0.25


# What must hold of the rows of queries without SQL.
HOLDS = {
    "d9_containment_matches": lambda rows: rows and _unique(rows, "image_id") and all(r.n_matches > 0 for r in rows),
    "d14_hash_copies": lambda rows: rows and _unique(rows, "image_id") and all(r.by_hash <= r.by_name <= r.image_id for r in rows),
    "d14_same_name_pairs": lambda rows: _unique(rows, "a", "b") and all(r.distance > 6 for r in rows),
    "e3_thinned_clips": lambda rows: rows and _unique(rows, "image_id") and all(r.keep == (r.kept_by is None) for r in rows) and {r.kept_by for r in rows} - {None} <= {r.image_id for r in rows if r.keep},
    "e9_detection_duplicates": lambda rows: _unique(rows, "image_id") and all(r.component <= r.image_id and r["size"] > 1 for r in rows),
    "f2_novel_hard_examples": lambda rows: rows and _unique(rows, "image_id") and sorted(r["rank"] for r in rows) == list(range(len(rows))) and {r.fate for r in rows} <= {"kept", "near_pool", "near_kept", "over_limit"},
    "g15_size_groups": lambda rows: rows and len(rows) <= 5 and all(a.area_to < b.area_from for a, b in zip(rows, rows[1:])) and all(r.area_from <= r.area <= r.area_to for r in rows),
    "h1_balanced_split": _one_side_per_group,
    "h3_quota_subset": lambda rows: rows and _unique(rows, "image_id"),
    "i2_average_precision": _ap,
    "i4_curve_at_confidence": lambda rows: _ap(rows) and all(x is None or 0 <= x <= 1 for r in rows for x in (r.precision, r.recall)),
    "i5_class_means": lambda rows: len(rows) == 1 and rows[0].classes > 0,
    "k6_placement": lambda rows: rows and _unique(rows, "name") and {r.action for r in rows} <= {"move", "exclude"},
    "o3_selection": lambda rows: rows and _unique(rows, "image_id") and all((r.stage is None) == (r.reason is None) and r.excluded == (r.stage is not None) for r in rows),
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_holds(spark, small, name):
    rows = QUERIES[name](spark, small).collect()
    assert HOLDS[name](sorted(rows, key=lambda r: r["group"]) if name == "g15_size_groups" else rows)


def test_entry(spark, small):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_distances_have_no_ceiling(spark, tmp_path):
    """Two datasets of distance 10: a pair nine bits apart is one, across to a dataset of 8 it isn't."""
    rows = [(1, "ds-v1"), (2, "other-v2"), (3, "third-v3")]
    spark.createDataFrame([(i, f"x/{d}/train/images/{i}.jpg", d, None, 640, 480, 1) for i, d in rows], "image_id bigint, image_path string, dataset_id string, split string, width int, height int, indexed_at bigint").write.parquet(f"{tmp_path}/image_index.parquet")
    spark.createDataFrame([(1, 0, 0), (2, 2**9 - 1, 0), (3, (2**9 - 1) << 20, 0)], "image_id bigint, phash bigint, phash_mirror bigint").write.parquet(f"{tmp_path}/hashes.parquet")
    spark.createDataFrame([(1, 0, 0, 0.5, 0.5, 0.1, 0.1)], "image_id bigint, box_ord int, class_id int, xc double, yc double, w double, h double").write.parquet(f"{tmp_path}/boxes.parquet")
    columns = ["enabled", "download", "workspace_id", "project_id", "version", "escooter_class_name", "variety_min_instances", "closeup_area_threshold", "faraway_area_threshold", "phash_distance_threshold", "notes"]
    cat = [("1", "1", "w", d.split("-v")[0], d.split("-v")[1], "a", "", "", "", most, "") for (_, d), most in zip(rows, ("10", " 10 ", "default"))]
    spark.createDataFrame(cat, ", ".join(f"{c} string" for c in columns)).write.parquet(f"{tmp_path}/datasets_to_download.parquet")
    assert [tuple(r) for r in QUERIES["d13_hamming_pairs"](spark, str(tmp_path)).collect()] == [(1, 2, 9)]
    assert {tuple(r) for r in QUERIES["e5_duplicates"](spark, str(tmp_path)).collect()} == {(1, 1, 1, 1), (2, 1, 1, 0)}


def test_cross_pairs_are_whole_with_copies_and_names(spark, small, duck):
    from frameloom.catalogue.views import H, IMG

    copies = {r.image_id: r for r in QUERIES["d14_hash_copies"](spark, small).collect()}
    near = {(r.a, r.b) for r in QUERIES["d14_cross_pairs"](spark, small).collect()}
    named = {(r.a, r.b) for r in QUERIES["d14_same_name_pairs"](spark, small).collect()}
    got = {(a, b) for a in copies for b in copies if copies[a].split == "valid" and copies[b].split == "train" and ((copies[a].by_hash, copies[b].by_hash) in near or (copies[a].by_name, copies[b].by_name) in named)}
    sql = f"WITH {IMG}, {H}, j AS (SELECT * FROM img JOIN hs USING (image_id)) SELECT v.image_id, t.image_id FROM j v, j t WHERE v.split = 'valid' AND t.split = 'train' AND v.phash IS NOT NULL AND t.phash IS NOT NULL AND t.phash_mirror IS NOT NULL AND (least(bit_count(xor(v.phash, t.phash)), bit_count(xor(v.phash, t.phash_mirror))) <= 6 OR v.base = t.base)"
    assert got == set(duck.execute(sql).fetchall())


def test_pairs_of_one_name_at_any_distance(spark, tmp_path):
    rows = [(1, "x/ds/valid/images/ds__a_flip.jpg"), (2, "x/ds/train/images/A.jpg"), (3, "x/ds/train/images/b.jpg")]
    spark.createDataFrame([(i, p, "ds", None, 1) for i, p in rows], "image_id bigint, image_path string, dataset_id string, split string, indexed_at bigint").write.parquet(f"{tmp_path}/image_index.parquet")
    spark.createDataFrame([(1, 0, 0), (2, 2**20 - 1, 2**30 - 1), (3, 2**20 - 1, 2**30 - 1)], "image_id bigint, phash bigint, phash_mirror bigint").write.parquet(f"{tmp_path}/hashes.parquet")
    assert [tuple(r) for r in QUERIES["e12_suspicious_groups"](spark, str(tmp_path)).collect()] == [(1, 2, 20, 1, 0)]
    assert [tuple(r) for r in QUERIES["d14_same_name_pairs"](spark, str(tmp_path)).collect()] == [(1, 2, 20, False)]


def test_every_hard_example_has_a_fate(spark, tmp_path):
    """More candidates than the 2,000 that were once tried, all look-alikes but the last."""
    n = 2100
    spark.createDataFrame([(i, f"x/ds/train/images/{i}.jpg", "ds", None, 640, 480, 1) for i in range(n)], "image_id bigint, image_path string, dataset_id string, split string, width int, height int, indexed_at bigint").write.parquet(f"{tmp_path}/image_index.parquet")
    spark.createDataFrame([(i, 0 if i < n - 1 else -1, 0) for i in range(n)], "image_id bigint, phash bigint, phash_mirror bigint").write.parquet(f"{tmp_path}/hashes.parquet")
    # det has the confidence 0 for these numbers, so that all boxes are missed alike
    spark.createDataFrame([(i, (-i * 31 * 53) % 100, 80, 0.5, 0.5, 0.2, 0.2) for i in range(n)], "image_id bigint, box_ord int, class_id int, xc double, yc double, w double, h double").write.parquet(f"{tmp_path}/boxes.parquet")
    got = {r.image_id: r.fate for r in QUERIES["f2_novel_hard_examples"](spark, str(tmp_path)).collect()}
    assert len(got) == n and [i for i, f in got.items() if f == "kept"] in ([0, n - 1], [n - 1, 0])


def test_detection_duplicates_have_their_members(spark, tmp_path):
    n = 3
    spark.createDataFrame([(i, f"x/ds/train/images/{i}.jpg", "ds", None, 1) for i in range(n + 1)], "image_id bigint, image_path string, dataset_id string, split string, indexed_at bigint").write.parquet(f"{tmp_path}/image_index.parquet")
    boxes = [(i, k, k, 0.1 + 0.2 * k, 0.5, 0.1, 0.1) for i in range(n) for k in range(4)] + [(n, k, k, 0.5, 0.5, 0.9, 0.9) for k in range(4)]
    spark.createDataFrame(boxes, "image_id bigint, box_ord int, class_id int, xc double, yc double, w double, h double").write.parquet(f"{tmp_path}/boxes.parquet")
    assert {tuple(r) for r in QUERIES["e9_detection_duplicates"](spark, str(tmp_path)).collect()} == {(i, 0, n) for i in range(n)}
