"""The queries of the problems on the smallest tables: against SQL where there is one, else what must hold of them."""

from __future__ import annotations

import collections

import pytest
from pyspark.sql import functions as F

from frameloom.llm import queries as Q
from tests.same import assert_same


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_same_as_sql(spark, small, duck, name):
    assert_same(Q.queries()[name](spark, small), duck, Q.oracle_sql()[name])


def test_sample_matches_report(spark, small):
    sample = Q.p2_sample(spark, small).collect()
    report = Q.p2_report(spark, small).collect()
    assert collections.Counter(r.class_id for r in sample) == {r.category: r.drawn for r in report if r.drawn}
    assert len({(r.image_id, r.box_ord) for r in sample}) == len(sample) == round(0.1 * sum(r.available for r in report if r.share > 0))


def test_subset_has_every_dataset(spark, small):
    got = Q.p3_subset(spark, small).collect()
    assert len({r.image_id for r in got}) == len(got)


def test_mixture_matches_report(spark, small):
    uses, report = Q.p5_mixture(spark, small).collect(), Q.p5_report(spark, small).collect()
    n = collections.Counter()
    for r in uses:
        n[r.source_kind, r.source_id] += r.repeats
    assert n == {(r.source_kind, r.source_id): r.used for r in report if r.used}
    assert all(r.max_repeats is None or r.used <= r.available * r.max_repeats for r in report)
    assert abs(sum(r.target_share for r in report) - 1) < 1e-9


def test_splits_keep_groups_and_shares(spark, small):
    got = Q.p7_splits(spark, small).collect()
    side = collections.defaultdict(set)
    for r in got:
        side[r.group_id].add(r.new_split)
    assert all(len(s) == 1 for s in side.values())
    n = collections.Counter(r.new_split for r in got)
    assert all(abs(n[k] - v * len(got)) <= 1 for k, v in Q.SHARES.items())


def test_containers(spark, small):
    got = Q.p9_containers(spark, small).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r.container].append(r)
    for rows in by.values():
        at = 0
        for r in sorted((r for r in rows if r["size"]), key=lambda r: r.ordinal):
            assert r.start == at
            at += r["size"]
        assert at <= Q.CAPACITY
    report = Q.p9_report(spark, small).first()
    assert report.containers - report.lower_bound <= 1
    ids = {r.doc_id: len(r.ids) for r in Q.p8_ids(spark, small).collect()}
    size = collections.Counter()
    for r in got:
        size[r.doc_id] += r["size"]
    assert dict(size) == ids
    pieces = collections.Counter(r.doc_id for r in got)
    assert all(n == max(1, -(-ids[d] // Q.CAPACITY)) for d, n in pieces.items())


@pytest.mark.parametrize("name", sorted(set(Q.queries()) - set(Q.oracle_sql())))
def test_runs(spark, small, name):
    assert Q.queries()[name](spark, small).select(F.count(F.lit(1)).alias("n")).first().n > 0


def test_entry_holds_them():
    import __spark_entry__ as e

    assert set(Q.queries()) <= set(e.queries())
