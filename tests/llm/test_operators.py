"""Operators of the problems against plain restatements on small data: nulls, ties, repeats, empty tables, clashing names."""

from __future__ import annotations

import collections
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from frameloom.llm import events as Ev
from frameloom.llm import mixing as Mix
from frameloom.llm import overlaps as O
from frameloom.llm import packing as P
from frameloom.llm import proportions as Pr
from frameloom.llm import repetition as Rep
from frameloom.llm import splits as Sp
from frameloom.llm import tokens as Tok
from frameloom.llm import variety as Var
from frameloom.llm.groups import hash_to_min
from frameloom.plans.scratch import Scratch


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


# 1


def runs(rows, least):
    out = set()
    by = collections.defaultdict(list)
    for e, at, i, h in rows:
        if e is not None and at is not None and i is not None:
            by[e].append((at, i, h))
    for seq in by.values():
        seq.sort(key=lambda x: x[:2])
        run = []
        for x in seq:
            if run and x[2] is not None and run[-1][2] is not None and bits(x[2], run[-1][2]) < 10 and x[0] - run[-1][0] <= 60:
                run.append(x)
            else:
                if len(run) >= least:
                    out.add((run[0][1], len(run), run[0][0], run[-1][0]))
                run = [x]
        if len(run) >= least:
            out.add((run[0][1], len(run), run[0][0], run[-1][0]))
    return out


@pytest.mark.parametrize(("seed", "least"), [(0, 1), (1, 2), (2, 2)])
def test_runs(spark, seed, least):
    rng = random.Random(seed)
    rows, h = [], 0
    for i in range(3000):
        if rng.random() < 0.2:
            h = rng.getrandbits(64)
        e = None if rng.random() < 0.01 else "hot" if rng.random() < 0.4 else rng.choice("abc")
        rows.append((e, None if rng.random() < 0.01 else rng.randrange(900) if e == "hot" else rng.randrange(20000), i, None if rng.random() < 0.03 else signed(h ^ (1 << rng.randrange(64)))))
    df = spark.createDataFrame(rows, "e string, at bigint, id bigint, hash bigint").withColumn("n", F.lit("clash")).withColumn("start_id", F.lit(None)).repartition(7)
    got = {(r.start_id, r.n, r.start_at, r.end_at) for r in Ev.collapse_runs(df, Scratch(spark, "t"), ["e"], "at", "id", "hash", least=least).collect()}
    assert got == runs(rows, least)


def test_run_over_many_partitions(spark):
    rows = [("a", i, i, 5) for i in range(5000)] + [("b", 0, 9999, 5)]
    df = spark.createDataFrame(rows, "e string, at bigint, id bigint, hash bigint").repartition(6)
    got = {(r.start_id, r.n) for r in Ev.collapse_runs(df, Scratch(spark, "t"), ["e"], "at", "id", "hash").collect()}
    assert got == {(0, 5000), (9999, 1)}


def test_runs_of_nothing(spark):
    df = spark.createDataFrame([], "e string, at bigint, id bigint, hash bigint")
    assert Ev.collapse_runs(df, Scratch(spark, "t"), ["e"], "at", "id", "hash").count() == 0


def test_agglomeration_takes_the_most_similar_first():
    heads, tails, sizes = Ev._agglomerate(np.array([True, False, True, True]), np.array([3, 0, 5, 1], np.uint8), np.array([1, 1, 2, 1, 1]))
    assert (heads, tails, sizes) == ([0, 2], [1, 4], [2, 4])


# 4 and 7


@pytest.mark.parametrize("seed", range(3))
def test_groups(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)] + [(None, 1), (2, None), (None, None), (3, 3), (500, 501), (501, 500), (500, 501)]
    chain = list(range(1000, 1120))
    rng.shuffle(chain)
    links += list(zip(chain, chain[1:])) + [(2000, i) for i in range(2001, 2100)]
    df = spark.createDataFrame(links, "a bigint, b bigint").withColumn("v", F.lit(1)).withColumn("m", F.lit(2))
    want = components(links)
    assert {r.id: r.group_id for r in hash_to_min(df, Scratch(spark, "t")).collect()} == want
    assert {r.v: r.p for r in Sp.hook_and_shortcut(df, Scratch(spark, "t")).collect()} == want


def test_groups_of_nothing(spark):
    df = spark.createDataFrame([], "a bigint, b bigint")
    assert hash_to_min(df, Scratch(spark, "t")).count() == 0
    assert Sp.hook_and_shortcut(df, Scratch(spark, "t")).count() == 0


def test_related_records(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["d", "e", "f"]), rng.choice([None, "x", "y", "z"]), f"b{rng.randrange(150)}" if rng.random() > 0.1 else None, rng.choice(["train", "test", None])) for i in range(200)]
    df = spark.createDataFrame(rows, "id bigint, dataset string, clip string, base string, split string").withColumn("group_id", F.lit("clash"))
    got = {r.id: r.group_id for r in Sp.components(df, Scratch(spark, "t"), ["dataset", "clip"], ["base"]).collect()}
    links = [(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and ((a[2] is not None and a[1:3] == b[1:3]) or (a[3] is not None and a[3] == b[3]))]
    want = {r[0]: r[0] for r in rows} | components(links)
    assert got == want


def test_split_totals():
    sizes = {1: 5, 7: 3, 40: 1, 13: 2}
    got = Sp.choose_totals(sizes, {"train": 0.8, "valid": 0.1, "test": 0.1})
    assert {s: sum(g[s] for g in got.values()) for s in sizes} == sizes
    total = sum(s * n for s, n in sizes.items())
    assert sum(s * n for s, n in got["valid"].items()) == round(total * 0.1)
    assert Sp.choose_totals({}, {"train": 0.9, "test": 0.1}) == {"train": {}, "test": {}}
    one = Sp.choose_totals({100: 1}, {"train": 0.9, "test": 0.1})
    assert one["train"] == {100: 1}


def test_split_totals_of_many_sizes():
    sizes = {s: 1 + s % 3 for s in range(1, 120)}
    got = Sp.choose_totals(sizes, {"train": 0.7, "valid": 0.2, "test": 0.1})
    total = sum(s * n for s, n in sizes.items())
    assert {s: sum(g[s] for g in got.values()) for s in sizes} == sizes
    assert all(n >= 0 for g in got.values() for n in g.values())
    assert max(abs(sum(s * n for s, n in got[k].items()) - share * total) for k, share in (("valid", 0.2), ("test", 0.1))) <= 1


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 3), max_size=6), st.integers(0, 40))
def test_closest_sum(sizes, target):
    groups = sorted(sizes.items())
    sums = {sum(s * k for (s, _), k in zip(groups, ks)) for ks in itertools.product(*(range(n + 1) for _, n in groups))}
    got = sum(s * k for (s, _), k in zip(groups, Sp._closest(groups, target)))
    assert got in sums and abs(got - target) == min(abs(x - target) for x in sums)


def test_assign_splits_of_ties_and_nothing(spark):
    df = spark.createDataFrame([(i, i // 2) for i in range(100)], "id bigint, group_id bigint").withColumn("new_split", F.lit("clash"))
    got = Sp.assign_splits(df, Scratch(spark, "t"), {"train": 0.8, "valid": 0.1, "test": 0.1}).collect()
    assert collections.Counter(r.new_split for r in got) == {"train": 80, "valid": 10, "test": 10}
    assert Sp.assign_splits(df.limit(0), Scratch(spark, "t"), {"train": 0.9, "test": 0.1}).count() == 0


# 6


@pytest.mark.parametrize("hot", [500_000, 3])
def test_overlaps(spark, hot, monkeypatch):
    near = O.near_values
    monkeypatch.setattr(O, "near_values", lambda v, threshold: near(v, threshold, hot=hot))
    rng = random.Random(hot)
    base = [rng.getrandbits(64) for _ in range(25)]

    def h():
        if rng.random() < 0.05:
            return None
        x = rng.choice(base)
        for _ in range(rng.randrange(7)):
            x ^= 1 << rng.randrange(64)
        return signed(x)

    mark = lambda: None if rng.random() < 0.5 else f"{rng.randrange(60):032x}"
    rows = [(i, rng.choice(["train", "train", "valid", "test", None]), h(), h(), mark()) for i in range(260)] + [(None, "train", 1, 1, None)]
    df = spark.createDataFrame(rows, "id bigint, split string, phash bigint, phash_mirror bigint, mark string").withColumns({c: F.lit("clash") for c in ("t", "kind", "h", "train")})
    got = {(r.id_train, r.id_eval): (r.distance, r.same_mark) for r in O.cross_split_overlaps(df, Scratch(spark, "t")).collect()}
    want = {}
    for a in rows:
        for b in rows:
            if a[1] == "train" and b[1] in ("valid", "test") and a[0] is not None:
                d = [bits(x, y) for x, y in ((a[2], b[2]), (a[2], b[3]), (a[3], b[2])) if x is not None and y is not None]
                d = min((x for x in d if x <= 4), default=None)
                m = a[4] is not None and a[4] == b[4]
                if d is not None or m:
                    want[a[0], b[0]] = (d, m)
    assert got == want
    counts = {(r.split, r.o): r[2:] for r in O.overlap_counts(df.withColumn("o", F.col("id") % 3), Scratch(spark, "t"), ["o"]).collect()}
    wanted = {}
    for b in rows:
        if b[1] in ("valid", "test"):
            of = [v for (_, e), v in want.items() if e == b[0]]
            n = wanted.setdefault((b[1], b[0] % 3), [0] * 5)
            for k, x in enumerate((1, bool(of), len(of), sum(d is not None for d, _ in of), sum(m for _, m in of))):
                n[k] += x
    assert counts == {k: tuple(v) for k, v in wanted.items()}


def test_overlaps_of_nothing(spark):
    df = spark.createDataFrame([], "id bigint, split string, phash bigint, phash_mirror bigint, mark string")
    assert O.cross_split_overlaps(df, Scratch(spark, "t")).count() == 0


# 2 and 5


def test_fill():
    assert Mix.fill(100, [0.5, 0.5], [10, None]) == [10, 90]
    assert Mix.fill(100, [0.5, 0.5], [10, 20]) == [10, 20]
    assert Mix.fill(10, [1, 1, 1], [None] * 3) == [4, 3, 3]
    assert Mix.fill(10, [0, 0], [5, 5]) == [0, 0]
    assert Mix.fill(10, [], []) == []


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 500), st.lists(st.tuples(st.floats(0, 1), st.one_of(st.none(), st.integers(0, 100))), max_size=6))
def test_fill_keeps_total_and_caps(total, sources):
    weights, caps = [w for w, _ in sources], [c for _, c in sources]
    got = Mix.fill(total, weights, caps)
    room = sum(10**9 if c is None else c for w, c in sources if w > 0)
    assert all(g >= 0 and (c is None or g <= c) for g, c in zip(got, caps))
    assert abs(sum(got) - min(total, room)) <= 0


def test_mixture(spark):
    records = spark.createDataFrame([("k", "big", i) for i in range(1000)] + [("k", "small", i) for i in range(10)] + [("k", None, 5), (None, "big", 6), ("k", "unlisted", 7)], "source_kind string, source_id string, record_id bigint").withColumn("repeats", F.lit("clash"))
    targets = spark.createDataFrame([("k", "big", 0.5, None), ("k", "small", 0.5, 3), ("k", "none", 0.5, 1), ("k", "null", None, 1)], "source_kind string, source_id string, target_share double, max_repeats int")
    uses, report = Mix.mixture(records, targets, Scratch(spark, "t"), total=1530)
    n = collections.Counter()
    for r in uses.collect():
        n[r.source_id] += r.repeats
        assert r.repeats in ((3,) if r.source_id == "small" else (1, 2))
    assert n == {"big": 1500, "small": 30}
    assert {r.source_id: r.used for r in report.collect()} == {"big": 1500, "small": 30, "none": 0, "null": 0}
    assert Mix.mixture(records.limit(0), targets, Scratch(spark, "t"))[0].count() == 0
    assert Mix.mixture(records, targets.limit(0), Scratch(spark, "t"))[0].count() == 0


def test_proportional_sample(spark):
    rows = [(c, i) for c, n in ((1, 5000), (2, 500), (3, 40), (4, 3), (9, 100)) for i in range(n)] + [(None, 1), (1, 7), (1, 7)]
    df = spark.createDataFrame(rows, "class_id int, image_id bigint").withColumn("share", F.lit("clash"))
    targets = spark.createDataFrame([(1, 60.0, "a"), (2, 30.0, "b"), (3, 1.0, None), (4, 9.0, "d"), (5, 0.0, "e"), (6, None, "f")], "category int, share double, name string")
    sample, report = Pr.proportional_sample(df, targets, Scratch(spark, "t"), "class_id", ["image_id"], size=400, floor=20)
    n = collections.Counter(r.class_id for r in sample.collect())
    said = {r.category: r for r in report.collect()}
    assert n == {c: r.drawn for c, r in said.items() if r.drawn} and sum(n.values()) == 400
    assert n[3] == 20 and n[4] == 3 and said[4].lacking == pytest.approx(33) and said[4].below_floor == 17
    assert 1.6 < n[1] / n[2] < 2.4
    assert Pr.proportional_sample(df.limit(0), targets, Scratch(spark, "t"), "class_id", ["image_id"])[0].count() == 0


def test_floors_beyond_the_sample():
    plan = Pr.plan_sample(30, [100, 100, 4], [90.0, 9.0, 1.0], 50, 0.3)
    assert [f for _, _, f in plan] == [13, 13, 4]
    assert sum(f for _, _, f in Pr.plan_sample(2, [5, 5, 5], [1.0, 1.0, 1.0], 9, 0.9)) == 2


# 3


def test_pivots_take_independent_rows_first():
    h = np.array([0, 0, 1, 2**64 - 1, 0xFFFFFFFF, 0xFFFFFFFE], np.uint64)
    taken, new = Var.pivots(h, np.ones(6, bool), np.arange(6, dtype=np.int64), np.zeros(6), 3)
    assert len(set(taken)) == 3 and sum(i in (4, 5) for i in taken) == 1
    taken, _ = Var.pivots(h, np.ones(6, bool), np.arange(6, dtype=np.int64), np.zeros(6), 10)
    assert sorted(taken) == list(range(6))


def test_varied_subset_has_look_alikes_of_datasets_and_clips_once(spark):
    """A set of look-alikes that fills several datasets and many clips is shown once while others are there."""
    rng = random.Random(5)
    rows = []
    for d in range(4):
        for i in range(200):
            look = signed(2**40 + (1 << rng.randrange(2)) * (i % 2)) if i % 2 else signed(rng.getrandbits(64))
            rows.append((d * 1000 + i, f"d{d}", f"c{rng.randrange(60)}", look, 0.0, None, 3))
    df = spark.createDataFrame(rows, "id bigint, dataset string, clip string, hash bigint, shape double, least_boxes int, boxes bigint")
    got = Var.varied_subset(df, Scratch(spark, "t"), k=100, per_cell=8, block=64).collect()
    look = {r[0]: r[3] for r in rows}
    ids = [r.id for r in got]
    assert len(set(ids)) == 100 and {r.dataset for r in got} == {f"d{d}" for d in range(4)}
    assert not [(a, b) for a in ids for b in ids if a < b and bits(look[a], look[b]) <= 4]


def test_look_alikes_of_long_groups_are_apart():
    rng = np.random.default_rng(1)
    base = rng.integers(-2**62, 2**62, 300)
    h = np.concatenate([base, base ^ 1, base, base ^ (1 << 50)])
    import pyarrow as pa

    batches = [pa.record_batch({"id": pa.array(np.arange(i, min(i + 100, len(h)))), "hash": pa.array(h[i : i + 100]), "w": pa.array(np.zeros(min(100, len(h) - i), np.int64))}) for i in range(0, len(h), 100)]
    got = [x for b in Var._apart(iter(batches), chunk=64) for x in b.column("id").to_pylist()]
    assert got == list(range(300))


def test_varied_subset(spark):
    rng = random.Random(4)
    rows = [(i, "hot" if i < 3000 else rng.choice("abc"), f"c{i % 40}" if rng.random() < 0.7 else None, signed(rng.choice([5, 5, rng.getrandbits(64)])) if rng.random() > 0.1 else None, rng.random(), 2 if i % 2 else None, i % 4) for i in range(3400)]
    rows += [(3400, "few", None, 9, 0.0, 3, 1), (None, "a", None, 1, 0.0, None, 0), (3401, None, None, 1, 0.0, None, 0)]
    df = spark.createDataFrame(rows, "id bigint, dataset string, clip string, hash bigint, shape double, least_boxes int, boxes bigint").withColumn("cell", F.lit("clash"))
    got = Var.varied_subset(df, Scratch(spark, "t"), k=120, block=256).collect()
    assert len(got) == 120 == len({r.id for r in got})
    able = {r[0] for r in rows if r[0] is not None and r[1] is not None and (r[5] is None or (r[6] or 0) >= r[5])}
    assert {r.id for r in got} <= able
    n = collections.Counter(r.dataset for r in got)
    assert set(n) == {"hot", "a", "b", "c"} and n["hot"] < 120 * 0.8
    hash_of = {r[0]: r[3] for r in rows}
    assert sum(hash_of[r.id] == 5 for r in got) <= 8
    assert Var.varied_subset(df.limit(0), Scratch(spark, "t")).count() == 0


# 8


@pytest.fixture(scope="module")
def encoder():
    return Tok.piece_encoder(f"{Tok.TOKENIZER_DIR}/{Tok.VOCABULARY}")


PARTS = [" ", "  ", "\n", "\t", "'", "s", "t", "re", "a", "qx", "É", "ß", "1", "23", "!", "?", "-", " ", " ", "　", "日本", "🙂", "\x1c", "\x85", "<|endoftext|>", "'ll", ".\n", "\r\n", "́", "ſ", "​", "zzzzqjq"]


@settings(max_examples=500, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), st.text(max_size=30), st.lists(st.sampled_from(PARTS), max_size=40).map("".join)), max_size=5))
def test_pieces_encode_as_the_whole(encoder, texts):
    texts = [None if t is None else t.encode("utf-8", "ignore").decode() for t in texts]
    ids, ends = encoder.encode_all(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert ids[ends[i] : ends[i + 1]].tolist() == (encoder.whole.encode_ordinary(t) if t else [])


def test_long_text_is_cut(encoder):
    text = "qx" * 50_000 + " word" * 50_000 + "\n" * 5000
    ids, ends = encoder.encode_all(pa.array([text]))
    assert ids.tolist() == encoder.whole.encode_ordinary(text)


def test_token_ids(spark, encoder):
    rows = [(1, "some text"), (1, "some text"), (None, "x"), (3, None), (4, ""), (5, "  "), (6, "é" * 30000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("ids", F.lit("clash"))
    got = sorted(((r.doc_id, list(r.ids)) for r in Tok.token_ids(df).collect()), key=repr)
    assert got == sorted(((i, encoder.whole.encode_ordinary(t) if t else []) for i, t in rows), key=repr)
    counts = sorted(((r.doc_id, r.n_tokens) for r in Tok.token_counts(df).collect()), key=repr)
    assert counts == sorted(((i, len(x)) for i, x in got), key=repr)
    assert Tok.token_ids(df.limit(0)).count() == 0


# 9


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=7))
def test_lower_bound_is_one(sizes):
    def best(left):
        if not left:
            return 0
        n = len(left)
        first, out = left[0], n
        rest = left[1:]
        for mask in range(1 << len(rest)):
            chosen = [rest[i] for i in range(len(rest)) if mask >> i & 1]
            if first + sum(chosen) <= 20:
                out = min(out, 1 + best([rest[i] for i in range(len(rest)) if not mask >> i & 1]))
        return out

    s = np.array(sizes)
    v, c = np.unique(s, return_counts=True)
    bins, start, ordinal, free = P.best_fit_decreasing(s, 20)
    assert P.lower_bound(v, c, 20) <= best(sorted(sizes, reverse=True)) <= len(free)
    for b in range(len(free)):
        of = sorted((ordinal[i], start[i], s[i]) for i in range(len(s)) if bins[i] == b)
        at = 0
        for k, (o, st_, z) in enumerate(of):
            assert (o, st_) == (k, at)
            at += z
        assert at == 20 - free[b]


def test_pack(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([0, 1, 3, rng.randrange(100), rng.randrange(400)])) for i in range(3000)] + [(5000, None), (None, 4), (5001, 100), (5002, 1000)]
    df = spark.createDataFrame(rows, "id bigint, size bigint").withColumn("container", F.lit("clash"))
    got = P.pack(df, Scratch(spark, "t"), 100, per_bucket=400).collect()
    whole = collections.Counter()
    bins = collections.defaultdict(list)
    for r in got:
        whole[r.id] += r["size"]
        assert r.begin == r.piece * 100
        if r["size"]:
            bins[r.container].append((r.ordinal, r.start, r["size"]))
    assert whole == collections.Counter({i: s or 0 for i, s in rows if i is not None}) and set(whole) == {i for i, _ in rows if i is not None}
    assert sorted(bins) == list(range(len(bins)))
    for of in bins.values():
        at = 0
        for k, (o, s, z) in enumerate(sorted(of)):
            assert (o, s) == (k, at)
            at += z
        assert at <= 100
    report = P.packing_report(P.pack(df, Scratch(spark, "t"), 100, per_bucket=400), 100).first()
    assert report.containers == len(bins) and report.containers <= report.lower_bound * 1.02 + 1
    assert P.pack(df.limit(0), Scratch(spark, "t"), 100).count() == 0
    empty = P.pack(spark.createDataFrame([(1, 0)], "id bigint, size bigint"), Scratch(spark, "t"), 100).first()
    assert (empty.container, empty["size"]) == (0, 0)


# 10


def repeated(words, span):
    hit, seen = set(), set()
    for p in range(len(words) - span + 1):
        g = tuple(words[p : p + span])
        if g in seen:
            hit |= set(range(p, p + span))
        seen.add(g)
    return len(hit)


def longest(words, span):
    best = 0
    for i in range(len(words)):
        for j in range(i + 1, len(words)):
            k = 0
            while j + k < len(words) and words[i + k] == words[j + k]:
                k += 1
            best = max(best, k)
    return best if best >= span else 0


@settings(max_examples=120, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=40), max_size=5), st.integers(1, 6))
def test_repeated_words(docs, span):
    n, r, most = Rep.repeated_words(docs, span)
    assert n.tolist() == [len(d) for d in docs]
    assert r.tolist() == [repeated(d, span) for d in docs]
    assert most.tolist() == [longest(d, span) if len(d) > span else 0 for d in docs]


def test_repetition(spark):
    phrase = "one two three four five six "
    rows = [(1, phrase * 20), (2, None), (3, ""), (4, " \n"), (5, phrase), (6, "Ünï ünÏ " * 10), (6, "x_y " * 4000), (None, phrase * 2), (7, "a " * 60000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("share", F.lit("clash"))
    got = sorted(((r.doc_id, r.n_words, r.n_repeated) for r in Rep.repetition(df).collect()), key=repr)
    want = sorted(((i, len(Rep.words(t)), repeated(Rep.words(t), 6)) for i, t in rows), key=repr)
    assert got == want
    assert {r.doc_id for r in Rep.mostly_repeated(df).collect()} == {1, 6, 7, None}
    assert Rep.repetition(df.limit(0)).count() == 0
