"""Near-dedup against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from tailmap.llm import minhash
from tailmap.llm.components import connected_components
from tailmap.llm.minhash import dedup_near, near_groups


def brute(rows, percent=85, k=5):
    import re

    sets = {}
    for i, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", low) if x]
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def corpus(seed=4):
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(400)]
    passage = [rng.choice(words) for _ in range(30)]
    rows = []
    for i in range(60):
        base = [rng.choice(words) for _ in range(rng.choice([3, 40, 150]))] + passage * rng.randint(0, 1)
        rows.append(" ".join(base))
        for _ in range(rng.choice([0, 0, 2, 6])):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append(" ".join(copy).upper() if rng.random() < 0.3 else "\t".join(copy))
    rows += ["", None, " \n", "one", "ONE", "one two"] + rows[:3]
    return list(enumerate(rows, 10))


@pytest.mark.parametrize("seed", [4, 5])
def test_groups_are_those_of_all_pairs(spark, seed):
    rows = corpus(seed)
    got = near_groups(spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("node", F.lit(1)))
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got.collect()} == brute(rows)


def test_a_group_that_never_meets_its_representatives(spark):
    # Variants of one text, each too far from most others: every star round leaves buckets open.
    rng = random.Random(1)
    base = ["b%d" % i for i in range(120)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(120)] = "x%d" % rng.randrange(10_000)
        rows.append((i, " ".join(w)))
    got = near_groups(spark.createDataFrame(rows, "doc_id bigint, text string"), star_rounds=1)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got.collect()} == brute(rows)


def test_open_buckets_whose_representatives_are_done(spark, monkeypatch):
    # 3 and 4 are linked; all their buckets are represented by 1 or 2, which link with nobody and were compared before.
    def smallest(here, turn):
        found = here.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min(F.struct("node", "component")).alias("r"))
        return found.where("lo < hi").select("bucket", F.col("r.node").alias("rep"), F.col("r.component").alias("rep_component"))

    monkeypatch.setattr(minhash, "_centres", smallest)
    base = ["b%d" % i for i in range(85)]
    own = lambda c: ["%s%d" % (c, i) for i in range(8)]
    rows = [(1, " ".join(base[:70])), (2, " ".join(base[15:])), (3, " ".join(base + own("x"))), (4, " ".join(base + own("y")))]
    got = near_groups(spark.createDataFrame(rows, "doc_id bigint, text string"), percent=80, shingle=1, band_rows=1, star_rounds=1)
    assert {r.doc_id: r.component_id for r in got.collect()} == {1: 1, 2: 2, 3: 3, 4: 3}


def test_nulls_repeats_and_empty(spark):
    schema = "doc_id bigint, text string, bucket string"
    rows = spark.createDataFrame([(None, "a b c d e f", "x"), (1, None, None), (1, "a b c d e f", "y"), (1, "q r s", "y"), (2, "Q r S", None)], schema)
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id, r.kept) for r in near_groups(rows).collect())
    assert got == [("1", 0, 1, True), ("1", 1, 1, True), ("1", 2, 1, True), ("2", 1, 1, False), ("None", 2, None, True)]
    assert near_groups(spark.createDataFrame([], schema)).count() == 0
    kept = dedup_near(rows)
    assert kept.columns == ["doc_id", "text", "bucket"] and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "1", "None"]


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (5, 5), (None, 4)] + [(i, i + 1) for i in range(100, 160)], "u bigint, v bigint")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8} | {i: 100 for i in range(100, 161)}
    assert connected_components(edges.limit(0)).count() == 0
