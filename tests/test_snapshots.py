"""Snapshots kept in sorted ranges and merged two at a time."""

import random

from pyspark.sql import functions as F

from boardloom.operators import snapshot_diff as sd

KIND = "snapshot string, rec_key string, a bigint, b string"


def test_kept_one_by_one(spark, tmp_path):
    rng = random.Random(2)
    state, told = {}, []
    kept = sd.Snapshots(spark, str(tmp_path / "kept"), ["a", "b"], bits=1, group=1_000)
    dates = ["2026-01-01", "2026-01-08", "2026-01-15"]
    for day in dates:
        before = dict(state)
        for _ in range(900):
            key = rng.choice([f"k{rng.randrange(1500)}", "\u0000"])
            if rng.random() < 0.3:
                state.pop(key, None)
            else:
                state[key] = (rng.choice([None, 1, 2]), rng.choice([None, "", "x"]))
        kept.add(spark.createDataFrame([(day, k, *v) for k, v in state.items()], KIND))
        if day != dates[0]:
            told += [(day, k, "removed") for k in before.keys() - state.keys()] + [(day, k, "added") for k in state.keys() - before.keys()]
            told += [(day, k, "changed") for k in state.keys() & before.keys() if state[k] != before[k]]
    want = sorted((d, k if k != "\u0000" else None, c) for d, k, c in told if k != "\u0000") + [(d, None, c) for d, k, c in told if k == "\u0000"]
    got = sorted(map(tuple, kept.changes(dates).collect()), key=lambda r: (r[1] is None, r))
    assert got == sorted(want, key=lambda r: (r[1] is None, r))
    assert kept.changes(dates[:1]).count() == kept.changes([]).count() == 0
    assert kept.changes(dates).rdd.getNumPartitions() == 4


def test_old_snapshots_are_not_shuffled_again(spark, tmp_path):
    kept = sd.Snapshots(spark, str(tmp_path / "kept"), ["a"], bits=1)
    rows = spark.range(100).select(F.explode(F.array(F.lit("1"), F.lit("2"))).alias("snapshot"), F.col("id").cast("string").alias("rec_key"), F.col("id").alias("a"))
    kept.add(rows)
    plan = kept.changes(["1", "2"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
