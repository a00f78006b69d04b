"""Source mixing."""

from pathlib import Path

import pytest

from boardloom.llm import corpus_tokens, mixture as mx


def slow_sainte_lague(weights, seats, caps):
    got = {k: 0 for k in weights}
    for _ in range(seats):
        open_keys = [k for k in weights if weights[k] > 0 and got[k] < caps.get(k, seats)]
        if not open_keys:
            break
        got[max(open_keys, key=lambda k: (weights[k] / (2 * got[k] + 1), -ord(k)))] += 1
    return got


@pytest.mark.parametrize("seats", [0, 1, 7, 100, 333])
@pytest.mark.parametrize("caps", [{}, {"a": 5}, {"a": 5, "b": 3, "c": 1}])
def test_apportionment(seats, caps):
    weights = {"a": 53, "b": 24, "c": 23, "d": 0}
    assert mx.apportion(weights, seats, caps) == slow_sainte_lague(weights, seats, caps)


def test_quotas_keep_the_caps():
    tokens = {(s, h): n for s, n in (("a", 4000), ("b", 700), ("c", 50)) for h in range(4)}
    made = mx.plan(tokens, {"a": (0.5, 1), "b": (0.3, 2), "c": (0.2, 4), "none": (0.1, 1)}, 4)
    used = {s: sum(q for (x, _), q in made.quota.items() if x == s) * made.block for s in "abc"}
    total = sum(used.values())
    assert all(made.quota[s, h] * made.block <= tokens[s, h] * reps for s, reps in (("a", 1), ("b", 2), ("c", 4)) for h in range(4) if (s, h) in made.quota)
    assert abs(used["a"] / total - 0.5) < 0.01 and abs(used["c"] / total - 0.2) < 0.01


@pytest.mark.skipif(not Path(corpus_tokens.VOCABULARIES, "byte_bpe_50k.tiktoken").exists(), reason="no vocabulary")
def test_mix(spark, monkeypatch):
    monkeypatch.setattr(mx, "SHARD_TOKENS", 4000)
    rows = [(i, f"parola numero {i} " * (1 + i % 9), "abc"[i % 3 if i % 10 else 0], "clash", 1) for i in range(900)] + [(1000, None, "a", "k", 1), (1001, "", "a", "k", 1), (1002, "altro", None, "k", 1), (1003, "altro", "z", "k", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, k string, uses int")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 3), ("empty", 0.1, 1), (None, 0.1, 1)], "source string, target_share double, max_repeats bigint")
    used = mx.mix(docs, targets).collect()
    assert len({r.doc_id for r in used}) == len(used) and all(r.uses <= {"a": 1, "b": 2, "c": 3}[r.source] for r in used)
    report = {r.source: r for r in mx.mix_report(docs, targets).collect()}
    assert report["empty"].tokens == 0
    for s, share in (("a", 0.5), ("b", 0.3), ("c", 0.2)):
        assert abs(report[s].share - share) < 0.02
    assert sorted(map(tuple, used)) == sorted(map(tuple, mx.mix(docs, targets).collect()))
    assert mx.mix(docs.limit(0), targets).count() == 0 and mx.mix(docs, targets.limit(0)).count() == 0
