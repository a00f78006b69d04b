"""Near copies against history, against brute force."""

import datetime as dt
import random
import re
from collections import Counter

import pytest

from boardloom.llm import history_dedup as hd

KIND = "row_id bigint, first_seen timestamp, origin string, school_code string, title string, key string, ts string"
WORD = re.compile(r"[^\W_]+")


def bag(title):
    return Counter(WORD.findall((title or "").upper().lower()))


def brute(rows):
    out, seen = set(), []
    for r, t, o, s, title in sorted(rows, key=lambda x: (x[1] or dt.datetime(1, 1, 1), x[0])):
        b = bag(title)
        if o != "archivio" and any(s == s2 and max(sum((b - c).values()), sum((c - b).values())) <= 3 for s2, c in seen):
            out.add(r)
        seen.append((s, b))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], KIND)


def known(spark, rows):
    return {r.row_id for r in hd.known_findings(frame(spark, rows)).collect()}


def when(n):
    return None if n is None else dt.datetime(2026, 1, 1) + dt.timedelta(hours=n)


def cases(seed, n, words, length):
    rng = random.Random(seed)
    base = [[rng.choice(words) for _ in range(rng.randrange(*length))] for _ in range(12)]
    rows = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(6)):
            at = rng.randrange(len(w) + 1)
            w[at : at + rng.randrange(2)] = [rng.choice(words)] * rng.randrange(2)
        rng.shuffle(w)
        rows.append((i, when(rng.choice([*range(50), None])), rng.choice(["nuovo", "archivio", None]), rng.choice(["s", "t", None]), rng.choice([" ".join(w), " ".join(w).upper(), "", None]) if rng.random() < 0.1 else " ".join(w)))
    return rows


@pytest.mark.parametrize(("seed", "length"), [(1, (8, 20)), (2, (0, 6)), (3, (3, 9))])
def test_against_brute_force(spark, seed, length):
    rows = cases(seed, 300, [f"w{i}" for i in range(40)], length)
    assert known(spark, rows) == brute(rows)


def test_runs_longer_than_the_window(spark, monkeypatch):
    monkeypatch.setattr(hd, "WINDOW", 3)
    for seed, length in ((4, (9, 15)), (5, (2, 8))):
        rows = cases(seed, 250, [f"w{i}" for i in range(14)], length)
        assert known(spark, rows) == brute(rows)


def test_hot_copies_and_edges(spark):
    rows = [(i, when(i % 7), "nuovo", "s", "lo stesso avviso di tutti i giorni qui") for i in range(3000)]
    assert known(spark, rows) == brute(rows[:0]) | {r[0] for r in rows} - {0}
    assert known(spark, []) == set()
    long = " ".join(f"p{i}" for i in range(20_000))
    assert known(spark, [(1, when(1), "nuovo", "s", long), (2, when(2), None, "s", long + " a b c"), (3, when(3), None, "s", long + " d e f g")]) == {2}


def fed(spark, index, parts):
    found = set()
    for part in parts:
        found |= {r.row_id for r in index.accept(hd.records(frame(spark, part))).collect()}
    return found


def test_batches_give_what_the_whole_gives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(hd, "FAN", 2)
    monkeypatch.setattr(hd, "WINDOW", 4)
    rows = cases(6, 260, [f"w{i}" for i in range(18)], (1, 14))
    parts = [[r for r in rows if a <= (r[1] or when(0)) < b] for a, b in ((when(0), when(15)), (when(15), when(25)), (when(25), when(35)), (when(35), when(99)))]
    assert fed(spark, hd.HistoryIndex(spark, str(tmp_path / "index")), parts) == brute(rows)


def test_an_index_can_be_opened_again(spark, tmp_path):
    rows = [r for r in cases(7, 200, [f"w{i}" for i in range(30)], (4, 14)) if r[1] is not None]
    parts = [[r for r in rows if a <= r[1] < b] for a, b in ((when(0), when(20)), (when(20), when(35)), (when(35), when(99)))]
    folder, found = str(tmp_path / "index"), set()
    for part in parts:
        found |= fed(spark, hd.HistoryIndex(spark, folder), [part])
    index = hd.HistoryIndex(spark, folder)
    assert found == brute(rows) and [r["level"] for r in index.runs] == [0, 0, 0]
    (tmp_path / "index" / "run-000000099").mkdir()  # what a broken step leaves
    index.compact(fan=3)
    assert [r["level"] for r in index.runs] == [1] and sorted(p.name for p in (tmp_path / "index").glob("run-*")) == ["run-000000099", "run-000000100"]
    again = [(1000 + r[0], r[1] + dt.timedelta(days=40), "nuovo", *r[3:]) for r in rows]
    assert fed(spark, hd.HistoryIndex(spark, folder), [again]) == {r[0] for r in again}
    assert fed(spark, hd.HistoryIndex(spark, folder), [again[:20], []]) == {r[0] for r in again[:20]}  # delivered again as they are


def test_late_rows(spark, tmp_path):
    """Batches in any order: every row ends up known that has an earlier near copy."""
    rows = cases(8, 200, [f"w{i}" for i in range(20)], (2, 12))
    parts = [[r for r in rows if r[0] % 3 == n] for n in (2, 0, 1)]
    assert fed(spark, hd.HistoryIndex(spark, str(tmp_path / "index")), parts) == brute(rows)


def test_full_keys_of_the_last_level(spark, monkeypatch):
    monkeypatch.setattr(hd, "WINDOW", 2)
    monkeypatch.setattr(hd, "BLOCK", 4)
    # the same four words and four more in each
    rows = [(i, when(i), "nuovo", "s", "aaa bbb ccc ddd " + " ".join(f"z{(i * 7 + 3 * k * k) % 23}" for k in range(4))) for i in range(60)]
    assert known(spark, rows) == brute(rows) != set()


def test_a_batch_reads_as_much_of_a_long_history_as_of_a_short_one(spark, tmp_path):
    rng = random.Random(9)
    told = lambda first, n: [(first + i, when(first + i), "nuovo", "s", " ".join(f"w{rng.randrange(50_000)}" for _ in range(9))) for i in range(n)]
    read = []
    for n in (2_000, 16_000):
        index = hd.HistoryIndex(spark, str(tmp_path / str(n)), bits=2, group=4_096)
        fed(spark, index, [told(0, n)])
        before = index.bytes_read.value
        fed(spark, index, [told(n, 5)])
        read.append(index.bytes_read.value - before)
    assert 0 < read[1] < 1.5 * read[0]
