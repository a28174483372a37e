import hashlib
import random
import re

import pytest
from odd_rows import docs, none  # noqa: F401
from pyspark.sql import functions as F

from quillbook.llm import mixing
from quillbook.llm.queries import SCHEDULES

PLAIN = [mixing.Schedule(((0, w), (1, w))) for w in (5, 2, 1)]


def targets(sizes, weights=(5, 2, 1), passes=3):
    """Targets by sharing again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(passes * sizes[s] for s in full)
        level = {s: rest * weight[s] / sum(weight[o] for o in names if o not in full) for s in names if s not in full}
        over = {s for s, t in level.items() if t > passes * sizes[s]}
        if not over:
            return {s: level.get(s, passes * sizes[s]) for s in names}
        full |= over


def brute(rows, passes=3):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sums = {}
    for _, t, s in rows:
        sums[s] = sums.get(s, 0) + size(t)
    aims, out = targets(sums), []
    for s in sums:
        own = [(hashlib.md5(f"{'' if i is None else i}:{t or ''}".encode()).hexdigest(), i, size(t)) for i, t, o in rows if o == s]
        at, take = 0, int(aims[s] + 1e-9)
        for _, i, n in sorted(own, key=str):
            got = [max(min(take - (p * sums[s] + at), n), 0) for p in range(passes)]
            out.append((str(i), n, sums[s], round(aims[s], 6), sum(got)))
            at += n
    return sorted(out)


def found(frame, schedules=PLAIN):
    rows = mixing.mixed(frame, schedules).collect()
    return sorted((str(r["doc_id"]), r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in rows), rows


def corpus(spark, sizes, seed=1):
    rng = random.Random(seed)
    rows, i = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            rows.append((i, " ".join(["w"] * rng.randint(0, 30)), s))
            i += 1
    rows += [rows[0]] * 5 + [(None, "without id", "a")] * 7 + [(None, None, None)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)


@pytest.mark.parametrize("sizes", [{"a": 300, "b": 200, None: 50}, {"a": 5, "b": 500, "c": 3, "d": 2}, {"a": 40}, {"é": 20, "z": 30, "Z": 10, "": 300}])
def test_against_loops(spark, sizes):
    rows, frame = corpus(spark, sizes)
    got, full = found(frame)
    assert got == brute(rows)
    taken = {}
    for r in full:
        assert r["taken"] <= 3 * r["size"] and sum(p["words"] for p in r["places"]) == r["taken"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        assert [p["position"] for p in r["places"]] == sorted(p["position"] for p in r["places"])
    for r in full:
        assert abs(taken[r["source"]] - r["target"]) < 1 + 1e-6


def test_odd_rows(docs, none):  # noqa: F811
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    assert found(docs)[0] == brute(rows)
    empty = mixing.mixed(none, PLAIN)
    assert empty.count() == 0 and mixing.curriculum(empty).count() == 0
    assert found(docs.withColumn("text", F.lit(" ")))[0] == sorted((str(i), 0, 0, 0.0, 0) for i, _, _ in rows)


def test_weights_change_along_the_way(spark):
    """In every tenth of the training each source has the share that its schedule has there."""
    rows = [(i, "w " * 20, "abc"[i % 3]) for i in range(30_000)]
    result = mixing.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string"), SCHEDULES)
    read = mixing.curriculum(result).collect()
    at = [r["position"] for r in read]
    assert at == sorted(at) and 0 <= at[0] and at[-1] <= 1
    total = sum(r["words"] for r in read)
    for tenth in range(10):
        part = [r for r in read if tenth / 10 <= r["position"] < (tenth + 1) / 10]
        middle = (tenth + 0.5) / 10
        wanted = {"a": 7.5 - 5 * middle, "b": 2.0, "c": 0.5 + middle}
        for s, w in wanted.items():
            assert abs(sum(r["words"] for r in part if r["source"] == s) / (total / 10) - w / 8) < 0.02, (tenth, s)


def test_runs_agree_whatever_the_partitions(spark):
    rows, frame = corpus(spark, {"a": 200, "b": 100, "c": 20})
    one, two = (mixing.curriculum(mixing.mixed(frame.repartition(k), SCHEDULES)).collect() for k in (1, 7))
    assert one == two
    order = [r["position"] for r in mixing.in_order(mixing.mixed(frame, SCHEDULES)).collect()]
    read = [p for p in order if p is not None]
    assert read == sorted(read) and order == read + [None] * (len(order) - len(read))


def test_only_built_in_functions(spark):
    _, frame = corpus(spark, {"a": 20})
    plan = mixing.in_order(mixing.mixed(frame, SCHEDULES))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_wrong_schedules():
    for points in (((0, 1),), ((0, 1), (0.5, 1)), ((0, 1), (0, 2), (1, 1)), ((0, 0), (1, 0)), ((0, -1), (1, 2))):
        with pytest.raises(ValueError):
            mixing.Schedule(points)
