import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F

from quillbook.llm import vectorcodes


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Codes by loops over whole numbers."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = -(-max((len(v) for _, v, _ in rows), default=0) // parts) * parts or parts
    own = width // parts
    limit = 1 << 62
    ints = [[max(-limit, min(limit, math.floor(scale * x))) for x in v] + [0] * (width - len(v)) for _, v, _ in rows]
    cut = [[v[p * own : (p + 1) * own] for p in range(parts)] for v in ints]
    first = sorted((i for i in range(len(rows)) if rows[i][0] is not None), key=lambda i: (rows[i][0], rows[i][1]))[:entries]
    books = [[cut[i][p] for i in first] or [[0] * own] for p in range(parts)]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda x, book: min(range(len(book)), key=lambda k: (distance(x, book[k]), k))
    for _ in range(rounds if first else 0):
        for p in range(parts):
            groups = {}
            for v in cut:
                groups.setdefault(nearest(v[p], books[p]), []).append(v[p])
            books[p] = [[sum(c) // len(groups[k]) for c in zip(*groups[k])] if k in groups else e for k, e in enumerate(books[p])]
    out, sums = [], {}
    for (i, _, label), v in zip(rows, cut):
        near = [nearest(v[p], books[p]) for p in range(parts)]
        error = sum(distance(v[p], books[p][k]) for p, k in enumerate(near))
        sums[label] = sums.get(label, 0) + error
        out.append((i, "".join(f"{k:02x}" for k in near), min(error, 2**63 - 1), label))
    text = ",".join(str(x) for b in books for e in b for x in e)
    return out, sums, hashlib.sha256(text.encode()).hexdigest(), books


def vectors(spark, rows):
    schema = "vec_id long, embedding array<double>, label int, code string, n int, position string"
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], schema)


def agree(spark, rows, **options):
    codes, books = vectorcodes.compress(vectors(spark, rows).repartition(3), **options)
    found = vectorcodes.label_errors(codes).collect()
    wanted, sums, digest, _ = brute(rows, **options)
    assert vectorcodes.digest(books) == digest
    assert sorted((str(r["vec_id"]), r["code"], r["error"], min(sums[r["label"]], 2**63 - 1) == r["label_error"]) for r in found) == sorted(
        (str(i), c, e, True) for i, c, e, _ in wanted)


def test_against_loops(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(16)], rng.choice([0, 1, None])) for i in range(300)]
    # few values: many parts are equal, begin alike and are as near to two entries
    rows += [(1000 + i, [rng.choice([0.0, 0.25, -0.25]) for _ in range(16)], 2) for i in range(400)]
    rows += [(5000 + i, [0.5] * 16, 3) for i in range(300)]
    rows += [(7, [float("nan")] * 16, 1), (8, None, 1), (9, [None] * 16, 1), (10, [float("inf")] + [0.0] * 15, None), (3, rows[3][1], 0),
             (None, [0.1] * 16, 1), (11, [], 1), (12, [0.3] * 5, 1), (13, [0.1] * 15, None)]
    agree(spark, rows)


def test_large_numbers_few_rows_and_no_ids(spark):
    agree(spark, [(i, [10.0 ** (i + k) for k in range(8)], 0) for i in range(20)])
    agree(spark, [(1, [1e300, -1e300, 5e5, -5e5, 0.0, 0.0, 1e12, 3.0], 0), (2, [1.0] * 8, None)])
    agree(spark, [(5, [0.5] * 9, None)])
    agree(spark, [(None, [0.5] * 8, 1), (None, [0.25] * 8, 1)])
    agree(spark, [(1, [], 1), (2, [], 1)])


def test_no_vectors(spark):
    codes, books = vectorcodes.compress(vectors(spark, [(1, None, 1)]))
    assert books == [] and vectorcodes.label_errors(codes).count() == 0


def test_walk_shares_sums_and_keeps_ties():
    rng = np.random.default_rng(1)
    parts, _, n = vectorcodes.distinct(rng.integers(-3, 4, (5000, 5)))
    assert n.sum() == 5000 and (np.lexsort(parts.T[::-1]) == np.arange(len(parts))).all()
    book = rng.integers(-3, 4, (16, 5))
    every = ((parts[:, None, :] - book) ** 2).sum(axis=2)
    for leaves in (1, 7, 100, 10_000):
        found = vectorcodes.walk(parts, book, leaves)
        assert (found.entry == every.argmin(axis=1)).all() and (found.distance == every.min(axis=1)).all()


def test_whole_table_in_any_partitioning(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    one, two = (vectorcodes.compress(rows.repartition(k))[1] for k in (1, 9))
    assert vectorcodes.digest(one) == vectorcodes.digest(two)
    assert rows.select(F.max(F.size("embedding"))).first()[0] == 8 * one[0].shape[1]
