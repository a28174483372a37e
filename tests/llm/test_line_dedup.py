import re

import pytest

from odd_rows import docs, none  # noqa: F401

from quillbook.llm import linededup

SPACE = " \t\n\x0b\f\r"


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(SPACE))


def expected(rows, min_docs, keep):
    where = {}
    for doc, text in rows:
        for pos, line in enumerate((text or "").split("\n")):
            if key(line):
                where.setdefault(key(line), {}).setdefault(doc, []).append(pos)
    gone = {}
    for k, docs in where.items():
        if len(docs) >= min_docs:
            least = min(docs, key=lambda d: (d is not None, d or 0))
            first = (least, min(docs[least]))
            for doc, found in docs.items():
                for pos in found:
                    if keep == "none" or (doc, pos) != first:
                        gone.setdefault(doc, set()).add(pos)
    return [(d, "\n".join(x for i, x in enumerate((t or "").split("\n")) if i not in gone.get(d, ())) if d in gone else t)
            for d, t in rows]


@pytest.mark.parametrize("keep", ["none", "first"])
def test_against_brute_force(spark, keep):
    common = ["Shared Line", "  shared line\t", "ÉTÉ", "été", "", "   ", "solo"]
    rows = [(i, "\n".join([common[i % 7], f"own {i}", common[(i * 3) % 7], "SHARED line" if i % 2 else "x"])) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "Shared line"), (None, "shared line\nnone")]
    rows += [(200, "\n".join(f"l{j}" if j % 3 else "shared line" for j in range(200)))]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, keep int")
    found = linededup.drop_repeated_lines(frame, min_docs=5, keep=keep)
    assert found.columns == ["doc_id", "text", "keep", "_lines"]
    assert sorted(((r["doc_id"], r["text"]) for r in found.collect()), key=str) == sorted(expected(rows, 5, keep), key=str)


def test_odd_rows_and_empty_tables(docs, none):
    found = linededup.drop_repeated_lines(docs, min_docs=2)
    assert found.count() == docs.count()
    assert linededup.drop_repeated_lines(none).count() == 0


def test_bitmaps_are_sparse(spark):
    rows = [(i, "\n".join([f"{i} {j}" for j in range(300)] + ["same"])) for i in range(3)]
    maps = linededup.keep_bitmaps(spark.createDataFrame(rows, "doc_id long, text string"), min_docs=3).collect()
    assert [len(r["keep"]) for r in maps] == [1, 1, 1] and {r["n_dropped"] for r in maps} == {1}


def test_only_built_in_functions(docs):
    plan = linededup.drop_repeated_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
