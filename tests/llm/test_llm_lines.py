"""Line dedup against a plain version, on rows with nulls, repeats and columns whose names clash."""

import hashlib
import re
import time
from collections import defaultdict

import pytest

from opsframe.llm.line_dedup import apply_bitmaps, keep_bitmaps

BLANK = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, n_lines long, keep_runs string, h1 int"


def key(line):
    return line.strip(BLANK).translate(LOWER)


def plain(rows, min_docs, keep_first=False):
    where = defaultdict(set)
    first = {}
    for i, text in rows:
        for at, line in enumerate((text or "").split("\n")):
            where[key(line)].add(i)
            place = (i is not None, i, hashlib.sha256((text or "").encode()).hexdigest(), at)
            first.setdefault(key(line), []).append(place)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        gone = [len(key(x)) > 0 and len(where[key(x)]) >= min_docs for x in lines]
        if keep_first:
            gone = [g and not (i == min(w for w in where[key(x)]) and key(x) not in map(key, lines[:n])) for n, (x, g) in enumerate(zip(lines, gone))]
        kept = "\n".join(x for x, g in zip(lines, gone) if not g)
        out.append((i, len(lines), sum(gone), text if text is None and not sum(gone) else kept))
    return sorted(out, key=str)


ROWS = [(i, f"Shared line\nown {i}\n  SHARED LINE \n\n{'x' * i}") for i in range(6)] + [
    (7, None),
    (8, ""),
    (9, "shared line"),
    (9, "shared line"),
    (10, "É shared\n é shared\nown"),
    (11, "a\nb\nb\n" * 500 + "shared line"),
    (None, "shared line\nnameless"),
]


@pytest.mark.parametrize("min_docs", [1, 3, 6, 50])
def test_against_plain_version(spark, min_docs):
    docs = spark.createDataFrame([(i, t, 5, "x", 1) for i, t in ROWS], SCHEMA)
    got = apply_bitmaps(docs, keep_bitmaps(docs, min_docs=min_docs))
    assert got.columns == ["doc_id", "text", "n_lines", "keep_runs", "h1", "lines_before", "lines_dropped"]
    found = sorted(((r.doc_id, r.lines_before, r.lines_dropped, r.text) for r in got.collect()), key=str)
    assert found == plain(ROWS, min_docs)


def test_first_lines_stay(spark):
    rows = [(3, "a\nb\na"), (1, "b\nc\nb"), (2, "a\nc"), (5, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = apply_bitmaps(docs, keep_bitmaps(docs, min_docs=2, keep_first=True))
    assert {r.doc_id: r.text for r in got.collect()} == {1: "b\nc", 2: "a", 3: "", 5: "d"}


def test_bitmaps_are_run_lengths(spark):
    rows = [(1, "x\ny\na\nb\nx\nx\nc"), (2, "x\ny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    runs = {r.doc_id: list(r.keep_runs) for r in keep_bitmaps(docs, min_docs=2).collect()}
    assert runs == {1: [0, 2, 2, 2, 1], 2: [0, 2, 0]}


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert keep_bitmaps(docs).count() == 0
    assert apply_bitmaps(docs, keep_bitmaps(docs)).count() == 0


def test_plan_has_no_python(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = apply_bitmaps(docs, keep_bitmaps(docs))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_many_lines_and_columns_of_any_name(spark):
    rows = [(i, "\n".join(["shared", *(f"own {i} {k}" for k in range(200_000 if i == 1 else 3)), "shared"]), 1, 2.0, "x") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lines_before int, `a.b` double, _mask string")
    began = time.time()
    got = apply_bitmaps(docs, keep_bitmaps(docs, min_docs=3), counts=False)
    assert got.columns == docs.columns
    assert {r.doc_id: r.text for r in got.collect()} == {i: t[len("shared\n") : -len("\nshared")] for i, t, *_ in rows}
    assert time.time() - began < 60
