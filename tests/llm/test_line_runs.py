"""Recall of op3 against repeated runs of lines that are counted without any cut into chunks."""

import hashlib

from conftest import SMALL

from muniscope.llm import line_dedup
from muniscope.llm.queries import QUERIES


def lines_left(rows):
    """Number of lines, removed lines and the text left, if every later run of two lines or more goes."""
    first, out = {}, {}
    for i, text in rows:
        each = (text or "").split("\n")
        gone = set()
        for k in range(len(each) - 1):
            doc, at = first.setdefault((each[k], each[k + 1]), (i, k))
            if doc != i or k >= at + 2:
                gone |= {k, k + 1}
        out[i] = (len(each), len(gone), "\n".join(x for k, x in enumerate(each) if k not in gone))
    return out


def test_repeated_runs_go(spark, corpus):
    got = {r["doc_id"]: r for r in QUERIES["op3_line_dedup"](spark, SMALL).collect()}
    want = lines_left(corpus[1])
    assert sum(n for _, n, _ in want.values()) > 100 and got.keys() == want.keys()
    assert all(got[i]["n_lines"] == n and got[i]["n_removed_lines"] <= gone for i, (n, gone, _) in want.items())
    assert sum(r["n_removed_lines"] for r in got.values()) >= 0.99 * sum(gone for _, gone, _ in want.values())


def test_short_runs_and_their_edges(spark):
    rows, expected = [], {}
    for size in range(2, 8):
        shared = [f"passage {size}, line {k}" for k in range(size)]
        for copy in range(5):
            i = 10 * size + copy
            before, after = [f"{i} before {k}" for k in range(copy)], [f"{i} after {k}" for k in range(4 - copy)]
            rows.append((i, "\n".join(before + shared + after)))
            expected[i] = "\n".join(before + after) if copy else rows[-1][1]
    rows += [(100, "a\na\na"), (101, "b\nb\nb\nb\nb"), (102, "c\nd\nc\nd"), (103, "x\nalone\ny"), (104, "v\nalone\nw"), (105, "é\n\nzwei"), (106, "é\n"), (107, "é")]
    expected |= {100: "a\na\na", 101: "b\nb", 102: "c\nd", 103: "x\nalone\ny", 104: "v\nalone\nw", 105: "é\n\nzwei", 106: "", 107: "é"}
    out = {r["doc_id"]: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: r["text"] for i, r in out.items()} == expected
    assert all(r["n_removed_lines"] == i // 10 for i, r in out.items() if i < 100 and i % 10)


def test_rows_of_one_id_are_one_document(spark):
    rows = [(1, "p\nq\nr"), (1, "p\nq\nr"), (1, "s\np\nq"), (2, "q\nr\nt")]
    out = sorted((r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert out == [(1, "p\nq\nr"), (1, "p\nq\nr"), (1, "s"), (2, "t")]
