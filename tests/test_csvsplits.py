"""CSV files read in splits: every cut gives what reading the whole file gives."""

from __future__ import annotations

import csv
import io

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from legwise.sources import csvsplits, tables
from tests.conftest import rows_of

cell = st.text(st.sampled_from('a",\n\r ;'), max_size=6)


def written(rows):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows)
    return out.getvalue()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(cell, min_size=2, max_size=3), min_size=1, max_size=12), st.data())
def test_every_cut_gives_the_same_records(rows, data):
    text = written(rows)
    lines = text.split("\n")[:-1]
    splits = data.draw(st.lists(st.integers(0, len(lines)), max_size=6).map(lambda cuts: sorted({0, *cuts})))
    blocks = [sum(k >= cut for cut in splits) * 10 - 10 for k in range(len(lines))]
    size = data.draw(st.integers(1, 5))

    def batches(*more):
        columns = [pa.array(lines, pa.string()), pa.array([7] * len(lines), pa.int64()), pa.array(blocks, pa.int64()), *more]
        table = pa.RecordBatch.from_arrays(columns, [str(k) for k in range(len(columns))])
        return [table.slice(k, size) for k in range(0, len(lines), size)]

    ends = {r["block"]: r for b in csvsplits._ends(batches(pa.array(["p"] * len(lines)))) for r in b.to_pylist()}
    state, begin = False, {}
    for block in sorted(ends):
        begin[block] = state
        state = ends[block]["from_inside" if state else "from_outside"]
    assert not state
    found, fragment = [], []
    for batch in csvsplits._records(batches(pa.array([begin[b] for b in blocks]))):
        for r in batch.to_pylist():
            if r["kind"] == csvsplits.WHOLE:
                found.append((r["block"], r["line"], r["record"]))
            else:
                fragment.append(r)
    joined: list = []
    for r in sorted(fragment, key=lambda r: (r["block"], r["line"])):
        if begin[r["block"]] and r["line"] == 0:
            joined[-1][1] += "\n" + r["record"]
        else:
            joined.append([(r["block"], r["line"]), r["record"], r["kind"]])
    found += [(*at, record) for at, record, kind in joined if kind != csvsplits.HEADER_FRAGMENT]
    read = [next(csv.reader(io.StringIO(record, newline=""))) for _, _, record in sorted(found) if record.strip("\r")]
    whole = [r for r in csv.reader(io.StringIO(text, newline="")) if r]
    assert read == whole[1:]


@pytest.mark.parametrize(
    ("line", "inside", "ends"),
    [("a,b", False, False), ("a,b", True, True), ('"a', False, True), ('"a""', False, True), ('"a"', False, False), ('a"b', False, False), ('a,"b', False, True),
     ('b"', True, False), ('b",c', True, False), ('b","c', True, True), ('b"",c', True, True), ('"a"x,"', False, True), ('5" x,6" y', False, False), ("", True, True), ("", False, False), ('"', False, True), ('"', True, False), ('","', True, True)],
)
def test_where_a_line_ends(line, inside, ends):
    assert csvsplits.ends_inside(line, inside) is ends


@pytest.mark.parametrize("size", [7, 29, 64, 10**6])
def test_one_file_by_many_tasks(spark, tmp_path, size):
    rows = [[str(k), f"t{k}", ""] for k in range(12)]
    rows[2:2] = [["x\ny", 'quote " and , comma', "long\n" * 30], ["", "5\" disk", " a "], ["\n", '"', "é\r\nz"]]
    (tmp_path / "one.csv").write_text("\n" + written([["id", "name, of", "rest"], *rows]) + "\n\n", newline="")
    whole = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(str(tmp_path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        read = tables.scan_csv(spark, str(tmp_path), with_order=True)
        assert read.columns == [*whole.columns, *tables.SOURCE_ORDER]
        got = [tuple(r)[:3] for r in read.orderBy(*tables.SOURCE_ORDER).collect()]
        assert got == [tuple(c if c else None for c in r) for r in rows]
        assert sorted(got, key=repr) == rows_of(whole.na.replace("", None))
        if size < 100:
            tasks = csvsplits._lines(spark, str(tmp_path)).rdd.getNumPartitions()
            assert tasks >= 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_carriage_returns_short_and_long_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b,c\r\n1,"x\r\ny",3\r\n1\r\n1,2,3,4\r\n"",N/A,z\r\n', newline="")
    (tmp_path / "b.csv").write_text("a,b,c\n9,,\n", newline="")
    (tmp_path / "c.csv").write_text("a,b,c", newline="")
    assert rows_of(tables.scan_csv(spark, str(tmp_path))) == sorted(
        [("1", "x\r\ny", "3"), ("1", None, None), ("1", "2", "3"), (None, None, "z"), ("9", None, None)], key=repr)


def test_a_file_that_ends_inside_quotes(spark, tmp_path):
    (tmp_path / "good.csv").write_text("a,b\n1,2\n")
    (tmp_path / "open.csv").write_text('a,b\n1,"2\n3,4\n')
    with pytest.raises(ValueError, match="ends inside quotes: .*open.csv"):
        tables.scan_csv(spark, str(tmp_path))
