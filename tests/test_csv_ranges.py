"""CSV files cut into ranges of bytes, against the csv module on whole files."""

import csv
import io
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.sources.pages import csv_cells
from quillspark.sources.sheets import quoted_after, read_csv_cells
from quillspark.sources.store import shared_path


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(st.sampled_from('a",x '), max_size=8), min_size=1, max_size=6))
def test_quotes_of_lines(lines):
    """A line end ends a record where the csv module ends one."""
    quoted, records, held = False, [], []
    for line in lines:
        held.append(line)
        quoted = quoted_after(line.encode(), quoted)
        if not quoted:
            records.append("\n".join(held))
            held = []
    if held:
        records.append("\n".join(held))
    want = list(csv.reader(io.StringIO("\n".join(lines) + "\n")))
    got = [next(csv.reader(io.StringIO(r + "\n")), []) for r in records]
    assert [r for r in got if r] == [r for r in want if r] or any("\n" in c for r in want for c in r[-1:])


def sheet(seed, rows):
    draw, out = random.Random(seed), io.StringIO()
    writer = csv.writer(out, lineterminator=draw.choice(["\n", "\r\n"]))
    cells = ["", " ", "007", "a,b", 'say "hi"', "two\nlines", "x\n\n,\ny", "é", "5", '"']
    for k in range(rows):
        writer.writerow([k, *(draw.choice(cells) for _ in range(3))] if draw.random() < 0.9 else ["", " "])
    return out.getvalue()


def got(frame):
    found = {}
    for r in frame.collect():
        found.setdefault(r.attachment_id, []).append((r.row_no, r.sheet_name, r.cells))
    return {k.split("/csv")[1]: sorted(v) for k, v in found.items()}


@pytest.mark.parametrize("size", ["700b", "40k", "128m"])
def test_ranges_of_any_size_give_the_same_cells(spark, tmp_path, size):
    long = "x" * 70_000 + "\n" + "y" * 70_000
    files = {
        "a/one.csv": sheet(1, 120).encode("utf-8-sig"), "b/one.csv": sheet(2, 80).encode("cp949", "ignore"), "b/two words+.csv": sheet(3, 40).encode("latin-1"),
        "a/long.csv": f'id,text\n1,"{long}"\n2,b\n'.encode(), "a/open.csv": b'a,"never\nclosed,b\nc', "b/empty.csv": b"", "b/blank.csv": b"\n , \n\n", "b/note.txt": b"no,sheet\n",
        "a/stray.csv": b'5" pipe,x\na "b",c\n"q"tail,z\n', "b/last.csv": "가,나\n다,라".encode("cp949"),
    }
    for name, data in files.items():
        target = tmp_path / "csv" / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(data)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k in names:
            spark.conf.set(k, size)
        frame = read_csv_cells(spark, [f"{tmp_path}/csv/a", f"{tmp_path}/csv/b"])
        found = got(frame)
        parts = frame.sparkSession.read.text(f"{tmp_path}/csv/a/one.csv").rdd.getNumPartitions()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert size != "700b" or parts > 2
    want = {}
    for name, data in files.items():
        rows = [(number, stem, cells) for stem, number, cells in csv_cells(name.rsplit("/", 1)[1], data)] if name.endswith(".csv") else []
        if rows:
            want["/" + name.replace(" ", "%20")] = rows
    assert found == want and len(found["/a/long.csv"][1][2][1]) == 140_001


def test_a_folder_without_files(spark):
    path = shared_path(spark, "csv")
    spark.createDataFrame([], "a string").write.csv(path)
    assert read_csv_cells(spark, path).collect() == []
