import gzip
import json
import os

from pyspark.sql import functions as F

from conftest import event
from shoplake.operators import ledger as L


def write(path, name, lines, compress=True):
    path.mkdir(parents=True, exist_ok=True)
    data = "".join(f"{x}\n" for x in lines).encode()
    (path / name).write_bytes(gzip.compress(data) if compress else data)


def lines(day, n=3):
    return [json.dumps(event(f"{day}-{i}", ts=f"2026-09-{day:02d}T10:0{i}:00")) for i in range(n)]


def states(spark, ledger):
    return {(r["load"], os.path.basename(os.path.dirname(r["file"])) + "/" + os.path.basename(r["file"])): (r["state"], r["reason"], r["rows"])
            for r in L.read_ledger(spark, ledger).collect()}


def test_loads_resume_and_retry(spark, tmp_path):
    src, dst, ledger = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "ledger")
    write(src / "a", "x.json.gz", lines(1))
    write(src / "b", "x.json.gz", lines(2))  # the same name in another folder
    write(src / "a", "plain.json", lines(3), compress=False)
    write(src / "a", "empty.json.gz", [])
    write(src / "a", "untimed.json.gz", ["no json"])
    whole = gzip.compress("".join(lines(4, 9)).encode() * 500)
    (src / "a" / "cut.json.gz").write_bytes(whole[:len(whole) // 2])
    L.load(spark, str(src), dst, ledger, "one")
    assert states(spark, ledger) == {
        ("one", "a/x.json.gz"): (L.LOADED, None, 3), ("one", "b/x.json.gz"): (L.LOADED, None, 3), ("one", "a/plain.json"): (L.LOADED, None, 3),
        ("one", "a/empty.json.gz"): (L.FAILED, L.NO_ROWS, 0), ("one", "a/untimed.json.gz"): (L.FAILED, L.NO_TIME, 0),
        ("one", "a/cut.json.gz"): (L.FAILED, L.UNREADABLE, 0)}
    # Mended, changed and new files are the next load's; the others are not touched again.
    write(src / "a", "cut.json.gz", lines(4))
    write(src / "b", "x.json.gz", lines(2, 5))
    write(src / "c", "late.json.gz", lines(5))
    second = L.load(spark, str(src), dst, ledger, "two")
    assert {os.path.basename(r["file"]): (r["state"], r["rows"]) for r in second.collect()} == {
        "cut.json.gz": (L.LOADED, 3), "x.json.gz": (L.LOADED, 5), "late.json.gz": (L.LOADED, 3),
        "empty.json.gz": (L.FAILED, 0), "untimed.json.gz": (L.FAILED, 0)}
    assert spark.read.text(dst).count() == 3 + 5 + 3 + 3 + 3
    # Repeating a load replaces its rows.
    L.load(spark, str(src), dst, ledger, "two")
    assert spark.read.text(dst).count() == 17
    assert L.pending_files(spark, str(src), ledger, "*.json*").count() == 2


def test_files_are_deleted_only_after_their_rows_are_readable(spark, tmp_path):
    src, dst, ledger = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "ledger")
    for day in (1, 2, 3):
        write(src, f"f{day}.json.gz", lines(day))
    write(src, "bad.json.gz", ["no json"])
    L.load(spark, str(src), dst, ledger, "one")
    assert len(list(src.iterdir())) == 4
    # A file that changed since it was listed, and one whose rows are not all in the zone, stay.
    write(src, "f2.json.gz", lines(2, 4))
    part = next((tmp_path / "raw").rglob("batch=f3*"))
    for f in part.glob("*.txt"):
        f.unlink()
    gone = L.delete_loaded(spark, dst, ledger, "one")
    assert [os.path.basename(r["file"]) for r in gone.collect()] == ["f1.json.gz"]
    assert {f.name for f in src.iterdir()} == {"f2.json.gz", "f3.json.gz", "bad.json.gz"}
    # Repeated, with the file gone already: the same answer.
    assert [os.path.basename(r["file"]) for r in L.delete_loaded(spark, dst, ledger, "one").collect()] == ["f1.json.gz"]
    assert spark.read.text(dst).count() == 6


def test_nothing_to_load(spark, tmp_path):
    src = tmp_path / "in"
    write(src, "f.json.gz", lines(1))
    args = (spark, str(src), str(tmp_path / "raw"), str(tmp_path / "ledger"))
    L.load(*args, "one", delete=True)
    write(src, "blank.json", [" "], compress=False)
    assert [(r["state"], r["reason"]) for r in L.load(*args, "two").collect()] == [(L.FAILED, L.NO_ROWS)]
    deleted = L.read_ledger(spark, args[3]).where(F.col("state") == L.DELETED)
    assert deleted.select("rows").collect()[0][0] == 3
