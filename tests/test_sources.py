from __future__ import annotations

from pathlib import Path

import pytest

from conftest import rows
from ledgerloom.schemas import RAW_COLUMNS
from ledgerloom.sources import raw_csv
from ledgerloom.sources import append_raw, default_countries, load_raw, read_countries, scan_raw

HEADER = ",".join(RAW_COLUMNS)
GOOD = "536365,85123A,WHITE HOLDER,6,12/1/2010 8:26,2.55,17850,United Kingdom"


def write(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_bad_lines_are_kept_apart(spark, tmp_path, scratch):
    folder = tmp_path / "in"
    write(folder, "a.csv", HEADER, GOOD, "536366,short", GOOD + ",long",
          '536367,22,"a, ""b""",1,12/1/2010 8:28,1.5,,France')
    write(folder, "b.csv", HEADER, GOOD)
    write(folder, "notes.txt", "not,read")
    load = load_raw(spark, str(folder), scratch.path("bronze"))
    assert load.rows.columns == list(RAW_COLUMNS)
    assert all(t == "string" for _, t in load.rows.dtypes)
    assert rows(load.rows, "InvoiceNo", "Description", "CustomerID") == [
        ("536365", "WHITE HOLDER", "17850"), ("536365", "WHITE HOLDER", "17850"),
        ("536367", 'a, "b"', None),
    ]
    assert rows(load.rejects) == [("536365" + GOOD[6:] + ",long",), ("536366,short",)]
    assert rows(load.counts()) == [(3, 2)]


def test_other_encodings(spark, tmp_path, scratch):
    folder = tmp_path / "in"
    folder.mkdir()
    text = f"{HEADER}\n{GOOD.replace('WHITE HOLDER', '£1 CAFÉ MUG')}\n"
    (folder / "a.csv").write_bytes(text.encode("latin-1"))
    load = load_raw(spark, str(folder), scratch.path("bronze"), encoding="ISO-8859-1")
    assert rows(load.rows, "Description") == [("£1 CAFÉ MUG",)]


def test_loading_again_replaces(spark, tmp_path, scratch):
    target = scratch.path("bronze")
    write(tmp_path / "in", "a.csv", HEADER, GOOD)
    for _ in range(2):
        load = load_raw(spark, str(tmp_path / "in"), target)
    assert rows(load.counts()) == [(1, 0)]


def test_appending_reads_new_files_only(spark, tmp_path, scratch):
    target, one, two = scratch.path("bronze"), tmp_path / "one", tmp_path / "two"
    write(one, "a.csv", HEADER, GOOD)
    assert rows(append_raw(spark, str(one), target).counts()) == [(1, 0)]
    assert rows(append_raw(spark, str(one), target).counts()) == [(1, 0)]
    write(one, "b.csv", HEADER, GOOD, "536366,short")
    assert rows(append_raw(spark, str(one), target).counts()) == [(2, 1)]
    write(two, "a.csv", HEADER, GOOD)
    assert rows(append_raw(spark, str(two), target).counts()) == [(3, 1)]
    # A changed file counts as new.
    write(two, "a.csv", HEADER, GOOD, GOOD)
    assert rows(append_raw(spark, str(two), target).counts()) == [(5, 1)]


def test_an_unfinished_append_adds_nothing(spark, tmp_path, scratch):
    target = scratch.path("bronze")
    write(tmp_path / "in", "a.csv", HEADER, GOOD)
    append_raw(spark, str(tmp_path / "in"), target)
    spark.read.parquet(f"{target}/loads").drop("load").write.partitionBy("rejected").parquet(
        f"{target}/loads/load=unfinished"
    )
    assert rows(append_raw(spark, str(tmp_path / "in"), target).counts()) == [(1, 0)]


def test_nothing_to_append(spark, tmp_path, scratch):
    (tmp_path / "in").mkdir()
    with pytest.raises(FileNotFoundError):
        append_raw(spark, str(tmp_path / "in"), scratch.path("bronze"))


def test_no_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        scan_raw(spark, str(tmp_path / "absent"))
    write(tmp_path / "in", "notes.txt", "x")
    with pytest.raises(FileNotFoundError):
        scan_raw(spark, str(tmp_path / "in"))


def test_countries(spark, tmp_path):
    shipped = default_countries(spark)
    assert shipped.count() == 193
    assert rows(shipped.filter("id = 180"), "alpha2", "en") == [
        ("cd", "Congo, Democratic Republic of the")
    ]
    write(tmp_path / "in", "c.csv", "id,alpha2,en", '1,aa,"A, of"', "2,bb,B")
    assert rows(read_countries(spark, str(tmp_path / "in"))) == [(1, "aa", "A, of"), (2, "bb", "B")]


def test_rejected_lines_say_where_they_come_from(spark, tmp_path, scratch):
    folder = tmp_path / "in"
    write(folder, "a.csv", HEADER, GOOD, "536366,short", GOOD + ",long")
    write(folder, "b.csv", HEADER, '1,"a, ""b"", c",x', GOOD)
    load = load_raw(spark, str(folder), scratch.path("bronze"))
    found = load.rejections.collect()
    assert sorted((r.file.rsplit("/", 1)[1], r.fields, r.reason, r.line) for r in found) == [
        ("a.csv", 2, "too few fields", "536366,short"),
        ("a.csv", 9, "too many fields", GOOD + ",long"),
        ("b.csv", 3, "too few fields", '1,"a, ""b"", c",x'),
    ]
    assert {r.block_start for r in found} == {0}
    by_file = load.rejections_by_file().collect()
    assert sorted((r.file.rsplit("/", 1)[1], r.reason, r.lines) for r in by_file) == [
        ("a.csv", "too few fields", 1), ("a.csv", "too many fields", 1),
        ("b.csv", "too few fields", 1),
    ]
    appended = append_raw(spark, str(folder), scratch.path("other"))
    assert rows(appended.rejections, "fields") == [(2,), (3,), (9,)]


def test_of_two_appends_at_once_each_file_is_loaded_once(spark, tmp_path, scratch, monkeypatch):
    target, folder = scratch.path("bronze"), tmp_path / "in"
    write(folder, "a.csv", HEADER, GOOD)
    write(folder, "b.csv", HEADER, GOOD, GOOD)
    create = raw_csv.create_file
    overtaken = []

    def late(spark_, path, content):
        """Just before the first load is listed, another one loads the same files, and a
        third file appears."""
        monkeypatch.setattr(raw_csv, "create_file", create)
        overtaken.append(rows(append_raw(spark, str(folder), target).counts()))
        write(folder, "c.csv", HEADER, GOOD, "536366,short")
        return create(spark_, path, content)

    monkeypatch.setattr(raw_csv, "create_file", late)
    load = append_raw(spark, str(folder), target)
    assert overtaken == [[(3, 0)]]
    assert rows(load.counts()) == [(4, 1)]
    lists = sorted(p.name for p in Path(target.removeprefix("file:"), "lists").glob("0*.json"))
    assert lists == ["000000000000.json", "000000000001.json"]
    loads = list(Path(target.removeprefix("file:"), "loads").glob("load=*"))
    assert len(loads) == 2  # the overtaken load left nothing


def test_an_append_whose_list_raised_but_is_there_stands(spark, tmp_path, scratch, monkeypatch):
    target, folder = scratch.path("bronze"), tmp_path / "in"
    write(folder, "a.csv", HEADER, GOOD)
    create = raw_csv.create_file

    def lost_answer(*line):
        create(*line)
        raise ConnectionError

    monkeypatch.setattr(raw_csv, "create_file", lost_answer)
    assert rows(append_raw(spark, str(folder), target).counts()) == [(1, 0)]
    monkeypatch.setattr(raw_csv, "create_file", lambda *_: 1 / 0)
    write(folder, "b.csv", HEADER, GOOD)
    with pytest.raises(ZeroDivisionError):
        append_raw(spark, str(folder), target)
    monkeypatch.undo()
    assert rows(append_raw(spark, str(folder), target).counts()) == [(2, 0)]
