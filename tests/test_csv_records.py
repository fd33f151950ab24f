"""CSV records over many tasks: equal to a reader that sees the whole file, whatever the splits."""

import csv
import os
import random

import pytest

from hausprep.sources.files import CSV_OPTIONS, read_csv_text, scan_csv_dir, scan_csv_files, scan_regions
from hausprep.sources.records import cells_of, ends_inside


@pytest.fixture
def tiny_splits(spark):
    """Files are cut every 64 bytes."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "64")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def write(path, text):
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(text)
    return str(path)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def random_csv(seed, ends, rows=60):
    rnd = random.Random(seed)
    parts = ["a", "é漢", ' ', '""', ",", "\n", "\r\n", "\n\n", "x" * 30, ""]
    cell = lambda: "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 4)))
    text = 'id,"te\nxt",plain' + ends[0]
    for i in range(rows):
        quoted = '"' + cell() + '"'
        plain = rnd.choice(["", "p", '5" pipe', "a b", "it's"])
        text += f"{i},{quoted},{plain}" + rnd.choice(ends) + rnd.choice(["", "", ends[0]])
    return text


@pytest.mark.parametrize("seed,ends", [(0, ["\n"]), (1, ["\n"]), (2, ["\n"]), (3, ["\r\n"]), (4, ["\n", "\r\n"])])
def test_many_splits_equal_the_multi_line_reader(spark, tmp_path, tiny_splits, seed, ends):
    path = write(tmp_path / "a.csv", random_csv(seed, ends))
    df = read_csv_text(spark, path)
    got = rows_of(df)
    assert df.columns == ["id", "te\nxt", "plain"] and len(got) == 60
    if ends == ["\n"]:
        assert got == rows_of(spark.read.options(**CSV_OPTIONS).option("multiLine", True).csv(path))
    with open(path, newline="", encoding="utf-8") as f:
        rows = [r for r in csv.reader(f) if r][1:]      # Spark reads an empty cell as null, quoted or not
    assert got == sorted((tuple(c or None for c in r) for r in rows), key=str)
    assert spark.read.text(path).rdd.getNumPartitions() > 10


def test_whole_splits_inside_one_cell(spark, tmp_path, tiny_splits):
    long = "\n".join(f"line {i} with, a comma" for i in range(200))
    path = write(tmp_path / "a.csv", f'a,b\n1,"{long}"\n2,x\n3,"never closed\n{long}')
    assert rows_of(read_csv_text(spark, path)) == [("1", long), ("2", "x"), ("3", f"never closed\n{long}")]


def test_header_longer_than_a_split(spark, tmp_path, tiny_splits):
    names = [f"column {i}\nof a long header" for i in range(20)]
    path = write(tmp_path / "a.csv", "﻿" + ",".join(f'"{n}"' for n in names) + "\n" + ",".join(map(str, range(20))) + "\n")
    df = read_csv_text(spark, path)
    assert df.columns == names and rows_of(df) == [tuple(map(str, range(20)))]


def test_states_and_cells():
    for line, outside, inside in [("", False, True), ("a,b", False, True), ('"a', True, False), ('"a,b",', False, False),
                                  ('x"', False, False), ('a,"', True, False), ('5" pipe,"open', True, True), ('"",""', False, True),
                                  ('" x"y,"z', True, True), ('\ufeff"a', True, False), ('a"",b', False, True)]:
        assert ends_inside(line, False) == outside, line
        assert ends_inside(line, True) == inside, line
    for record, n in [("", 1), (",", 2), ('"a,b",c', 2), ('"a""b,",', 2), ('5" x,y', 2), ('"a"b,c', 2), ('"a,b\nc', 1), ("a,b,", 3), ('x,"y,z', 2)]:
        assert cells_of(record) == n, record
    assert ends_inside('"' + '""' * 100_000, False) and not ends_inside('"' + '""' * 100_000 + '"', False)


def test_without_quoted_breaks(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'a,b\n1,"x"\n2,"y,z"\n')
    assert rows_of(read_csv_text(spark, path, multi_line=False)) == [("1", "x"), ("2", "y,z")]


def test_malformed_records(spark, tmp_path):
    write(tmp_path / "a.csv", 'a,b\n1,2\n1,2,3\n4\n5,"6,\n7"\n')
    write(tmp_path / "b.csv", "a,b,c\n1,2,3\n")
    with pytest.raises(Exception, match="more than 2 cells"):
        read_csv_text(spark, f"{tmp_path}/a.csv").collect()
    with pytest.raises(Exception, match="more than 2 cells"):          # whatever columns are asked for
        read_csv_text(spark, f"{tmp_path}/a.csv").count()
    scan = scan_csv_files(spark, str(tmp_path), malformed="quarantine")
    assert rows_of(scan.frame.select("a", "b", "c", "source")) == [
        ("1", "2", "3", "b.csv"), ("1", "2", None, "a.csv"), ("5", "6,\n7", None, "a.csv")]
    assert scan.malformed() == {"records": 5, "too_long": 1, "too_short": 1}
    assert rows_of(scan.rejected) == [("a.csv", "too_long", "1,2,3"), ("a.csv", "too_short", "4")]
    short = write(tmp_path / "c.csv", "a,b,c\n1\n1,2\n")
    assert rows_of(read_csv_text(spark, short)) == [("1", "2", None), ("1", None, None)]


def test_one_scan_per_header(spark, tmp_path):
    headers = ["a,b", "b,a", "a,c"]
    for i in range(1000):
        write(tmp_path / f"file {i}+%41.csv", f"{headers[i % 3]}\n{i},x\n")
    os.mkdir(tmp_path / "dir.csv")
    write(tmp_path / "dir.csv" / "part-0.csv", "a,b\nd,0\n")
    write(tmp_path / "dir.csv" / "part-1.csv", "a,b\nd,1\n")
    write(tmp_path / "empty.csv", "")
    write(tmp_path / "only header.csv", "a,b\n")
    df = scan_csv_dir(spark, str(tmp_path))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 4                     # three headers, and the directories of one
    rows = rows_of(df.select("a", "b", "c", "source"))
    want = [((str(i), "x", None), ("x", str(i), None), (str(i), None, "x"))[i % 3] + (f"file {i}+%41.csv",) for i in range(1000)]
    assert rows == sorted([*want, ("d", "0", None, "dir.csv"), ("d", "1", None, "dir.csv")], key=str)


def test_regions_keep_their_code(spark, tmp_path):
    write(tmp_path / "data_ab.csv", "x\n1\n")
    write(tmp_path / "data_bc.csv", "x\n2\n")
    scan = scan_regions(spark, str(tmp_path), ["ab", "bc", "on"])
    assert rows_of(scan.frame) == [("1", "ab"), ("2", "bc")] and scan.missing == [f"{tmp_path}/data_on.csv"]
