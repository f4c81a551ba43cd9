"""Reference lists: records over several lines, charsets, and numbers that do not depend on how a file is cut."""

import csv
import io
import random

import pytest

from tidegate.sources import delimited, tables

ROWS = [
    ["1", "plain", "x"], ["2", "two\nlines", 'said "yes"'], ["3", "a;b", ""], ["4", "café €", "\n\nthree\n"], ["5", 'inch 5"', "y"],
    ["6", "crlf\r\nin it", "z"], ["7", '""', '"'], ["8", " ", "last"],
]


def written(rows, end="\n", header=("Nr", "Tekst", "Rest"), **options):
    out = io.StringIO(newline="")
    csv.writer(out, delimiter=";", lineterminator=end, **options).writerows([header, *rows])
    return out.getvalue()


def read(spark, path, parts=1, **options):
    size = path.stat().st_size
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(-(-size // parts)))
    spark.conf.set("spark.sql.files.openCostInBytes", str(-(-size // parts)))
    try:
        df = delimited.numbered_records(spark, str(path), **options)
        return [r.cells for r in sorted(df.collect(), key=lambda r: r.record)], sorted(r.record for r in df.collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_same_records_from_any_number_of_parts(spark, tmp_path, end, parts):
    path = tmp_path / "list.csv"
    path.write_bytes(written(ROWS * 5, end).encode("cp1252"))
    cells, numbers = read(spark, path, parts)
    assert numbers == list(range(len(ROWS) * 5 + 1))
    assert cells == [["Nr", "Tekst", "Rest"], *ROWS * 5]


def test_random_lists(spark, tmp_path):
    rng = random.Random(8)
    for trial in range(4):
        rows = [["".join(rng.choice('ab;" \n\r€é') for _ in range(rng.randrange(6))) for _ in range(3)] for _ in range(40)]
        rows = [[str(i), *r] for i, r in enumerate(rows)]
        path = tmp_path / f"r{trial}.csv"
        path.write_bytes(written(rows, "\n", ("a", "b", "c", "d"), quoting=csv.QUOTE_ALL).encode("cp1252"))
        assert read(spark, path, 9)[0] == [["a", "b", "c", "d"], *rows]


def test_records_are_cut_in_several_parts(spark, tmp_path):
    """One record reaches over all edges of a file."""
    path = tmp_path / "long.csv"
    long = "line\n" * 2000
    path.write_bytes(written([["1", "a", "b"], ["2", long, "c"], ["3", "d", "e"]]).encode())
    assert read(spark, path, 6, encoding="utf-8")[0][1:] == [["1", "a", "b"], ["2", long, "c"], ["3", "d", "e"]]


def test_stray_quotes_blank_lines_and_open_ends(spark, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_bytes(b'a;b\n\n 5";x"y\n   \n"q"tail;2\r\n\r\nshort\none;two;three\n"open;\nend')
    cells, _ = read(spark, path)
    assert cells == [["a", "b"], [' 5"', 'x"y'], ["qtail", "2"], ["short"], ["one", "two", "three"], ["open;\nend"]]
    got = delimited.read_numbered(spark, str(path)).orderBy("new_index").collect()
    assert [tuple(r) for r in got][3:4] == [("one", "two", 4)] and got[2].b is None


def test_charsets_need_no_session_option(spark, tmp_path):
    spark.conf.unset("spark.sql.legacy.javaCharsets")
    for charset in ("cp1252", "utf-8", "iso8859-15", "utf-8-sig"):
        path = tmp_path / f"{charset}.csv"
        path.write_bytes("sleutel;prijs\nå;€ 3\n".encode(charset))
        row = tables.read_list(spark, str(path), ";", "utf-8" if charset == "utf-8-sig" else charset).first()
        assert (row.sleutel, row.prijs, row.new_index) == ("å", "€ 3", 1)
    bad = tmp_path / "bad.csv"
    bad.write_bytes(b"a;b\n\x81;\xe9\n")
    assert tuple(tables.read_list(spark, str(bad)).first()) == ("�", "é", 1)
    with pytest.raises(ValueError, match="utf-16"):
        tables.read_list(spark, str(bad), ";", "utf-16")


def test_headers_and_empty_files(spark, tmp_path):
    assert delimited.header_names(["a", "", "a", "a", " "]) == ["a", "Unnamed: 1", "a.1", "a.2", "Unnamed: 4"]
    path = tmp_path / "h.csv"
    path.write_text("a.b;a`c;a.b\n1;NA;3\n")
    assert tables.read_list(spark, str(path)).first().asDict() == {"a.b": "1", "a`c": None, "a.b.1": "3", "new_index": 1}
    path = tmp_path / "only.csv"
    path.write_text("a;b\n")
    assert tables.read_list(spark, str(path)).collect() == []
    folder = tmp_path / "two"
    folder.mkdir()
    for name in ("x.csv", "y.csv"):
        (folder / name).write_text("a\n1\n")
    with pytest.raises(ValueError, match="one file"):
        tables.read_list(spark, str(folder))
