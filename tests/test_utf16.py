"""UTF-16 exports in byte ranges: rows equal those of a plain reading, and files that can't be cut are read whole."""

from __future__ import annotations

import codecs

import pytest

from tulha.sources import utf16

MARK = {"UTF-16LE": codecs.BOM_UTF16_LE, "UTF-16BE": codecs.BOM_UTF16_BE}


def land(folder, name, text, encoding, mark=True):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes((MARK[encoding] if mark else b"") + text.encode(encoding, "surrogatepass"))
    return folder


def ways(spark, folder):
    return {r.path.rsplit("/", 1)[1]: (r.encoding, r.line_end) for r in utf16.split_ways(spark, str(folder)).collect()}


@pytest.fixture
def small_ranges(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1001")  # odd, so that ranges begin inside code units
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for key, setting in before.items():
        spark.conf.set(key, setting)


@pytest.mark.parametrize("last", ["", "end"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("encoding", list(MARK))
def test_one_file_is_many_tasks(spark, tmp_path, small_ranges, encoding, end, last):
    lines = [f'{i}\t"nº\t{i}"\t😀{"é€"[i % 2]}{chr(0x2200 + i % 2)}' for i in range(2000)]
    folder = land(tmp_path / "x y", "a b.txt", end.join(["Ano\tSérie\tNome", *lines]) + (end if last else ""), encoding)
    assert ways(spark, folder) == {"a%20b.txt": (encoding, end)}
    df = utf16.read_utf16_split(spark, str(folder))
    assert df.columns == ["ano", "serie", "nome"]
    assert df.rdd.getNumPartitions() > 50
    got = sorted(tuple(r) for r in df.collect())
    assert got == sorted((str(i), f"nº\t{i}", f"😀{'é€'[i % 2]}{chr(0x2200 + i % 2)}") for i in range(2000))


@pytest.mark.parametrize("encoding", list(MARK))
@pytest.mark.parametrize(
    "cell",
    [
        "Ċ",  # the byte of a line end inside a letter
        "ਅ",
        "ਅĀ",  # the bytes of a line end across two letters
        "ਅਅĀ　",
        '"two\nlines"',
        '"two ""quoted""\nlines"',
        '5" pipe',
    ],
)
def test_other_files_are_read_whole(spark, tmp_path, small_ranges, encoding, cell):
    text = "Ano\tNome\n" + "".join(f"{i}\tplain\n" for i in range(300)) + f"300\t{cell}\tx\n".replace("\tx", "")
    folder = land(tmp_path / "odd", "a.txt", text, encoding)
    land(folder, "b.txt", "Ano\tNome\n" + "".join(f"{i}\tsplit\n" for i in range(1000, 1300)), encoding)
    assert ways(spark, folder) == {"a.txt": (None, None), "b.txt": (encoding, "\n")}
    got = {r.ano: r.nome for r in utf16.read_utf16_split(spark, str(folder), escape='"').collect()}
    assert len(got) == 601
    shown = cell[1:-1].replace('""', '"') if cell.startswith('"') else cell
    assert got["300"] == shown
    assert got["1299"] == "split"


def test_marks_and_line_ends(spark, tmp_path):
    folder = tmp_path / "marks"
    land(folder, "none.txt", "Ano\n1\n", "UTF-16BE", mark=False)
    land(folder, "mixed.txt", "Ano\r\n1\n2\r\n", "UTF-16LE")
    land(folder, "inside.txt", "Ano\n1\r2\n", "UTF-16LE")
    land(folder, "header.txt", "Ano", "UTF-16LE")
    land(folder, "header_end.txt", "Ano\r\n", "UTF-16BE")
    land(folder, "only_mark.txt", "", "UTF-16LE")
    (folder / "empty.txt").write_bytes(b"")
    got = ways(spark, folder)
    # A file without a byte has no piece, and so no row.
    assert got == {
        "none.txt": (None, None),
        "mixed.txt": (None, None),
        "inside.txt": (None, None),
        "header.txt": ("UTF-16LE", "\n"),
        "header_end.txt": ("UTF-16BE", "\r\n"),
        "only_mark.txt": ("UTF-16LE", "\n"),
    }
