import io
import zipfile

import pytest
from pyspark.sql import functions as F

from tulha.functions.html import decode_references
from tulha.plans.ingest import ingest_file
from tulha.session import fresh_database
from tulha.sources import delimited, mixed, portal, responses, stations, tables

COLUMNS = {"data": "string", "temperatura_c": "double", "chuva_mm": "double"}


def station_text(header, rows):
    return "\r\n".join([f"LINHA {i};x" for i in range(8)] + [header] + rows) + "\r\n"


def test_semicolon_latin1_infers_types(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("Código;Município;qtd(t)\n1;São João;2,5\n2;Itú;3\n".encode("latin-1"))
    (tmp_path / "b.txt").write_bytes("Código;Município;qtd(t)\n3;Ceará;4\n".encode("latin-1"))
    df = delimited.read_semicolon_latin1(spark, str(tmp_path), infer=True)
    assert df.dtypes == [("codigo", "int"), ("municipio", "string"), ("qtd_t", "string")]
    assert {r.municipio for r in df.collect()} == {"São João", "Itú", "Ceará"}


def test_declared_schema_must_match_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    assert delimited.read_comma_csv(spark, str(tmp_path), schema="a int, b double").first() == (1, 2.0)
    with pytest.raises(Exception, match="does not conform"):
        delimited.read_comma_csv(spark, str(tmp_path), schema="x int, b double").collect()


def test_decimal_comma_file(spark, tmp_path):
    (tmp_path / "p.txt").write_bytes("UF;Preço;Nota\nSP;1234,56;a\nRJ; ;NA\nMG;NaN; \n".encode("latin-1"))
    rows = {r.uf: (r.preco, r.nota) for r in delimited.read_decimal_comma(spark, str(tmp_path), ["preco"]).collect()}
    assert rows == {"SP": (1234.56, "a"), "RJ": (None, None), "MG": (None, None)}


@pytest.mark.parametrize("encoding", ["utf-16", "utf-16-le"])
def test_utf16_export(spark, tmp_path, encoding):
    text = "Ano\tUF\tQuantidade (mil t)\n2020\tSão Paulo\t12.5\n2021\tCeará\t13\n"
    data = text.encode(encoding) if encoding == "utf-16" else b"\xff\xfe" + text.encode(encoding)
    (tmp_path / "e.xls").write_bytes(data)
    df = delimited.read_utf16_export(spark, str(tmp_path), infer=True)
    assert df.columns == ["ano", "uf", "quantidade_mil_t"]
    assert sorted(df.collect()) == [(2020, "São Paulo", 12.5), (2021, "Ceará", 13.0)]


def test_extension_dispatch(spark, tmp_path):
    (tmp_path / "a.txt").write_text("a;b\n1;2\n")
    assert delimited.read_landed_file(spark, str(tmp_path), ".TXT").columns == ["a", "b"]
    with pytest.raises(ValueError, match="unsupported"):
        delimited.read_landed_file(spark, str(tmp_path), "pdf")


def test_station_files_with_differing_headers(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    one = station_text('Data;Temperatura (°C);Chuva (mm);', ["2024/01/01;25,4;0;", "2024/01/02;;1,2;", ""])
    two = station_text('CHUVA (MM);Data;"Outra; coluna"', ['3,5;"2024;01";x', ";2024/01/04;y"])
    (tmp_path / "A.CSV").write_bytes(one.encode("latin-1"))
    (tmp_path / "sub" / "b.csv").write_bytes(two.encode("latin-1"))
    (tmp_path / "sub" / "notes.txt").write_text("skip me")
    rows = stations.read_station_files(spark, str(tmp_path), COLUMNS).drop("path").collect()
    assert sorted(map(tuple, rows), key=str) == sorted(
        [
            ("2024/01/01", 25.4, 0.0, "A.CSV"),
            ("2024/01/02", None, 1.2, "A.CSV"),
            ("2024;01", None, 3.5, "b.csv"),
            ("2024/01/04", None, None, "b.csv"),
        ],
        key=str,
    )


def test_columns_found_from_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(station_text("Data;1º Valor;Nota;", ["2024/01/01;1,5;a", "2024/01/02;;2"]).encode("latin-1"))
    (tmp_path / "b.csv").write_bytes(station_text("Vento;DATA", ["3;x"]).encode("latin-1"))
    files = stations.read_binary_files(spark, str(tmp_path))
    assert stations.station_columns(files) == {"col_1o_valor": "double", "data": "string", "nota": "string", "vento": "double"}
    rows = sorted(map(tuple, stations.read_station_files(spark, str(tmp_path)).drop("path").collect()), key=str)
    assert rows == [(1.5, "2024/01/01", "a", None, "a.csv"), (None, "2024/01/02", "2", None, "a.csv"), (None, "x", None, 3.0, "b.csv")]


def test_decimal_columns_found(spark, tmp_path):
    (tmp_path / "p.txt").write_bytes("UF;Preço;Vazia;Mista\nSP;1234,56;;1\nRJ; ;NA;1.5\n".encode("latin-1"))
    df = delimited.read_decimal_comma(spark, str(tmp_path))
    assert df.dtypes == [("uf", "string"), ("preco", "double"), ("vazia", "double"), ("mista", "string")]


def test_archives(spark, tmp_path):
    for name in ("x.zip", "y.ZIP"):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as archive:
            archive.writestr("2024/est.CSV", station_text("Data;Chuva (mm)", ["2024/01/01;1,5"]).encode("latin-1"))
            archive.writestr("leia.txt", "nota")
            archive.writestr("../fora.csv", "nada")
            archive.writestr("/abs.csv", "nada")
        (tmp_path / name).write_bytes(out.getvalue())
    members = stations.expand_archives(stations.read_binary_files(spark, str(tmp_path), "*.[zZ][iI][pP]"))
    assert sorted(r.path for r in members.collect()) == ["2024/est.CSV", "2024/est.CSV", "leia.txt", "leia.txt"]
    rows = stations.read_archived_station_files(spark, str(tmp_path), COLUMNS).collect()
    assert [(r.data, r.chuva_mm, r.arquivo_origem) for r in rows] == [("2024/01/01", 1.5, "est.CSV")] * 2


PAGE = """<html><head><script>var x='<h4>não</h4><a href="/downloads/arquivos/n.txt">n</a>'</script></head><body>
<a href="/downloads/arquivos/antes.txt">Antes</a>
<h4 class="t"> Armazenamento <b>e Logística</b></h4><!-- <a href="/downloads/arquivos/oculto.txt">Oculto</a> -->
<div><a class=x href="/downloads/arquivos/Armazens.TXT">- Armazenagem</a>
<a href='https://outro.org/downloads/arquivos/S%C3%A9rie.xls'>-- <i>Série</i> hist&oacute;rica </a>
<a href="/downloads/arquivos/vazio.txt"> - </a><a href="/sobre.html">Sobre</a></div>
<h4>!!</h4><a href="/downloads/arquivos/sem.txt">Sem categoria</a>
<H4>Pre&ccedil;os &amp; custos</H4><a id="1" href="../downloads/arquivos/custo.csv?a=1&amp;b=2">Custo de produ&#231;&#227;o</a>
</body></html>"""


def test_page_links(spark):
    pages = spark.createDataFrame([("http://portal.org/a/lista.html", PAGE), ("http://vazio.org/", "<p>nada</p>")], "url string, html string")
    rows = [tuple(r)[2:] for r in portal.page_links(pages).orderBy("section", "position").collect()]
    assert rows == [
        ("armazenamentoe_logistica", "armazenagem", "Armazenagem", "http://portal.org/downloads/arquivos/Armazens.TXT", "txt"),
        ("armazenamentoe_logistica", "seriehistorica", "Sériehistórica", "https://outro.org/downloads/arquivos/S%C3%A9rie.xls", "xls"),
        ("precos_custos", "custo_de_producao", "Custo de produção", "http://portal.org/downloads/arquivos/custo.csv?a=1&b=2", "csv?a=1&b=2"),
    ]


def test_whole_file_and_line_responses(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": "1",\n "nome": "x", "agregados": []}]')
    df = responses.read_landed_text(spark, str(tmp_path), whole_file=True)
    parsed = responses.parse_body(df, responses.CATALOGUE_SCHEMA).first()
    assert parsed.source_file == "a.json" and parsed.parsed[0].nome == "x"
    assert responses.read_landed_text(spark, str(tmp_path)).count() == 2


def test_inventory_needs_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS vazio_inventario")
    with pytest.raises(ValueError):
        tables.table_inventory(spark, ["vazio_inventario"])
    empty = tables.profile_table(spark.range(0).withColumn("x", F.lit(None).cast("string")), "t").first()
    assert empty.n_rows == 0 and empty.null_ratio is None and empty.last_ingest_ts is None


def test_repeated_and_blank_station_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(station_text("Data;Chuva;Chuva;;Vento;", ["2024/01/01;1,5;2;x;3;"]).encode("latin-1"))
    files = stations.read_binary_files(spark, str(tmp_path))
    kinds = {"data": "string", "chuva": "double", "chuva_2": "double", "column": "string", "vento": "double"}
    assert stations.station_columns(files) == kinds
    row = stations.parse_station_files(files, kinds, rejected="_r").first()
    assert (row.chuva, row.chuva_2, row.column, row.vento, row._r) == (1.5, 2.0, "x", 3.0, [])


def test_unreadable_decimals_are_listed(spark, tmp_path):
    (tmp_path / "a.txt").write_text("uf;preco\nSP;1.234,56\nRJ;2,5\nMG;N/A\n", encoding="latin-1")
    got = delimited.read_decimal_comma(spark, str(tmp_path), ["preco"], rejected="_r").orderBy("uf").collect()
    assert [(r.uf, r.preco, r._r) for r in got] == [("MG", None, []), ("RJ", 2.5, []), ("SP", None, ["preco"])]


def test_references(spark):
    pairs = {
        "&#128512;": "😀", "&#99999;": chr(99999), "&#x1F600;": "😀", "PRODU&Ccedil;&Atilde;O": "PRODUÇÃO", "&#38;lt;": "&lt;", "&amp;amp;": "&amp;",
        "&ordm;&nada; & x": "º&nada; & x", "&#0;&#55296;&#1114112;": "&#0;&#55296;&#1114112;", "sem": "sem", "": "",
    }
    df = spark.createDataFrame(list(pairs.items()), "t string, quer string")
    assert [r.quer for r in df.where(decode_references(F.col("t")) != F.col("quer")).collect()] == []


def _mixed(spark, folder, sep=";", encoding="ISO-8859-1", **options):
    good, bad = mixed.read_mixed_headers(spark, str(folder), sep, encoding, **options)
    return good.drop("_source_file").collect(), bad.collect()


def test_lines_of_many_quoted_cells(spark, tmp_path):
    (tmp_path / "a.txt").write_text("a;b\n" + ";".join(f'"a;{i}"' for i in range(5000)) + "\n1;2\n")
    good, bad = _mixed(spark, tmp_path)
    assert [tuple(r) for r in good] == [("1", "2")]
    assert [r["_motivo"] for r in bad] == ["5000 celulas para 2 colunas"]
    long_lines = [("x" * 1_000_000 + ";" + '"q;q";' * 100_000,)]
    cells = spark.createDataFrame(long_lines, "line string").select(F.size(mixed.cells_of(F.col("line"), ";"))).first()[0]
    assert cells == 100_002


def test_cells_of_odd_lines(spark):
    lines = {
        "a;b": ["a", "b"], "": [""], ";": ["", ""], '"a;b";c': ["a;b", "c"], 'a;"b""c;d"': ["a", 'b"c;d'], 'pipe 5";x': ['pipe 5"', "x"],
        'x;"open;y': ["x", '"open', "y"], ' "a" ;b': ["a", "b"], '"";b': ["", "b"], 'a"b;c"d;e': ['a"b;c"d', "e"],
    }
    rows = spark.createDataFrame([(k,) for k in lines], "line string").select("line", mixed.cells_of(F.col("line"), ";").alias("cells")).collect()
    assert {r.line: r.cells for r in rows} == lines
    assert spark.createDataFrame([("a|b.c",)], "line string").select(mixed.cells_of(F.col("line"), "|")).first()[0] == ["a", "b.c"]


def test_no_line_is_lost(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("a;b\n1;2\na;b\n3;4\n\n5;x\x01kept\n6;ç\r\n7\n8;\"open\n".encode("latin-1"))
    good, bad = _mixed(spark, tmp_path)
    assert sorted(tuple(r) for r in good) == [("1", "2"), ("3", "4"), ("5", "x\x01kept"), ("6", "ç"), ("8", '"open')]
    assert [(r.line, r["_motivo"], r["_source_file"]) for r in bad] == [("7", "1 celulas para 2 colunas", "a.txt")]


def test_repeated_headers_are_alike_in_every_block(spark, tmp_path):
    lines = [f"{i};{'x' * 50}" for i in range(4000)]
    for at in (10, 3900):
        lines.insert(at, "n;texto")
    (tmp_path / "a.csv").write_text("\n".join(["n;texto", *lines]) + "\n")
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    try:
        for size in ("16k", before):
            spark.conf.set(setting, size)
            good, bad = _mixed(spark, tmp_path, encoding="UTF-8")
            assert bad == []
            assert sorted(int(r.n) for r in good) == list(range(4000))
    finally:
        spark.conf.set(setting, before)


def test_rejects_are_counted_by_the_write(spark, tmp_path):
    """Every path of the write: create, append, new column, type conflict."""
    db = fresh_database(spark, "teste")
    loads = {"um": "a;b\n1;2\n3\n", "dois": "a;b\n1;2\n", "tres": "a;b;c\n1;2;3\n4;5\n6\n"}
    for name, text in loads.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / f"{name}.txt").write_text(text)
        ingest_file(spark, str(tmp_path / name), "txt", f"{db}.t", name, "2024-01-01 00:00:00")
    assert spark.table(f"{db}.t").count() == 3
    lost = spark.table(f"{db}.t_rejeitadas").groupBy("_batch_id").count().collect()
    assert {tuple(r) for r in lost} == {("um", 1), ("tres", 2)}
    spark.sql(f"CREATE TABLE {db}.c (a int) USING parquet")
    assert ingest_file(spark, str(tmp_path / "um"), "txt", f"{db}.c", "c", "2024-01-01 00:00:00").path == "recreate"
    assert spark.table(f"{db}.c_rejeitadas").count() == 1
