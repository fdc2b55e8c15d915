import sys
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tulha.functions.names import column_name, column_names, conform_columns, fold_accents, mentions, plain_slug, slug, spaced


def ascii_of(text):
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()


def test_folding_every_character(spark):
    """Each code point alone, and between letters, against the standard library."""
    points = [c for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF and (c < 0x3000 or 0xA640 <= c < 0xAC00 or 0xF900 <= c <= 0x10000 or 0x1D400 <= c < 0x1F800)]
    df = spark.createDataFrame([(f"a{chr(c)}b",) for c in points], "t string")
    wrong = [r for r in df.select("t", fold_accents(F.col("t")).alias("f")).collect() if r.f != ascii_of(r.t)]
    assert not wrong[:5]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=50, max_size=100))
def test_slugs_of_random_text(spark, texts):
    texts = [t for t in texts if "\0" not in t]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    for r in df.select("t", slug(F.col("t")).alias("s"), spaced(F.col("t")).alias("p")).collect():
        if r.t is None:
            assert r.s is None and r.p is None
        else:
            assert r.s == plain_slug(r.t) and r.p == plain_slug(r.t).replace("_", " ")


def test_slug_examples(spark):
    examples = {
        "Área Colhida (ha)": "area_colhida_ha",
        "Produção (ton)": "producao_ton",
        "Valor da Produção (R$ 1000)": "valor_da_producao_r_1000",
        "2º Levantamento": "2o_levantamento",
        "—": "",
    }
    df = spark.createDataFrame([(t,) for t in examples], "t string")
    assert {r.t: r.s for r in df.select("t", slug(F.col("t")).alias("s")).collect()} == examples


def test_column_names():
    header = ["qtd_capacidade_estatica(t)", "A\0n\0o\0", None, "  ", "2022", "Código", "CODIGO", "codigo_2", "código", "()"]
    assert column_names(header) == [
        "qtd_capacidade_estatica_t", "ano", "column", "column_2", "col_2022", "codigo", "codigo_2", "codigo_2_2", "codigo_3", "column_3",
    ]
    assert column_name("Quantidade (mil t)") == "quantidade_mil_t"


def test_conform_is_lazy_projection(spark):
    df = conform_columns(spark.range(1).select(F.lit(1).alias("Ação"), F.lit(2).alias("ACAO")))
    assert df.columns == ["acao", "acao_2"]


def test_short_terms_need_word_boundaries(spark):
    texts = {"pesquisa ppm 2020": True, "apppmx": False, "efetivo pecuaria municipal": True, "ppm": True, "agricola": False}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.m for r in df.select("t", mentions(F.col("t"), ["pecuaria municipal", "ppm"]).alias("m")).collect()}
    assert got == texts
