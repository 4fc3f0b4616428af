from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import codes, dates, text
from ledgerline.functions.records import list_text, row_json


def mapped(table, function, *inputs):
    rows = [(str(i), v) for i, v in enumerate(inputs)]
    df = table(["i", "v"], *rows).select("i", function(F.col("v")).alias("out"))
    return [r["out"] for r in sorted(df.collect(), key=lambda r: int(r["i"]))]


def test_branch_has_empty_text_for_everything_else(table):
    assert mapped(table, codes.branch, "1", "2", "9", "", None) == ["Matriz", "Filial", "", "", ""]


def test_status(table):
    assert mapped(table, codes.status, "01", "02", "03", "04", "08", "99", None) == [
        "Nula", "Ativa", "Suspensa", "Inapta", "Baixada", None, None,
    ]


def test_size_leaves_04_unmapped(table):
    assert mapped(table, codes.size, "01", "02", "03", "05", "04", None) == [
        "NAO INFORMADO", "MICRO EMPRESA", "EMPRESA DE PEQUENO PORTE", "DEMAIS", None, None,
    ]


def test_partner_type(table):
    assert mapped(table, codes.partner_type, "1", "2", "3", "0", None) == [
        "PESSOA JURÍDICA", "PESSOA FÍSICA", "ESTRANGEIRO", None, None,
    ]


def test_age_band(table):
    labels = mapped(table, codes.age_band, *"0123456789", "10", None)
    assert labels == [
        "Não se aplica",
        "Entre 0 a 12 anos",
        "Entre 13 a 20 anos",
        "Entre 21 a 30 anos",
        "Entre 31 a 40 anos",
        "Entre 41 a 50 anos",
        "Entre 51 a 60 anos",
        "Entre 61 a 70 anos",
        "Entre 71 a 80 anos",
        "Maiores de 80 anos",
        None,
        None,
    ]


def test_parse_date(table):
    inputs = ["20210407", "0", "", "00000000", "20211301", "20210230", "2021040", "202104070", None]
    assert mapped(table, dates.parse_date, *inputs) == [date(2021, 4, 7)] + [None] * 8


def test_start_date_is_guarded_by_the_status_date(table):
    df = table(["status", "start"], ("0", "20210407"), ("20200101", "0"), (None, "20210407"))
    out = df.select(dates.parse_date(F.col("start"), guard=F.col("status")).alias("d")).collect()
    assert [r["d"] for r in out] == [None, None, date(2021, 4, 7)]


def test_strict_date_fails_on_text_whatever_the_session_says(spark, table):
    good = table(["v"], ("2021-04-07",), (None,)).select(dates.strict_date(F.col("v")).alias("d"))
    assert [r["d"] for r in good.collect()] == [date(2021, 4, 7), None]
    ansi = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for setting in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", setting)
            with pytest.raises(Exception, match="not a date: cnpj"):
                table(["v"], ("cnpj",)).select(dates.strict_date(F.col("v"))).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", ansi)


def test_repair(table):
    assert mapped(table, text.repair, "PARTICIPA��O", None) == ["PARTICIPAççO", None]


def cleaned(table, value):
    return mapped(table, lambda v: text.clean(F.encode(v, "ISO-8859-1")), value)[0]


def test_clean_keeps_the_class_and_is_idempotent(table):
    raw = '"0001";"SÃO JOSÉ & FILHOS (ME) \\ ç\'~";"a\rb";"x;y"\r\n'
    expected = '"0001";"SO JOS  FILHOS ME  ";"ab";"x;y"\n'
    assert cleaned(table, raw) == expected
    assert cleaned(table, expected) == expected
    assert cleaned(table, None) is None


def test_clean_is_the_pattern_on_every_byte(spark):
    df = spark.createDataFrame([(bytes([b]),) for b in range(256)], "raw binary")
    pattern = F.regexp_replace(text.decode_latin1(F.col("raw")), text.DROPPED_CHARACTERS, "")
    assert df.where(text.clean(F.col("raw")) != pattern).count() == 0
    kept = "".join(r[0] for r in df.select(text.clean(F.col("raw"))).collect())
    assert sorted(kept) == sorted({*"0123456789,-./:;<=>?@+_ \"\n", *map(chr, range(65, 91)), *map(chr, range(97, 123))})


def test_decode_latin1_accepts_every_byte(spark):
    df = spark.createDataFrame([(bytes(range(256)),)], "raw binary")
    assert df.select(text.decode_latin1(F.col("raw"))).first()[0] == bytes(range(256)).decode("latin-1")


def test_build_key_is_null_if_a_part_is(table):
    df = table(["a", "b", "c"], ("00000000", "0001", "91"), ("00000000", None, "91"))
    assert [r[0] for r in df.select(text.build_key("a", "b", "c")).collect()] == ["00000000000191", None]


def test_key_prefix_and_suffix(table):
    assert mapped(table, text.key_prefix, "12345678000191", None) == ["12345678", None]
    assert mapped(table, text.strip_suffix, "F.K.MUNICCSV.zip", ".zip", "ab") == ["F.K.MUNICCSV", "", ""]


def test_row_json_keeps_nulls_and_order(spark):
    df = spark.sql("select 'x' as b, cast(null as string) as pais, date'2021-04-07' as d, 'say \"hi\"' as q")
    assert df.select(row_json(["b", "pais", "d", "q"])).first()[0] == (
        '{"b":"x","pais":null,"d":"2021-04-07","q":"say \\"hi\\""}'
    )


def test_list_text(spark):
    df = spark.sql("select array('{1}', null, '{2}') as a union all select cast(null as array<string>)")
    assert [r[0] for r in df.select(list_text(F.col("a"))).collect()] == ["{1},{2}", None]
