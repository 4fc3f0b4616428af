import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import text
from ledgerline.schemas import DATASETS, ESTABLISHMENTS
from ledgerline.sources import archives, listing, register


def test_field_rules(spark, tmp_path):
    (tmp_path / "a.CSV").write_bytes(b'"a";"";;"x""y"\n"b";"e\\";"f";"lone\rreturn"\r\n')
    rows = register.scan_csv(spark, str(tmp_path), "abcd").collect()
    assert [tuple(r) for r in rows] == [("a", "", None, 'x"y'), ("b", "e\\", "f", "lone\rreturn")]


def test_first_line_is_data_and_malformed_lines_fail_unless_asked_for(spark, tmp_path):
    (tmp_path / "a.CSV").write_text("codigo;descricao\n1\n\n2;two;more\n")
    rows = register.scan_csv(spark, str(tmp_path), ("codigo", "descricao"), bad_records=True).collect()
    assert [tuple(r) for r in rows] == [("codigo", "descricao", None), ("1", None, "1"), ("2", "two", "2;two;more")]


@pytest.mark.parametrize("line", ["1", "1;2;3"])
def test_a_line_too_short_or_too_long_fails_every_query(spark, tmp_path, line):
    (tmp_path / "F.PAISCSV").write_text(f"1;one\n{line}\n")
    scanned = register.scan(spark, str(tmp_path), "countries")
    lines = register.scan_lines(spark, str(tmp_path)).select(F.col("line").cast("string").alias("line"))
    parsed = register.parse_lines(lines, ("codigo", "descricao"))
    for df in (scanned, scanned.select("codigo"), parsed):
        with pytest.raises(Exception, match="MALFORMED"):
            df.collect()


def test_scan_by_suffix_and_encoding(spark, tmp_path):
    (tmp_path / "F.K.QUALSCSV").write_bytes('"05";"PARTICIPAÇÃO"\n'.encode("latin-1"))
    (tmp_path / "F.K.PAISCSV").write_bytes(b'"105";"BRASIL"\n')
    default = register.scan(spark, str(tmp_path), "qualifications")
    assert [tuple(r) for r in default.collect()] == [("05", "PARTICIPA��O")]
    assert default.select(text.repair(F.col("descricao"))).first()[0] == "PARTICIPAççO"
    right = register.scan(spark, str(tmp_path), "qualifications", encoding="ISO-8859-1")
    assert [tuple(r) for r in right.collect()] == [("05", "PARTICIPAÇÃO")]


def establishment_line(**fields):
    return ";".join(f'"{fields[c]}"' if c in fields else "" for c in ESTABLISHMENTS)


def test_establishments_are_cleaned_before_they_are_parsed(spark, tmp_path):
    line = establishment_line(
        cnpj_basico="00000000", nome_fantasia="SÃO \r JOSÉ; (ME)", logradouro='RUA ""A""', telefone_2=""
    )
    blank = "\n  \n\r\n ç&\n"
    unquoted = "2" + ";" * 29 + "\n"
    (tmp_path / "K.ESTABELE").write_bytes((line + "\r\n" + blank + unquoted).encode("latin-1"))
    rows = register.scan_cleaned(spark, str(tmp_path), "establishments").collect()
    assert [r["cnpj_basico"] for r in rows] == ["00000000", "2"]
    row = rows[0]
    assert row["cnpj_basico"] == "00000000"
    assert row["nome_fantasia"] == "SO  JOS; ME"
    assert row["logradouro"] == 'RUA "A"'
    assert row["telefone_2"] == ""
    assert row["fax"] is None


def test_malformed_lines_are_found(spark, tmp_path):
    content = "1;one\n2\n3;three;3\n4;four\n"
    (tmp_path / "F.PAISCSV").write_text(content)
    lines = register.scan_lines(spark, str(tmp_path)).select(F.col("line").cast("string").alias("line"))
    by_line = register.parse_lines(lines, ("codigo", "descricao"), bad_records=True)
    by_file = register.scan(spark, str(tmp_path), "countries", bad_records=True)
    for df in (by_line, by_file):
        assert sorted(r["codigo"] for r in df.collect()) == ["1", "2", "3", "4"]
        bad = sorted(r[register.BAD_RECORD] for r in df.collect() if r[register.BAD_RECORD])
        assert bad == ["2", "3;three;3"]
    by_file.where("codigo in ('1', '4')").write.parquet(str(tmp_path / "good"))
    good = register.require_well_formed(spark.read.parquet(str(tmp_path / "good")))
    assert good.columns == ["codigo", "descricao"] and good.count() == 2
    by_file.write.parquet(str(tmp_path / "all"))
    with pytest.raises(register.MalformedError, match="3;three;3"):
        register.require_well_formed(spark.read.parquet(str(tmp_path / "all")))


def make_zip(path, **members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in members.items():
            z.writestr(name, content)


def test_archives_expand_route_and_land(spark, tmp_path):
    source = tmp_path / "download"
    source.mkdir()
    raw = '"1";"São"\n"2";"Não"'.encode("latin-1")
    make_zip(source / "K1.PAISCSV.zip", **{"K1.PAISCSV": raw, "notes.txt": b"extra\n"})
    make_zip(source / "K2 $Z.MUNICCSV.zip", **{"K2 $Z.MUNICCSV": b"\n\nx\n", "empty": b""})
    (source / "K3.CNAECSV.zip").write_bytes(b"no zip file at all")
    lines = archives.expand(archives.list_files(spark, str(source)))
    found = sorted((r["member"], r["line_no"], bytes(r["line"])) for r in lines.collect())
    assert found == [
        ("K1.PAISCSV", 0, '"1";"São"'.encode("latin-1")),
        ("K1.PAISCSV", 1, '"2";"Não"'.encode("latin-1")),
        ("K2 $Z.MUNICCSV", 0, b""),
        ("K2 $Z.MUNICCSV", 1, b""),
        ("K2 $Z.MUNICCSV", 2, b"x"),
        ("notes.txt", 0, b"extra"),
    ]
    routed = archives.route(lines)
    assert {(r["member"], r["dataset"]) for r in routed.collect()} == {
        ("K1.PAISCSV", "PAISCSV"), ("K2 $Z.MUNICCSV", "MUNICCSV"),
    }
    landing = str(tmp_path / "landing")
    archives.land(routed, landing)
    countries = register.scan(spark, landing, "countries", encoding="ISO-8859-1")
    assert sorted(tuple(r) for r in countries.collect()) == [("1", "São"), ("2", "Não")]


def test_members_longer_than_a_block_keep_their_lines(spark, tmp_path):
    content = b"\n".join(b"%d" % i * (i % 7 + 1) for i in range(900_000)) + b"\n" + b"z" * (9 << 20) + b"\nend"
    make_zip(tmp_path / "big.zip", big=content)
    lines = archives.expand(archives.list_files(spark, str(tmp_path)))
    got = lines.agg(F.count("*"), F.max("line_no"), F.sum(F.length("line")), F.max(F.length("line"))).first()
    expected = content.split(b"\n")
    assert tuple(got) == (len(expected), len(expected) - 1, sum(map(len, expected)), 9 << 20)


def test_listing_keeps_only_data_files(spark):
    page = """<html><!-- <a href="hidden.zip">x</a> --><a href="?C=N;O=D">n</a><A class=x HREF='/up'>up</A>
      <a href="Layout.pdf">l</a><a href="abc.zip">a</a><a name="here">no link</a><a href="">e</a>
      <script>var s = '<a href="script.zip">'</script>
      <a title="t" href="F.K.MUNICCSV.zip">m</a><a href=Bare.zip>b</a><a href="Q&amp;A.zip">q</a></html>"""
    pages = spark.createDataFrame([(page,)], "html string")
    found = [r["file_name"] for r in listing.list_links(pages).collect()]
    assert found == ["F.K.MUNICCSV.zip", "Bare.zip", "Q&A.zip"]


def test_list_files(spark, tmp_path):
    (tmp_path / "one").write_bytes(b"123")
    (tmp_path / "two").write_bytes(b"1")
    (tmp_path / "none").write_bytes(b"")
    files = archives.list_files(spark, str(tmp_path)).collect()
    assert sorted((r["path"].rsplit("/", 1)[1], r["length"]) for r in files) == [("one", 3), ("two", 1)]


def test_every_dataset_has_its_columns():
    widths = {name: len(d.columns) for name, d in DATASETS.items()}
    assert widths == {
        "qualifications": 2, "countries": 2, "legal_natures": 2, "cities": 2, "activities": 2,
        "companies": 7, "establishments": 30, "partners": 11,
    }
