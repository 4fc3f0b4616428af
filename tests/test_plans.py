"""Transforms on small register rows, with results worked out by hand."""

import functools
import json
import zipfile
from collections import Counter
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators.fold import OversizeError
from ledgerline.plans import gates, load
from ledgerline.plans.partners import partner_rows, partners_in_parts, partners_json, partners_with_chunks, records_gate
from ledgerline.plans.publish import Tables, next_version, publish, rollback, served_chunks, versions
from ledgerline.plans.refresh import hand_over, refresh
from ledgerline.plans.wide import registry_wide, registry_wide_v1, registry_wide_v2
from ledgerline.schemas import COMPANIES, DATASETS, ESTABLISHMENTS, LOOKUP, PARTNERS, WIDE, WIDE_V1, typed_wide_schema
from ledgerline.sinks import audit, export, tables
from ledgerline.sources import archives
from ledgerline.sources.register import MalformedError
from ledgerline.workspace import Workspace


@pytest.fixture
def rows(table):
    """Rows of a register table from dicts; what is not given is NULL."""

    def build(columns, *dicts):
        return table(columns, *([d.get(c) for c in columns] for d in dicts))

    return build


@pytest.fixture
def reg(rows, table):
    return {
        "qualifications": table(LOOKUP, ("05", "Administra��o"), ("49", "S�cio")),
        "countries": table(LOOKUP, ("105", "BRASIL")),
        "legal_natures": table(LOOKUP, ("2062", "Sociedade Empres�ria")),
        "cities": table(LOOKUP, ("7107", "SAO PAULO")),
        "activities": table(LOOKUP, ("6201", "Programa��o")),
        "companies": rows(
            COMPANIES,
            {"cnpj_basico": "1", "razao_social": "UM", "natureza_juridica": "2062", "porte_empresa": "05",
             "capital_social": "10,00"},
            {"cnpj_basico": "2", "razao_social": "DOIS", "natureza_juridica": "9", "porte_empresa": "04"},
        ),
        "establishments": rows(
            ESTABLISHMENTS,
            {"cnpj_basico": "1", "cnpj_ordem": "0001", "cnpj_dv": "91", "identificador_matriz_filial": "1",
             "situacao_cadastral": "02", "data_situacao_cadastral": "20210407", "data_inicio_atividade": "20200101",
             "cnae_fiscal_principal": "6201", "municipio": "7107", "uf": "SP", "tipo_logradouro": "RUA"},
            {"cnpj_basico": "1", "cnpj_ordem": "0002", "cnpj_dv": "72", "identificador_matriz_filial": "2",
             "data_situacao_cadastral": "0", "data_inicio_atividade": "20200101"},
            {"cnpj_basico": "2", "cnpj_ordem": "0001", "cnpj_dv": "10"},
            {"cnpj_basico": "3", "cnpj_ordem": "0001", "cnpj_dv": "11"},
            {"cnpj_basico": "3", "cnpj_ordem": None, "cnpj_dv": "12"},
        ),
        "partners": rows(
            PARTNERS,
            {"cnpj_basico": "1", "identificador_socio": "2", "nome_socio": "ANA", "cpf_cnpj_socio": "***1**",
             "qualificacao_socio": "49", "data_entrada_sociedade": "20200101", "representante_legal": "***0**",
             "qualificacao_representante": "05", "faixa_etaria": "4"},
            {"cnpj_basico": "1", "identificador_socio": "1", "nome_socio": "BETA", "cpf_cnpj_socio": "2",
             "qualificacao_socio": "99", "data_entrada_sociedade": "0", "pais": "105"},
            {"cnpj_basico": "3", "nome_socio": "CAIO", "cpf_cnpj_socio": "3"},
        ),
    }


def folded(reg):
    return partners_json(reg["partners"], reg["qualifications"], reg["countries"])


def wide(reg, **options):
    names = ("establishments", "companies", "activities", "cities", "legal_natures")
    return registry_wide(*(reg[n] for n in names), folded(reg), **options)


def test_partner_rows_use_the_partners_own_qualification_for_the_representative(reg):
    ana = partner_rows(reg["partners"], reg["qualifications"], reg["countries"]).where("nome_socio = 'ANA'").first()
    assert ana["qualificacao_socio"] == ana["qualificacao_representante"] == "Sçcio"
    assert (ana["identificador_socio"], ana["faixa_etaria"]) == ("PESSOA FÍSICA", "Entre 31 a 40 anos")
    assert ana["data_entrada_sociedade"] == date(2020, 1, 1) and ana["pais"] is None


def test_fixed_representative(reg):
    fixed = partner_rows(reg["partners"], reg["qualifications"], reg["countries"], fix_representative=True)
    assert fixed.where("nome_socio = 'ANA'").first()["qualificacao_representante"] == "Administraçço"


def test_partners_are_json_objects_in_an_array(reg):
    by_key = {r["cnpj_basico"]: [json.loads(s) for s in r["socios_json"]] for r in folded(reg).collect()}
    assert {k: sorted(p["nome_socio"] for p in v) for k, v in by_key.items()} == {"1": ["ANA", "BETA"], "3": ["CAIO"]}
    beta = next(p for p in by_key["1"] if p["nome_socio"] == "BETA")
    assert beta["pais"] == "BRASIL" and beta["qualificacao_socio"] is None and beta["data_entrada_sociedade"] is None
    assert list(beta)[:3] == ["cnpj_basico", "identificador_socio", "nome_socio"] and len(beta) == 10


def test_wide_rows(reg):
    out = wide(reg)
    assert out.columns == list(WIDE) and out.dtypes == [(f.name, f.dataType.simpleString()) for f in typed_wide_schema()]
    found = {r["cnpj"]: r for r in out.collect()}
    assert len(found) == 5 and None in found
    first = found["1000191"]
    assert first["matriz_filial"] == "Matriz" and first["desc_situacao_cadastral"] == "Ativa"
    assert first["data_situacao_cadastral"] == date(2021, 4, 7) and first["data_inicio_atividade"] == date(2020, 1, 1)
    assert first["nome_cnae_principal"] == "Programaçço"
    assert first["nome_municipio"] == "SAO PAULO" and first["porte"] == "DEMAIS"
    assert first["natureza_juridica"] == "Sociedade Empresçria" and first["capital_social"] == "10,00"
    assert first["cnpj_basico"] == "1"
    assert first["socios_json"].count("},{") == 1 and first["socios_json"][0] == "{"
    second = found["1000272"]
    assert second["matriz_filial"] == "Filial" and second["data_inicio_atividade"] is None
    assert second["socios_json"] == first["socios_json"]
    # A company without partners, and an unmapped size and legal nature.
    third = found["2000110"]
    assert third["cnpj_basico"] is None and third["socios_json"] is None
    assert (third["razao_social"], third["porte"], third["natureza_juridica"]) == ("DOIS", None, None)
    assert third["matriz_filial"] == ""
    # An establishment without company.
    fourth = found["3000111"]
    assert (fourth["razao_social"], fourth["cnpj_basico"]) == (None, "3")


def test_start_guard_can_be_fixed(reg):
    found = {r["cnpj"]: r["data_inicio_atividade"] for r in wide(reg, fix_start_guard=True).collect()}
    assert found["1000272"] == date(2020, 1, 1)


def test_wide_is_the_same_with_hot_keys_split_and_nothing_broadcast(reg):
    expected = Counter(tuple(r) for r in wide(reg).collect())
    assert Counter(tuple(r) for r in wide(reg, hot_rows=1, max_bytes=0).collect()) == expected


def test_repeated_codes_repeat_rows_until_the_typed_load(reg, table):
    reg["cities"] = table(LOOKUP, ("7107", "SAO PAULO"), ("7107", "S. PAULO"))
    out = wide(reg)
    assert out.where("cnpj = '1000191'").count() == 2
    typed = load.typed(out.select(*(F.col(c).cast("string") for c in WIDE)))
    assert [r["nome_municipio"] for r in typed.where("cnpj = '1000191'").collect()] == ["S. PAULO"]


def test_editions(reg):
    names = ("establishments", "companies", "activities", "cities", "legal_natures")
    first = registry_wide_v1(*(reg[n] for n in names))
    assert first.columns == list(WIDE_V1) and len(WIDE_V1) == 25
    assert Counter(map(tuple, first.collect())) == Counter(map(tuple, wide(reg).select(*WIDE_V1).collect()))
    keyed = first.withColumn("cnpj", F.concat(F.lit("0000000"), "cnpj"))
    partners = folded(reg).withColumn("cnpj_basico", F.concat(F.lit("0000000"), "cnpj_basico"))
    second = registry_wide_v2(keyed, partners)
    assert second.columns == [*WIDE_V1, "cnpj_basico", "socios_json"]
    assert {r["cnpj"]: r["socios_json"] and len(r["socios_json"]) for r in second.collect()} == {
        "00000001000191": 2, "00000001000272": 2, "00000002000110": None, "00000003000111": 1, None: None,
    }


def test_hand_over_through_shards_with_headers(spark, reg, tmp_path):
    source = wide(reg)
    path = export.export_csv(source.repartition(3), str(tmp_path / "export"))
    staged = load.stage(spark, path)
    headers = staged.where("cnpj = 'cnpj'").count()
    assert headers >= 2 and staged.count() == 5 + headers
    gates.require(gates.row_count_gate(staged, source))
    typed = load.typed(staged)
    assert typed.schema == typed_wide_schema()
    keyed = source.where("cnpj is not null")
    assert Counter(map(tuple, typed.collect())) == Counter(map(tuple, keyed.collect()))
    gates.require(gates.distinct_key_gate(typed, source, "cnpj"))


def test_export_round_trip_keeps_empty_null_quotes_and_blanks(spark, table, tmp_path):
    df = table(["a", "b", "c"], ("", None, ' x ;"y",\\'), (None, "", "{\"k\":\"v\"},{}"), ("1", "2", "ç�"))
    path = export.export_csv(df, str(tmp_path / "e"))
    back = export.read_as_one(spark, path, ["a", "b", "c"]).where("a is null or a <> 'a'")
    assert Counter(map(tuple, back.collect())) == Counter(map(tuple, df.collect()))
    assert [p.name.endswith(".csv.gz") for p in (tmp_path / "e").glob("part-*")].count(True) >= 1


def test_typed_keeps_existing_rows(spark, rows, reg):
    existing = load.typed(rows(WIDE, {"cnpj": "1", "uf": "AA"}))
    out = load.typed(rows(WIDE, {"cnpj": "1", "uf": "BB"}, {"cnpj": "2", "uf": "CC"}), existing=existing)
    assert {r["cnpj"]: r["uf"] for r in out.collect()} == {"1": "AA", "2": "CC"}


def test_gates(table):
    three = table(["cnpj"], ("1",), ("2",), ("3",))
    four = table(["cnpj"], ("1",), ("2",), ("3",), ("cnpj",))
    two = table(["cnpj"], ("1",), ("2",))
    assert gates.require(gates.row_count_gate(three, three)) == (3, 3)
    assert gates.require(gates.row_count_gate(four, three)) == (4, 3)
    with pytest.raises(gates.GateError, match="loaded 2 rows, expected 3"):
        gates.require(gates.row_count_gate(two, three))
    repeated = table(["cnpj"], ("1",), ("1",), ("2",), (None,))
    assert gates.require(gates.distinct_key_gate(two, repeated, "cnpj")) == (2, 2)
    with pytest.raises(gates.GateError):
        gates.require(gates.distinct_key_gate(three, repeated, "cnpj"))


def test_publish_and_rollback(spark, table, values):
    names = Tables(f"{Workspace(spark, 'publish').database()}.registry")

    def version(v):
        tables.replace_table(table(["cnpj"], (v,)), names.stage)
        tables.replace_table(table(["cnpj"], (v,)), names.new)
        publish(spark, names)

    version("v1")
    assert values(spark.table(names.served)) == ["v1"]
    assert not spark.catalog.tableExists(names.backup) and not spark.catalog.tableExists(names.stage)
    with pytest.raises(LookupError):
        rollback(spark, names)
    with pytest.raises(LookupError):
        publish(spark, names)
    assert values(spark.table(names.served)) == ["v1"]
    version("v2")
    version("v3")
    assert values(spark.table(names.served)) == ["v3"] and values(spark.table(names.backup)) == ["v2"]
    rollback(spark, names)
    assert values(spark.table(names.served)) == ["v2"] and values(spark.table(names.error)) == ["v3"]
    assert not spark.catalog.tableExists(names.backup)


def test_something_is_served_at_every_moment(spark, table, values, monkeypatch):
    names = Tables(f"{Workspace(spark, 'moments').database()}.registry")
    seen = []

    def read():
        seen.append(values(spark.table(names.served)))

    def version(v):
        tables.replace_table(table(["cnpj"], (v,)), name := next_version(spark, names))
        return name

    publish(spark, names, version("v1"))
    begun = spark.table(names.served)
    sql = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: (read(), sql(self, text, *a, **k), read())[1])
    publish(spark, names, version("v2"))
    # All of the old or all of the new, the new once it was there; a reader that had begun goes on.
    assert {tuple(s) for s in seen} == {("v1",), ("v2",)} and seen == sorted(seen)
    assert values(begun) == ["v1"]
    publish(spark, names, version("v3"))
    seen.clear()
    rollback(spark, names)
    assert {tuple(s) for s in seen} == {("v3",), ("v2",)} and seen == sorted(seen, reverse=True)
    # The error's version is kept, and the next one does not go over it.
    publish(spark, names, version("v4"))
    assert values(spark.table(names.error)) == ["v3"] and values(spark.table(names.backup)) == ["v2"]
    with pytest.raises(ValueError, match="served already"):
        publish(spark, names, versions(spark, names)["registry.version"])
    monkeypatch.undo()
    # One change of the catalog moves the served rows and the backup together.
    pointer = spark.sql(f"SHOW TBLPROPERTIES {names.served}").collect()
    assert {r["key"] for r in pointer} >= {"registry.version", "registry.backup", "registry.error"}


def test_a_run_that_ends_after_the_pointer_moved_is_mended(spark, table, values, monkeypatch):
    names = Tables(f"{Workspace(spark, 'broken').database()}.registry")
    for v in ("v1", "v2"):
        tables.replace_table(table(["cnpj"], (v,)), names.new)
        publish(spark, names)
    tables.replace_table(table(["cnpj"], ("v3",)), names.new)
    monkeypatch.setattr("ledgerline.plans.publish._follow", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        publish(spark, names)
    monkeypatch.undo()
    assert values(spark.table(names.served)) == ["v3"]
    rollback(spark, names)
    assert values(spark.table(names.served)) == ["v2"] and values(spark.table(names.error)) == ["v3"]


def test_a_served_table_of_an_older_release_becomes_a_version(spark, table, values):
    names = Tables(f"{Workspace(spark, 'older').database()}.registry")
    tables.replace_table(table(["cnpj"], ("old",)), names.served)
    tables.replace_table(table(["cnpj"], ("older",)), names.backup)
    tables.replace_table(table(["cnpj"], ("new",)), names.new)
    publish(spark, names)
    assert values(spark.table(names.served)) == ["new"] and values(spark.table(names.backup)) == ["old"]


def test_gates_of_a_refresh_read_nothing_again(spark, reg, monkeypatch):
    space = Workspace(spark, "observed")
    database = space.database()
    counting = gates.Counting(wide(reg), load.KEY)
    source = tables.replace_table(counting.rows, f"{database}.source", typed_wide_schema())
    expected = counting.found()
    assert expected.rows == source.count() and expected.keyed == source.where("cnpj IS NOT NULL").count()

    # Both gates, from the end of the write on, start no job.
    started, context = [], spark.sparkContext

    def jobs(check):
        def checked(*args):
            before = set(context.statusTracker().getJobIdsForGroup("gates"))
            result = check(*args)
            started.append(set(context.statusTracker().getJobIdsForGroup("gates")) - before)
            return result

        return checked

    monkeypatch.setattr(gates.Counting, "found", jobs(gates.Counting.found))
    for name in ("require_staged", "require_typed"):
        monkeypatch.setattr(gates, name, jobs(getattr(gates, name)))
    context.setJobGroup("gates", "gates")
    try:
        hand_over(spark, source, expected, space, Tables(f"{database}.registry"))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert context.statusTracker().getJobIdsForGroup("gates")
    assert started == [set()] * 4


@pytest.mark.parametrize("fault", ["a row less", "a row twice for another", "a changed key", "none"])
@pytest.mark.parametrize("through_files", [True, False])
def test_a_fault_on_the_way_stops_a_refresh(spark, reg, monkeypatch, fault, through_files):
    space = Workspace(spark, "faults")
    database = space.database()
    counting = gates.Counting(wide(reg), load.KEY)
    source = tables.replace_table(counting.rows, f"{database}.source", typed_wide_schema())
    names, stage, typed = Tables(f"{database}.registry"), load.stage, load.typed

    def spoil(df):
        df = df.withColumn("spoiled", F.row_number().over(Window.partitionBy("cnpj").orderBy("nome_fantasia")) * 0)
        first = df.where("cnpj IS NOT NULL AND cnpj <> 'cnpj'").agg(F.min("cnpj")).first()[0]
        if fault == "a row less":
            df = df.where(f"cnpj IS NULL OR cnpj <> '{first}'")
        elif fault == "a row twice for another":
            other = df.where(f"cnpj <> '{first}' AND cnpj <> 'cnpj'").limit(1)
            df = df.where(f"cnpj IS NULL OR cnpj <> '{first}'").unionAll(other)
        elif fault == "a changed key":
            df = df.withColumn("cnpj", F.when(F.col("cnpj") == first, "x").otherwise(F.col("cnpj")))
        return df.drop("spoiled")

    if through_files:
        monkeypatch.setattr(load, "stage", lambda *a: spoil(stage(*a)))
    else:
        monkeypatch.setattr(load, "typed", lambda rows, **k: typed(spoil(rows), **k))
    if fault == "none":
        assert hand_over(spark, source, counting.found(), space, names, through_files).count() == source.where("cnpj IS NOT NULL").select("cnpj").distinct().count()
        return
    with pytest.raises(gates.GateError):
        hand_over(spark, source, counting.found(), space, names, through_files)
    assert not spark.catalog.tableExists(names.served)


def test_append_is_by_position(spark, table):
    name = f"{Workspace(spark, 'append').database()}.t"
    tables.create_table(spark, name, table(["a", "b"]).schema)
    out = tables.append(table(["b", "a"], ("1", "2")), name)
    assert [r.asDict() for r in out.collect()] == [{"a": "1", "b": "2"}]
    with pytest.raises(ValueError, match="2 columns, got 1"):
        tables.append(table(["a"], ("1",)), name)


def test_audit_keeps_local_time(spark, table):
    name = f"{Workspace(spark, 'audit').database()}.etl_jobs"
    tables.create_table(spark, name, audit.AUDIT)
    moment = F.lit("2024-01-15 12:00:00").cast("timestamp")
    out = tables.append(audit.audit_rows(table(["f"], ("a.zip",)), F.col("f"), moment), name)
    out = tables.append(audit.audit_rows(table(["f"], ("b.zip",)), F.col("f")), name)
    found = {r["file_name"]: str(r["t"]) for r in out.selectExpr("file_name", "cast(download_timestamp as string) t").collect()}
    assert found["a.zip"] == "2024-01-15 09:00:00" and set(found) == {"a.zip", "b.zip"}


def test_two_refreshes_and_a_rollback(spark, reg, tmp_path):
    """From Latin-1 files to the served table, twice into the same database."""
    database = Workspace(spark, "refreshes").database()
    options = dict(sep=";", quote='"', escape='"', encoding="ISO-8859-1", lineSep="\n")

    def landed(version):
        root = f"{tmp_path}/{version}"
        for name, dataset in DATASETS.items():
            df = reg[name]
            if "descricao" in df.columns:
                df = df.withColumn("descricao", F.regexp_replace("descricao", "�+", "ç"))
            if name == "establishments":
                df = df.withColumn("nome_fantasia", F.lit(f"PÃO & {version}"))
            df.write.options(**options).csv(f"{root}/register.{dataset.suffix}")
        return root

    served = refresh(spark, landed("A"), database, run="weekly")
    assert sorted(r["cnpj"] for r in served.collect()) == ["1000191", "1000272", "2000110", "3000111"]
    assert {r["nome_fantasia"] for r in served.collect()} == {"PO  A"}
    assert served.where("cnpj = '1000191'").first()["natureza_juridica"] == "Sociedade Empresçria"
    through_files = Counter(map(tuple, served.drop("nome_fantasia").collect()))
    straight = refresh(spark, landed("B"), database, run="weekly", through_files=False)
    assert Counter(map(tuple, straight.drop("nome_fantasia").collect())) == through_files
    names = Tables(f"{database}.registry")
    state = {t: {r["nome_fantasia"] for r in spark.table(t).collect()} for t in (names.served, names.backup)}
    assert state == {names.served: {"PO  B"}, names.backup: {"PO  A"}}
    rollback(spark, names)
    assert {r["nome_fantasia"] for r in spark.table(names.served).collect()} == {"PO  A"}


def test_from_archives_to_the_served_table(spark, reg, tmp_path):
    download = tmp_path / "download"
    download.mkdir()
    for name, dataset in DATASETS.items():
        rows = [["" if v is None else f'"{v}"' for v in row] for row in reg[name].collect()]
        content = "".join(";".join(row) + "\r\n" for row in rows).replace("��", "çã").replace("�", "ç")
        with zipfile.ZipFile(download / f"F.K1.{dataset.suffix}.zip", "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr(f"F.K1.{dataset.suffix}", content.encode("latin-1"))
            archive.writestr("LEIAME.TXT", "extra")
    lines = archives.expand(archives.list_files(spark, str(download)))
    archives.land(archives.route(lines), str(tmp_path / "landing"))
    served = refresh(spark, str(tmp_path / "landing"))
    expected = Counter(map(tuple, load.typed(wide(reg)).collect()))
    assert Counter(map(tuple, served.collect())) == expected


@pytest.mark.parametrize("dataset", DATASETS)
def test_a_malformed_line_stops_a_refresh(spark, reg, tmp_path, dataset):
    for name, known in DATASETS.items():
        reg[name].write.options(sep=";", encoding="UTF-8", escape='"').csv(f"{tmp_path}/register.{known.suffix}")
    line = "x;y;z" if len(DATASETS[dataset].columns) == 2 else "x"
    spark.createDataFrame([(line,)], "line string").write.mode("append").text(
        f"{tmp_path}/register.{DATASETS[dataset].suffix}"
    )
    with pytest.raises(MalformedError, match=f"'{line}'"):
        refresh(spark, str(tmp_path))


def test_a_refresh_makes_its_database_and_leaves_only_tables(spark, reg, tmp_path):
    for name, dataset in DATASETS.items():
        reg[name].write.options(sep=";", encoding="UTF-8", escape='"').csv(f"{tmp_path}/register.{dataset.suffix}")
    for run in ("one", "two"):
        assert refresh(spark, str(tmp_path), "fresh_register", run=run).count() > 0
    left = {t.name for t in spark.catalog.listTables("fresh_register")}
    # Views over the two versions in use, and the warehouse tables.
    assert left == {"registry", "registry_bkp", "registry_v1", "registry_v2", "socios_agg_json", "registry_source"}
    root = Workspace(spark, "refresh", "one").path().removeprefix("file:")
    assert not any(Path(root, name).exists() for name in ("kept", "export"))


def test_an_oversize_company_stops_a_refresh_before_any_table_is_written(spark, reg, tmp_path, monkeypatch):
    for name, dataset in DATASETS.items():
        reg[name].write.options(sep=";", encoding="UTF-8", escape='"').csv(f"{tmp_path}/register.{dataset.suffix}")
    limited = functools.partial(partners_json, max_bytes=400)
    monkeypatch.setattr("ledgerline.plans.refresh.partners_json", limited)
    with pytest.raises(OversizeError, match="1 "):
        refresh(spark, str(tmp_path), "oversize_register", chunked=False)
    assert not spark.catalog.listTables("oversize_register")


def test_partners_without_a_company_are_left_out_where_they_are_only_joined(reg, rows):
    partners = reg["partners"].unionAll(rows(PARTNERS, {"nome_socio": "NINGUEM"}))
    both = [partners_json(partners, reg["qualifications"], reg["countries"], keyless=k) for k in (True, False)]
    assert [df.where("cnpj_basico is null").count() for df in both] == [1, 0]


def test_parts_of_partners_are_the_same_records(reg):
    parts = partners_in_parts(reg["partners"], reg["qualifications"], reg["countries"], part_bytes=300)
    whole = folded(reg).select("cnpj_basico", F.explode("socios_json").alias("r"))
    cut = parts.select("cnpj_basico", F.explode("socios_json").alias("r"))
    assert Counter(map(tuple, whole.collect())) == Counter(map(tuple, cut.collect()))


def test_an_oversize_company_is_served_in_chunks(spark, reg, table, tmp_path, monkeypatch):
    """A company of three times the limit and more goes through a refresh, as does any number of partners without one."""
    partners, columns = reg["partners"], reg["partners"].columns
    large = partners.where("cnpj_basico IS NOT NULL").select(F.min("cnpj_basico")).first()[0]
    first = partners.where(F.col("cnpj_basico") == large).limit(1)
    name, key = F.concat(F.lit("PARTNER "), F.col("id").cast("string")), F.when(F.col("id") % 2 == 0, F.lit(large))
    more = first.crossJoin(spark.range(60)).withColumn("nome_socio", name).withColumn("cnpj_basico", key).select(*columns)
    reg = dict(reg, partners=partners.unionAll(more))
    for dataset, known in DATASETS.items():
        reg[dataset].write.options(sep=";", encoding="UTF-8", escape='"').csv(f"{tmp_path}/register.{known.suffix}")
    args = (reg["partners"], reg["qualifications"], reg["countries"])
    whole = {r[0]: r[1] for r in partners_json(*args, keyless=False).collect()}
    limit = max(sum(len(x) + 1 for x in whole[large]) // 4, 1)
    monkeypatch.setattr(
        "ledgerline.plans.refresh.partners_with_chunks",
        functools.partial(partners_with_chunks, max_bytes=limit, part_bytes=limit // 3),
    )
    served = refresh(spark, str(tmp_path), "chunked_register")
    tables = Tables("chunked_register.registry")
    chunks = served_chunks(spark, tables)
    assert {r["cnpj_basico"] for r in chunks.collect()} == {large} and chunks.count() > 3
    cells = {r["cnpj_basico"]: r["socios_json"] for r in served.where("cnpj_basico IS NOT NULL").collect()}
    rest = [x for r in chunks.orderBy("part").collect() for x in r["socios_json"]]
    texts = {k: sorted(x for x in v) for k, v in whole.items()}
    for company, cell in cells.items():
        records = json.loads(f"[{cell}]") + [json.loads(x) for x in rest if company == large]
        assert Counter(json.dumps(r) for r in records) == Counter(json.dumps(json.loads(x)) for x in texts[company])
    assert len(cells[large]) <= limit
    # The gate sees a lost chunk; the next version without large companies has no chunks, and a rollback brings them back.
    folded = spark.table("chunked_register.socios_agg_json")
    assert records_gate(*args, folded, chunks).first()["passed"]
    assert not records_gate(*args, folded, chunks.where(F.col("part") > chunks.agg(F.min("part")).first()[0])).first()["passed"]
    monkeypatch.setattr("ledgerline.plans.refresh.partners_with_chunks", partners_with_chunks)
    refresh(spark, str(tmp_path), "chunked_register", run="next")
    assert served_chunks(spark, tables) is None
    rollback(spark, tables)
    assert served_chunks(spark, tables).count() == chunks.count()


def test_staging_refuses_records_of_another_width(spark, tmp_path):
    (tmp_path / "part-0.csv").write_text(",".join(WIDE) + "\n" + ",".join("x" * 27) + "\n")
    with pytest.raises(Exception, match="MALFORMED"):
        load.stage(spark, str(tmp_path)).count()
