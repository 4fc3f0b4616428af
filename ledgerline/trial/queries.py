"""One query per operator, over the given tables. Dates, decimals and arrays are rendered as text for comparison."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import codes, dates, text
from ledgerline.functions.records import list_text, row_json
from ledgerline.operators import filters, joins, keys, sampling
from ledgerline.operators.fold import fold
from ledgerline.plans import gates, load
from ledgerline.plans.partners import partner_rows
from ledgerline.plans.partners import partners_in_parts as fold_parts
from ledgerline.plans.partners import partners_json as fold_partners
from ledgerline.plans.publish import Tables, publish, rollback
from ledgerline.plans.refresh import refresh
from ledgerline.plans.wide import registry_wide, registry_wide_v1, registry_wide_v2
from ledgerline.schemas import (
    COMPANIES,
    DATASETS,
    ESTABLISHMENTS,
    LOOKUP,
    PARTNER_RECORD,
    WIDE,
    text_schema,
    typed_wide_schema,
)
from ledgerline.sinks import audit, export, tables
from ledgerline.sources import archives, listing
from ledgerline.sources import register as files
from ledgerline.trial.driver_tables import Register, land
from ledgerline.trial.packing import pack
from ledgerline.workspace import Workspace

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    """Register ``function`` under its name, dates and decimals as text and arrays as comma-joined text."""

    def rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = function(spark, sf_dir)
        return df.select(*(_rendered(f).alias(f.name) for f in df.schema.fields))

    rendered.__name__ = function.__name__
    rendered.__doc__ = function.__doc__
    QUERIES[function.__name__] = rendered
    return function


def _rendered(field: T.StructField):
    column = F.col(field.name)
    if isinstance(field.dataType, T.DateType | T.DecimalType):
        return column.cast("string")
    if isinstance(field.dataType, T.TimestampType | T.TimestampNTZType):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss")
    if isinstance(field.dataType, T.ArrayType):
        return list_text(column)
    return column


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _wide(reg: Register, establishments: DataFrame | None = None, partners: DataFrame | None = None) -> DataFrame:
    """The wide table of the given establishments and partners, or of all of them."""
    partners = reg.partners if partners is None else partners
    codes_of_rows = (reg.activities, reg.cities, reg.legal_natures)
    measures = joins.Measures(partners, reg.qualifications, reg.countries, *codes_of_rows)
    folded = fold_partners(partners, reg.qualifications, reg.countries, keyless=False, measures=measures)
    establishments = reg.establishments if establishments is None else establishments
    return registry_wide(establishments, reg.companies, *codes_of_rows, folded, measures=measures)


def _landed(spark: SparkSession, sf_dir: str, label: str, *datasets: str) -> str:
    space = Workspace(spark, label)
    return land(Register(spark, sf_dir), space.path("landing"), datasets)


# Scans.


@query
def scan_csv(spark, sf_dir):
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    path = Workspace(spark, "scan_csv").path("orders")
    orders = _table(spark, sf_dir, "orders").withColumns(
        {
            "o_totalprice": F.col("o_totalprice").cast("decimal(18,2)"),
            "o_orderdate": F.date_format("o_orderdate", "yyyy-MM-dd"),
        }
    )
    orders.select(*(F.col(c).cast("string") for c in columns)).write.options(sep=";", escape='"').csv(path)
    return files.scan_csv(spark, path, columns)


@query
def scan_lookup(spark, sf_dir):
    """All five code tables."""
    names = [name for name, dataset in DATASETS.items() if dataset.columns == LOOKUP]
    root = _landed(spark, sf_dir, "scan_lookup", *names)
    scans = [files.scan(spark, root, name).withColumn("dataset", F.lit(name)) for name in names]
    result = scans[0]
    for scan in scans[1:]:
        result = result.unionByName(scan)
    return result


@query
def scan_companies(spark, sf_dir):
    return files.scan(spark, _landed(spark, sf_dir, "scan_companies", "companies"), "companies")


@query
def scan_establishments(spark, sf_dir):
    root = _landed(spark, sf_dir, "scan_establishments", "establishments")
    return files.scan_cleaned(spark, root, "establishments")


@query
def scan_partners(spark, sf_dir):
    return files.scan(spark, _landed(spark, sf_dir, "scan_partners", "partners"), "partners")


@query
def scan_by_suffix(spark, sf_dir):
    """Three datasets are landed; the scan reads the one asked for."""
    root = _landed(spark, sf_dir, "scan_by_suffix", "companies", "partners", "activities")
    return files.scan(spark, root, "activities")


@query
def clean_text(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", text.clean(F.encode("text", "UTF-8")).alias("text"))


@query
def decode_latin1(spark, sf_dir):
    """Trade names written as Latin-1 files and decoded from the bytes."""
    root = _landed(spark, sf_dir, "decode_latin1", "establishments")
    lines = files.scan_lines(spark, files.dataset_glob(root, "establishments"))
    decoded = lines.select(text.decode_latin1(F.col("line")).alias("line"))
    return files.parse_lines(decoded, ESTABLISHMENTS).select("cnpj_basico", "cnpj_ordem", "cnpj_dv", "nome_fantasia")


@query
def unzip_members(spark, sf_dir):
    folder = pack(_table(spark, sf_dir, "documents"), Workspace(spark, "unzip_members").path("download"))
    lines = archives.expand(archives.list_files(spark, folder))
    return lines.select(
        F.element_at(F.split("member", r"\."), -1).alias("kind"), text.decode_utf8(F.col("line")).alias("line")
    )


@query
def route_members(spark, sf_dir):
    space = Workspace(spark, "route_members")
    folder = pack(_table(spark, sf_dir, "documents"), space.path("download"))
    archives.land(archives.route(archives.expand(archives.list_files(spark, folder))), space.path("landing"))
    return spark.read.text(space.path("landing"), lineSep="\n").select("dataset", F.col("value").alias("line"))


@query
def listing_links(spark, sf_dir):
    """The pages' links all start with "/", so that character is not skipped here."""
    return listing.list_links(_table(spark, sf_dir, "pages"), skipped=("?", "L", "a"), keep=["page_id"])


@query
def list_parts(spark, sf_dir):
    """The shards of an export, however many, by the prefix and suffix of their names; whether the listing has every
    shard that rows are read from, and how many records, without the header lines, are in them."""
    companies = Register(spark, sf_dir).companies
    path = export.export_csv(companies, Workspace(spark, "list_parts").path("export"))
    listed = archives.list_files(spark, path).select(
        F.col("path").alias("listed"),
        F.regexp_replace("path", r"^.*/(part)-\d+-.*?(\.csv\.gz)$", "$1$2").alias("name"),
        (F.col("length") > 0).alias("filled"),
    )
    rows = export.read_as_one(spark, path, COMPANIES)
    read = rows.where("cnpj_basico IS NULL OR cnpj_basico <> 'cnpj_basico'")
    read = read.groupBy(F.input_file_name().alias("read")).agg(F.count(F.lit(1)).alias("n"))
    base = F.substring_index(F.col("listed"), "/", -1)
    found = listed.join(read, base == F.substring_index(F.col("read"), "/", -1), "full")
    return found.groupBy("name", "filled").agg(
        F.bool_and(F.col("listed").isNotNull()).alias("complete"), F.coalesce(F.sum("n"), F.lit(0)).alias("records")
    )


# Sinks.


@query
def replace_table(spark, sf_dir):
    database = Workspace(spark, "replace_table").database()
    schema = T.StructType(
        [
            T.StructField("o_orderkey", T.StringType()),
            T.StructField("o_custkey", T.LongType()),
            T.StructField("o_orderdate", T.DateType()),
            T.StructField("o_totalprice", T.DecimalType(18, 2)),
        ]
    )
    tables.create_table(spark, f"{database}.orders", text_schema(["replaced"]))
    return tables.replace_table(_table(spark, sf_dir, "orders"), f"{database}.orders", schema)


@query
def insert_positional(spark, sf_dir):
    """Two appends whose column names differ from the table's."""
    reg = Register(spark, sf_dir)
    name = f"{Workspace(spark, 'insert_positional').database()}.codes"
    tables.create_table(spark, name, text_schema(["chave", "texto"]))
    tables.append(reg.activities, name)
    return tables.append(reg.companies.select("cnpj_basico", "razao_social"), name)


@query
def ordered_output(spark, sf_dir):
    name = f"{Workspace(spark, 'ordered_output').database()}.partners"
    partners = Register(spark, sf_dir).partners
    return tables.replace_table(partners, name, sort_by="cnpj_basico")


@query
def export_csv_gz(spark, sf_dir):
    establishments = Register(spark, sf_dir).establishments
    # A cell with line breaks in it.
    broken = F.concat_ws("\r\n", "logradouro", "numero", F.lit('"\n')).alias("logradouro")
    establishments = establishments.withColumn("logradouro", broken)
    path = export.export_csv(establishments, Workspace(spark, "export_csv_gz").path("export"))
    return filters.data_rows(export.read_as_one(spark, path, ESTABLISHMENTS), "cnpj_basico")


@query
def read_parts_as_one(spark, sf_dir):
    """Shards small enough that there are many, each with its header line."""
    companies = Register(spark, sf_dir).companies
    path = export.export_csv(companies, Workspace(spark, "read_parts_as_one").path("export"), shard_rows=500)
    joined = export.read_as_one(spark, path, COMPANIES)
    return joined.groupBy((F.col("cnpj_basico") == "cnpj_basico").alias("header")).agg(
        F.min("razao_social").alias("first"), F.max("razao_social").alias("last"),
        F.count_distinct("cnpj_basico").alias("different"),
    )


def _staged(spark, sf_dir, label):
    path = Workspace(spark, label).path("export")
    return load.stage(spark, export.export_csv(_wide(Register(spark, sf_dir)), path))


@query
def stage_load(spark, sf_dir):
    """Staging as text, without the header lines, whose number depends on the number of shards."""
    return _staged(spark, sf_dir, "stage_load").where("cnpj is null or cnpj <> 'cnpj'")


@query
def stage_to_typed(spark, sf_dir):
    return load.typed(_staged(spark, sf_dir, "stage_to_typed"))


def _two_versions(spark, sf_dir, label):
    """Publish companies as version one, establishments' companies as version two."""
    reg = Register(spark, sf_dir)
    names = Tables(f"{Workspace(spark, label).database()}.registry")
    first = reg.companies.select("cnpj_basico", F.col("razao_social").alias("nome"))
    second = reg.establishments.select("cnpj_basico", F.col("nome_fantasia").alias("nome"))
    for version in (first, second):
        tables.replace_table(version, names.stage)
        tables.replace_table(spark.table(names.stage), names.new)
        publish(spark, names)
    return names


def _states(spark, names, *states):
    """The rows of the given states of a published table, one after the other."""
    result = None
    for state in states:
        rows = spark.table(getattr(names, state)).withColumn("state", F.lit(state))
        result = rows if result is None else result.unionByName(rows)
    return result


@query
def publish_swap(spark, sf_dir):
    return _states(spark, _two_versions(spark, sf_dir, "publish_swap"), "served", "backup")


@query
def rollback_table(spark, sf_dir):
    names = _two_versions(spark, sf_dir, "rollback")
    rollback(spark, names)
    return _states(spark, names, "served", "error")


QUERIES["rollback"] = QUERIES.pop("rollback_table")


@query
def ingest_audit(spark, sf_dir):
    """One audit row per fetched page, appended to the audit table, at a fixed moment."""
    name = f"{Workspace(spark, 'ingest_audit').database()}.etl_jobs"
    tables.create_table(spark, name, audit.AUDIT)
    moment = F.lit("2024-01-15 12:00:00").cast("timestamp")
    return tables.append(audit.audit_rows(_table(spark, sf_dir, "pages"), F.col("url"), moment), name)


@query
def audit_landed_files(spark, sf_dir):
    """One audit row per dataset that was landed as files."""
    root = _landed(spark, sf_dir, "audit_landed_files", "qualifications", "countries", "cities")
    found = archives.list_files(spark, f"{root}/*").select(F.regexp_extract("path", r"(register\.\w+)/", 1).alias("file"))
    moment = F.lit("2024-01-15 12:00:00").cast("timestamp")
    return audit.audit_rows(found.distinct(), F.col("file"), moment)


# Projections and filters.


@query
def project_rename(spark, sf_dir):
    reg = Register(spark, sf_dir)
    return reg.establishments.select(
        "cnpj_basico", "cnpj_ordem", "cnpj_dv", F.col("cnae_fiscal_principal").alias("cnae"), "logradouro"
    )


@query
def filter_not_null(spark, sf_dir):
    rows = Register(spark, sf_dir).establishments
    return rows.where(F.col("nome_fantasia").isNotNull()).select("cnpj_basico", "cnpj_dv", "nome_fantasia")


@query
def filter_header_rows(spark, sf_dir):
    """Orders with their priority as key, '1-URGENT' in the part of the header."""
    rows = _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "1-URGENT", "chave")
        .when(F.col("o_orderpriority") == "5-LOW", F.lit(None))
        .otherwise(F.col("o_orderpriority"))
        .alias("chave"),
    )
    return filters.data_rows(rows, "chave")


@query
def filter_optional(spark, sf_dir):
    """The four ways to ask: by state, by activity, by both, and for everything."""
    rows = Register(spark, sf_dir).establishments.select(
        F.concat("cnpj_basico", "cnpj_ordem", "cnpj_dv").alias("cnpj"),
        F.col("cnae_fiscal_principal").alias("cnae"),
        "uf",
    )
    asked = {
        "uf": {"uf": "S07"},
        "cnae": {"cnae": "0000007"},
        "both": {"cnae": "0000007", "uf": "S07"},
        "none": {"cnae": None, "uf": None},
    }
    result = None
    for name, wanted in asked.items():
        part = filters.where_equal(rows, **wanted).withColumn("asked", F.lit(name))
        result = part if result is None else result.unionByName(part)
    return result


# Joins.


@query
def lookup_left_join(spark, sf_dir):
    reg = Register(spark, sf_dir)
    rows = reg.establishments.select("cnpj_basico", "cnpj_ordem", "cnpj_dv", "cnae_fiscal_principal", "municipio")
    return joins.lookup(
        rows, ("cnae_fiscal_principal", reg.activities, "cnae"), ("municipio", reg.cities, "cidade")
    ).drop("cnae_codigo", "cidade_codigo")


@query
def role_playing_lookup(spark, sf_dir):
    """The same code table twice, for the partner's and for the representative's qualification."""
    reg = Register(spark, sf_dir)
    rows = reg.partners.select("cpf_cnpj_socio", "qualificacao_socio", "qualificacao_representante")
    return joins.lookup(
        rows,
        ("qualificacao_socio", reg.qualifications, "socio"),
        ("qualificacao_representante", reg.qualifications, "representante"),
    ).select("cpf_cnpj_socio", "socio_descricao", "representante_descricao")


def _with_company(reg):
    rows = reg.establishments.select("cnpj_basico", "cnpj_ordem", "cnpj_dv")
    company = reg.companies.select(
        F.col("cnpj_basico").alias("company_key"), "razao_social", "capital_social", "natureza_juridica"
    )
    return joins.left_join(rows, "cnpj_basico", (company, "company_key")).drop("company_key")


@query
def chained_lookup(spark, sf_dir):
    reg = Register(spark, sf_dir)
    return joins.lookup(_with_company(reg), ("natureza_juridica", reg.legal_natures, "natureza")).drop(
        "natureza_codigo"
    )


@query
def fact_fact_left_join(spark, sf_dir):
    return _with_company(Register(spark, sf_dir))


@query
def join_preaggregated(spark, sf_dir):
    reg = Register(spark, sf_dir)
    folded = fold_partners(reg.partners, reg.qualifications, reg.countries, keyless=False)
    rows = reg.establishments.select(F.col("cnpj_basico").alias("basico"), "cnpj_ordem", "cnpj_dv")
    return joins.left_join(rows, "basico", (folded, "cnpj_basico"))


@query
def join_on_prefix(spark, sf_dir):
    reg = Register(spark, sf_dir)
    rows = reg.establishments.select(F.concat("cnpj_basico", "cnpj_ordem", "cnpj_dv").alias("cnpj"))
    keyed = rows.withColumn("prefix", text.key_prefix(F.col("cnpj")))
    company = reg.companies.select("cnpj_basico", "razao_social")
    return joins.left_join(keyed, "prefix", (company, "cnpj_basico"))


@query
def insert_if_absent(spark, sf_dir):
    """Companies, plus one row for each establishment's company that is not among them."""
    reg = Register(spark, sf_dir)
    target = reg.companies.select("cnpj_basico", F.col("razao_social").alias("nome"))
    new = reg.establishments.select("cnpj_basico", F.col("nome_fantasia").alias("nome"))
    return keys.insert_if_absent(target, new, "cnpj_basico")


# Aggregations.


@query
def partners_json_agg(spark, sf_dir):
    """Partners as they are read, folded per company."""
    partners = Register(spark, sf_dir).partners
    return fold(partners, partners.columns)


@query
def count_rows(spark, sf_dir):
    return gates.count_rows(_table(spark, sf_dir, "lineitem"))


@query
def count_distinct_key(spark, sf_dir):
    return gates.count_distinct(Register(spark, sf_dir).establishments, "cnpj_basico")


@query
def distinct_rows(spark, sf_dir):
    rows = Register(spark, sf_dir).establishments
    return keys.distinct_rows(rows.select("identificador_matriz_filial", "situacao_cadastral", "uf", "municipio"))


@query
def dedup_by_key(spark, sf_dir):
    """One establishment per company."""
    return keys.one_per_key(Register(spark, sf_dir).establishments, "cnpj_basico")


# Samples.


_CNPJ = ["cnpj_basico", "cnpj_ordem", "cnpj_dv"]


@query
def random_sample(spark, sf_dir):
    """How many rows are drawn, how many of them differ, and how many are not in the table."""
    rows = Register(spark, sf_dir).establishments
    drawn = Workspace(spark, "random_sample").keep(sampling.random_sample(rows), "drawn")
    strange = drawn.join(rows.select(*_CNPJ), _CNPJ, "left_anti").agg(F.count(F.lit(1)).alias("strange"))
    counts = drawn.agg(F.count(F.lit(1)).alias("drawn"), F.count_distinct(*_CNPJ).alias("different"))
    return counts.crossJoin(strange)


@query
def seeded_sample(spark, sf_dir):
    rows = Register(spark, sf_dir).establishments.select(
        F.concat("cnpj_basico", "cnpj_ordem", "cnpj_dv").alias("cnpj"), "uf", "logradouro"
    )
    return sampling.seeded_sample(rows, "cnpj", "2021")


def _sampled_registry(spark, sf_dir):
    """A filtered sample of the wide table. Keys are drawn first, wide rows are built for them only."""
    reg = Register(spark, sf_dir)
    keyed = reg.establishments.withColumns(
        {"cnpj": text.build_key(*(F.col(c) for c in _CNPJ)), "cnae": F.col("cnae_fiscal_principal")}
    )
    drawn = sampling.sample_registry(keyed, {"uf": "S07"}, seed="2021").drop("cnpj", "cnae")
    drawn = Workspace(spark, "sample_registry").keep(drawn, "drawn")
    # At most a hundred companies.
    companies = F.broadcast(drawn.select("cnpj_basico").distinct())
    return _wide(reg, drawn, reg.partners.join(companies, "cnpj_basico", "left_semi"))


@query
def sample_registry(spark, sf_dir):
    return _sampled_registry(spark, sf_dir)


@query
def sample_answer(spark, sf_dir):
    """The sample in the shape of an answer: a JSON object per row under ``data``."""
    columns = ["cnpj", "nome_fantasia", "cnae", "uf", "nome_municipio", "razao_social"]
    return sampling.as_records(_sampled_registry(spark, sf_dir).select(*columns))


# Scalar functions.


def _decoded(spark, sf_dir, table, key, code, decode):
    df = getattr(Register(spark, sf_dir), table)
    return df.select(*key, code, decode(F.col(code)).alias("label"))


@query
def decode_partner_type(spark, sf_dir):
    return _decoded(spark, sf_dir, "partners", ["cpf_cnpj_socio"], "identificador_socio", codes.partner_type)


@query
def decode_age_band(spark, sf_dir):
    return _decoded(spark, sf_dir, "partners", ["cpf_cnpj_socio"], "faixa_etaria", codes.age_band)


@query
def decode_branch(spark, sf_dir):
    return _decoded(spark, sf_dir, "establishments", _CNPJ, "identificador_matriz_filial", codes.branch)


@query
def decode_status(spark, sf_dir):
    return _decoded(spark, sf_dir, "establishments", _CNPJ, "situacao_cadastral", codes.status)


@query
def decode_size(spark, sf_dir):
    return _decoded(spark, sf_dir, "companies", ["cnpj_basico"], "porte_empresa", codes.size)


@query
def safe_parse_date(spark, sf_dir):
    column = "data_situacao_cadastral"
    return _decoded(spark, sf_dir, "establishments", _CNPJ, column, dates.parse_date)


@query
def guarded_parse_date(spark, sf_dir):
    rows = Register(spark, sf_dir).establishments
    start, status = F.col("data_inicio_atividade"), F.col("data_situacao_cadastral")
    return rows.select(*_CNPJ, start, status, dates.parse_date(start, guard=status).alias("inicio"))


@query
def repair_text(spark, sf_dir):
    rows = Register(spark, sf_dir).activities
    return rows.select("codigo", text.repair(F.col("descricao")).alias("descricao"))


@query
def build_key(spark, sf_dir):
    """Keys of establishments, NULL where the trade name, taken as a part, is NULL."""
    rows = Register(spark, sf_dir).establishments
    return rows.select(
        text.build_key(*(F.col(c) for c in _CNPJ)).alias("cnpj"),
        text.build_key(F.col("cnpj_dv"), F.col("nome_fantasia")).alias("nullable"),
    )


@query
def row_to_json(spark, sf_dir):
    reg = Register(spark, sf_dir)
    rows = partner_rows(reg.partners, reg.qualifications, reg.countries)
    return rows.select(row_json(PARTNER_RECORD).alias("json"))


@query
def array_to_text(spark, sf_dir):
    """Trade names of each company as one text, without the NULLs; NULL for companies without establishments."""
    reg = Register(spark, sf_dir)
    names = reg.establishments.groupBy("cnpj_basico").agg(
        F.sort_array(F.collect_set(F.col("bairro"))).alias("nomes"),
        F.max("nome_fantasia").alias("maior"),
    )
    listed = names.select(
        "cnpj_basico", F.concat(F.array(F.lit(None).cast("string"), F.col("maior")), F.col("nomes")).alias("nomes")
    )
    return reg.companies.select("cnpj_basico").join(listed, "cnpj_basico", "left").select(
        "cnpj_basico", list_text(F.col("nomes")).alias("texto")
    )


@query
def cast_date(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem")
    return rows.select(
        "l_orderkey", "l_linenumber", dates.strict_date(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("dia")
    )


@query
def key_prefix(spark, sf_dir):
    rows = Register(spark, sf_dir).establishments
    cnpj = text.build_key(*(F.col(c) for c in _CNPJ))
    return rows.select(cnpj.alias("cnpj"), text.key_prefix(cnpj).alias("basico"))


@query
def strip_suffix(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", text.strip_suffix(F.col("url")).alias("name"))


# Gates.


@query
def gate_row_count(spark, sf_dir):
    """Staged companies, with a header line for each of their shards, against the companies. What the headers add depends on
    the number of shards, so it is told apart."""
    companies = Register(spark, sf_dir).companies
    path = export.export_csv(companies, Workspace(spark, "gate_row_count").path("export"))
    staged = export.read_as_one(spark, path, COMPANIES)
    headers = F.count(F.when(F.col("cnpj_basico") == "cnpj_basico", 1))
    shards = staged.groupBy(F.input_file_name()).agg(headers.alias("headers"))
    shards = shards.agg(F.sum("headers").alias("headers"), F.bool_and(F.col("headers") == 1).alias("one_header_each"))
    gate = gates.row_count_gate(staged, companies).withColumns({"headers": F.lit(0), "one_header_each": F.lit(True)})
    both = gate.unionByName(shards.withColumns({"loaded": F.lit(0), "expected": F.lit(0), "passed": F.lit(True)}))
    return both.agg(
        F.sum(F.col("loaded") - F.col("headers")).alias("loaded"),
        F.sum("expected").alias("expected"),
        F.bool_and("passed").alias("passed"),
        F.bool_and("one_header_each").alias("one_header_each"),
    )


@query
def gate_distinct_key(spark, sf_dir):
    establishments = Register(spark, sf_dir).establishments
    return gates.distinct_key_gate(keys.one_per_key(establishments, "cnpj_basico"), establishments, "cnpj_basico")


# Compositions.


@query
def partners_json(spark, sf_dir):
    reg = Register(spark, sf_dir)
    return fold_partners(reg.partners, reg.qualifications, reg.countries)


@query
def partners_in_parts(spark, sf_dir):
    """The layout for companies of any size, record by record."""
    reg = Register(spark, sf_dir)
    parts = fold_parts(reg.partners, reg.qualifications, reg.countries, part_bytes=500)
    return parts.select("cnpj_basico", F.explode("socios_json").alias("record"))


@query
def registry_wide_table(spark, sf_dir):
    return _wide(Register(spark, sf_dir))


QUERIES["registry_wide"] = QUERIES.pop("registry_wide_table")


def _first_edition(reg):
    return registry_wide_v1(reg.establishments, reg.companies, reg.activities, reg.cities, reg.legal_natures)


@query
def registry_first_edition(spark, sf_dir):
    return _first_edition(Register(spark, sf_dir))


QUERIES["registry_wide_v1"] = QUERIES.pop("registry_first_edition")


@query
def registry_second_edition(spark, sf_dir):
    """Over the stored first edition."""
    reg = Register(spark, sf_dir)
    folded = fold_partners(reg.partners, reg.qualifications, reg.countries, keyless=False)
    first = Workspace(spark, "first_edition").keep(_first_edition(reg), "wide")
    return registry_wide_v2(first, folded)


QUERIES["registry_wide_v2"] = QUERIES.pop("registry_second_edition")


@query
def full_refresh(spark, sf_dir):
    """From landed files to the published table."""
    return refresh(spark, _landed(spark, sf_dir, "landing", *DATASETS))


QUERIES["refresh"] = QUERIES.pop("full_refresh")
