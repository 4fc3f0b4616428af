"""The given tables in the shape of the register, every row of each table used.

Keys and codes are spread so that lookups hit and miss: every tenth company is missing, half of the companies
have partners, some codes have no description.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.text import REPAIRED, UNDECODABLE
from ledgerline.schemas import COMPANIES, DATASETS, ESTABLISHMENTS, PARTNERS


def padded(number: str, width: int) -> str:
    """SQL for ``number`` zero-padded to ``width`` and never cut."""
    digits = f"cast({number} as string)"
    return f"if(length({digits}) < {width}, lpad({digits}, {width}, '0'), {digits})"


class Register:
    """The eight datasets, each read when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._table = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")

    @cached_property
    def qualifications(self) -> DataFrame:
        return code_table(self._table("nation"), "n_nationkey", 2, "n_name", f"{UNDECODABLE}o")

    @cached_property
    def countries(self) -> DataFrame:
        return code_table(self._table("supplier"), "s_suppkey", 3, "s_name", "")

    @cached_property
    def legal_natures(self) -> DataFrame:
        return code_table(self._table("region"), "r_regionkey", 4, "r_name", f"{UNDECODABLE}o")

    @cached_property
    def cities(self) -> DataFrame:
        return code_table(self._table("nation"), "n_nationkey", 4, "n_name", "")

    @cached_property
    def activities(self) -> DataFrame:
        return code_table(self._table("part"), "p_partkey", 7, "p_name", UNDECODABLE)

    @cached_property
    def companies(self) -> DataFrame:
        return companies(self._table("customer"))

    @cached_property
    def establishments(self) -> DataFrame:
        return establishments(self._table("orders"))

    @cached_property
    def partners(self) -> DataFrame:
        return partners(self._table("events"))


def code_table(df: DataFrame, key: str, width: int, name: str, ending: str) -> DataFrame:
    return df.selectExpr(f"{padded(key, width)} as codigo", f"{name} || '{ending}' as descricao")


def companies(customer: DataFrame) -> DataFrame:
    columns = {
        # 0-8, 10-18, 20-28, …: companies whose number ends in 9 are missing.
        "cnpj_basico": padded("c_custkey + c_custkey div 9", 8),
        "razao_social": "c_name",
        "natureza_juridica": padded("c_nationkey % 7", 4),
        "qualificacao_responsavel": padded("c_nationkey", 2),
        "capital_social": "cast(cast(c_acctbal as decimal(18,2)) as string)",
        "porte_empresa": """case c_mktsegment when 'AUTOMOBILE' then '01' when 'BUILDING' then '02'
            when 'FURNITURE' then '03' when 'MACHINERY' then '05' else '04' end""",
    }
    return customer.selectExpr(*_in_order(columns, COMPANIES))


def establishments(orders: DataFrame) -> DataFrame:
    k = "o_orderkey"
    day = "date_format(o_orderdate, 'yyyyMMdd')"

    def number(modulus: int, width: int = 1) -> str:
        return padded(f"{k} % {modulus}", width)

    columns = {
        "cnpj_basico": padded("o_custkey", 8),
        "cnpj_ordem": padded(f"{k} div 100", 4),
        "cnpj_dv": number(100, 2),
        "identificador_matriz_filial": f"case {k} % 3 when 0 then '1' when 1 then '2' else '9' end",
        "nome_fantasia": f"""case {k} % 10 when 0 then null when 1 then ''
            else o_orderpriority || ' São & Irmãos (ME)' end""",
        "situacao_cadastral": f"array('01', '02', '03', '04', '08', '99')[int({k} % 6)]",
        "data_situacao_cadastral": f"""case when {k} % 7 = 0 then '0' when {k} % 11 = 0 then '00000000'
            when {k} % 13 = 0 then '20210230' when {k} % 17 = 0 then null else {day} end""",
        "motivo_situacao_cadastral": number(9, 2),
        "data_inicio_atividade": f"if({k} % 19 = 0, '0', {day})",
        "cnae_fiscal_principal": number(2500, 7),
        "cnae_fiscal_secundaria": f"{number(11, 7)} || ',' || {number(13, 7)}",
        "tipo_logradouro": f"if({k} % 2 = 0, 'RUA', 'AVENIDA')",
        "logradouro": f"'DO \"MEIO\"; ' || {number(97)}",
        "numero": number(1000),
        "complemento": f"if({k} % 5 = 0, null, ' ANDAR #' || {number(5)} || ' ')",
        "bairro": "o_orderstatus",
        "cep": number(99999, 8),
        "uf": f"'S' || {padded('o_custkey % 27', 2)}",
        "municipio": padded("o_custkey % 30", 4),
        "ddd_1": number(90, 2),
        "telefone_1": number(9973, 8),
        "telefone_2": f"if({k} % 4 = 0, '', null)",
        "correio_eletronico": f"'c' || {k} || '@example.com'",
    }
    return orders.selectExpr(*_in_order(columns, ESTABLISHMENTS))


def partners(events: DataFrame) -> DataFrame:
    k = "event_id"
    columns = {
        # Three partners for each company with an even number.
        "cnpj_basico": padded(f"{k} div 3 * 2", 8),
        "identificador_socio": f"string({k} % 4)",
        "nome_socio": f"event_type || ' ' || {k}",
        "cpf_cnpj_socio": padded(k, 11),
        "qualificacao_socio": padded(f"{k} % 28", 2),
        "data_entrada_sociedade": f"if({k} % 9 = 0, '0', date_format(ts, 'yyyyMMdd'))",
        "pais": f"if({k} % 8 = 0, null, {padded(f'{k} % 130', 3)})",
        "representante_legal": "'***000000**'",
        "nome_representante": f"'R' || {padded('user_id', 6)}",
        "qualificacao_representante": padded(f"({k} + 1) % 28", 2),
        "faixa_etaria": f"string({k} % 11)",
    }
    return events.selectExpr(*_in_order(columns, PARTNERS))


def _in_order(columns: dict[str, str], names) -> list[str]:
    """All columns of a register table; those not given are NULL."""
    return [f"{columns.get(name, 'cast(null as string)')} as {name}" for name in names]


def land(reg: Register, path: str, datasets=tuple(DATASETS)) -> str:
    """Write the register as it is published: headerless Latin-1 text, one ``register.<SUFFIX>`` folder per dataset.

    Descriptions get back the letter that reading Latin-1 as UTF-8 destroys.
    """
    for name in datasets:
        df = getattr(reg, name)
        if "descricao" in df.columns:
            df = df.withColumn("descricao", F.replace("descricao", F.lit(UNDECODABLE), F.lit(REPAIRED)))
        (
            df.write.mode("overwrite")
            .options(
                sep=";", quote='"', escape='"', quoteAll="false", encoding="ISO-8859-1", lineSep="\n",
                ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
            )
            .csv(f"{path}/register.{DATASETS[name].suffix}")
        )
    return path
