"""The wide registry table: one row per establishment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import codes, dates, text
from ledgerline.functions.records import list_text
from ledgerline.operators.joins import (
    BROADCAST_BYTES,
    HOT_ROWS,
    Measures,
    Role,
    left_join,
    lookup_large,
    lookup_small,
    split_by_size,
)
from ledgerline.schemas import WIDE, WIDE_V1

_ESTABLISHMENT = (
    "cnpj_basico",
    "cnpj_ordem",
    "cnpj_dv",
    "identificador_matriz_filial",
    "nome_fantasia",
    "situacao_cadastral",
    "data_situacao_cadastral",
    "data_inicio_atividade",
    "cnae_fiscal_principal",
    "cnae_fiscal_secundaria",
    "tipo_logradouro",
    "logradouro",
    "numero",
    "complemento",
    "bairro",
    "cep",
    "uf",
    "municipio",
    "ddd_1",
    "telefone_1",
    "ddd_2",
    "telefone_2",
    "correio_eletronico",
)


def registry_wide(
    establishments: DataFrame,
    companies: DataFrame,
    activities: DataFrame,
    cities: DataFrame,
    legal_natures: DataFrame,
    partners: DataFrame,
    fix_start_guard: bool = False,
    max_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
    measures: Measures | None = None,
) -> DataFrame:
    """Establishments left-joined with their company, their code tables and their company's folded partners.

    ``partners`` is what :func:`ledgerline.plans.partners.partners_json` returns. The output's ``cnpj_basico``
    is the partner side's, so it is NULL where a company has no partners. The start date has always been
    dropped where the *status* date says none; ``fix_start_guard`` looks at the start date itself.
    """
    folded = partners.select(
        F.col("cnpj_basico").alias("partner_key"), list_text(F.col("socios_json")).alias("socios_json")
    )
    by_company = [(_company(companies), "company_key"), (folded, "partner_key")]
    joined = _joined(establishments, by_company, activities, cities, legal_natures, max_bytes, hot_rows, measures)
    columns = _published(WIDE, fix_start_guard)
    return joined.select(*(c.alias(name) for name, c in zip(WIDE, columns)))


def registry_wide_v1(
    establishments: DataFrame,
    companies: DataFrame,
    activities: DataFrame,
    cities: DataFrame,
    legal_natures: DataFrame,
    fix_start_guard: bool = False,
    max_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
    measures: Measures | None = None,
) -> DataFrame:
    """First edition, 25 columns. The partners it joined had one row per company and no column selected,
    so leaving them out changes nothing."""
    by_company = [(_company(companies), "company_key")]
    joined = _joined(establishments, by_company, activities, cities, legal_natures, max_bytes, hot_rows, measures)
    columns = _published(WIDE_V1, fix_start_guard)
    return joined.select(*(c.alias(name) for name, c in zip(WIDE_V1, columns)))


def registry_wide_v2(first_edition: DataFrame, partners: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Second edition: the first one left-joined with the partner arrays on the company part of the key."""
    keyed = first_edition.withColumn("company_part", text.key_prefix(F.col("cnpj")))
    return left_join(keyed, "company_part", (partners, "cnpj_basico"), hot_rows=hot_rows).drop("company_part")


def _company(companies: DataFrame) -> DataFrame:
    return companies.select(
        F.col("cnpj_basico").alias("company_key"),
        "razao_social",
        "capital_social",
        "porte_empresa",
        F.col("natureza_juridica").alias("legal_nature"),
    )


def _joined(
    establishments: DataFrame,
    by_company: list[tuple[DataFrame, str]],
    activities: DataFrame,
    cities: DataFrame,
    legal_natures: DataFrame,
    max_bytes: int,
    hot_rows: int,
    measures: Measures | None,
) -> DataFrame:
    """All joins. Code tables too large to broadcast come first, while rows are still narrow; small ones come
    last, so that their descriptions are never shuffled."""
    roles = [
        Role("cnae_fiscal_principal", activities, "activity"),
        Role("municipio", cities, "city"),
        Role("legal_nature", legal_natures, "nature"),
    ]
    small, large = split_by_size(roles, max_bytes, measures)
    rows = lookup_large(
        establishments.select(*_ESTABLISHMENT), [r for r in large if r.column != "legal_nature"], hot_rows
    )
    rows = left_join(rows, "cnpj_basico", *by_company, hot_rows=hot_rows, max_bytes=max_bytes)
    rows = lookup_large(rows, [r for r in large if r.column == "legal_nature"], hot_rows)
    return lookup_small(rows, small)


def _published(names: Sequence[str], fix_start_guard: bool) -> list[Column]:
    """The published columns as expressions over the joined ones."""
    status_date, start_date = F.col("data_situacao_cadastral"), F.col("data_inicio_atividade")
    start_guard = start_date if fix_start_guard else status_date
    computed = {
        "cnpj": text.build_key(F.col("cnpj_basico"), F.col("cnpj_ordem"), F.col("cnpj_dv")),
        "matriz_filial": codes.branch(F.col("identificador_matriz_filial")),
        "desc_situacao_cadastral": codes.status(F.col("situacao_cadastral")),
        "data_situacao_cadastral": dates.parse_date(status_date),
        "data_inicio_atividade": dates.parse_date(start_date, guard=start_guard),
        "cnae": F.col("cnae_fiscal_principal"),
        "nome_cnae_principal": text.repair(F.col("activity_descricao")),
        "nome_municipio": F.col("city_descricao"),
        "porte": codes.size(F.col("porte_empresa")),
        "natureza_juridica": text.repair(F.col("nature_descricao")),
        "cnpj_basico": F.col("partner_key"),
    }
    return [computed.get(name, F.col(name)) for name in names]
