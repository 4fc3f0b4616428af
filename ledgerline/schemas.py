"""Fixed schemas of the register's files and tables. Nothing is inferred and no file carries a header."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Column names and order of the register's files and of the published table.
LOOKUP = ("codigo", "descricao")

COMPANIES = (
    "cnpj_basico",
    "razao_social",
    "natureza_juridica",
    "qualificacao_responsavel",
    "capital_social",
    "porte_empresa",
    "ente_federativo_responsavel",
)

ESTABLISHMENTS = (
    "cnpj_basico",
    "cnpj_ordem",
    "cnpj_dv",
    "identificador_matriz_filial",
    "nome_fantasia",
    "situacao_cadastral",
    "data_situacao_cadastral",
    "motivo_situacao_cadastral",
    "nome_cidade_exterior",
    "pais",
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
    "ddd_fax",
    "fax",
    "correio_eletronico",
    "situacao_especial",
    "data_situacao_especial",
)

PARTNERS = (
    "cnpj_basico",
    "identificador_socio",
    "nome_socio",
    "cpf_cnpj_socio",
    "qualificacao_socio",
    "data_entrada_sociedade",
    "pais",
    "representante_legal",
    "nome_representante",
    "qualificacao_representante",
    "faixa_etaria",
)

PARTNER_RECORD = (
    "cnpj_basico",
    "identificador_socio",
    "nome_socio",
    "cpf_cnpj_socio",
    "qualificacao_socio",
    "data_entrada_sociedade",
    "pais",
    "cpf_representante_legal",
    "qualificacao_representante",
    "faixa_etaria",
)

WIDE = (
    "cnpj",
    "matriz_filial",
    "nome_fantasia",
    "desc_situacao_cadastral",
    "data_situacao_cadastral",
    "data_inicio_atividade",
    "cnae",
    "nome_cnae_principal",
    "cnae_fiscal_secundaria",
    "tipo_logradouro",
    "logradouro",
    "numero",
    "complemento",
    "bairro",
    "cep",
    "uf",
    "nome_municipio",
    "ddd_1",
    "telefone_1",
    "ddd_2",
    "telefone_2",
    "correio_eletronico",
    "porte",
    "razao_social",
    "capital_social",
    "natureza_juridica",
    "cnpj_basico",
    "socios_json",
)

WIDE_DATES = ("data_situacao_cadastral", "data_inicio_atividade")

# The first edition of the wide table lacks these three.
WIDE_V1 = tuple(c for c in WIDE if c not in ("tipo_logradouro", "cnpj_basico", "socios_json"))


@dataclass(frozen=True)
class Dataset:
    """One kind of register file: the suffix its files carry and its columns, in file order."""

    suffix: str
    columns: tuple[str, ...]

    @property
    def schema(self) -> T.StructType:
        return text_schema(self.columns)


# File suffix of each dataset.
DATASETS = {
    "qualifications": Dataset("QUALSCSV", LOOKUP),
    "countries": Dataset("PAISCSV", LOOKUP),
    "legal_natures": Dataset("NATJUCSV", LOOKUP),
    "cities": Dataset("MUNICCSV", LOOKUP),
    "activities": Dataset("CNAECSV", LOOKUP),
    "companies": Dataset("EMPRECSV", COMPANIES),
    "establishments": Dataset("ESTABELE", ESTABLISHMENTS),
    "partners": Dataset("SOCIOCSV", PARTNERS),
}


def text_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def typed_wide_schema() -> T.StructType:
    return T.StructType(
        [T.StructField(c, T.DateType() if c in WIDE_DATES else T.StringType()) for c in WIDE]
    )
