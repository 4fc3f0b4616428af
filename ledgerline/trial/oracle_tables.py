"""SQL for the same register-shaped tables as :mod:`ledgerline.trial.driver_tables`, as CTEs for DuckDB."""

from __future__ import annotations

from ledgerline.schemas import COMPANIES, ESTABLISHMENTS, PARTNERS

# Written out once more, so that the SQL does not share what it checks.
PARTNER_TYPE = {"1": "PESSOA JURÍDICA", "2": "PESSOA FÍSICA", "3": "ESTRANGEIRO"}
AGE_BAND = {
    "0": "Não se aplica",
    "1": "Entre 0 a 12 anos",
    "2": "Entre 13 a 20 anos",
    "3": "Entre 21 a 30 anos",
    "4": "Entre 31 a 40 anos",
    "5": "Entre 41 a 50 anos",
    "6": "Entre 51 a 60 anos",
    "7": "Entre 61 a 70 anos",
    "8": "Entre 71 a 80 anos",
    "9": "Maiores de 80 anos",
}
BRANCH = {"1": "Matriz", "2": "Filial"}
STATUS = {"01": "Nula", "02": "Ativa", "03": "Suspensa", "04": "Inapta", "08": "Baixada"}
SIZE = {"01": "NAO INFORMADO", "02": "MICRO EMPRESA", "03": "EMPRESA DE PEQUENO PORTE", "05": "DEMAIS"}


def padded(number: str, width: int) -> str:
    digits = f"cast({number} as varchar)"
    return f"(case when length({digits}) < {width} then lpad({digits}, {width}, '0') else {digits} end)"


def decode(code: str, labels: dict[str, str], default: str = "null") -> str:
    whens = " ".join(f"when '{value}' then '{label}'" for value, label in labels.items())
    return f"(case {code} {whens} else {default} end)"


def parse_date(value: str, guard: str | None = None) -> str:
    return f"(case when {guard or value} = '0' then null else cast(try_strptime({value}, '%Y%m%d') as date) end)"


def repair(value: str) -> str:
    return f"replace({value}, '\ufffd', 'ç')"


def clean(value: str) -> str:
    return rf"""regexp_replace({value}, '[^a-zA-Z0-9,-@+_ "\n]', '', 'g')"""


def _select(columns: dict[str, str], order, table: str) -> str:
    return "select " + ", ".join(f"{columns[c]} as {c}" for c in order) + f" from {table}"


def _code_table(table: str, key: str, width: int, name: str, ending: str) -> str:
    return f"select {padded(key, width)} as codigo, {name} || '{ending}' as descricao from {table}"


_K = "o_orderkey"
_DAY = "strftime(o_orderdate, '%Y%m%d')"
_E = "event_id"


def _mod(modulus: int, width: int = 1) -> str:
    return padded(f"{_K} % {modulus}", width)


_COMPANY = {
    "cnpj_basico": padded("c_custkey + c_custkey // 9", 8),
    "razao_social": "c_name",
    "natureza_juridica": padded("c_nationkey % 7", 4),
    "qualificacao_responsavel": padded("c_nationkey", 2),
    "capital_social": "cast(cast(c_acctbal as decimal(18, 2)) as varchar)",
    "porte_empresa": decode(
        "c_mktsegment", {"AUTOMOBILE": "01", "BUILDING": "02", "FURNITURE": "03", "MACHINERY": "05"}, "'04'"
    ),
    "ente_federativo_responsavel": "cast(null as varchar)",
}

_ESTABLISHMENT = {
    "cnpj_basico": padded("o_custkey", 8),
    "cnpj_ordem": padded(f"{_K} // 100", 4),
    "cnpj_dv": padded(f"{_K} % 100", 2),
    "identificador_matriz_filial": f"(case {_K} % 3 when 0 then '1' when 1 then '2' else '9' end)",
    "nome_fantasia": f"(case {_K} % 10 when 0 then null when 1 then '' "
    "else o_orderpriority || ' São & Irmãos (ME)' end)",
    "situacao_cadastral": f"(['01', '02', '03', '04', '08', '99'])[{_K} % 6 + 1]",
    "data_situacao_cadastral": f"(case when {_K} % 7 = 0 then '0' when {_K} % 11 = 0 then '00000000' "
    f"when {_K} % 13 = 0 then '20210230' when {_K} % 17 = 0 then null else {_DAY} end)",
    "motivo_situacao_cadastral": _mod(9, 2),
    "data_inicio_atividade": f"(case when {_K} % 19 = 0 then '0' else {_DAY} end)",
    "cnae_fiscal_principal": _mod(2500, 7),
    "cnae_fiscal_secundaria": f"{_mod(11, 7)} || ',' || {_mod(13, 7)}",
    "tipo_logradouro": f"(case when {_K} % 2 = 0 then 'RUA' else 'AVENIDA' end)",
    "logradouro": f"'DO \"MEIO\"; ' || {_mod(97)}",
    "numero": _mod(1000),
    "complemento": f"(case when {_K} % 5 = 0 then null else ' ANDAR #' || {_mod(5)} || ' ' end)",
    "bairro": "o_orderstatus",
    "cep": _mod(99999, 8),
    "uf": f"'S' || {padded('o_custkey % 27', 2)}",
    "municipio": padded("o_custkey % 30", 4),
    "ddd_1": _mod(90, 2),
    "telefone_1": _mod(9973, 8),
    "telefone_2": f"(case when {_K} % 4 = 0 then '' else null end)",
    "correio_eletronico": f"'c' || cast({_K} as varchar) || '@example.com'",
}
_ESTABLISHMENT = {c: _ESTABLISHMENT.get(c, "cast(null as varchar)") for c in ESTABLISHMENTS}

_PARTNER = {
    "cnpj_basico": padded(f"{_E} // 3 * 2", 8),
    "identificador_socio": f"cast({_E} % 4 as varchar)",
    "nome_socio": f"event_type || ' ' || cast({_E} as varchar)",
    "cpf_cnpj_socio": padded(_E, 11),
    "qualificacao_socio": padded(f"{_E} % 28", 2),
    "data_entrada_sociedade": f"(case when {_E} % 9 = 0 then '0' else strftime(ts, '%Y%m%d') end)",
    "pais": f"(case when {_E} % 8 = 0 then null else {padded(f'{_E} % 130', 3)} end)",
    "representante_legal": "'***000000**'",
    "nome_representante": f"'R' || {padded('user_id', 6)}",
    "qualificacao_representante": padded(f"({_E} + 1) % 28", 2),
    "faixa_etaria": f"cast({_E} % 11 as varchar)",
}

CTES = {
    "qualifications": _code_table("nation", "n_nationkey", 2, "n_name", "\ufffdo"),
    "countries": _code_table("supplier", "s_suppkey", 3, "s_name", ""),
    "legal_natures": _code_table("region", "r_regionkey", 4, "r_name", "\ufffdo"),
    "cities": _code_table("nation", "n_nationkey", 4, "n_name", ""),
    "activities": _code_table("part", "p_partkey", 7, "p_name", "\ufffd"),
    "companies": _select(_COMPANY, COMPANIES, "customer"),
    "establishments": _select(_ESTABLISHMENT, ESTABLISHMENTS, "orders"),
    "partners": _select(_PARTNER, PARTNERS, "events"),
    "cleaned": "select " + ", ".join(f"{clean(c)} as {c}" for c in ESTABLISHMENTS) + " from establishments",
}

# Partner rows as published, then as JSON, then folded.
CTES["partner_rows"] = f"""
    select p.cnpj_basico,
      {decode('p.identificador_socio', PARTNER_TYPE)} as identificador_socio,
      p.nome_socio, p.cpf_cnpj_socio,
      {repair('own.descricao')} as qualificacao_socio,
      {parse_date('p.data_entrada_sociedade')} as data_entrada_sociedade,
      country.descricao as pais,
      p.representante_legal as cpf_representante_legal,
      {repair('agent.descricao')} as qualificacao_representante,
      {decode('p.faixa_etaria', AGE_BAND)} as faixa_etaria
    from partners p
    left join qualifications own on own.codigo = p.qualificacao_socio
    left join qualifications agent on agent.codigo = p.qualificacao_socio
    left join countries country on country.codigo = p.pais"""
CTES["partner_records"] = """
    select cnpj_basico, cast(to_json(struct_pack(
      cnpj_basico := cnpj_basico, identificador_socio := identificador_socio, nome_socio := nome_socio,
      cpf_cnpj_socio := cpf_cnpj_socio, qualificacao_socio := qualificacao_socio,
      data_entrada_sociedade := data_entrada_sociedade, pais := pais,
      cpf_representante_legal := cpf_representante_legal,
      qualificacao_representante := qualificacao_representante, faixa_etaria := faixa_etaria)) as varchar) as record
    from partner_rows"""
CTES["folded"] = """
    select cnpj_basico, list_sort(list(record)) as socios_json from partner_records group by cnpj_basico"""


def wide(source: str) -> str:
    """The 28-column table over ``source`` (``establishments`` or ``cleaned``), dates as dates."""
    return f"""
    select e.cnpj_basico || e.cnpj_ordem || e.cnpj_dv as cnpj,
      {decode('e.identificador_matriz_filial', BRANCH, "''")} as matriz_filial,
      e.nome_fantasia,
      {decode('e.situacao_cadastral', STATUS)} as desc_situacao_cadastral,
      {parse_date('e.data_situacao_cadastral')} as data_situacao_cadastral,
      {parse_date('e.data_inicio_atividade', 'e.data_situacao_cadastral')} as data_inicio_atividade,
      e.cnae_fiscal_principal as cnae,
      {repair('activity.descricao')} as nome_cnae_principal,
      e.cnae_fiscal_secundaria, e.tipo_logradouro, e.logradouro, e.numero, e.complemento, e.bairro, e.cep, e.uf,
      city.descricao as nome_municipio,
      e.ddd_1, e.telefone_1, e.ddd_2, e.telefone_2, e.correio_eletronico,
      {decode('company.porte_empresa', SIZE)} as porte,
      company.razao_social, company.capital_social,
      {repair('nature.descricao')} as natureza_juridica,
      folded.cnpj_basico,
      array_to_string(folded.socios_json, ',') as socios_json
    from {source} e
    left join companies company on company.cnpj_basico = e.cnpj_basico
    left join folded on folded.cnpj_basico = e.cnpj_basico
    left join activities activity on activity.codigo = e.cnae_fiscal_principal
    left join cities city on city.codigo = e.municipio
    left join legal_natures nature on nature.codigo = company.natureza_juridica"""


CTES["wide"] = wide("establishments")
CTES["wide_cleaned"] = wide("cleaned")


def with_tables(query: str) -> str:
    return "with " + ",\n".join(f"{name} as ({body})" for name, body in CTES.items()) + "\n" + query
