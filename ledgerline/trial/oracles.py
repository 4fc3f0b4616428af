"""The same results in SQL, for every query whose result SQL can state."""

from __future__ import annotations

from ledgerline.schemas import COMPANIES, DATASETS, ESTABLISHMENTS, LOOKUP, PARTNERS, WIDE, WIDE_DATES, WIDE_V1
from ledgerline.trial.oracle_tables import (
    AGE_BAND,
    BRANCH,
    PARTNER_TYPE,
    SIZE,
    STATUS,
    clean,
    decode,
    parse_date,
    repair,
    with_tables,
)

_CNPJ = "cnpj_basico || cnpj_ordem || cnpj_dv"
_PARTS = "cnpj_basico, cnpj_ordem, cnpj_dv"


def _text(columns, prefix: str = "") -> str:
    """The columns, dates as ISO text."""
    return ", ".join(f"cast({prefix}{c} as varchar) as {c}" if c in WIDE_DATES else f"{prefix}{c}" for c in columns)


def _plain(columns) -> str:
    return ", ".join(columns)


def _code(label: str, table: str, key: str, code: str) -> str:
    return f"select {key}, {code}, {label} as label from {table}"


_lookups = [name for name, dataset in DATASETS.items() if dataset.columns == LOOKUP]

_first_last = """
    select {header} as header, min(razao_social) as first, max(razao_social) as last,
      count(distinct cnpj_basico) as different from {table}"""

_BODIES = {
    "scan_csv": """
        select cast(o_orderkey as varchar) as o_orderkey, cast(o_custkey as varchar) as o_custkey, o_orderstatus,
          cast(cast(o_totalprice as decimal(18, 2)) as varchar) as o_totalprice,
          strftime(o_orderdate, '%Y-%m-%d') as o_orderdate, o_orderpriority from orders""",
    # Read as UTF-8, the Latin-1 letter arrives as the undecodable mark.
    "scan_lookup": " union all ".join(f"select codigo, descricao, '{name}' as dataset from {name}" for name in _lookups),
    "scan_companies": f"select {_plain(COMPANIES)} from companies",
    "scan_establishments": f"select {_plain(ESTABLISHMENTS)} from cleaned",
    "scan_partners": f"select {_plain(PARTNERS)} from partners",
    "scan_by_suffix": "select codigo, descricao from activities",
    "clean_text": f"select doc_id, {clean('text')} as text from documents",
    "decode_latin1": f"select {_PARTS}, nome_fantasia from establishments",
    "unzip_members": """
        select 'TEXTCSV' as kind, cast(doc_id as varchar) || chr(9) || unnest(string_split(text, chr(10))) as line
        from documents
        union all select 'LISTA', cast(doc_id as varchar) from documents""",
    "route_members": """
        select 'TEXTCSV' as dataset, cast(doc_id as varchar) || chr(9) || unnest(string_split(text, chr(10))) as line
        from documents""",
    "listing_links": r"""
        select page_id, file_name from (
          select page_id, replace(replace(replace(replace(replace(
            regexp_replace(link, '^["'']|["'']$', '', 'g'),
            '&quot;', '"'), '&#39;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') as file_name
          from (
            select page_id, unnest(regexp_extract_all(
              regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script>', '', 'g'),
              '(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|''[^'']*''|[^\s>"'']+)', 1)) as link
            from pages))
        where file_name <> '' and file_name[1] not in ('?', 'L', 'a')""",
    "replace_table": """
        select cast(o_orderkey as varchar) as o_orderkey, o_custkey,
          cast(cast(o_orderdate as date) as varchar) as o_orderdate,
          cast(cast(o_totalprice as decimal(18, 2)) as varchar) as o_totalprice from orders""",
    "insert_positional": """
        select codigo as chave, descricao as texto from activities
        union all select cnpj_basico, razao_social from companies""",
    "ordered_output": f"select {_plain(PARTNERS)} from partners",
    "export_csv_gz": "select * replace (concat_ws(chr(13) || chr(10), logradouro, numero, '\"' || chr(10)) as logradouro) "
    "from establishments",
    "list_parts": "select 'part.csv.gz' as name, true as filled, true as complete, count(*) as records from companies",
    "audit_landed_files": """
        select 'register.' || unnest(['QUALSCSV', 'PAISCSV', 'MUNICCSV']) as file_name,
          '2024-01-15 09:00:00' as download_timestamp""",
    "random_sample": """
        select least(100, count(*)) as drawn, least(100, count(*)) as different, 0 as strange from establishments""",
    "partners_in_parts": "select cnpj_basico, record from partner_records",
    "sample_answer": """
        select cast(to_json(struct_pack(cnpj := cnpj, nome_fantasia := nome_fantasia, cnae := cnae, uf := uf,
          nome_municipio := nome_municipio, razao_social := razao_social)) as varchar) as data
        from (select * from wide where uf = 'S07' order by md5('2021' || cnpj), cnpj limit 100)""",
    "read_parts_as_one": _first_last.format(header="false", table="companies")
    + " union all select true, 'razao_social', 'razao_social', 1",
    "stage_load": f"select {_text(WIDE)} from wide",
    "stage_to_typed": f"""
        select {_text(WIDE)} from (
          select *, row_number() over (partition by cnpj order by {', '.join(f'{c} nulls first' for c in WIDE[1:])}) as n
          from wide where cnpj is not null)
        where n = 1""",
    "publish_swap": """
        select cnpj_basico, nome_fantasia as nome, 'served' as state from establishments
        union all select cnpj_basico, razao_social, 'backup' from companies""",
    "rollback": """
        select cnpj_basico, razao_social as nome, 'served' as state from companies
        union all select cnpj_basico, nome_fantasia, 'error' from establishments""",
    "ingest_audit": "select url as file_name, '2024-01-15 09:00:00' as download_timestamp from pages",
    "project_rename": f"select {_PARTS}, cnae_fiscal_principal as cnae, logradouro from establishments",
    "filter_not_null": """
        select cnpj_basico, cnpj_dv, nome_fantasia from establishments where nome_fantasia is not null""",
    "filter_header_rows": """
        select o_orderkey, o_orderpriority as chave from orders where o_orderpriority not in ('1-URGENT', '5-LOW')""",
    "filter_optional": f"""
        with asked as (select {_CNPJ} as cnpj, cnae_fiscal_principal as cnae, uf from establishments)
        select *, 'uf' as asked from asked where uf = 'S07'
        union all select *, 'cnae' from asked where cnae = '0000007'
        union all select *, 'both' from asked where cnae = '0000007' and uf = 'S07'
        union all select *, 'none' from asked""",
    "lookup_left_join": f"""
        select {_PARTS}, cnae_fiscal_principal, municipio, a.descricao as cnae_descricao, c.descricao as cidade_descricao
        from establishments
        left join activities a on a.codigo = cnae_fiscal_principal
        left join cities c on c.codigo = municipio""",
    "role_playing_lookup": """
        select cpf_cnpj_socio, s.descricao as socio_descricao, r.descricao as representante_descricao
        from partners
        left join qualifications s on s.codigo = qualificacao_socio
        left join qualifications r on r.codigo = qualificacao_representante""",
    "chained_lookup": """
        select e.cnpj_basico, cnpj_ordem, cnpj_dv, razao_social, capital_social, natureza_juridica,
          n.descricao as natureza_descricao
        from establishments e
        left join companies c on c.cnpj_basico = e.cnpj_basico
        left join legal_natures n on n.codigo = c.natureza_juridica""",
    "fact_fact_left_join": """
        select e.cnpj_basico, cnpj_ordem, cnpj_dv, razao_social, capital_social, natureza_juridica
        from establishments e left join companies c on c.cnpj_basico = e.cnpj_basico""",
    "join_preaggregated": """
        select e.cnpj_basico as basico, cnpj_ordem, cnpj_dv, f.cnpj_basico, array_to_string(socios_json, ',') as socios_json
        from establishments e left join folded f on f.cnpj_basico = e.cnpj_basico""",
    "join_on_prefix": f"""
        select k.cnpj, substr(k.cnpj, 1, 8) as prefix, c.cnpj_basico, c.razao_social
        from (select {_CNPJ} as cnpj from establishments) k
        left join companies c on c.cnpj_basico = substr(k.cnpj, 1, 8)""",
    "insert_if_absent": """
        select cnpj_basico, razao_social as nome from companies
        union all
        select cnpj_basico, nome from (
          select cnpj_basico, nome_fantasia as nome,
            row_number() over (partition by cnpj_basico order by nome_fantasia nulls first) as n from establishments) e
        where n = 1 and not exists (select 1 from companies c where c.cnpj_basico = e.cnpj_basico)""",
    "partners_json_agg": f"""
        select cnpj_basico, array_to_string(list_sort(list(record)), ',') as socios_json from (
          select cnpj_basico, cast(to_json(struct_pack({', '.join(f'{c} := {c}' for c in PARTNERS)})) as varchar) as record
          from partners)
        group by cnpj_basico""",
    "count_rows": "select count(*) as qt from lineitem",
    "count_distinct_key": "select count(distinct cnpj_basico) as qt from establishments",
    "distinct_rows": """
        select distinct identificador_matriz_filial, situacao_cadastral, uf, municipio from establishments""",
    "dedup_by_key": f"""
        select {_plain(ESTABLISHMENTS)} from (
          select *, row_number() over (partition by cnpj_basico
            order by {', '.join(f'{c} nulls first' for c in ESTABLISHMENTS[1:])}) as n from establishments)
        where n = 1""",
    "seeded_sample": f"""
        select * from (select {_CNPJ} as cnpj, uf, logradouro from establishments)
        order by md5('2021' || cnpj), cnpj limit 100""",
    "sample_registry": f"""
        select {_text(WIDE)} from wide where uf = 'S07' order by md5('2021' || cnpj), cnpj limit 100""",
    "decode_partner_type": _code(
        decode("identificador_socio", PARTNER_TYPE), "partners", "cpf_cnpj_socio", "identificador_socio"
    ),
    "decode_age_band": _code(decode("faixa_etaria", AGE_BAND), "partners", "cpf_cnpj_socio", "faixa_etaria"),
    "decode_branch": _code(
        decode("identificador_matriz_filial", BRANCH, "''"), "establishments", _PARTS, "identificador_matriz_filial"
    ),
    "decode_status": _code(
        decode("situacao_cadastral", STATUS), "establishments", _PARTS, "situacao_cadastral"
    ),
    "decode_size": _code(decode("porte_empresa", SIZE), "companies", "cnpj_basico", "porte_empresa"),
    "safe_parse_date": _code(
        f"cast({parse_date('data_situacao_cadastral')} as varchar)", "establishments", _PARTS, "data_situacao_cadastral"
    ),
    "guarded_parse_date": f"""
        select {_PARTS}, data_inicio_atividade, data_situacao_cadastral,
          cast({parse_date('data_inicio_atividade', 'data_situacao_cadastral')} as varchar) as inicio
        from establishments""",
    "repair_text": f"select codigo, {repair('descricao')} as descricao from activities",
    "build_key": f"select {_CNPJ} as cnpj, cnpj_dv || nome_fantasia as nullable from establishments",
    "row_to_json": "select record as json from partner_records",
    "array_to_text": """
        select c.cnpj_basico, array_to_string(nomes, ',') as texto from companies c
        left join (
          select cnpj_basico, [null, max(nome_fantasia)] || list_sort(list(distinct bairro)) as nomes
          from establishments group by cnpj_basico) e on e.cnpj_basico = c.cnpj_basico""",
    "cast_date": """
        select l_orderkey, l_linenumber, cast(cast(strftime(l_shipdate, '%Y-%m-%d') as date) as varchar) as dia
        from lineitem""",
    "key_prefix": f"select {_CNPJ} as cnpj, substr({_CNPJ}, 1, 8) as basico from establishments",
    "strip_suffix": "select page_id, substr(url, 1, length(url) - 4) as name from pages",
    "gate_row_count": """
        select count(*) as loaded, count(*) as expected, true as passed, true as one_header_each from companies""",
    "gate_distinct_key": """
        select count(distinct cnpj_basico) as loaded, count(distinct cnpj_basico) as expected, true as passed
        from establishments""",
    "partners_json": "select cnpj_basico, array_to_string(socios_json, ',') as socios_json from folded",
    "registry_wide": f"select {_text(WIDE)} from wide",
    "registry_wide_v1": f"select {_text(WIDE_V1)} from wide",
    "registry_wide_v2": f"""
        select {_text(WIDE_V1, 'w.')}, f.cnpj_basico, array_to_string(f.socios_json, ',') as socios_json
        from wide w left join folded f on f.cnpj_basico = substr(w.cnpj, 1, 8)""",
    "refresh": f"""
        select {_text(WIDE)} from (
          select *, row_number() over (partition by cnpj order by {', '.join(f'{c} nulls first' for c in WIDE[1:])}) as n
          from wide_cleaned where cnpj is not null)
        where n = 1""",
}


def oracles() -> dict[str, str]:
    return {name: with_tables(_merged(body)) for name, body in _BODIES.items()}


def _merged(body: str) -> str:
    """A body with a CTE of its own, as a subquery."""
    return f"select * from ({body})" if body.strip().startswith("with ") else body
