"""Each company's partners as JSON records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import codes, dates, text
from ledgerline.operators.fold import KEY, MAX_CELL_BYTES, PART_BYTES, fold, fold_in_parts, oversize_keys, record_bytes
from ledgerline.operators.joins import Measures, lookup
from ledgerline.schemas import PARTNER_RECORD
from ledgerline.workspace import Workspace

# A date as text.
DATE_BYTES = 10


def partner_rows(
    partners: DataFrame,
    qualifications: DataFrame,
    countries: DataFrame,
    fix_representative: bool = False,
    measures: Measures | None = None,
) -> DataFrame:
    """Partners with decoded codes, in the published field order.

    The representative's qualification has always been looked up with the partner's own code, so it equals
    the partner's; ``fix_representative`` uses the representative's code.
    """
    looked_up = lookup(
        partners.select(
            "cnpj_basico",
            "identificador_socio",
            "nome_socio",
            "cpf_cnpj_socio",
            "qualificacao_socio",
            "data_entrada_sociedade",
            "pais",
            "representante_legal",
            "qualificacao_representante",
            "faixa_etaria",
        ),
        ("qualificacao_socio", qualifications, "own"),
        ("qualificacao_representante" if fix_representative else "qualificacao_socio", qualifications, "agent"),
        ("pais", countries, "country"),
        measures=measures,
    )
    return looked_up.select(
        "cnpj_basico",
        codes.partner_type(F.col("identificador_socio")).alias("identificador_socio"),
        "nome_socio",
        "cpf_cnpj_socio",
        text.repair(F.col("own_descricao")).alias("qualificacao_socio"),
        dates.parse_date(F.col("data_entrada_sociedade")).alias("data_entrada_sociedade"),
        F.col("country_descricao").alias("pais"),
        F.col("representante_legal").alias("cpf_representante_legal"),
        text.repair(F.col("agent_descricao")).alias("qualificacao_representante"),
        codes.age_band(F.col("faixa_etaria")).alias("faixa_etaria"),
    )


def partners_json(
    partners: DataFrame,
    qualifications: DataFrame,
    countries: DataFrame,
    fix_representative: bool = False,
    keyless: bool = True,
    max_bytes: int = MAX_CELL_BYTES,
    measures: Measures | None = None,
) -> DataFrame:
    """``(cnpj_basico, socios_json)``: the array of a company's partner records, complete.

    Partners without a company are a group, too, unless ``keyless`` is false, as it may be where the arrays are only
    joined: that group matches nothing.

    A company with more records than a row may hold is an error that names it; :func:`partners_in_parts` has the
    layout for registers with such companies.
    """
    measures = measures or Measures(partners, qualifications, countries)
    bound = _key_bound(partners, qualifications, countries, measures)
    partners = partners if keyless else partners.where(F.col(KEY).isNotNull())
    rows = partner_rows(partners, qualifications, countries, fix_representative, measures)
    return fold(rows, PARTNER_RECORD, max_bytes, bound)


def _key_bound(partners: DataFrame, qualifications: DataFrame, countries: DataFrame, measures: Measures) -> int:
    """Upper bound of the bytes of any company's records."""
    read, own, country = measures.of(partners, qualifications, countries)
    # The partners as read, and for each row the longest labels and descriptions; repeated codes repeat rows.
    repeats = max(1, own.key_rows) ** 2 * max(1, country.key_rows)
    labels = sum(max(len(label.encode()) for label in known.values()) for known in (codes.PARTNER_TYPE, codes.AGE_BAND))
    # A repaired mark is never longer than the one it replaces.
    added = labels + DATE_BYTES + 2 * own.row_text + country.row_text
    return repeats * record_bytes(PARTNER_RECORD, read.key_text + read.key_rows * added, read.key_rows)


def partners_in_parts(
    partners: DataFrame,
    qualifications: DataFrame,
    countries: DataFrame,
    fix_representative: bool = False,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``(cnpj_basico, part, socios_json)``: the same records in arrays of bounded size, for companies of any size."""
    rows = partner_rows(partners, qualifications, countries, fix_representative)
    return fold_in_parts(rows, PARTNER_RECORD, part_bytes)


def partners_with_chunks(
    workspace: Workspace,
    partners: DataFrame,
    qualifications: DataFrame,
    countries: DataFrame,
    max_bytes: int = MAX_CELL_BYTES,
    part_bytes: int = PART_BYTES,
    measures: Measures | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """The arrays of :func:`partners_json`, for companies of any size, and the chunks that did not fit into them.

    A company with more than ``max_bytes`` of records has the first chunk of its records as its array; the others are in
    ``(cnpj_basico, part, socios_json)``, and every record is in one of the two. Without such a company there are no chunks
    (None). Partners without a company are left out: an array of them would match nothing, however many they are.
    """
    measures = measures or Measures(partners, qualifications, countries)
    bound = _key_bound(partners, qualifications, countries, measures)
    rows = partner_rows(partners.where(F.col(KEY).isNotNull()), qualifications, countries, measures=measures)
    if bound <= max_bytes:
        return fold(rows, PARTNER_RECORD, max_bytes, bound), None
    # At most one company for each ``max_bytes`` of records.
    over = workspace.keep(oversize_keys(rows, PARTNER_RECORD, max_bytes).select(KEY), "oversize")
    if over.isEmpty():
        return fold(rows, PARTNER_RECORD, max_bytes, max_bytes), None
    fitting = fold(rows.join(over, KEY, "left_anti"), PARTNER_RECORD, max_bytes, max_bytes)
    parts = fold_in_parts(rows.join(over, KEY, "left_semi"), PARTNER_RECORD, part_bytes)
    parts = workspace.keep(parts, "parts")
    firsts = parts.groupBy(KEY).agg(F.min("part").alias("part"))
    first = parts.join(firsts, [KEY, "part"], "left_semi").drop("part")
    return fitting.unionByName(first), parts.join(firsts, [KEY, "part"], "left_anti")


def records_gate(partners: DataFrame, qualifications: DataFrame, countries: DataFrame, *folded: DataFrame) -> DataFrame:
    """``(loaded, expected, passed)``: the arrays of all ``folded`` tables together have as many records as companies have
    partner rows."""
    rows = partner_rows(partners.where(F.col(KEY).isNotNull()), qualifications, countries).agg(F.count(F.lit(1)).alias("n"))
    counts = [rows.select(F.lit(0).cast("long").alias("loaded"), F.col("n").alias("expected"))]
    for table in folded:
        loaded = F.coalesce(F.sum(F.size("socios_json")), F.lit(0)).cast("long")
        counts.append(table.agg(loaded.alias("loaded")).withColumn("expected", F.lit(0).cast("long")))
    both = reduce(DataFrame.unionAll, counts).agg(F.sum("loaded").alias("loaded"), F.sum("expected").alias("expected"))
    return both.withColumn("passed", F.col("loaded") == F.col("expected"))
