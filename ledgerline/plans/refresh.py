"""The full refresh: landed files → wide table → export → staged load → gates → published table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerline.operators.fold import FOLDED, KEY
from ledgerline.operators.joins import Measures
from ledgerline.operators.keys import COPIES
from ledgerline.plans import gates, load
from ledgerline.plans.partners import partners_json, partners_with_chunks, records_gate
from ledgerline.plans.publish import Tables, chunks_of, next_version, publish
from ledgerline.plans.wide import registry_wide
from ledgerline.schemas import DATASETS, text_schema, typed_wide_schema
from ledgerline.sinks.export import export_csv
from ledgerline.sinks.tables import replace_table
from ledgerline.sources.register import require_well_formed, scan, scan_cleaned
from ledgerline.workspace import Workspace

PARTNERS_JSON = T.StructType([T.StructField(KEY, T.StringType()), T.StructField(FOLDED, T.ArrayType(T.StringType()))])
CHUNKS = T.StructType([PARTNERS_JSON[KEY], T.StructField("part", T.LongType()), PARTNERS_JSON[FOLDED]])


def build(
    spark: SparkSession, landing: str, workspace: Workspace, database: str, encoding: str = "UTF-8", chunked: bool = True
) -> tuple[DataFrame, gates.Counted, DataFrame | None]:
    """Landed files → the warehouse tables ``socios_agg_json`` and ``registry_source``; returns the latter, its counts and
    the chunks of companies that have more partners than a row may hold, if there are any.

    Text is parsed once: all datasets go to Parquet, and a line without exactly its dataset's columns stops the run before any
    table is written. So does a company of more partners than a row may hold where the result may not be ``chunked``. With
    chunks the records in arrays and chunks are counted against the partner rows.
    """

    def parsed(name: str) -> DataFrame:
        if name == "establishments":
            return require_well_formed(workspace.keep(scan_cleaned(spark, landing, name, bad_records=True), name))
        return require_well_formed(workspace.keep(scan(spark, landing, name, encoding, bad_records=True), name))

    data = {name: parsed(name) for name in DATASETS}
    codes = ("activities", "cities", "legal_natures")
    measures = Measures(data["partners"], *(data[n] for n in ("qualifications", "countries", *codes)))
    partners = (data["partners"], data["qualifications"], data["countries"])
    if chunked:
        folded, chunks = partners_with_chunks(workspace, *partners, measures=measures)
    else:
        folded, chunks = partners_json(*partners, measures=measures), None
    folded = replace_table(folded, f"{database}.socios_agg_json", PARTNERS_JSON)
    if chunks is not None:
        chunks = workspace.keep(chunks, "chunks")
        gates.require(records_gate(*partners, folded, chunks))
    wide = registry_wide(
        data["establishments"],
        data["companies"],
        *(data[n] for n in codes),
        folded,
        measures=measures,
    )
    counting = gates.Counting(wide, load.KEY)
    source = replace_table(counting.rows, f"{database}.registry_source", typed_wide_schema())
    return source, counting.found(), chunks


def hand_over(
    spark: SparkSession,
    source: DataFrame,
    expected: gates.Counted,
    workspace: Workspace,
    tables: Tables,
    through_files: bool = True,
    chunks: DataFrame | None = None,
) -> DataFrame:
    """Load ``source`` as a new version, check it and publish it; returns the served table.

    ``chunks`` of companies above a row's size become a table beside the version, served, backed up and rolled back with it.

    Loading goes through exported shards and a staging table, as it must when another system takes over the
    files. Without that, the same rows are loaded straight from ``source``. ``expected`` are the source's counts, seen
    when it was written; both gates compare with what was seen on the way into the tables, without reading them.
    """
    rows = source
    if through_files:
        shards = export_csv(source, workspace.path("export"))
        counting = gates.Counting(load.stage(spark, shards), load.KEY)
        rows = replace_table(counting.rows, tables.stage, text_schema(source.columns))
        gates.require_staged(counting.found(), expected)
    # Sorted files take the place of an index on the activity code.
    version = next_version(spark, tables)
    counting = gates.Counting(load.typed(rows, copies=True, stored=True), load.KEY, copies=COPIES)
    replace_table(counting.rows, version, typed_wide_schema(), sort_by="cnae")
    gates.require_typed(counting.found(), expected)
    spark.sql(f"DROP TABLE IF EXISTS {chunks_of(version)}")
    if chunks is not None:
        replace_table(chunks, chunks_of(version), CHUNKS)
    publish(spark, tables, version)
    return spark.table(tables.served)


def refresh(
    spark: SparkSession,
    landing: str,
    database: str | None = None,
    run: str | None = None,
    encoding: str = "UTF-8",
    through_files: bool = True,
    chunked: bool = True,
) -> DataFrame:
    """Run everything on the files below ``landing``; returns the served table ``<database>.registry``.

    The next refresh into the same database keeps what is served now as the backup. The database is created if it is
    not there; without one, one of this run's own is used. Runs of the same name overwrite each other's files. A company of more partners than a row
    may hold is served with the first chunk of them, the rest is in :func:`ledgerline.plans.publish.served_chunks`; unless
    ``chunked``, it stops the run.
    """
    workspace = Workspace(spark, "refresh", run)
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    else:
        database = workspace.database()
    source, expected, chunks = build(spark, landing, workspace, database, encoding, chunked)
    served = hand_over(spark, source, expected, workspace, Tables(f"{database}.registry"), through_files, chunks)
    # What is served is in tables; the run's own files are done with.
    workspace.discard("kept")
    workspace.discard("export")
    return served
