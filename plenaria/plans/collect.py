"""Collection jobs over landing data.

Network fetching is not part of the library: responses land as JSON text and
these jobs turn them into proposal records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plenaria import vocab
from plenaria.functions.authors import senate_author
from plenaria.functions.util import in_list, lit_array, lookup
from plenaria.operators.capture import two_route_capture
from plenaria.operators.dedup import first_per_key
from plenaria.operators.rollup import apply_profiles, author_rollup, enrich_authors
from plenaria.sources import landing


def worklist(spark: SparkSession, terms=vocab.SEARCH_TERMS, types=vocab.CHAMBER_TYPES,
             first_year: int = vocab.YEAR_START, last_year: int = vocab.YEAR_END) -> DataFrame:
    """Every (term, type, year) request unit, generated by explode (no join)."""
    return (spark.range(1)
            .select(F.explode(lit_array(terms)).alias("termo"))
            .select("termo", F.explode(lit_array(types)).alias("tipo"))
            .select("termo", "tipo", F.explode(F.sequence(F.lit(first_year), F.lit(last_year))).alias("ano")))


def pending_work(units: DataFrame, done: DataFrame, keys=("termo", "tipo", "ano")) -> DataFrame:
    """Units not done yet (anti-join on the unit key)."""
    return units.join(done.select(*keys).distinct(), list(keys), "left_anti")


def done_units(proposals: DataFrame, terms=vocab.SEARCH_TERMS, types=vocab.CHAMBER_TYPES,
               first_year: int = vocab.YEAR_START, last_year: int = vocab.YEAR_END) -> DataFrame:
    """Chamber units already present in collected data, restricted to the configured
    domain (so the anti-join's right side is bounded by the work list)."""
    return (proposals.filter(F.col("origem") == "CD")
            .select(F.col("termo_busca").alias("termo"), "tipo",
                    F.col("ano").try_cast("int").alias("ano"))
            .filter(in_list(F.col("termo"), terms) & in_list(F.col("tipo"), types)
                    & F.col("ano").between(first_year, last_year)))


def merge_by_term_priority(records: DataFrame, key: str = "id_interno",
                           terms=vocab.SEARCH_TERMS) -> DataFrame:
    """First-wins merge of records found by several terms: lowest term position wins."""
    pos = lookup({t: i for i, t in enumerate(terms)}, "termo_busca", len(terms))
    return first_per_key(records.withColumn("_term_pos", pos), [key], ["_term_pos"]).drop("_term_pos")


def collect_chamber(pages: DataFrame, author_responses: DataFrame,
                    profiles: DataFrame | None = None, terms=vocab.SEARCH_TERMS) -> DataFrame:
    """Page records (with ``termo_busca``) -> one record per id with its authors."""
    recs = landing.chamber_records(pages, keep=("termo_busca",))
    recs = merge_by_term_priority(recs, "id_interno", terms)
    authors = landing.chamber_authors(author_responses, key="id_interno")
    if profiles is not None:
        authors = apply_profiles(authors, profiles)
    roll = author_rollup(authors, "id_interno", ["pos"], recs.select("id_interno", "tipo"))
    return enrich_authors(recs, roll, "id_interno")


def both_houses(chamber: DataFrame, senate: DataFrame) -> DataFrame:
    """The collected records of both houses in one table; a column that only one house has is null for the other."""
    return chamber.unionByName(senate, allowMissingColumns=True)


def collect_senate(processes: DataFrame, details: DataFrame, terms=vocab.SEARCH_TERMS,
                   doc_types=vocab.SENATE_TYPES, content_types=vocab.SENATE_CONTENT_TYPES) -> DataFrame:
    """Process listing + details -> captured records with author fields and subjects.

    ``details``: (id_processo, indexacao, assunto_geral, assunto_especifico).
    """
    procs = landing.senate_processes(processes)
    procs = (procs.withColumn("_a", senate_author(F.col("autoria"), F.col("tipo_doc")))
             .select("*", "_a.parlamentar", "_a.tipo_autor", "_a.uf").drop("_a", "autoria"))
    det = details.select("id_processo", "indexacao", "assunto_geral", "assunto_especifico")
    captured = two_route_capture(procs, det, terms, doc_types, content_types, detail_key="id_processo")
    return (captured
            .withColumn("id_interno", F.concat(F.lit("SF-"), F.col("cod")))
            .withColumn("uri", F.concat(F.lit("http://legis.senado.leg.br/dadosabertos/materia/"), F.col("cod")))
            .withColumnRenamed("tipo_doc", "tipo"))
