"""Two-route capture (C2 core: F5-F7, J7, J3, J13).

Route 1 matches the search terms in the listing's summary.  Only rows that
missed route 1 *and* have a listed content type are candidates for route 2,
which matches the terms in the detail text; the cheap predicate is evaluated
before the detail join so the join only receives rows that can still be
captured.  Each side matches its own text before the join, so the join carries
terms and never a detail text.  A key captured by both routes keeps route 1
(first-wins merge).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plenaria import vocab
from plenaria.functions.util import in_list
from plenaria.operators.dedup import first_per_key
from plenaria.operators.filters import require_key
from plenaria.operators.term_match import first_term


def two_route_capture(listing: DataFrame, details: DataFrame, terms,
                      doc_types=vocab.SENATE_TYPES,
                      content_types=vocab.SENATE_CONTENT_TYPES,
                      key: str = "cod", summary: str = "ementa", detail_text: str = "indexacao",
                      doc_type: str = "tipo_doc", content_type: str = "tipo_conteudo",
                      detail_key: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """Captured rows: listing columns + ``termo_busca`` + ``rota`` (1 summary, 2 detail).

    ``columns``: the listing columns to return (all by default); a summary left out is not shuffled.
    """
    cand = require_key(listing.filter(in_list(F.col(doc_type), doc_types)), key)
    cand = cand.withColumn("_t1", first_term(summary, terms))
    cand = cand.filter(F.col("_t1").isNotNull()
                       | F.coalesce(in_list(F.col(content_type), content_types), F.lit(False)))
    if columns is not None:
        cand = cand.select(*dict.fromkeys([key, detail_key or key, *columns]), "_t1")
    found = details.withColumn("_t2", first_term(detail_text, terms)).drop(detail_text)
    captured = (cand.join(found, detail_key or key, "left")
                .withColumn("termo_busca", F.coalesce("_t1", "_t2"))
                .withColumn("rota", F.when(F.col("_t1").isNotNull(), F.lit(1)).otherwise(F.lit(2)))
                .filter(F.col("termo_busca").isNotNull())
                .drop("_t1", "_t2"))
    return first_per_key(captured, [key], ["rota"])
