"""Queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import collocations, ngram_join, topk, trie, warc
from .collocations import op12_collocations
from .extraction import op5_extraction
from .fingerprints import op6_fingerprints
from .mixing import op1_mixing
from .ngram_join import op9_ngram_join
from .packing import op8_packing
from .pii import op4_pii
from .quality import op7_quality
from .sharding import op3_sharding
from .topk import op11_topk
from .toxicity import op10_toxicity
from .trie import op13_trie
from .warc import op2_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mixing, op2_warc, op3_sharding, op4_pii, op5_extraction, op6_fingerprints, op7_quality, op8_packing, op9_ngram_join, op10_toxicity,
        op11_topk, op12_collocations, op13_trie,
    )
}
ORACLE: dict[str, str] = {
    "op2_warc": warc.ORACLE_SQL, "op9_ngram_join": ngram_join.ORACLE_SQL,
    "op11_topk": topk.ORACLE_SQL, "op12_collocations": collocations.ORACLE_SQL, "op13_trie": trie.ORACLE_SQL,
}
