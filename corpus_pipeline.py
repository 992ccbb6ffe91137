"""The corpus pipeline: quality rules, near-duplicates, benchmark decontamination, secrets, mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next
stage's documents. No ORACLE_SQL: SimHash fingerprints need XXH64, which SQL has not. The tests compare the whole run with
a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daygrid.llm import decontaminate, mixing, quality, secrets, simhash
from daygrid.llm.common import staged, table

STAGES = [
    ("quality rules", quality.reject),
    ("SimHash near-dedup", simhash.keep_one),
    ("benchmark decontamination", decontaminate.drop_contaminated),
    ("secret scans", secrets.blank),
    ("mixing sources to target weights", mixing.mix),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = staged(function(spark, docs, sf_dir), name.split()[0].lower())
    return docs
