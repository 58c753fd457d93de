"""From raw documents to training tokens: five stages, each written before the next one reads it.

Every stage but the last returns the columns of ``documents``; where it changes a
text it sets ``n_chars`` to the new length.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from barworks.llm.bpe import encode  # noqa: E402
from barworks.llm.common import table  # noqa: E402
from barworks.llm.decontaminate import decontaminate  # noqa: E402
from barworks.llm.line_dedup import dedup_lines  # noqa: E402
from barworks.llm.quality import reject_low_quality  # noqa: E402
from barworks.llm.queries import vocabulary_path  # noqa: E402
from barworks.llm.simhash import drop_near_duplicates  # noqa: E402
from barworks.session import scratch_path, write_and_reread  # noqa: E402


def _with_length(docs, names):
    """The columns of documents, lengths as the texts are now (a null text keeps what it had)."""
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), F.col("n_chars"))).select(*names)


def quality_stage(spark, docs, sf_dir):
    """Documents that the classifier scores below 0.3 go."""
    return reject_low_quality(docs, table(spark, sf_dir, "labels"))


def line_stage(spark, docs, sf_dir):
    """Lines of 40 code points or more that 5 documents hold stay only in the one of largest id."""
    return _with_length(dedup_lines(docs), docs.columns)


def near_duplicate_stage(spark, docs, sf_dir):
    """Of documents linked by SimHash (three-word shingles, 3 bits), the one of smallest id stays."""
    return drop_near_duplicates(docs)


def decontamination_stage(spark, docs, sf_dir):
    """Passages of benchmark items go, and with them documents that are mostly such passages."""
    return _with_length(decontaminate(docs, table(spark, sf_dir, "benchmark")), docs.columns)


def encoding_stage(spark, docs, sf_dir):
    """The documents with their packed token ids."""
    return encode(docs, vocabulary_path())


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_duplicate_stage),
    ("decontaminate", decontamination_stage),
    ("bpe", encoding_stage),
]

#: A trained model and a tokenizer are not to be had in SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_and_reread(stage(spark, docs, sf_dir), scratch_path(spark, f"pipeline-{name}"))
    return docs
