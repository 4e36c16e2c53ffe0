"""From raw documents to training text, in stages that each read the one before from Parquet.

Classifier, near-duplicates, benchmark passages, secrets, pieces. All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import latent, near_dups, pieces, quality, secrets
from tidemark.llm.common import prepare, table, written
from tidemark.llm.queries import vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_good(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier scores 1/2 or more; all others go.

    Null and empty texts are scored like any other (all alike); rows without an id
    are scored but teach nothing; repeated rows stay or go together. Without
    trusted positives every score is 1/2 and all stay; an empty table gives none.
    """
    prepare(spark)
    model = quality.train(docs, table(spark, folder, "labels", "doc_id", "quality"))
    scored = quality.score(docs.select(*COLUMNS), model, keep=("doc_id", "lang", "source", "n_chars", "text"))
    return scored.filter("score >= 0.5").select(*COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of documents linked by near-equal shingle sets the one with the least id.

    Links ask for an overlap of 0.8, so there are more bands than for the 0.85 of
    ``op3``: a pair at 0.8 shares none with a chance of 4 in 10 million. Rows
    without an id are in no group and stay; of several rows with one id, which
    hold one text, all stay or go together. Null and wordless texts are linked
    with nothing and stay; an empty table gives none.
    """
    groups = near_dups.near_duplicates(docs.select("doc_id", "text"), percent=80, bands=28)
    gone = groups.filter(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti").select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without a benchmark passage.

    Null and wordless texts hold none and stay, as do rows without an id; rows
    with one id go if any of their texts holds one; an empty table gives none, an
    empty benchmark lets all stay.
    """
    found = latent.contaminated(docs.select("doc_id", "text"), table(spark, folder, "benchmark", "item_id", "text"))
    gone = found.filter("contaminated").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti").select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document, secrets in its text replaced by a mark; n_chars follows where it was known.

    Null texts stay null; a text without secrets is left as it is; repeated rows
    and rows without an id are treated one by one.
    """
    found = secrets.find_secrets(docs.select(*COLUMNS), keep=("text", "lang", "source", "n_chars"))
    clean = secrets.redacted(F.col("text"), F.col("spans"))
    changed = F.size("spans") > 0
    return found.select("doc_id", clean.alias("text"), "lang", "source", F.when(changed & F.col("n_chars").isNotNull(), F.length(clean)).otherwise(F.col("n_chars")).cast("long").alias("n_chars"))


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Each document's ids, with their number and the text they decode to.

    Null and empty texts have no ids and decode to the empty text; repeated rows
    and rows without an id have a row each; an empty table gives none.
    """
    done = pieces.encode_decode(docs.select("doc_id", "text"), vocabulary("piece_bpe_32k.model"))
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality classifier", keep_good),
    ("near-duplicates", keep_one_of_each_group),
    ("benchmark decontamination", drop_leaks),
    ("secret scans", redact_secrets),
    ("piece encoding", encode),
]

#: No stage's method can be put in SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared folder and read again."""
    docs = table(spark, folder, "documents", *COLUMNS)
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, folder), "stage")
    return STAGES[-1][1](spark, docs, folder)
