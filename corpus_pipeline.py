"""Cleaning and packing of a document table, stage by stage.

Each stage takes the documents its predecessor kept, and all but the last return the columns of `documents`: toxic
documents go, one document of each group of near copies stays, documents that hold benchmark items go, personal data is
replaced by its kind (n_chars counts the new text), and what is left is packed into sequences.

Edge cases: null and empty texts are clean, are copies of nothing and become sequences of the closing id alone; rows
without an id stay rows of their own unless their texts are near copies; repeated rows are copies; a text of any length
is read whole; without usable labels nothing is toxic; an empty table gives no rows; further columns pass through to the
last stage, whatever their names, and n_chars may be missing.
"""

from pyspark.sql import functions as F

from gridlake.llm.common import read_table, stage
from gridlake.llm.decontamination import with_hits
from gridlake.llm.ngram_join import one_of_each
from gridlake.llm.packing import pack_documents
from gridlake.llm.pii import fit_pii, redacted_column
from gridlake.llm.toxicity import REJECT, fit_toxicity, with_toxicity


def unused(name, docs):
    """`name`, with underscores behind it until no column of `docs` is called so (names differ by case alone too)."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def drop_toxic(spark, docs, sf_dir):
    """Documents that score below the limit; a null text stays."""
    model = fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    score = unused("_toxicity", docs)
    return with_toxicity(docs, model, score).where(F.col(score) < REJECT).select(docs.columns)


def drop_near_copies(spark, docs, sf_dir):
    return one_of_each(docs)


def drop_contaminated(spark, docs, sf_dir):
    hits = unused("_hits", docs)
    return with_hits(docs, read_table(spark, sf_dir, "benchmark"), hits).where(F.size(hits) == 0).select(docs.columns)


def redact_personal_data(spark, docs, sf_dir):
    clean = docs.withColumn("text", redacted_column(fit_pii(docs), F.col("text")))
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def pack(spark, docs, sf_dir):
    import public_tokenizers

    pieces = pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("packing", pack),
]
#: Scores, field and packing cannot be said in SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The packed pieces of what the stages keep of the documents."""
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
