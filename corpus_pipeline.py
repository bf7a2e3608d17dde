"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the documents of
the next stage. All but the last return the columns of documents.
"""

from pyspark.sql import functions as F

from jobsieve.llm import decontaminate, line_dedup, near_dedup, packing, toxicity
from jobsieve.llm.common import small_batches, stored, table
from jobsieve.llm.queries import tokenizer
from jobsieve.session import scratch_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Words in a shingle, and percent of shared shingles from which documents are near copies.
SHINGLE, PERCENT = 5, 80
#: Chunks that a worker of the last stage keeps: it still holds memory of the stages before.
KNOWN = 150_000

#: The stages learn, hash and tokenise, which SQL cannot express; a brute-force version tests them.
ORACLE_SQL = None


def drop_toxic(spark, docs, sf_dir):
    """Documents with a toxicity score below the threshold, learnt from the labels of documents still here."""
    small_batches(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = model.score(docs.select(*COLUMNS), out="toxicity")
    return scored.filter(F.col("toxicity") < toxicity.THRESHOLD).select(*COLUMNS)


def drop_repeated_lines(spark, docs, sf_dir):
    """All documents, less lines that at least five documents hold; ``n_chars`` follows the text."""
    small_batches(spark)
    docs = docs.select(*COLUMNS)
    cleaned = line_dedup.LineState(spark, scratch_dir(spark, "lines")).insert(docs).clean(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def drop_near_copies(spark, docs, sf_dir):
    """One document, that of the smallest id, of each group of near copies."""
    return near_dedup.drop_copies(docs.select(*COLUMNS), words=SHINGLE, percent=PERCENT)


def drop_contaminated(spark, docs, sf_dir):
    """Documents of which less than a twentieth of the words lie in benchmark windows."""
    small_batches(spark)
    return decontaminate.decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def pack(spark, docs, sf_dir):
    """Pieces of all documents with their places in sequences of 4,096 tokens."""
    small_batches(spark)
    return packing.pack_documents(docs.select("doc_id", "text"), tokenizer(), known=KNOWN)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]


def run(spark, sf_dir):
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
