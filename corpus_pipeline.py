"""Corpus preparation in five stages over ``documents``.

Each stage takes (spark, docs, folder) and returns a frame that is written as Parquet and
read again as the next stage's ``docs``. All but the last return the columns of ``docs``.

1. language ID: null texts and texts without a letter go (``und``). Any other text gets the
   nearest learned language and stays, be it foreign or garbage; learned from the rows of the
   input whose ``lang`` is given, outside the held-out fold.
2. n-gram Jaccard join: of each group of near copies (five-word shingles, similarity of 0.8
   or more) one row stays.
3. benchmark decontamination: contaminated rows go.
4. secret scans: found secrets are replaced by a mark; every row stays.
5. packing: the texts as pieces of token sequences.

Null text is ``und`` and goes in the first stage. Repeated rows are copies: one stays. Empty
input passes through all stages.
"""

from __future__ import annotations

from public_tokenizers import path as tokenizer_path
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm import decontaminate, jaccard_join, langid, packing, secrets
from ledgerloom.llm.common import HELD_OUT, fold, table
from ledgerloom.scratch import Scratch

SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
FILE_BITS = 40  # rows a file may hold
TOKENIZER, END_ID = "word_bpe_49k.json", 2


def identify_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    model = langid.fit(docs.filter(fold(F.col("doc_id")) != HELD_OUT))
    known = langid.predict(docs, model, docs.columns)
    return known.filter(F.col("lang_pred") != langid.UNDETERMINED).select("row.*")


def with_places(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(row, place): a number for each row that is the same however often it is read.

    Rows of stored files are numbered by their file and their place in it, whatever pieces the
    files are read in. Rows of any other frame are numbered and written once.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    try:
        origin = docs.metadataColumn("_metadata")
        found = docs.select(
            row, origin["file_path"].alias("file"), origin["row_index"].alias("index")
        )
        found.schema  # raises where the frame is not a scan of files
    except AnalysisException:
        return scratch.keep(docs.select(row, F.monotonically_increasing_id().alias("place")), "rows")
    # One row per file.
    number = F.row_number().over(Window.orderBy("file")).cast("long")
    files = scratch.keep(found.select("file").distinct().withColumn("number", number), "files")
    place = F.shiftleft("number", FILE_BITS) + F.col("index")
    return found.join(files, "file").select("row", place.alias("place"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    scratch = Scratch(spark)
    rows = with_places(docs, scratch)
    texts = rows.select(F.col("place").alias("doc_id"), F.col("row.text").alias("text"))
    joined = jaccard_join.jaccard_join(texts, scratch, SHINGLE_WORDS, SIMILAR_PERCENT)
    gone = joined.filter("component_id <> doc_id").select(F.col("doc_id").alias("place"))
    return rows.join(gone, "place", "left_anti").select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    items = table(spark, folder, "benchmark")
    found = decontaminate.scan(docs, items, Scratch(spark).keep)
    clean = ~decontaminate.contaminated(F.col("n_words"), F.col("n_hit"))
    return found.filter(clean).select("row.*")


def mask_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    found = secrets.find(docs, Scratch(spark).keep)
    masked = secrets.redacted(F.col("row.text"), F.col("spans"))
    row = F.col("row").withField("text", masked)
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length(masked).cast("long"))
    return found.select(row.alias("row")).select("row.*")


def pack_windows(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return packing.packed(docs, tokenizer_path(TOKENIZER), END_ID, Scratch(spark).keep)


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secret_scans", mask_secrets),
    ("packing", pack_windows),
]

# Naive Bayes and retrieval packing are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return scratch.keep(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])
