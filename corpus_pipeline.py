"""A corpus made ready for training: the operators of ``segwatch.llm`` one after the other.

Each stage takes the documents its predecessor kept and returns documents, the last one packed pieces. The files
between the stages lie in the session's shared folder, so a lost executor costs a stage its tasks and no more.

In every stage a NULL key is a key like any other, columns beyond those of ``documents`` are not read, an empty table
gives an empty one, and texts are taken whole, however long. What NULL and empty texts, ties and repeated rows become is
said at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segwatch.functions.storage import cut
from segwatch.llm.harmonic import harmonic_packing
from segwatch.llm.pii import personal_data
from segwatch.llm.quality_lines import line_quality
from segwatch.llm.queries import VOCABULARY
from segwatch.llm.simhash_tree import near_duplicates
from segwatch.llm.suffix_dedup import PASSAGE_WORDS, suffix_dedup

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    """The columns of documents, with the length of the text as it now is."""
    return df.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that are junk or lose too much with them.

    NULL and empty texts have no words and go. Repeated rows are judged alike.
    """
    judged = line_quality(docs.select(*COLUMNS))
    # As a filter on ``quality`` would be moved below it, the rules would be evaluated twice.
    kept = judged.withColumn("quality", F.explode(F.filter(F.array("quality"), lambda q: q["kept"])))
    return _documents(kept.withColumn("text", F.col("quality.cleaned")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the document with the smallest id stays, repeated rows once.

    A NULL key comes after all others; of documents with one key the smallest hash of the text decides. NULL and
    empty texts have the fingerprint zero, so one of them stays.
    """
    marked = docs.select(*COLUMNS).withColumn("mark", F.xxhash64("text"))
    groups = near_duplicates(marked, carry=("mark",))
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "carried.mark")).alias("one"))
    kept = first.select(F.col("one.doc_id").alias("kept_id"), F.col("one.mark").alias("kept_mark"))
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("mark") == F.col("kept_mark"))
    return _documents(marked.join(kept, same, "left_semi").dropDuplicates(["doc_id", "mark"]))


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words that also stand elsewhere go, but for their first place.

    That is in the document with the smallest key (NULL first, then by the hash of the text), and there the
    smallest offset. Words are what stands between blanks, so a passage may be broken into lines differently. NULL texts stay
    NULL, shorter texts as they are, and rows that are equal in key and text count as one document.
    """
    others = [c for c in COLUMNS if c not in ("doc_id", "text")]
    done = suffix_dedup(docs, length=PASSAGE_WORDS, words=True, keep_first=True, kept=True, carry=others)
    return _documents(done.select("doc_id", F.col("kept").alias("text"), "carried.*"))


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in the text. NULL texts stay NULL, empty ones empty, repeated rows are masked alike."""
    return _documents(personal_data(docs.select(*COLUMNS), redacted=True))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token pieces placed in sequences. NULL and empty texts are their end mark alone, and
    repeated rows are packed each for itself."""
    return harmonic_packing(docs, VOCABULARY)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("passage_dedup", passage_dedup),
    ("personal", personal),
    ("packing", packing),
]

# SQL has neither the fingerprints nor the tokenizer; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
