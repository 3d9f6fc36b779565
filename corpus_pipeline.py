"""From raw documents to packed training sequences, one operator after the other.

Each stage takes (spark, docs, sf_dir) and returns the columns of documents, with its decisions
taken: language (documents in no known language go), near-duplicates (the smallest id of a group
stays), repeated passages (cut out of the texts), benchmark leaks (documents that hold a test item
go). The last stage returns the packed pieces. Rows that repeat an id are told apart by their texts'
fingerprints when near-duplicates are dropped; benchmark leaks drop every row of an id.

Cases: a null text is in no language; a document of which nothing is left after its repeated
passages are cut goes; rows with a null id pass the filters they are not caught by.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import language
from tidewell.llm.decontamination import contaminated
from tidewell.llm.packing import pack
from tidewell.llm.simhash import fingerprints, near_duplicates
from tidewell.llm.suffix_dedup import remove_repeats
from tidewell.llm.worker import small_batches
from tidewell.session import stage, staging

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document is in no known language if the best one is less likely than this.
LEAST_CERTAIN = 0.4
#: Of the parameters of the SimHash contract: words of a shingle, most bits that differ.
SHINGLE_WORDS, MOST_BITS = 4, 4


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a known language; lang becomes the language found."""
    small_batches(spark)
    model = language.learn(docs, public_tokenizers.path("piece_bpe_32k.model"), F.lit(True), per_language=400)
    found = language.identify(docs.select(*COLUMNS), model, keep=COLUMNS)
    known = found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_CERTAIN))
    return known.select("doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group, once; rows with a null id stay.

    Where an id is repeated each of its fingerprints is judged by its own group, and of the rows of
    one id in one group the one with the smallest text stays.
    """
    small_batches(spark)
    groups = stage(near_duplicates(docs, width=SHINGLE_WORDS, distance=MOST_BITS), "near-duplicates")
    rows = docs.select(*COLUMNS)
    repeated = groups.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    repeated = stage(repeated, "repeated-ids")
    dropped = groups.where("doc_id > component").select("doc_id").distinct()
    if repeated.isEmpty():
        return rows.join(stage(dropped, "near-duplicates-dropped"), "doc_id", "left_anti").select(*COLUMNS)
    single = rows.join(stage(dropped.union(repeated).distinct(), "near-duplicates-dropped"), "doc_id", "left_anti")
    again = fingerprints(rows.join(repeated, "doc_id", "left_semi"), width=SHINGLE_WORDS, keep=tuple(COLUMNS))
    judged = groups.join(repeated, "doc_id", "left_semi").where("doc_id <= component").distinct()
    smallest = F.min(F.struct("text", "lang", "source", "n_chars")).alias("row")
    kept = again.join(judged, ["doc_id", "fp"]).groupBy("doc_id", "component").agg(smallest).select("doc_id", "row.*")
    return single.select(*COLUMNS).unionByName(kept)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that an earlier document has; whole characters only."""
    small_batches(spark)
    cut = remove_repeats(docs, carry=("lang", "source"), whole_characters=True)
    text = F.decode("kept", "UTF-8")
    return cut.where(F.octet_length("kept") > 0).select(
        "doc_id", text.alias("text"), "lang", "source", F.char_length(text).cast("long").alias("n_chars")
    )


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    small_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    leaked = stage(contaminated(docs, benchmark).select("doc_id").distinct(), "leaked")
    return docs.select(*COLUMNS).join(leaked, "doc_id", "left_anti").select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two length, each a sequence of its own."""
    small_batches(spark)
    packed = pack(docs, public_tokenizers.path("word_bpe_49k.json"), most=4096, closing_id=2)
    return packed.select("doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("leaks", drop_leaks),
    ("packing", pack_sequences),
]

#: SQL cannot express these stages; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what one keeps is stored and read again by the next.

    The tables a stage made on its way go when its result is stored.
    """
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, function in STAGES[:-1]:
        with staging(spark):
            docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}", outlive=True)
    return STAGES[-1][1](spark, docs, sf_dir)
