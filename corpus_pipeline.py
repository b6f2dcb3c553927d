"""Training-data pipeline: language, near-duplicates, benchmark, personal data, piece ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of their input, with its own values whatever their names; the last replaces columns named ``ids``
and ``n_tokens``. A stage's result is written and read again before the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import decontaminate, langid, minhash, pii, sentencepiece
from ledgerlens.session import new_folder

SIMILAR = 80  # per cent of the union from which near_duplicates takes two texts for one

def _numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str], list]:
    """The input with columns c0, c1, ..., which no operator adds; those names by the old ones; and
    the columns that give the old names back."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names, [F.col(n).alias(c) for c, n in names.items()]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters, where no language can be told, and fills a missing
    ``lang``; a given one is kept, whatever the prediction and its score. Profiles are learned from
    the labelled documents; where there are none, no language is filled in."""
    profiles = langid.learn(docs)
    numbered, names, back = _numbered(docs)
    kept = langid.identify(numbered, profiles, text=names["text"], lettered=True).where("lettered")
    if profiles.languages:
        kept = kept.withColumn(names["lang"], F.coalesce(names["lang"], "lang_pred"))
    return kept.select(*back)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each near-duplicate group (``SIMILAR``), and of
    repeated rows one. Rows without an id cannot be told apart and stay."""
    kept = minhash.near_duplicates(docs, threshold=SIMILAR).where("kept and doc_id is not null").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return named.unionByName(docs.where("doc_id is null"))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item, whatever their length. Null and
    word-less texts hold none and stay, and so do all rows where no item has words; repeated rows
    go or stay together; an empty table stays empty."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    numbered, names, back = _numbered(docs)
    return decontaminate.decontaminate(numbered, items, text=names["text"]).where("n_hit = 0").select(*back)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by marks and counts the characters anew. A null text stays null, with
    a null count; repeated rows are masked alike; an empty table stays empty."""
    columns = docs.columns
    done = pii.mask(docs, pii.fit(docs))
    return done.withColumn("n_chars", F.length("text").cast("long")).select(*columns)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document, with what is known about it. A null or empty text has no ids and
    0 tokens; repeated rows each have their own; an empty table gives no rows."""
    keep = [c for c in docs.columns if c != "text"]
    encoded = sentencepiece.encode(docs, sentencepiece.load_vocabulary(), keep=keep)
    return encoded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("personal_data", personal_data),
    ("piece_ids", piece_ids),
]

# The stages' models have no SQL form; tests hold run() against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
