"""A corpus from documents to training sequences: quality, near duplicates, personal data, mixture,
packing. Each stage works on what its predecessor kept, stored as Parquet in between."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from temblor.lineage import scratch_path
from temblor.llm import minhash, mixing, packing, pii, quality
from temblor.llm.frames import OWN, numbered, remove, sweep, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that fail the base rules or a cutoff proven on ``labels`` for their language."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates by words of five, the smallest ``doc_id`` stays."""
    return minhash.keep_one(docs, minhash.Bands(shingle=5))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the text becomes its kind in angle brackets; every document stays."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; the order of files and rows is the Pfair mixture of the sources."""
    return mixing.in_order(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and offset; sequences follow the mixture, which
    is the order of the stored table's files and rows."""
    place = f"{OWN}place"
    return packing.pack_documents(numbered(docs, place), place=place)


def _stage(work: Stage) -> Stage:
    """``work`` after the scratch tables of earlier stages, whose results are stored by then, go."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        sweep()
        return work(spark, docs, sf_dir)

    return run


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", _stage(quality_rules)),
    ("minhash_near_dedup", _stage(near_dedup)),
    ("contextual_pii", _stage(redact_pii)),
    ("pfair_mixing", _stage(mix_sources)),
    ("best_fit_packing", _stage(pack)),
]

#: Binomial cutoffs, similarity components and vector packing have no SQL; tests use brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is stored in the shared folder for the next,
    and goes when the next one is stored. Only the result stays there, until the next ``sweep``."""
    docs, stored = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        if stored:
            remove(spark, stored)
        docs, stored = spark.read.parquet(path), path
    result = written(STAGES[-1][1](spark, docs, sf_dir), "packed")
    remove(spark, stored)
    return result
