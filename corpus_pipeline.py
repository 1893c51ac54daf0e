"""Training-corpus pipeline: toxicity, near duplicates, benchmark
decontamination, mixing, sharding. Each stage reads what the one before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import decontaminate, jaccard_join, mixing, sharding, toxicity
from quire.llm.common import fresh_names
from quire.llm.queries import TARGETS, labelled_domains
from quire.session import discard, scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under one half."""
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    out, = fresh_names(docs, "toxicity")
    return toxicity.score(docs, model, out=out).where(F.col(out) < 0.5).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles (similarity 0.8 or more) the
    document with the smallest id (null ids last), once."""
    return jaccard_join.one_per_group(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its rate says, so that the expected tokens of
    the domains meet the targets."""
    return mixing.mixed_documents(docs, labelled_domains(docs, _table(spark, sf_dir, "labels")), TARGETS)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row the mix kept."""
    return sharding.shard_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_passages),
    ("mixing to target weights", mix_domains),
    ("sharding", assign_shards),
]

# The classifiers and alignments have no SQL form. The tests of the whole
# pipeline check sanity only; those of the operators say how far each goes.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each landed as Parquet and reread; a
    stage's table is removed when the next one's is written."""
    docs, read = _table(spark, sf_dir, "documents"), None
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        out.write.parquet(path)
        if read:
            discard(spark, read)
        docs, read = spark.read.schema(out.schema).parquet(path), path
    return docs
