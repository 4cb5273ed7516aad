"""A corpus, from documents to token files.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which ``run`` writes as Parquet and reads again as the
next one's ``docs``.  All but the last return the columns of ``docs``.

1. toxicity: learns from the labels of the documents at hand and drops the
   documents whose score is 0.5 or more;
2. near duplicates: of every component of documents that share 80 % of their
   five-word shingles, one row stays, that with the smallest id (null ids last);
3. decontamination: drops documents that contain a benchmark item;
4. mixing: repeats or leaves out documents so that sources meet their targets;
5. tokens: writes token files, reads them back and returns what they hold.

Rows are told apart even where ids are null or repeated; mixing may repeat a row.
Empty tables pass through every stage; extra columns are kept up to the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kollektiv.llm import decontaminate, mixing, prefix_join, token_files, toxicity
from kollektiv.llm.common import prepare, scratch_path, stage_table, table
from kollektiv.operators.ids import dense_row_number
from kollektiv.session import StagingScope, use_scope

#: What the stage before staged; its output is written when the next begins.
_scope = StagingScope()


def _begin(spark: SparkSession) -> StagingScope:
    prepare(spark)
    _scope.drop(spark)
    return _scope


def _plain(docs: DataFrame, *needed: str) -> tuple[DataFrame, list[str]]:
    """``docs`` under names that meet none of an operator's, but for those it
    ``needed``; and those names."""
    names = [c if c in needed else f"column{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), names


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with use_scope(_begin(spark)):
        known = toxicity.marks(table(spark, sf_dir, "labels"), "toxic")
        known = known.filter(~toxicity.held_out(F.col("doc_id"), 5, 0) & F.col("mark").isin(0, 1))
        model = toxicity.train(docs.select("doc_id", "text"), known)
        rows, names = _plain(docs, "text")
        kept = toxicity.scored(rows, model, tuple(names)).filter("predicted = 0")
        return kept.select(*names).toDF(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with use_scope(_begin(spark)):
        rows, names = _plain(docs)
        doc_id, text = (names[docs.columns.index(c)] for c in ("doc_id", "text"))
        # ids that do not tell rows apart: rows get numbers, in the order of their ids
        if not rows.groupBy(doc_id).count().filter((F.col("count") > 1) | F.col(doc_id).isNull()).isEmpty():
            rows = stage_table(dense_row_number(rows, [F.col(doc_id).asc_nulls_last(), F.xxhash64(text).asc()], "number"), "numbered")
            doc_id = "number"
        found = prefix_join.jaccard_components(rows.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), words=5, percent=80)
        stay = stage_table(found.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(doc_id)), "stay")
        return rows.join(stay, doc_id, "left_semi").select(*names).toDF(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with use_scope(_begin(spark)):
        rows, names = _plain(docs, "doc_id", "text")
        return decontaminate.clean(rows, table(spark, sf_dir, "benchmark")).select(*names).toDF(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with use_scope(_begin(spark)):
        rows, names = _plain(docs, "doc_id", "text", "source")
        return mixing.remix(rows).select(*names).toDF(*docs.columns)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    with use_scope(_begin(spark)):
        path = scratch_path(spark, "tokens")
        token_files.write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
        return token_files.layout(token_files.checksums(spark, path))


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]

#: Models, near-duplicate components and tokens are beyond SQL; the stages are
#: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
