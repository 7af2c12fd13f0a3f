"""From raw documents to packed training batches.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents.

When a stage begins, the result of the one before is a table of its own, so that stage's
intermediate tables are removed: the disk in use is that of one stage, not of all. ``run`` keeps a list
of its own, so runs do not touch each other's tables. A caller that runs stages one by one has to write
each result before the next stage begins, and passes a dict of its own as ``scratch`` if it runs
several pipelines over one folder in an application.
"""

from pyspark.sql import functions as F

from auditloom.llm import mixing, packing, simhash, stream_dedup, toxicity
from auditloom.llm.common import let_workers_import, table
from auditloom.llm.queries import tokenizer_path
from auditloom.storage import few_tasks, new_path, remove, scope, staged, write_staged

_scratch = {}   # folder of intermediate tables by application, input folder and place, for stages run one by one


def drop_toxic(spark, docs, sf_dir):
    """Documents that the classifier, trained on labels of these documents, does not reject."""
    let_workers_import(spark)
    return toxicity.clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark, docs, sf_dir):
    """Of equal texts, the document with the largest id."""
    return stream_dedup.survivors(docs)


def drop_near_copies(spark, docs, sf_dir):
    """Of each SimHash component, the document whose id names it.

    Rows of a component without any id have none to name them: the first in order of all columns
    stays, which also decides among several rows with the naming id.
    """
    let_workers_import(spark)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.col("text"), whole.alias("doc"))
    rows = staged(rows, "candidates")
    n = rows.count()
    found = simhash.near_duplicates(rows.select(F.col("row").alias("doc_id"), "text")).select(
        F.col("doc_id").alias("row"), F.col("component_id").alias("component"))
    ids = staged(few_tasks(rows.select("row", "doc_id").join(found, "row"), 2 * n), "components")
    named = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    keep = ids.groupBy("component").agg(F.min(named).alias("first")).select("first.row")
    # the dropped rows are few as a rule: where their table is small, Spark shuffles no document
    dropped = staged(few_tasks(ids.join(keep, "row", "left_anti").select("row"), 2 * n), "dropped")
    return rows.join(dropped, "row", "left_anti").select("doc.*")


def mix_sources(spark, docs, sf_dir):
    """Documents repeated to the square root of their sources' sizes, in a global order."""
    return mixing.mix(docs).select("doc.*")


def pack_batches(spark, docs, sf_dir):
    """Length buckets and token-budget batches."""
    let_workers_import(spark)
    return packing.pack_documents(docs, tokenizer_path())


def _in_order(*stages):
    """The stages, each of which removes the intermediate tables of the one before."""
    def scoped(place, name, function):
        def stage(spark, docs, sf_dir, scratch=_scratch):
            run_of = (spark.sparkContext.applicationId, sf_dir)
            done = scratch.pop((*run_of, place - 1), None)
            if done:
                remove(spark, done)
            with scope(spark, function.__name__) as path:
                scratch[*run_of, place] = path
                return function(spark, docs, sf_dir)

        stage.__doc__ = function.__doc__
        return name, stage

    return [scoped(place, *stage) for place, stage in enumerate(stages)]


STAGES = _in_order(
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("simhash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_batches),
)

#: The classifier and the stream have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents of ``sf_dir``."""
    docs, last, scratch = table(spark, sf_dir, "documents"), None, {}
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name.replace(" ", "_"))
        docs = write_staged(stage(spark, docs, sf_dir, scratch), path)
        if last:
            remove(spark, last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir, scratch)
