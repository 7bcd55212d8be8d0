"""Quality of documents by hierarchical empirical Bayes.

**Evidence of the document.** A logistic regression over the shapes of its words (runs of capitals, small letters and digits
are one sign each) and over how often words repeat. It is fitted on a bounded part of the labelled rows.

**Sites.** Hosts hold paths, paths hold documents. A document counts for its site with its label where it has one, and else with its
score. The mean of a host is shrunk towards the global mean, that of a path
towards its host, each by a strength that the spread between sites implies: sites that differ little or hold few documents
stay close to the level above. All of it is sums by path and by host.

**Posterior.** The odds of a document are those of its own evidence, times the odds of its path over the global odds. The path's
figures leave the document itself out, so it does not count twice.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel, Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from keepwell.llm.shared import stored, words_of

#: Labelled rows that the regression is fitted on, at most; those with the smallest hashes of their ids.
FIT_ROWS = 20_000
SHAPES = 512
THRESHOLD = 0.5


def shaped(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` with ``shapes``, the shapes of all words, and ``repeated``, the share of words seen before."""
    text = F.coalesce("text", F.lit(""))
    for pattern, sign in ((r"\p{Lu}+", "A"), (r"\p{L}+", "a"), (r"\p{N}+", "9")):
        # Capitals are marked first; the mark itself must not be taken for a letter again.
        text = F.regexp_replace(text, pattern if sign != "a" else r"(?:(?!A)\p{L})+", sign)
    worded = docs.select(*keep, words_of(F.col("text")).alias("words"), words_of(text).alias("shapes"))
    repeated = 1 - F.size(F.array_distinct("words")) / F.greatest(F.size("words"), F.lit(1))
    return worded.select(*keep, "shapes", repeated.alias("repeated"))


def labelled(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """``label, shapes, repeated`` of at most ``rows`` labelled documents, those with the smallest hashes of their ids."""
    order = F.xxhash64(F.col("label_id"), F.lit(5))
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("quality").cast("double").alias("label"))
        .filter("label_id is not null and label is not null").orderBy(order, "label_id").limit(rows)
    )
    # At most ``rows`` pairs of numbers are broadcast, so no text moves to meet them.
    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(stored(chosen, "chosen")), F.col("doc_id") == F.col("label_id")
    )
    return stored(shaped(some, ["label"]), "examples")


def fit(examples: DataFrame) -> PipelineModel:
    """The regression on examples of both kinds."""
    stages = [
        HashingTF(inputCol="shapes", outputCol="counts", numFeatures=SHAPES),
        Normalizer(inputCol="counts", outputCol="shares", p=1.0),
        VectorAssembler(inputCols=["shares", "repeated"], outputCol="features"),
        LogisticRegression(maxIter=50, regParam=1e-4),
    ]
    return Pipeline(stages=stages).fit(examples)


def _strength(sites: DataFrame, above: Column) -> float:
    """Pseudo-documents of the level above: how much the means of ``sites`` spread beyond chance, by moments."""
    row = sites.select(
        (F.col("n") * (F.col("sum") / F.col("n") - above) ** 2).alias("between"), (above * (1 - above)).alias("chance"), "n"
    ).agg(F.avg("between"), F.avg("chance"), F.avg("n")).first()
    if row[0] is None or not row[1]:
        return 1.0
    # Mean of n * (mean - above)^2 is chance * (1 + (n - 1) * rho); the strength is 1 / rho - 1.
    rho = min(0.99, max(1e-4, (row[0] / row[1] - 1) / max(row[2] - 1, 1.0)))
    return 1 / rho - 1


def _odds(p: Column) -> Column:
    safe = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(safe / (1 - safe))


def posteriors(scored: DataFrame) -> DataFrame:
    """Rows ``(doc_id, host, path, score)`` with ``host_posterior, path_posterior, quality``.

    What a document tells about its site is its ``label``, if there is such a column and it is known, and else its score; a document
    is left out of the sums for itself. Null hosts and paths are sites of their own, apart from empty ones. A host with very many documents is summed before the shuffle; the join with
    sites is split by adaptive execution.
    """
    def site(name: str) -> Column:
        return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit(""))

    value = F.coalesce("label", "score") if "label" in scored.columns else F.col("score")
    rows = scored.withColumns({"_host": site("host"), "_path": site("path"), "_value": value})
    paths = stored(rows.groupBy("_host", "_path").agg(F.count(F.lit(1)).alias("n"), F.sum("_value").alias("sum")), "paths")
    hosts = paths.groupBy("_host").agg(F.sum("n").alias("n"), F.sum("sum").alias("sum"))
    n, total = hosts.agg(F.sum("n"), F.sum("sum")).first()
    mean = total / n if n else 0.5
    strong = _strength(hosts, F.lit(mean))
    hosts = hosts.withColumn("host_mean", (F.col("sum") + strong * mean) / (F.col("n") + strong))
    nested = paths.join(hosts.select("_host", F.col("n").alias("host_n"), F.col("sum").alias("host_sum"), "host_mean"), "_host")
    strong_path = _strength(nested, F.col("host_mean"))
    sites = nested.select("_host", "_path", "host_n", "host_sum", F.col("n").alias("path_n"), F.col("sum").alias("path_sum"))
    host = (F.col("host_sum") - F.col("_value") + strong * mean) / (F.col("host_n") - 1 + strong)
    path = (F.col("path_sum") - F.col("_value") + strong_path * F.col("host_posterior")) / (F.col("path_n") - 1 + strong_path)
    evidence = _odds(F.col("score")) + _odds(F.col("path_posterior")) - _odds(F.lit(mean))
    return (
        rows.join(sites, ["_host", "_path"])
        .withColumn("host_posterior", host).withColumn("path_posterior", path)
        .withColumn("quality", 1 / (1 + F.exp(-evidence)))
        .select(*scored.columns, "host_posterior", "path_posterior", "quality")
    )


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column, rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, host, path, score, host_posterior, path_posterior, quality, kept`` for every row of documents.

    The registered query takes the source as host and the language as path. ``kept`` is ``quality >= threshold``. A null text counts as empty. Repeated rows and null doc_ids are scored like any
    other row. Where the labels found are of one kind only there is no evidence: every document scores their mean, and 0.5
    without any label. An empty table gives an empty one. Other columns are ignored.
    """
    examples = labelled(docs, labels, rows)
    kinds, mean = examples.agg(F.count_distinct("label"), F.avg("label")).first()
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), host.alias("host"), path.alias("path"), F.col("text").alias("text"))
    if kinds < 2:
        scored = named.withColumn("score", F.lit(0.5 if mean is None else mean))
    else:
        scored = fit(examples).transform(shaped(named, ["doc_id", "host", "path"])).withColumn(
            "score", vector_to_array("probability")[1]
        )
    told = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("label"))
        .filter("doc_id is not null and label is not null").groupBy("doc_id").agg(F.avg("label").alias("label"))
    )
    plain = stored(scored.select("doc_id", "host", "path", "score"), "scored")
    found = posteriors(stored(plain.join(stored(told, "told"), "doc_id", "left"), "known")).drop("label")
    return found.withColumn("kept", F.col("quality") >= threshold)
