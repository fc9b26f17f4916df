"""Quality classifier with hierarchical empirical Bayes (operator 5).

A logistic model over text statistics gives each document a probability of being good. It is fitted
on a bounded sample of the labelled documents. All documents then bear on their sites: a document's
evidence is its label where it has one and the model's probability elsewhere, summed per host (the
source) and per path (the language within the source). A path's rate is shrunk toward its host's and
a host's toward the global one, by as much as the groups' own spread calls for (method of moments),
so that sparse sites say little. A document's log odds move by what its path says beyond the global
rate.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from orderdw.llm.common import table
from orderdw.session import cut_lineage

TRAIN_DOCS = 20_000  # about so many labelled documents are used to fit the model, if there are more
THRESHOLD = 0.5
HASH_STEPS = 1 << 30
CLASSES = np.zeros((256, 6))  # upper, lower, digit, mark of a sentence, other sign, beyond ASCII
CLASSES[65:91, 0] = CLASSES[97:123, 1] = CLASSES[48:58, 2] = CLASSES[128:, 5] = 1
CLASSES[[ord(c) for c in ".,;:?'\"-()"], 3] = 1
CLASSES[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:?'\"-()"], 4] = 1
FEATURES = 14


def features(text: str | None) -> list[float]:
    """Statistics of a whole text; zeros for an empty one."""
    if not text or text.isspace():
        return [0.0] * FEATURES
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    upper, lower, digit, mark, sign, wide = (np.bincount(data, minlength=256) @ CLASSES).tolist()
    n = float(len(data))
    words = text.split()
    lines = text.split("\n")
    count = len(words)
    kinds = len(set(words))
    repeats = sum(map(eq, words, words[1:]))
    letters = upper + lower + wide
    return [np.log1p(count), np.log1p(n / count), upper / max(1.0, upper + lower), digit / n,
            mark / n, sign / n, np.sqrt(sign / n), wide / n, letters / n, kinds / count ** 0.9,
            repeats / count, np.log1p(len(lines)), 1 - len(set(lines)) / len(lines),
            float(count < 5)]


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> dict[str, np.ndarray]:
    """Ridge logistic regression by Newton steps over standardised features."""
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = np.column_stack((np.ones(len(x)), np.clip((x - mean) / scale, -8, 8)))
    w = np.zeros(z.shape[1])
    keep = np.diag([1e-6] + [ridge] * x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + keep, z.T @ (y - p) - keep @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return {"mean": mean, "scale": scale, "w": w}


def probabilities(model: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    z = np.clip((x - model["mean"]) / model["scale"], -8, 8)
    return 1 / (1 + np.exp(-np.clip(model["w"][0] + z @ model["w"][1:], -12, 12)))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = [features(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())),
                                          batch.column("quality").cast(pa.float64())], ["x", "y"])


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> dict:
    """The model, from a hash sample of about ``train_docs`` labelled documents. Without labels of
    both kinds it says one half of everything."""
    known = _one_label(labels)
    n = known.count()
    share = min(1.0, train_docs / max(1, n))
    picked = known.filter(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(5)), F.lit(HASH_STEPS))
                          < share * HASH_STEPS)
    rows = (docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # bounded by the sample
            .select("text", "quality").mapInArrow(_feature_rows, "x array<double>, y double")
            .toPandas())
    if rows.empty or rows["y"].nunique() < 2:
        return {"mean": np.zeros(FEATURES), "scale": np.ones(FEATURES), "w": np.zeros(FEATURES + 1)}
    return fit(np.stack(rows["x"].to_numpy()), rows["y"].to_numpy())


def _one_label(labels: DataFrame) -> DataFrame:
    return (labels.filter("doc_id is not null and quality is not null").groupBy("doc_id")
            .agg((F.avg("quality") >= 0.5).cast("int").alias("quality")))


def document_evidence(spark: SparkSession, model: dict) -> object:
    """A column function: the model's probability that a text is good."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(DoubleType())
    def good(text: pd.Series) -> pd.Series:
        x = np.array([features(t) for t in text]).reshape(-1, FEATURES)
        return pd.Series(probabilities(shared.value, x))

    return good


def _strength(groups: DataFrame, above: Column) -> float:
    """How many documents the prior of a group is worth: the groups' means are taken to spread
    around ``above`` with the variance that is left after what sampling explains."""
    s = groups.filter("n > 0").agg(
        F.sum("n").alias("n"), F.count("*").alias("k"),
        F.sum(F.col("n") * above * (1 - above)).alias("within"),
        F.sum(F.col("n") * (F.col("good") / F.col("n") - above) ** 2).alias("between"),
        F.sum(above * (1 - above)).alias("expected")).first()
    if not s["n"] or s["k"] < 2:
        return 1e6
    spread = max(0.0, (s["between"] - s["expected"]) / s["n"])
    base = s["within"] / s["n"]
    return float(min(1e6, max(1.0, base / spread - 1))) if spread > 0 else 1e6


def site_posteriors(evidence: DataFrame) -> tuple[DataFrame, float]:
    """(host, path, host_rate, path_rate) from ``evidence`` (host, path, good), and the global
    rate."""
    paths = cut_lineage(evidence.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.sum("good").alias("good")), "site-paths")
    total = paths.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    overall = (total["good"] + 1) / (total["n"] + 2) if total["n"] else 0.5
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    k0 = _strength(hosts, F.lit(overall))
    hosts = hosts.select("host", ((F.col("good") + k0 * overall) / (F.col("n") + k0))
                         .alias("host_rate"))
    joined = paths.join(hosts, "host")
    k1 = _strength(joined, F.col("host_rate"))
    return joined.select("host", "path", "host_rate", (
        (F.col("good") + k1 * F.col("host_rate")) / (F.col("n") + k1)).alias("path_rate")), overall


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _site(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_host", F.coalesce("source", F.lit(""))).withColumn(
        "_path", F.coalesce("lang", F.lit("")))


def _with_sites(scored: DataFrame, sites: DataFrame, overall: float) -> DataFrame:
    """``scored`` (_host, _path, _doc_p) with host_rate, path_rate and _p."""
    named = sites.select(F.col("host").alias("_host"), F.col("path").alias("_path"),
                         F.col("host_rate").alias("_host_rate"),
                         F.col("path_rate").alias("_path_rate"))
    moved = _logit(F.col("_doc_p")) + _logit(F.col("_path_rate")) - _logit(F.lit(overall))
    return scored.join(named, ["_host", "_path"]).withColumn("_p", 1 / (1 + F.exp(-moved)))


def _evidence(scored: DataFrame, labels: DataFrame) -> DataFrame:
    known = _one_label(labels)
    return scored.join(known, "doc_id", "left").select(
        F.col("_host").alias("host"), F.col("_path").alias("path"),
        F.coalesce(F.col("quality").cast("double"), "_doc_p").alias("good"))


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, doc_score, host_score, path_score, score, keep) of every row of ``docs`` (doc_id,
    text, lang, source), learned from ``labels`` (doc_id, quality 0 or 1).

    A null or empty text counts as an empty text; null sources or languages are a site of their own.
    Several labels of a document count as their mean, rounded up; labels without a document only
    matter where it appears. Without labels of both kinds the model says one half, and all stay.
    Repeated rows repeat; scores of ``threshold`` or more are kept.
    """
    spark = docs.sparkSession
    good = document_evidence(spark, train(docs, labels))
    scored = cut_lineage(_site(docs.select("doc_id", "text", "lang", "source"))
                         .select("doc_id", "_host", "_path", good("text").alias("_doc_p")),
                         "quality")
    sites, overall = site_posteriors(_evidence(scored, labels))
    return _with_sites(scored, sites, overall).select(
        "doc_id", F.col("_doc_p").alias("doc_score"), F.col("_host_rate").alias("host_score"),
        F.col("_path_rate").alias("path_score"), F.col("_p").alias("score"),
        (F.round("_p", 9) >= threshold).alias("keep"))


def good_ones(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that :func:`judge` does not keep. Texts are scored again beside
    their rows rather than carried through a join with the scores."""
    spark = docs.sparkSession
    good = document_evidence(spark, train(docs, labels))
    scored = _site(docs.select("doc_id", "text", "lang", "source")).select(
        "doc_id", "_host", "_path", good("text").alias("_doc_p"))
    sites, overall = site_posteriors(_evidence(scored, labels))
    judged = _with_sites(_site(docs).withColumn("_doc_p", good("text")), sites, overall)
    return judged.filter(F.round("_p", 9) >= threshold).select(docs.columns)


def op5_quality_bayes(spark: SparkSession, folder: str) -> DataFrame:
    """The quality of every document."""
    return judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
