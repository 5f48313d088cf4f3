"""Quality classifier with hierarchical empirical-Bayes site evidence.

Method.

1. Every document becomes a short vector of surface features of its whole text.
2. A logistic regression is fitted on labelled documents (a bounded sample of them, see
   ``MAX_LABELLED``: drawn by a hash of ``doc_id``) and gives every document its
   own log-odds of being good.
3. *Sites.* Documents of a host, and of a path below it, are summed up by grouped
   aggregation over all documents: labels where there are any, else the classifier's
   probabilities. A host's rate is shrunk toward the global mean, a path's toward its
   host's, as Beta posteriors whose prior strength is the one that the spread between the
   sites shows (method of moments). So a sparse site says little, a large one what it shows.
4. A document's posterior log-odds add its own evidence to the prior of its path, from which
   its own share is taken out first (no document votes for itself).

Here a host is ``source`` and the path below it ``lang``, the only site columns of the
documents.

Scale. One map over the texts, then sums per site. Sums are joined back salted over
``SALTS`` keys, so that a site with a third of all rows is spread; sites are never collected.

Edge cases: a null or empty text has the feature vector of no words and is judged by it; a
null host or path is a site of its own; labels that repeat a document count once (the least
of them), null labels not at all; with no labels of one of the two classes every document
gets the neutral evidence 0 and stays; rows that repeat a ``doc_id`` are judged each; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import discard, lists, slices, staged, text_input, text_print

#: Labelled documents that the regression is fitted on, at most.
MAX_LABELLED = 20_000
SALTS = 16
THRESHOLD = 0.5
#: Evidence is clipped to this many nats, so that no single document is beyond all doubt.
CLIP = 8.0
#: The same for a site's prior: it shifts borderline documents, it does not condemn clear ones.
SITE_CLIP = 2.0
FEATURES = ("n_words", "upper", "symbols", "digits", "word_length", "distinct", "top_word", "repeats", "top_line", "lines", "stops", "plain")

_SYMBOLS = re.compile(r"[^\w\s.,;:'\"()?-]")
_DIGITS = re.compile(r"\d")


def features(text: str | None) -> list[float]:
    """Surface features of one whole text, each between 0 and about 1."""
    text = text or ""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, n_chars = len(words), len(text)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    letters = max(1, sum(map(len, words)))
    upper = sum(1 for w in words if len(w) > 1 and w.isupper())
    return [
        np.log1p(n) / 10,
        upper / n,
        min(1.0, len(_SYMBOLS.findall(text)) / n),
        min(1.0, len(_DIGITS.findall(text)) / letters),
        min(2.0, letters / n / 10),
        len(counts) / n ** 0.8 if n > 1 else 1.0,
        counts.most_common(1)[0][1] / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        max(map(len, lines)) / n_chars if len(lines) > 1 else 1.0,
        1 - len(set(lines)) / len(lines),
        min(1.0, 5 * sum(w.endswith((".", "!", "?")) for w in words) / n),
        sum(1 for w in words if w[:-1].isalpha() or w.isalpha()) / n,
    ]


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        vectors = np.array([features(t) for t in batch.column(1).to_pylist()], np.float64)
        columns = [batch.column(0), *(batch.column(i) for i in range(2, batch.num_columns)), lists(vectors.ravel(), [len(FEATURES)] * len(vectors))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "host", "path", "print", "features"])


def expand(x: np.ndarray) -> np.ndarray:
    """Features with squares and a constant."""
    return np.hstack([np.ones((len(x), 1)), x, x * x])


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Logistic regression by Newton's method; both classes weigh the same."""
    z = expand(x)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum())) * len(y)
    beta = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        gradient = z.T @ (weight * (y - p)) - ridge * beta
        hessian = (z * (weight * p * (1 - p))[:, None]).T @ z + ridge * np.eye(z.shape[1])
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-6:
            break
    return beta


def linear(beta: np.ndarray, vector: Column) -> Column:
    """The regression's log-odds as a column expression, clipped."""
    k = len(FEATURES)
    terms = [F.lit(float(beta[0]))]
    for i in range(k):
        f = vector.getItem(i)
        terms += [f * F.lit(float(beta[1 + i])), f * f * F.lit(float(beta[1 + k + i]))]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return F.least(F.greatest(total, F.lit(-CLIP)), F.lit(CLIP))


def logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def strength(sites: DataFrame, good: str, n: str, prior: Column) -> float:
    """Prior strength of a Beta whose spread is the one between sites beyond chance."""
    rate = F.col(good) / F.col(n)
    row = sites.where(F.col(n) > 1).agg(
        F.avg((rate - prior) * (rate - prior)).alias("spread"),
        F.avg(prior * (1 - prior) / F.col(n)).alias("chance"),
        F.avg(prior * (1 - prior)).alias("most"),
    ).first()
    if row is None or row["spread"] is None:
        return 10.0
    between = max(row["spread"] - row["chance"], 1e-6)
    return float(min(max(row["most"] / between - 1, 1.0), 1e4))


def score_sites(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    host_column: str = "source", path_column: str = "lang", label_column: str = "quality", max_labelled: int = MAX_LABELLED,
) -> DataFrame:
    """One row per document row: ``doc_id, host, path, evidence, site_prior, probability, print, accepted``."""
    kind = docs.schema[id_column].dataType.simpleString()
    source = text_input(
        docs, F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"),
        F.col(host_column).cast("string").alias("host"), F.col(path_column).cast("string").alias("path"), text_print(F.col(text_column)).alias("print"),
    )
    vectors = staged(source.mapInArrow(_describe, f"doc_id {kind}, host string, path string, print bigint, features array<double>"), "quality-features")
    known = labels.select(F.col(id_column).alias("labelled"), F.col(label_column).cast("double").alias("label")).where("label IS NOT NULL").groupBy("labelled").agg(F.min("label").alias("label"))
    described = staged(vectors.join(known, vectors["doc_id"] == known["labelled"], "left").drop("labelled"), "quality-labelled")
    discard(vectors)

    labelled = described.where("label IS NOT NULL")
    share = max_labelled / max(1, labelled.count())
    if share < 1:  # by hash, so that no task or driver sorts more than the sample
        labelled = labelled.where(F.abs(F.xxhash64("doc_id", "features") / F.lit(2.0**63)) < share)
    sample = labelled.select(F.xxhash64("doc_id", "features").alias("order"), "features", "label").toPandas().sort_values("order", kind="stable")
    y = sample["label"].to_numpy(dtype=float)
    fitted = bool(0 < (y > 0).sum() < len(y))
    if fitted:
        x = np.array(sample["features"].tolist(), dtype=float)
        evidence = linear(fit(x, y), F.col("features"))
        odds = float(np.log((y > 0).sum() / (y <= 0).sum()))  # the fit took both classes as equally common
    else:
        evidence, odds = F.lit(0.0), 0.0
    rate = 1 / (1 + F.exp(-(evidence + odds)))
    judged = described.select("doc_id", "host", "path", "print", evidence.alias("evidence"), F.coalesce("label", rate).alias("good"))

    paths = staged(judged.groupBy("host", "path").agg(F.sum("good").alias("path_good"), F.count("*").alias("path_n")), "quality-paths")
    hosts = paths.groupBy("host").agg(F.sum("path_good").alias("host_good"), F.sum("path_n").alias("host_n"))
    total = hosts.agg(F.sum("host_good").alias("good"), F.sum("host_n").alias("n")).first()
    mean = min(max((total["good"] or 0.0) / max(total["n"] or 0, 1), 1e-3), 1 - 1e-3)
    host_strength = strength(hosts, "host_good", "host_n", F.lit(mean))
    host_rate = (F.col("host_good") + mean * host_strength) / (F.col("host_n") + host_strength)
    sites = staged(
        paths.join(hosts.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h"))).drop("h").withColumn("host_rate", host_rate), "quality-sites"
    )
    path_strength = strength(sites, "path_good", "path_n", F.col("host_rate"))

    salted = sites.select(F.col("host").alias("h"), F.col("path").alias("p"), "path_good", "path_n", "host_good", "host_n", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
    salt = F.pmod(F.xxhash64("doc_id", "evidence"), F.lit(SALTS)).cast("int")
    joined = judged.withColumn("salt", salt).join(
        salted, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p")) & (F.col("salt") == F.col("s"))
    )
    others_host = (F.col("host_good") - F.col("good") + mean * host_strength) / (F.col("host_n") - 1 + host_strength)
    others_path = (F.col("path_good") - F.col("good") + others_host * path_strength) / (F.col("path_n") - 1 + path_strength)
    prior = F.least(F.greatest(others_path, F.lit(1e-4)), F.lit(1 - 1e-4))
    shift = F.least(F.greatest(logit(F.col("site_prior")) - logit(F.lit(mean)), F.lit(-SITE_CLIP)), F.lit(SITE_CLIP))
    out = joined.withColumn("site_prior", prior).withColumn("probability", 1 / (1 + F.exp(-(F.col("evidence") + shift))))
    return out.select("doc_id", "host", "path", "evidence", "site_prior", "probability", "print", ((F.col("probability") >= THRESHOLD) | F.lit(not fitted)).alias("accepted"))
