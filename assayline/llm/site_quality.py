"""Document quality shrunk by host and path: hierarchical empirical Bayes."""

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayline.llm.common import WHITE, WORD, crc_part, sampled, stage, text_or_empty

# The classifier is fitted on at most so many labelled documents.
SAMPLE = 20_000
EVIDENCE = (
    "__log_words", "__mean_length", "__upper", "__digit", "__symbol", "__mark", "__lines",
    "__dup_lines", "__variety", "__one",
)


def _evidence(text: Column) -> list[Column]:
    """Shares that tell prose from junk; all built-in, one row each."""
    words = F.split(F.regexp_replace(text, f"^{WHITE}+|{WHITE}+$", ""), WHITE + "+")
    n = F.greatest(F.lit(1), F.regexp_count(text, F.lit(WORD)))
    chars = F.greatest(F.lit(1), F.length(text))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    return [
        F.log1p(F.regexp_count(text, F.lit(WORD))).alias("__log_words"),
        (F.length(F.regexp_replace(text, WHITE + "+", "")) / n / 10).alias("__mean_length"),
        (F.regexp_count(text, F.lit("[A-Z]")) / chars * 5).alias("__upper"),
        (F.regexp_count(text, F.lit("[0-9]")) / chars * 10).alias("__digit"),
        (F.regexp_count(text, F.lit(r"[#*$%&|<>{}\[\]]")) / chars * 10).alias("__symbol"),
        (F.regexp_count(text, F.lit("[!?]")) / n * 5).alias("__mark"),
        (F.size(lines) / n * 10).alias("__lines"),
        (
            (F.size(lines) - F.size(F.array_distinct(lines))) / F.greatest(F.lit(1), F.size(lines))
        ).alias("__dup_lines"),
        (F.size(F.array_distinct(words)) / F.sqrt(n) / 10).alias("__variety"),
        F.lit(1.0).alias("__one"),
    ]


def fit_evidence(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic weights by Newton's method; the last column is constant.
    Without labels of both kinds the weights are 0 but for the constant."""
    w = np.zeros(x.shape[1])
    if not len(y) or y.min() == y.max():
        w[-1] = 0.0 if not len(y) else (3.0 if y[0] else -3.0)
        return w
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-3
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(keep)
        w -= np.linalg.solve(hess, x.T @ (p - y) + keep * w)
    return w


def _strength(groups: DataFrame, mean: Column) -> Column:
    """Pseudo-counts of a beta prior by moments: what spread of the group
    rates around their prior mean is left after binomial noise. Between 2 and
    1000; a single group, or none with two labels, gives 1000."""
    n, k = F.col("__n"), F.col("__k")
    several = n >= 2
    excess = F.sum(F.when(several, (k / n - mean) * (k / n - mean) * n)) - F.sum(
        F.when(several, mean * (1 - mean))
    )
    weight = F.sum(F.when(several, n - 1))
    level = F.avg(F.when(several, mean * (1 - mean)))
    share = excess / weight / level  # 1 / (strength + 1)
    return F.coalesce(
        F.least(F.lit(1000.0), F.greatest(F.lit(2.0), 1 / F.greatest(share, F.lit(1e-6)) - 1)),
        F.lit(1000.0),
    )


def _logit(p: Column) -> Column:
    bounded = F.least(F.lit(0.999), F.greatest(F.lit(0.001), p))
    return F.ln(bounded / (1 - bounded))


def site_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    path_col: str = "lang",
    threshold: float = 0.3,
    sample: int = SAMPLE,
) -> DataFrame:
    """Probability that each document is good, from its text and its site.

    A logistic classifier on shares of the text, fitted on at most ``sample``
    labelled documents (``labels``: doc_id, quality; remainder crc32(id) mod 5
    not 4; those with the smallest id hashes), gives each document's evidence.
    Labels of all other training rows count as well where they are summed:
    per host and per (host, path) the good labels and labels. The rate of a
    host is shrunk to the global rate, that of a path to its host's, by beta
    priors whose strength is estimated from the spread of the groups. The
    score adds the evidence and the site's departure from the global rate in
    log odds; a site without labels of its own departs no more than its host.

    Grouping is combined in the map tasks, so a hot host moves as one row a
    task; the site tables are staged and joined by their real size. Null
    hosts and paths are groups of their own. Null and empty texts are judged
    by their zero counts. Null ids never train. Repeated rows are judged one
    by one; an empty table gives no rows. Without labels every rate is 0.5.

    Columns: id, host, path, evidence, host_rate, path_rate, score, predicted
    int, held_out boolean, kept boolean.
    """
    rows = stage(
        docs.select(
            F.col(id_col).alias("__id"),
            F.col(host_col).cast("string").alias("__host"),
            F.col(path_col).cast("string").alias("__path"),
            *_evidence(text_or_empty(text_col)),
        ),
        "site-evidence",
    )
    labelled = (
        labels.filter(F.col("quality").isNotNull() & (crc_part("doc_id", 5) != 4))
        .groupBy(F.col("doc_id").alias("__label_id"))
        .agg(F.max("quality").cast("double").alias("__good"))
    )
    trained = stage(
        rows.join(labelled, F.col("__id") == F.col("__label_id")).drop("__label_id"),
        "site-labelled",
    )
    overall = trained.agg(F.sum("__good"), F.count("*")).first()
    # At most ``sample`` rows of ten numbers.
    chosen = (
        sampled(trained, "__id", sample, overall[1])
        .select(*EVIDENCE, "__good")
        .toPandas()
    )
    weights = fit_evidence(
        chosen[list(EVIDENCE)].to_numpy(float), chosen["__good"].to_numpy(float)
    )
    rate = ((overall[0] or 0.0) + 0.5) / (overall[1] + 1.0)
    counts = [F.sum("__good").alias("__k"), F.count("*").alias("__n")]
    paths = stage(trained.groupBy("__host", "__path").agg(*counts), "site-paths")
    hosts = paths.groupBy("__host").agg(F.sum("__k").alias("__k"), F.sum("__n").alias("__n"))
    firm = hosts.agg(_strength(hosts, F.lit(rate))).first()[0]
    hosts = stage(
        hosts.select(
            F.col("__host").alias("__h"),
            ((F.col("__k") + rate * firm) / (F.col("__n") + firm)).alias("host_rate"),
        ),
        "site-hosts",
    )
    within = paths.join(hosts, F.col("__host").eqNullSafe(F.col("__h")))
    fine = within.agg(_strength(within, F.col("host_rate"))).first()[0]
    sites = stage(
        within.select(
            F.col("__host").alias("__ph"),
            F.col("__path").alias("__p"),
            ((F.col("__k") + F.col("host_rate") * fine) / (F.col("__n") + fine)).alias("path_rate"),
        ),
        "site-rates",
    )
    logit = sum(
        (F.col(c) * float(w) for c, w in zip(EVIDENCE, weights, strict=True)), F.lit(0.0)
    )
    joined = rows.join(hosts, F.col("__host").eqNullSafe(F.col("__h")), "left").join(
        sites,
        F.col("__host").eqNullSafe(F.col("__ph")) & F.col("__path").eqNullSafe(F.col("__p")),
        "left",
    )
    host_rate = F.coalesce("host_rate", F.lit(rate))
    path_rate = F.coalesce("path_rate", host_rate)
    score = 1 / (1 + F.exp(-(logit + _logit(path_rate) - _logit(F.lit(rate)))))
    return joined.select(
        F.col("__id").alias(id_col),
        F.col("__host").alias(host_col),
        F.col("__path").alias(path_col),
        (1 / (1 + F.exp(-logit))).alias("evidence"),
        host_rate.alias("host_rate"),
        path_rate.alias("path_rate"),
        score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"),
        (crc_part("__id", 5) == 4).alias("held_out"),
        (score >= threshold).alias("kept"),
    )
