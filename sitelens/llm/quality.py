"""Quality rules per document, and verdicts on hosts by shrunken failure rates (DataFrame functions only)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions.scale import staged

MIN_WORDS, MAX_REPEAT_PERCENT, MAX_HOST_RATE = 50, 50, 0.5

# Each step binds one name inside a one-element array, so that it is evaluated once per row
# and never copied into the lambdas that look things up in it.
_WINDOWS = (
    "transform(slice(words, 1, greatest(size(words) - 2, 0)), (w, i) -> "
    "named_struct('t', concat(w, ' ', get(words, i + 1), ' ', get(words, i + 2)), 'i', i))"
)
_REPEATED = (
    "sort_array(array_compact(transform(wins, (x, k) -> "
    "if(get(wins, k - 1).t = x.t OR get(wins, k + 1).t = x.t, x.i, NULL))))"
)
_COVERED = (
    "aggregate(transform(found, (x, k) -> least(3, coalesce(get(found, k + 1) - x, 3))), 0L, (a, y) -> a + y)"
)
_REPEAT_WORDS = (
    f"transform(array(words), words -> transform(array(sort_array({_WINDOWS})), wins -> "
    f"transform(array({_REPEATED}), found -> {_COVERED})[0])[0])[0]"
)


def document_features(docs: DataFrame, carry: Sequence[str] = ("doc_id",), host: str = "source") -> DataFrame:
    """The rules' counts and ``base_failed`` per document, from one pass over whole texts.

    Columns ``carry`` come along inside the struct ``_row``, so their names cannot clash.
    A null text has no words.  A document stays in one row: its 3-word windows are sorted in
    the row, whatever its length, and no row is multiplied or shuffled.
    """
    text = "coalesce(cast(text AS string), '')"
    spaced = f"translate({text}, '\\t\\n\\u000b\\u000c\\r', '     ')"
    base = docs.select(
        F.struct(*carry).alias("_row"),
        F.col(host).alias("_host"),
        F.expr(text).alias("_text"),
        F.expr(f"array_remove(split({spaced}, ' '), '')").alias("words"),
    )
    lines = "filter(split(_text, '\\n'), x -> x RLIKE '[^\\\\x20\\\\x09-\\\\x0D]')"
    counted = base.selectExpr(
        "_row",
        "_host",
        "cast(size(words) AS bigint) AS n_words",
        "cast(length(translate(_text, ' \\t\\n\\u000b\\u000c\\r', '')) AS bigint) AS word_chars",
        "cast(length(_text) - length(translate(_text, '#*$%&|<>', '')) AS bigint) AS n_symbols",
        f"transform(array({lines}), x -> cast(size(x) - size(array_distinct(x)) AS bigint))[0] AS n_dup_lines",
        f"cast({_REPEAT_WORDS} AS bigint) AS n_repeat_words",
    )
    return counted.withColumn(
        "base_failed",
        F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"),
    )


def host_verdicts(features: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """(_host, host_docs, host_failed, host_ok) with failure rates shrunk to a beta prior.

    The prior is fitted to the hosts' own rates by moments: the spread between hosts beyond
    what binomial noise explains sets how many documents the prior is worth, from one to all.
    ``host_ok`` is false where the shrunken rate exceeds ``max_rate``.  A null host is a host
    of its own.  Sums combine map-side, so one host may hold any share of the rows; the
    prior is a scalar subquery over one row per host.
    """
    hosts = staged(
        features.groupBy("_host").agg(
            F.count("*").alias("host_docs"), F.sum(F.col("base_failed").cast("long")).alias("host_failed")
        )
    )
    total = hosts.selectExpr("1D * sum(host_failed) / sum(host_docs) AS mu").scalar()
    spread = hosts.withColumn("_mu", total).selectExpr(
        "*", "host_docs * (host_failed / host_docs - _mu) * (host_failed / host_docs - _mu) AS _s"
    )
    fitted = spread.selectExpr(
        "max(_mu) AS mu",
        "cast(sum(host_docs) AS double) AS n",
        "(sum(_s) - (count(*) - 1) * max(_mu) * (1 - max(_mu))) / "
        "nullif(sum(host_docs) - sum(1D * host_docs * host_docs) / sum(host_docs), 0) AS tau2",
    ).selectExpr(
        "mu",
        "if(coalesce(tau2, 0) <= 0, n, greatest(1D, least(n, mu * (1 - mu) / tau2 - 1))) AS worth",
    )
    prior = fitted.selectExpr("struct(mu, worth) AS prior").scalar()
    return (
        hosts.withColumn("_p", prior)
        .withColumn("_rate", F.expr("(host_failed + _p.worth * _p.mu) / (host_docs + _p.worth)"))
        .select("_host", "host_docs", "host_failed", (F.col("_rate") <= max_rate).alias("host_ok"))
    )


def quality_rules(docs: DataFrame, carry: Sequence[str] = ("doc_id",), host: str = "source") -> DataFrame:
    """``carry`` columns in ``_row``, the rules' counts, ``base_failed``, ``kept`` per document.

    Texts are read once: counts are staged, failures are summed by host, and the host verdicts
    are joined back (a sort-merge join that splits a hot host, or a broadcast where Spark sees
    from the staged file that hosts are few).  One row per input row, repeated rows included;
    an empty table gives an empty result; null ids and null hosts are ordinary values.
    """
    features = staged(document_features(docs, carry, host))
    hosts = host_verdicts(features).withColumnRenamed("_host", "_h")
    return features.join(hosts, F.col("_host").eqNullSafe(F.col("_h"))).select(
        "_row",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.col("host_ok")).alias("kept"),
        "host_docs",
        "host_failed",
    )


def without_rejected(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns of ``docs``."""
    return quality_rules(docs, docs.columns).filter("kept").select("_row.*")
