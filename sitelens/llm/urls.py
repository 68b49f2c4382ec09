"""URL verdicts: explicit rules, then path templates per host judged by labelled purity (DataFrame functions only)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions.scale import staged

#: Rules as (verdict, host and path); the longest that fits wins.
RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]
MANY_VALUES, PAGES_A_VALUE = 50, 3
Z, PRIOR_WEIGHT, MAX_BAD = 1.96, 10.0, 0.5
#: SQL: does the share of ``b`` in ``l`` lie within Z standard errors of the node's?  Branches without labels do.
CLOSE = (
    "coalesce(abs(b / nullif(l, 0) - _all_bad / nullif(_all, 0)) <= "
    f"{Z}D * sqrt((_all_bad / nullif(_all, 0)) * (1 - _all_bad / nullif(_all, 0)) / nullif(l, 0)), true)"
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_host_path(pages: DataFrame) -> DataFrame:
    """(_id, _url) with ``host`` (A-Z lower-cased) and ``path``; both empty without ``://``."""
    rest = "if(instr(_url, '://') > 0, substr(_url, instr(_url, '://') + 3), '')"
    return pages.select(F.col("page_id").alias("page_id"), F.col("url").alias("_url")).selectExpr(
        "page_id",
        f"translate(coalesce(regexp_extract({rest}, '^[^/?#]*', 0), ''), '{_UPPER}', '{_LOWER}') AS host",
        f"coalesce(regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1), '') AS path",
    )


def rule_columns(rules: Sequence[tuple[str, str]]) -> tuple[F.Column, F.Column]:
    """The winning rule, and its verdict, for ``host`` and ``path``."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):
        host, path = text[: text.index("/")], text[text.index("/") :]
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def templates(paths: DataFrame) -> DataFrame:
    """``paths(host, path, ...)`` with ``template``: the path, its variable segments as ``*``.

    A segment with a digit is variable.  Then level by level, under one host and parent
    template, a segment's place is variable if it has more than 50 values with under 3 pages
    each on average.  Levels are aggregates joined back, so a host may hold any share of the
    pages.  A parent with at most 50 paths cannot have more values below, so its paths leave
    the loop: it goes on to the depth at which templates can still branch that far.
    """
    segments = "transform(filter(split(path, '/'), x -> x <> ''), x -> if(x RLIKE '[0-9]', '*', x))"
    left = staged(paths.withColumn("_s", F.expr(segments)).withColumn("_t", F.lit("")))
    done, level = [], 0
    while True:
        parents = left.groupBy("host", "_t").agg(F.count("*").alias("_paths"), F.max(F.size("_s")).alias("_depth"))
        parents = parents.filter(f"_paths > {MANY_VALUES} AND _depth > {level}").select("host", "_t", F.lit(True).alias("_open"))
        marked = staged(left.join(parents, ["host", "_t"], "left"))
        rest = f"concat(_t, array_join(transform(slice(_s, {level + 1}, greatest(size(_s) - {level}, 1)), x -> concat('/', x)), ''))"
        done.append(marked.filter("_open IS NULL").withColumn("_t", F.expr(rest)).drop("_open"))
        left = marked.filter("_open").drop("_open")
        if left.isEmpty():
            break
        ended, left = left.filter(f"size(_s) <= {level}"), left.filter(f"size(_s) > {level}")
        done.append(ended)
        left = left.withColumn("_v", F.expr(f"_s[{level}]"))
        wide = (
            left.groupBy("host", "_t", "_v")
            .agg(F.sum("pages").alias("_n"))
            .groupBy("host", "_t")
            .agg(F.count("*").alias("_values"), F.sum("_n").alias("_n"))
            .filter(f"_values > {MANY_VALUES} AND _n < {PAGES_A_VALUE} * _values")
            .select("host", "_t", F.lit(True).alias("_wide"))
        )
        left = left.join(wide, ["host", "_t"], "left").withColumn("_t", F.expr("concat(_t, '/', if(_wide, '*', _v))"))
        left, level = staged(left.drop("_v", "_wide")), level + 1
    out = reduce(DataFrame.unionByName, done)
    return out.withColumn("template", F.expr("if(_t = '', '/', _t)")).drop("_s", "_t")


def merged_counts(counts: DataFrame) -> DataFrame:
    """``counts(host, template, labelled, bad)`` with ``l`` and ``b``: those of the branch each is merged into.

    Under each node of a host's tree the branches (subtrees, and the template that is the node
    itself) whose share of bad labels lies within 1.96 standard errors of the node's are merged.
    This goes from the leaves up: what is merged under a node goes on as one branch of the node
    above, with the counts of its members; a branch that does not fit stays by itself.  Nodes
    with a single branch merge nothing and are left out, so there are as many rounds as nodes
    that branch above each other.
    """
    segments = "if(template = '/', CAST(array() AS array<string>), slice(split(template, '/'), 2, size(split(template, '/')) - 1))"
    leaves = staged(counts.withColumn("_s", F.expr(segments)))
    nodes = leaves.select("host", "template", F.expr("posexplode(concat(_s, array('')))").alias("_k", "_next"), "_s").withColumn(
        "_node", F.expr("concat_ws('/', slice(_s, 1, _k))")
    )
    nodes = staged(nodes.select("host", "template", "_k", "_node", "_next"))
    branching = nodes.groupBy("host", "_k", "_node").agg(F.min("_next").alias("_a"), F.max("_next").alias("_z"))
    branching = branching.filter("_k = 0 OR _a <> _z").select("host", "_k", "_node")
    above = (
        nodes.join(branching, ["host", "_k", "_node"])
        .groupBy("host", "template")
        .agg(F.sort_array(F.collect_list(F.struct("_k", "_node"))).alias("_up"))
    )
    # one row per template: its counts, and the branching nodes above it from the root down
    leaves = staged(leaves.drop("_s").join(above, ["host", "template"]).withColumn("_rank", F.size("_up")))
    stops, carried = [], None
    for rank in range(leaves.agg(F.max("_rank").alias("n")).first().n or 0, 0, -1):
        units = leaves.filter(f"_rank = {rank}").selectExpr("host", "_up", "template AS _unit", f"{rank} AS _at", "true AS _own", "labelled AS l", "bad AS b")
        if carried is not None:
            units = units.unionByName(carried)
        units = units.withColumn("_node", F.expr("element_at(_up, -1)._node"))
        pool = units.groupBy("host", "_node").agg(F.sum("l").alias("_all"), F.sum("b").alias("_all_bad"))
        judged = staged(units.join(pool, ["host", "_node"]).withColumn("_fits", F.expr(CLOSE)))
        stops.append(judged.filter("NOT _fits").select("host", "_unit", "_own", "_at", "l", "b"))
        merged = judged.filter("_fits").groupBy("host", "_node").agg(F.any_value("_up").alias("_up"), F.sum("l").alias("l"), F.sum("b").alias("b"))
        carried = staged(
            merged.selectExpr(
                "host", f"slice(_up, 1, {rank - 1}) AS _up", "_node AS _unit", f"{rank - 1} AS _at", "false AS _own", "l", "b"
            )
        )
    if carried is None:
        return counts.selectExpr("*", "labelled AS l", "bad AS b")
    stops.append(carried.select("host", "_unit", "_own", "_at", "l", "b"))
    # the lowest branch that did not fit, or the root's, holds the template
    chain = leaves.selectExpr(
        "host",
        "template",
        "explode(concat(transform(_up, (x, i) -> struct(x._node AS _unit, false AS _own, i AS _at)), "
        "array(struct(template AS _unit, true AS _own, _rank AS _at)))) AS _c",
    ).select("host", "template", "_c.*")
    held = (
        chain.join(reduce(DataFrame.unionByName, stops), ["host", "_unit", "_own", "_at"])
        .groupBy("host", "template")
        .agg(F.max(F.struct("_at", "l", "b")).alias("_held"))
    )
    return leaves.drop("_up", "_rank").join(held, ["host", "template"]).select("host", "template", "labelled", "bad", "_held.l", "_held.b")


def url_filter(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]] = tuple(RULES)) -> DataFrame:
    """page_id, host, path, rule, verdict, template for every page.

    Where no rule fits, the page's path template decides.  Pages are labelled by the document
    number at the end of their path: bad is quality 0 or toxic.  Similar branches are merged
    from the leaves up (``merged_counts``); the share of what a template is merged into is then
    smoothed towards the overall one, worth 10 labels, and the template is blocked beyond one half.  Without labels everything else is allowed.

    Null ids and urls are ordinary rows (both parts empty); repeated pages are judged alike; of
    repeated labels the bad ones win; an empty table gives an empty result.
    """
    rule, verdict = rule_columns(rules)
    parsed = staged(with_host_path(pages))
    number = F.expr("try_cast(regexp_extract(path, '/([0-9]+)[^/]*/?$', 1) AS bigint)")
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("_doc")).agg(
        F.max(F.expr("if(quality = 0 OR toxic = 1, 1L, 0L)")).alias("_bad")
    )
    counted = (
        parsed.groupBy("host", "path")
        .agg(F.count("*").alias("pages"))
        .withColumn("_doc", number)
        .join(marks, "_doc", "left")
        .selectExpr("host", "path", "pages", "if(_bad IS NULL, 0L, pages) AS labelled", "coalesce(_bad, 0L) * pages AS bad")
    )
    by_path = staged(templates(counted).select("host", "path", "labelled", "bad", "template"))
    branch = by_path.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    branch = staged(branch)
    total = branch.selectExpr("coalesce(sum(bad) / nullif(sum(labelled), 0), 0D) AS share").scalar()
    scored = (
        merged_counts(branch)
        .withColumn("_share", total)
        .withColumn("_blocked", F.expr(f"(b + {PRIOR_WEIGHT}D * _share) / (l + {PRIOR_WEIGHT}D) > {MAX_BAD}D"))
        .select("host", "template", "_blocked")
    )
    verdicts = by_path.join(scored, ["host", "template"]).select("host", "path", "_blocked", "template")
    return parsed.join(verdicts, ["host", "path"]).select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("_blocked"), "block").otherwise("allow")).alias("verdict"),
        "template",
    )
