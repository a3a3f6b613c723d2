"""URL filters by a path-template tree.

Per host, paths become templates.  Numbers, long codes and dates turn into wildcards at once.  Level by level, a
place whose literals keep changing (by the Good-Turing share of unseen ones) becomes a wildcard too, except for literals
with pages or labels enough to be judged on their own.  Sibling branches are merged as long as their bad shares
are homogeneous by a chi-square test; a set that is not is split at its mean share and tested again.  A template is
rejected when the smoothed bad share of its branch reaches a limit; unlabelled templates keep the prior and stay.

All of it is aggregates over (host, template) rows, so a host with a third of all pages is no task of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, written


@dataclass(frozen=True)
class TemplateRules:
    """``prior_bad`` of ``prior_weight`` pseudo-labels smooths each branch's share."""

    max_depth: int = 16           # segments from here on count as one segment
    unseen_share: float = 0.1     # Good-Turing share of unseen literals from which a place is variable
    min_pages: int = 20           # a literal with so many pages, or ``min_labels`` labels, stays one
    min_labels: int = 5           # branches with fewer labels are not merged
    normal_quantile: float = 1.645  # of the chi-square test (5 %)
    prior_weight: float = 5.0
    prior_bad: float = 0.2
    reject_share: float = 0.8


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without a host part."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_verdict(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule of ``[("block", "net/"), ...]``; both null if none fits."""
    rule = verdict = None
    for kind, text in sorted(rules, key=lambda r: (-len(r[1]), r[1], r[0])):
        domain, slash, rest = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def _segment_class(seg: Column) -> Column:
    """Numbers, long codes and dated names become wildcards that keep the file ending."""
    ending = F.regexp_extract(seg, r"(\.[a-z]{1,5})$", 1)
    body = F.regexp_replace(seg, r"\.[a-z]{1,5}$", "")
    return (F.when(body.rlike(r"^[0-9]+$"), F.concat(F.lit("{num}"), ending))
            .when(body.rlike(r"^[0-9a-f-]{16,}$"), F.concat(F.lit("{hex}"), ending))
            .when(body.rlike(r"^[0-9]{1,4}([-_.][0-9]{1,4})+$"), F.concat(F.lit("{date}"), ending))
            .otherwise(seg))


def junk_page(html: Column, share: float = 0.05) -> Column:
    """1 where more than ``share`` of the blank-separated pieces of a page carry a run of three equal marks; 0 otherwise,
    null for a null page.  A weak label for pages that no rule judges."""
    marks = F.regexp_count(html, F.lit(r"###|\*\*\*|\$\$\$|%%%|\|\|\||(?:&amp;){3}"))
    pieces = F.regexp_count(html, F.lit(" ")) + 1
    return (marks > share * pieces).cast("int")


def path_templates(pages: DataFrame, rules: TemplateRules) -> DataFrame:
    """(host, path, pages, labelled, bad, segs) of the distinct (host, path) pairs in ``pages``; ``segs`` are the
    segments of the pair's template, the last one with a closing slash where the path has one.

    Counting is by partial aggregation, so a hot host costs its distinct shapes, not its rows.
    """
    segs = F.filter(F.split(F.col("path"), "/"), lambda s: s != "")
    typed = F.transform(segs, _segment_class)
    deep = F.size(segs) > rules.max_depth
    tail = F.array_join(F.slice(typed, rules.max_depth, 1 << 30), "/")
    base = written(pages.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("pages"), F.count("label").alias("labelled"), F.coalesce(F.sum("label"), F.lit(0)).alias("bad"))
        .withColumn("slash", F.when(F.col("path").rlike("./$"), F.lit("/")).otherwise(F.lit("")))
        .withColumn("raw", F.when(deep, F.concat(F.slice(typed, 1, rules.max_depth - 1), F.array(tail))).otherwise(typed)), "url-paths")
    shape = ["host", "raw", "slash"]
    current = base.groupBy(*shape).agg(F.sum("pages").alias("pages"), F.sum("labelled").alias("labelled"))
    current = written(current.withColumn("segs", F.array().cast("array<string>")), "url-shapes")
    depth = current.agg(F.max(F.size("raw"))).first()[0] or 0
    for level in range(1, depth + 1):
        here = F.size("raw") >= level
        seg = F.get("raw", F.lit(level - 1))
        child = (current.filter(here).groupBy("host", "segs", seg.alias("seg"))
                 .agg(F.sum("pages").alias("pages"), F.sum("labelled").alias("labelled")))
        place = (child.groupBy("host", "segs").agg((F.count_if(F.col("pages") == 1) / F.sum("pages")).alias("unseen"))
                 .filter(F.col("unseen") > rules.unseen_share)
                 .select(F.col("host").alias("_h"), F.col("segs").alias("_s")))
        rare = (child.filter((F.col("pages") < rules.min_pages) & (F.col("labelled") < rules.min_labels)
                             & ~F.col("seg").startswith("{"))
                .join(place, (F.col("host") == F.col("_h")) & (F.col("segs") == F.col("_s")))
                .select("_h", "_s", F.col("seg").alias("_seg"), F.lit("{any}").alias("_wild")))
        current = written(
            current.join(rare, (F.col("host") == F.col("_h")) & (F.col("segs") == F.col("_s")) & (seg == F.col("_seg")), "left")
            .withColumn("segs", F.when(here, F.concat("segs", F.array(F.coalesce("_wild", seg)))).otherwise(F.col("segs")))
            .drop("_h", "_s", "_seg", "_wild"), "url-level")
    made = current.select(*[F.col(c).alias("_" + c) for c in shape], "segs")
    return base.join(made, [F.col(c) == F.col("_" + c) for c in shape]).select(
        "host", "path", "pages", "labelled", "bad", F.concat("segs", F.array("slash")).alias("segs"))


def template_text(segs: Column) -> Column:
    """The template of a segment array whose last entry is the closing slash or empty."""
    body = F.slice(segs, 1, F.size(segs) - 1)
    return F.concat(F.array_join(F.transform(body, lambda s: F.concat(F.lit("/"), s)), ""), F.element_at(segs, -1))


def _homogeneous(cluster: DataFrame, keys: list[str], rules: TemplateRules) -> DataFrame:
    """Per cluster its mean share and whether its branches may have one share (chi-square, Wilson-Hilferty)."""
    n, b = F.sum("labelled"), F.sum("bad")
    per = cluster.groupBy(*keys).agg(F.count(F.lit(1)).alias("members"), (b / n).alias("share"), n.alias("n"), b.alias("b"),
                                     F.sum(F.col("bad") * F.col("bad") / F.col("labelled")).alias("squares"))
    df = F.col("members") - 1
    spread = F.col("share") * (1 - F.col("share"))
    statistic = (F.col("squares") - F.col("b") * F.col("b") / F.col("n")) / spread
    limit = df * F.pow(1 - 2 / (9 * df) + rules.normal_quantile * F.sqrt(2 / (9 * df)), F.lit(3))
    fits = F.when((df == 0) | (spread == 0), F.lit(True)).otherwise(statistic <= limit)
    return per.select(*[F.col(k).alias("_" + k) for k in keys], "members", "share", fits.alias("fits"))


def merged_branches(templates: DataFrame, rules: TemplateRules) -> DataFrame:
    """(host, segs, branch, in_branch, bad_in_branch) of every template (host, segs, labelled, bad).

    From the last segment to the first, branches of a host that differ only there, in a literal, are siblings.  Siblings
    with labels enough form one cluster; a cluster whose shares differ is split at its mean, until all fit.  The branches
    of a cluster become one branch, named by its least literal.
    """
    state = written(templates.select("host", "segs", F.col("segs").alias("branch"), "labelled", "bad"), "url-branches")
    depth = state.agg(F.max(F.size("segs"))).first()[0] or 0
    for level in range(depth - 1, 0, -1):
        seg = F.element_at("branch", level)
        ready = (state.filter(F.size("branch") > level).groupBy("host", "branch")
                 .agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
                 .filter((F.col("labelled") >= rules.min_labels) & ~seg.startswith("{"))
                 .select("host", "branch", "labelled", "bad", seg.alias("seg"), F.transform(
                     "branch", lambda s, i: F.when(i == level - 1, F.lit("")).otherwise(s)).alias("siblings"), F.lit("").alias("part")))
        keys = ["host", "siblings", "part"]
        cluster = written(ready, "url-cluster")
        while True:
            same = [F.col(k) == F.col("_" + k) for k in keys]
            tested = cluster.join(_homogeneous(cluster, keys, rules), same).drop("_host", "_siblings", "_part")
            if tested.filter(~F.col("fits")).isEmpty():
                break
            side = F.when(F.col("bad") / F.col("labelled") > F.col("share"), F.lit("1")).otherwise(F.lit("0"))
            cluster = written(tested.withColumn("part", F.when(F.col("fits"), F.col("part")).otherwise(F.concat("part", side)))
                              .select(*cluster.columns), "url-cluster")
        least = (tested.filter(F.col("members") > 1).groupBy(*keys).agg(F.min("seg").alias("least"))
                 .select(*[F.col(k).alias("_" + k) for k in keys], "least"))
        named = (tested.filter(F.col("members") > 1).join(least, [F.col(k) == F.col("_" + k) for k in keys])
                 .select(F.col("host").alias("_h"), F.col("branch").alias("_b"), F.transform("branch", lambda s, i: F.when(
                     i == level - 1, F.concat(F.lit("{"), F.col("least"), F.lit("~}"))).otherwise(s)).alias("_to")))
        if named.isEmpty():
            continue
        state = written(state.join(named, (F.col("host") == F.col("_h")) & (F.col("branch") == F.col("_b")), "left")
                        .withColumn("branch", F.coalesce("_to", "branch")).drop("_h", "_b", "_to"), "url-branches")
    per = (state.groupBy("host", "branch").agg(F.sum("labelled").alias("in_branch"), F.sum("bad").alias("bad_in_branch"))
           .select(F.col("host").alias("_h"), F.col("branch").alias("_b"), "in_branch", "bad_in_branch"))
    return state.join(per, (F.col("host") == F.col("_h")) & (F.col("branch") == F.col("_b"))).select(
        "host", "segs", "branch", "in_branch", "bad_in_branch")


def template_tree(pages: DataFrame, rules: TemplateRules = TemplateRules()) -> DataFrame:
    """(host, path, template, branch, in_branch, bad_share) of the distinct (host, path) pairs in ``pages``, which has
    columns host, path and label (1 bad, 0 good, null unknown)."""
    paths = written(path_templates(pages, rules), "url-templates")
    per = paths.groupBy("host", "segs").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    tree = merged_branches(per, rules).select(F.col("host").alias("_h"), F.col("segs").alias("_s"), "branch", "in_branch", "bad_in_branch")
    share = (F.col("bad_in_branch") + rules.prior_weight * rules.prior_bad) / (F.col("in_branch") + rules.prior_weight)
    return paths.join(tree, (F.col("host") == F.col("_h")) & (F.col("segs") == F.col("_s"))).select(
        "host", "path", template_text(F.col("segs")).alias("template"), template_text(F.col("branch")).alias("branch"),
        "in_branch", share.alias("bad_share"))


def url_verdicts(pages: DataFrame, hosts_rules: list[tuple[str, str]],
                 rules: TemplateRules = TemplateRules(), labels: DataFrame | None = None,
                 id_col: str = "page_id", url_col: str = "url", html_col: str | None = None) -> DataFrame:
    """One row per page: id, host, path, fitting rule, verdict, template, branch, bad_share.

    The rule's verdict holds where one fits.  Elsewhere a page is blocked when its
    template's smoothed bad share reaches ``reject_share``.  Labels are ``labels`` (id, bad 0/1) where given;
    else the rules' own verdicts (block is bad) and, with ``html_col``, junk marks of the pages that no rule
    judges.  A null url or one without ``://`` has empty host and path and gets a template of its own like any
    other; null ids and repeated rows are kept as they are.
    """
    page = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"),
                        (junk_page(F.col(html_col)) if html_col else F.lit(None).cast("int")).alias("junk"))
    rule, verdict = rule_verdict(F.col("host"), F.col("path"), hosts_rules)
    page = page.withColumn("rule", rule).withColumn("ruled", verdict)
    if labels is None:
        page = page.withColumn("label", F.when(F.col("ruled").isNotNull(), (F.col("ruled") == "block").cast("int"))
                               .otherwise(F.col("junk")))
    else:
        own = labels.select(F.col(labels.columns[0]).alias("_id"), F.col(labels.columns[1]).cast("int").alias("label"))
        page = page.join(own.groupBy("_id").agg(F.max("label").alias("label")),
                         F.col("page_id") == F.col("_id"), "left").drop("_id")
    page = written(page.drop("junk"), "url-pages")
    tree = template_tree(page, rules).select(F.col("host").alias("_h"), F.col("path").alias("_p"), "template", "branch", "bad_share")
    out = page.join(tree, (F.col("host") == F.col("_h")) & (F.col("path") == F.col("_p")))
    blocked = F.col("bad_share") >= rules.reject_share
    return out.select("page_id", "host", "path", "rule",
                      F.coalesce("ruled", F.when(blocked, "block").otherwise("allow")).alias("verdict"),
                      "template", "branch", "bad_share")
