"""URL filter: listed rules first, then a path-template tree judged by smoothed labelled purity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayflux.llm.common import Stages
from wayflux.session import salted_join

LEVELS = 8
FAN_OUT = 16
SMOOTHING = 4.0
EXPECTED = 5  # urls that a branch needs for each kind of rest before its kinds can tell it from others
BLOCK_FROM = 0.8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Rule (host and path as one text) and verdict of the longest rule (verdict, host, path) that fits, or null.

    A rule fits its host and every subdomain, if the path starts with the rule's.
    """
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1], r[2]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in reversed(ranked):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def segments(path: Column, levels: int = LEVELS) -> Column:
    """Segments of a path with typed wildcards: long hexadecimal words are `<x>`, digit runs `<n>`; beyond
    `levels` segments the rest is one `**`."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    typed = F.transform(parts, lambda s: F.regexp_replace(F.regexp_replace(s, r"(?i)\b(?=[0-9a-f]*[0-9])(?=[0-9a-f]*[a-f])[0-9a-f]{8,}\b", "<x>"), "[0-9]+", "<n>"))
    return F.when(F.size(typed) <= levels, typed).otherwise(F.concat(F.slice(typed, 1, levels), F.array(F.lit("**"))))


def kinds_of(segs: Column) -> Column:
    """What segments are made of, a letter each: n a number, x has a hexadecimal word, m has numbers, w words only."""
    kind = F.transform(segs, lambda s: F.when(s == "<n>", "n").when(s.contains("<x>"), "x").when(s.contains("<n>"), "m").otherwise("w"))
    return F.array_join(kind, "")


NODE = ["host", "scope", "template"]


def branches(going: DataFrame, level: int, stages: Stages) -> DataFrame:
    """(host, scope, template, seg, kept): what each branch below each node is called, `*` for those that are pooled.

    A branch is rare if it is one of FAN_OUT or more and has less than 1 / FAN_OUT of the urls. Rare branches are
    pooled unless what lies below (how many segments of which kinds) differs from all rare ones together: Pearson's
    statistic above its 95 % point, with EXPECTED urls for each kind of rest at least. Of the others, labelled ones that
    do not differ in their share of bad urls from the labelled ones together (two-sided test at 5 %) are pooled, if
    there are several; one without labels keeps its name, for nothing says that it is like another.
    """
    rest = kinds_of(F.slice("segs", level + 2, F.greatest(F.size("segs") - level - 1, F.lit(0))))
    kinds = stages.keep(going.groupBy(*NODE, "seg", rest.alias("rest")).agg(F.sum("n").alias("c"), F.sum("labelled").alias("l"), F.sum("bad").alias("b")), f"kinds{level}")
    child = kinds.groupBy(*NODE, "seg").agg(F.sum("c").alias("n"), F.sum("l").alias("l"), F.sum("b").alias("b"))
    node = child.groupBy(*NODE).agg(F.count("*").alias("many"), F.sum("n").alias("all_n"), F.sum("l").alias("all_l"), F.sum("b").alias("all_b"), F.sum((F.col("l") > 0).cast("int")).alias("labels"))
    rare = (F.col("many") >= FAN_OUT) & (F.col("n") * FAN_OUT < F.col("all_n"))
    child = stages.keep(salted_join(child, node, NODE, spread=["seg"]).withColumn("rare", rare), f"child{level}")

    below = kinds.select(*NODE, "seg", "rest", "c").join(child.filter("rare").select(*NODE, "seg", "n"), [*NODE, "seg"])
    pool = below.groupBy(*NODE, "rest").agg(F.sum("c").alias("pool"))
    whole = pool.groupBy(*NODE).agg(F.sum("pool").alias("every"), (F.count("*") - 1).alias("free"))
    shared = below.join(pool.join(whole, NODE), [*NODE, "rest"])
    far = shared.groupBy(*NODE, "seg", "n", "free").agg((F.sum(F.col("c") * F.col("c") * F.col("every") / F.col("pool")) / F.col("n") - F.col("n")).alias("x2"))
    cut = F.lit(2.0) / (9 * F.col("free"))
    odd = far.filter((F.col("free") > 0) & (F.col("n") >= EXPECTED * (F.col("free") + 1)) & (F.col("x2") > F.col("free") * F.pow(1 - cut + 1.645 * F.sqrt(cut), 3)))
    child = child.join(odd.select(*NODE, "seg", F.lit(True).alias("odd")), [*NODE, "seg"], "left")

    p = F.try_divide("all_b", "all_l")
    differs = (F.abs(F.try_divide("b", "l") - p) > 1.96 * F.sqrt(F.try_divide(p * (1 - p), F.col("l")))) & (p > 0) & (p < 1)
    pooled = F.when(F.col("rare"), F.col("odd").isNull()).otherwise((F.col("l") > 0) & (F.col("labels") > 1) & ~F.coalesce(differs, F.lit(False)))
    return child.select(*NODE, "seg", F.when(pooled, "*").otherwise(F.col("seg")).alias("kept"))


def template_tree(shapes: DataFrame, stages: Stages, levels: int) -> DataFrame:
    """(host, scope, segs, template) of counted shapes (host, scope, segs, n, labelled, bad), level by level per host
    and scope: urls of different scopes are kept apart.

    All counts are sums over shapes, so a host with many urls is no larger than its number of shapes.
    """
    going, ended = shapes.withColumn("template", F.array().cast("array<string>")), []
    for level in range(levels):
        ended.append(going.filter(F.size("segs") <= level))
        on = going.filter(F.size("segs") > level).withColumn("seg", F.get("segs", F.lit(level)))
        step = on.join(branches(on, level, stages), [*NODE, "seg"])
        going = stages.keep(step.select("host", "scope", "segs", "n", "labelled", "bad", F.concat("template", F.array("kept")).alias("template")), f"level{level}")
    for e in ended:
        going = going.unionByName(e)
    return going


def evidence_elsewhere(tree: DataFrame) -> DataFrame:
    """(host, template, l, b) of templates without labels: the labelled urls of the same shapes on other hosts."""
    known = tree.filter("labelled > 0").groupBy("host", "segs").agg(F.sum("labelled").alias("own_l"), F.sum("bad").alias("own_b"))
    every = known.groupBy("segs").agg(F.sum("own_l").alias("l"), F.sum("own_b").alias("b"))
    asked = tree.filter("NOT scope").select("host", "template", "segs").join(every, "segs")
    asked = asked.join(known, ["host", "segs"], "left")
    return asked.groupBy("host", "template").agg(F.sum(F.col("l") - F.coalesce("own_l", F.lit(0))).alias("l"), F.sum(F.col("b") - F.coalesce("own_b", F.lit(0))).alias("b"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], url: str = "url", labels: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """`pages` with struct `_url`: host, path, rule, template, purity, evidence, verdict.

    Labels (1 bad, 0 good, null unknown; default: the verdicts of the rules on the urls they fit) are
    summed per template of each host. Its share of bad urls is smoothed towards the host's, the host's
    towards the overall share, with SMOOTHING urls each; from BLOCK_FROM on the template is rejected.
    A rule's verdict says nothing about urls beyond its path on its host: without `labels`, the urls that no rule fits have
    templates of their own, and their evidence is that of the same shapes on other hosts, smoothed towards 0.5.
    `evidence` counts the labelled urls behind a purity. A url that a rule fits takes the rule's verdict.
    Null urls and urls without `://` have empty host and path, and are judged as that host; a path of more than `levels`
    segments counts as one of its first ones; repeated rows count as often as they occur; an empty table gives none.
    """
    stages = Stages(pages.sparkSession, "urls")
    host, path = host_of(F.col(url)), path_of(F.col(url))
    known = F.lit(None).cast("int") if labels is None else labels.cast("int")
    rows = pages.select(F.struct(*pages.columns).alias("_row"), known.alias("_y"), F.struct(host.alias("host"), path.alias("path"), segments(path, levels).alias("segs")).alias("_u"))
    rule, verdict = rule_of(F.col("_u.host"), F.col("_u.path"), rules)
    rows = rows.withColumn("_r", F.struct(rule.alias("rule"), verdict.alias("verdict")))
    known = F.when(F.col("_r.verdict").isNotNull(), (F.col("_r.verdict") == "block").cast("int")) if labels is None else F.col("_y")
    rows = rows.withColumn("_k", F.col("_r.verdict").isNotNull() if labels is None else F.lit(True))
    counted = rows.select(F.col("_u.host").alias("host"), F.col("_k").alias("scope"), F.col("_u.segs").alias("segs"), known.alias("y"))
    shapes = stages.keep(counted.groupBy("host", "scope", "segs").agg(F.count("*").alias("n"), F.count("y").alias("labelled"), F.coalesce(F.sum("y"), F.lit(0)).cast("long").alias("bad")), "shapes")
    deepest = shapes.agg(F.max(F.size("segs"))).first()[0] or 0
    tree = stages.keep(template_tree(shapes, stages, deepest), "tree")
    every = shapes.agg(((F.coalesce(F.sum("bad"), F.lit(0)) + 0.5 * SMOOTHING) / (F.coalesce(F.sum("labelled"), F.lit(0)) + SMOOTHING)).alias("g"))
    share = F.when(F.col("scope"), F.lit(every.first()["g"])).otherwise(F.lit(0.5))
    hosts = tree.groupBy("host", "scope").agg(((F.sum("bad") + SMOOTHING * share) / (F.sum("labelled") + SMOOTHING)).alias("prior"))
    own = tree.groupBy(*NODE).agg(F.sum("bad").alias("b"), F.sum("labelled").alias("l")).join(hosts, ["host", "scope"])
    other = evidence_elsewhere(tree).select("host", F.lit(False).alias("scope"), "template", F.col("l").alias("ol"), F.col("b").alias("ob"))
    both = own.join(other, NODE, "left").withColumns({"b": F.col("b") + F.coalesce("ob", F.lit(0)), "l": F.col("l") + F.coalesce("ol", F.lit(0))})
    purity = both.select(*NODE, F.col("l").alias("evidence"), ((F.col("b") + SMOOTHING * F.col("prior")) / (F.col("l") + SMOOTHING)).alias("purity"))
    judged = tree.join(stages.keep(purity, "purity"), NODE)
    judged = judged.select(F.col("host").alias("_h"), F.col("scope").alias("_o"), F.col("segs").alias("_s"), F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"), "purity", "evidence")
    out = rows.join(judged, (F.col("_u.host") == F.col("_h")) & (F.col("_u.segs") == F.col("_s")) & (F.col("_k") == F.col("_o")), "left")
    final = F.coalesce(F.col("_r.verdict"), F.when(F.col("purity") >= BLOCK_FROM, "block").otherwise("allow"))
    return out.select(*(F.col("_row")[c].alias(c) for c in pages.columns if c != "_url"), F.struct(F.col("_u.host"), F.col("_u.path"), F.col("_r.rule"), F.col("template"), F.col("purity"), F.col("evidence"), final.alias("verdict")).alias("_url"))
