"""URL filters: written rules first, then a path-template tree for each host.

Every expression here is a DataFrame operation; no Python runs in tasks.

Per host, paths become templates of all their segments: one that holds a
digit is variable (``*``), and so are the rare children of a node with very
many children. Two templates of one host that differ in one fixed segment
only are siblings there. Judged are labelled pages: those that a rule allows
or blocks. From the last segment to the first, siblings whose share of
blocked pages does not differ from that of all their other siblings by more
than ``z`` standard errors become one branch (``{first name}``), and this is
repeated until nothing merges. A branch is rejected when the share of its
labelled pages that are blocked reaches ``purity``, both as it is and drawn
towards the share over all labelled pages; so a branch without a blocked page
never is. Pages without a rule get the verdict of their branch.

Defined cases: a null url, or one without ``://``, has empty host and path
and fits no rule; its template is that of the empty host. Repeated rows are
pages of their own. Without rules nothing is blocked. Templates without
labelled pages merge with none and are allowed. An empty table gives no rows,
other columns of the pages play no part, very long paths are read whole, and
of siblings of one name order the smallest names the branch.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.components import written

VARIABLE = ""  # a segment is never empty, and never holds "/"
MERGED = "/"  # before the smallest name of merged siblings
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
         ("block", "net/fr/")]


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest) + 1), "^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def best_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null.

    The rules are written by hand and become literals of the plan.
    """
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        own, _, rest = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def shaped(path: Column) -> Column:
    """Segments of a path, variable ones empty."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(parts, lambda s: F.when(s.rlike("[0-9]"), F.lit(VARIABLE)).otherwise(s))


def template_tree(shapes: DataFrame, fanout: int) -> DataFrame:
    """Add ``template`` to ``(host, shape, n, ...)``: rare children of wide nodes become variable, level by level.

    A node with at most ``fanout`` shapes below it has no wide node below, so its shapes are done.
    """
    own = shapes.columns
    tree, done, k = shapes.withColumn("template", F.col("shape")), None, 0
    while True:
        # each level reads the last one several times
        tree, n = written(tree.withColumn("prefix", F.slice("template", 1, k)))
        many = tree.where(F.size("shape") > k).groupBy("host", "prefix").agg(F.count("*").alias("c")).where(F.col("c") > fanout)
        keys = ["host", "prefix"]
        rest = tree.where(F.size("shape") > k).join(many.select(keys), keys, "left_semi")
        over = tree.where(F.size("shape") <= k).unionByName(
            tree.where(F.size("shape") > k).join(many.select(keys), keys, "left_anti")).select(*own, "template")
        done = over if done is None else done.unionByName(over)
        rest, n = written(rest.withColumn("part", F.element_at("shape", k + 1)))
        if not n:
            return done
        child = rest.where(F.col("part") != VARIABLE).groupBy(*keys, "part").agg(F.sum("n").alias("c"))
        node = child.groupBy(keys).agg(F.count("*").alias("kinds"), F.sum("c").alias("total"))
        rare = (child.join(node.where(F.col("kinds") > fanout), keys).where(F.col("c") * fanout < F.col("total"))
                .select(*keys, "part", F.lit(True).alias("rare")))
        tree = rest.join(rare, [*keys, "part"], "left").withColumn("template", F.when(F.col("rare"), _with("template", k, F.lit(VARIABLE)))
                                                                  .otherwise(F.col("template"))).select(*own, "template")
        k += 1


def _with(branch: str, at: int | Column, segment: Column) -> Column:
    """A template with its segment ``at`` (from 0) replaced."""
    at = F.lit(at) if isinstance(at, int) else at
    return F.concat(F.slice(branch, F.lit(1), at), F.array(segment), F.slice(branch, at + 2, F.size(branch)))


def sibling_places(branches: DataFrame, below: int | None) -> int | None:
    """The last place (before ``below``) at which two branches of a host are siblings, or none."""
    place = branches.select("host", "branch", F.posexplode("branch").alias("i", "segment")).where(F.col("segment") != VARIABLE)
    if below is not None:
        place = place.where(F.col("i") < below)
    return (place.groupBy("host", "i", F.xxhash64(_with("branch", F.col("i"), F.lit("//"))).alias("rest")).agg(F.count("*").alias("c"))
            .where("c > 1").agg(F.max("i").alias("i")).first()["i"])


def merge_siblings(branches: DataFrame, at: int, z: float) -> DataFrame:
    """``(host, branch, merged)`` of branches that are alike but for their segment ``at``; a group has at least two."""
    rest = _with("branch", at, F.lit("//"))
    rows = branches.where(F.size("branch") > at).withColumn("segment", F.element_at("branch", at + 1)) \
        .where(F.col("segment") != VARIABLE).withColumn("rest", rest)
    pool = rows.groupBy("host", "rest").agg(F.sum("m").alias("pm"), F.sum("b").alias("pb"), F.count("*").alias("kinds")).where("kinds > 1")
    rows = rows.join(pool, ["host", "rest"])
    others = F.col("pm") - F.col("m")
    gap = F.col("b") / F.col("m") - (F.col("pb") - F.col("b")) / others
    share = F.col("pb") / F.col("pm")
    error = share * (1 - share) * (1 / F.col("m") + 1 / others)
    rows = rows.where(gap * gap <= z * z * error)
    lead = rows.groupBy("host", "rest").agg(F.min(F.ltrim("segment", F.lit(MERGED))).alias("lead"), F.count("*").alias("c")).where("c > 1")
    return rows.join(lead, ["host", "rest"]).select("host", "branch", _with("branch", at, F.concat(F.lit(MERGED), "lead")).alias("merged"))


def judge_templates(tree: DataFrame, z: float, purity: float, weight: float) -> DataFrame:
    """``(host, template, purity, rejected)`` for every template with labelled pages (``m``, of them ``b`` blocked)."""
    one, _ = written(tree.groupBy("host", "template").agg(F.sum("m").alias("m"), F.sum("b").alias("b")).where("m > 0")
                     .withColumn("branch", F.col("template")))
    again = True
    while again:
        again, at = False, None
        while True:
            branches = one.groupBy("host", "branch").agg(F.sum("m").alias("m"), F.sum("b").alias("b"))
            at = sibling_places(branches, at)
            if at is None:
                break
            moves, n = written(merge_siblings(branches, at, z))
            if n:
                again = True
                one, _ = written(one.join(moves, ["host", "branch"], "left").withColumn("branch", F.coalesce("merged", "branch")).drop("merged"))
    total = one.agg(F.sum("m").alias("m"), F.sum("b").alias("b")).first()  # two numbers
    base = (total["b"] or 0) / (total["m"] or 1)
    branch = (one.groupBy("host", "branch").agg(F.sum("m").alias("bm"), F.sum("b").alias("bb"))
              .withColumn("purity", (F.col("bb") + weight * F.lit(base)) / (F.col("bm") + weight))
              .withColumn("rejected", (F.col("purity") >= purity) & (F.col("bb") / F.col("bm") >= purity)))
    return one.join(branch, ["host", "branch"]).select("host", "template", "branch", "purity", "rejected")


def shown(template: Column) -> Column:
    """A template as text."""
    return F.concat_ws("", F.transform(template, lambda s: F.concat(F.lit("/"), F.when(s == VARIABLE, F.lit("*")).when(
        s.startswith(MERGED), F.concat(F.lit("{"), F.ltrim(s, F.lit(MERGED)), F.lit("}"))).otherwise(s))))


def judge(pages: DataFrame, rules: list[tuple[str, str]] | None = None, url_col: str = "url", id_col: str = "page_id",
          fanout: int = 50, z: float = 2.0, purity: float = 0.5, weight: float = 2.0) -> DataFrame:
    """``id, host, path, rule, verdict, template, purity`` for every page (purity null without labelled pages).

    The tree is built on distinct (host, shape) rows with counts, so a host
    with very many pages is one row for each of its shapes before any join.
    """
    rules = RULES if rules is None else rules
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("found", best_rule(F.col("host"), F.col("path"), rules)).withColumn("shape", shaped(F.col("path")))
    label = lambda *verdicts: F.sum(F.when(F.col("found.verdict").isin(*verdicts), 1).otherwise(0))
    shapes = rows.groupBy("host", "shape").agg(F.count("*").alias("n"), label("allow", "block").alias("m"), label("block").alias("b"))
    tree, _ = written(template_tree(shapes, fanout))
    verdicts = tree.select("host", "shape", "template").join(judge_templates(tree, z, purity, weight), ["host", "template"], "left")
    return rows.join(verdicts, ["host", "shape"], "left").select(
        F.col(id_col), "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        shown(F.coalesce("branch", "template")).alias("template"), "purity")
