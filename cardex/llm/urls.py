"""Operator 2: pages judged by host and path rules and a tree of path templates.

Rules decide what they cover; the pages that they decide are also the labels.  Per host
the paths form a tree of templates: segments are first generalised by their characters,
and where a node still has many rare children, these by a wildcard, level by level to
the last segment.  From the leaves up, the children of a node are merged into one pool
unless their labels differ by a test of two shares, and a child without evidence of its
own takes its parent's pool.  A template is rejected if the share of blocked pages in
its pool, smoothed towards the share of its template on all hosts, is high enough and
rests on labelled pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardex.llm.common import ascii_lower, let, prefix_sums, raw, store

# Fixed values of the contract: verdict, host, path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

# A node's rare children become a wildcard if there are more than this many; rare is a
# child that holds no more than the given share of the node's pages.
MANY_CHILDREN = 20
RARE_SHARE = 0.1
# A branch whose share differs from its siblings' by no more standard errors is merged.
SIMILAR_Z = 1.96
# Labelled pages that a prior is worth.
PRIOR_PAGES = 4.0
REJECTED_SHARE = 0.8
# Labelled pages of the branch, or of its template, below which nothing is rejected.
LEAST_LABELLED = 5


def _after_scheme(url: str) -> str:
    return f"substr({url}, instr({url}, '://') + 3)"


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host in lower case and path; both '' for NULL and for what has no ``://``."""
    found = f"{url} is not null and instr({url}, '://') > 0"
    host = f"regexp_extract({_after_scheme(url)}, {raw('^[^/?#]*')}, 0)"
    path = f"regexp_extract({_after_scheme(url)}, {raw('^[^/?#]*([^?#]*)')}, 1)"
    lowered = let("h", host, ascii_lower("h"))
    return F.expr(f"if({found}, {lowered}, '')"), F.expr(f"if({found}, {path}, '')")


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """STRUCT<rule, verdict> of the longest rule that fits, or NULL."""
    found = None
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        value = F.struct(F.lit(f"{rule_host}{rule_path}").alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    if found is None:
        return F.lit(None).cast("struct<rule: string, verdict: string>")
    return found


def _shape(segment: str) -> str:
    """SQL: a segment with what usually varies replaced by a sign for its kind.

    Digits become {n}, long hexadecimal strings and strings of digits and letters {x}.
    """
    plain = f"regexp_replace({segment}, '[0-9]+', '{{n}}')"
    mixed = raw("^(?=.*[0-9])[0-9a-fA-F-]{8,}$|^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9_-]{16,}$")
    return f"if({segment} rlike {mixed}, '{{x}}', {plain})"


def templates(pages: DataFrame) -> DataFrame:
    """``pages(_host, _path, ...)`` with ``_template``: its leaf in the host's tree.

    Level by level, a node's children are counted (partially before the shuffle, so a
    host with a third of all pages is a few rows per task).  Where many are rare, these
    are replaced by a wildcard; a child that is not rare stays beside it.  No wildcard
    can arise below a node of few different paths, so these leave the rounds with what
    is left of them, and a round is done for a level only while a node has many.
    """
    spark = pages.sparkSession
    shapes = f"transform(filter(split(_path, '/'), s -> s <> ''), s -> {_shape('s')})"
    shaped = pages.withColumn("_shape", F.expr(shapes))
    counts = store(
        spark, shaped.groupBy("_host", "_shape").agg(F.count(F.lit(1)).alias("_pages")), "shapes"
    )
    node = ["_host", "_template"]
    active = counts.withColumn("_template", F.expr("cast(array() as array<string>)"))
    found, level = None, 0
    while True:
        wide = (
            active.groupBy(*node)
            .agg(F.count(F.lit(1)).alias("_paths"), F.max(F.size("_shape")).alias("_deepest"))
            .where((F.col("_paths") > MANY_CHILDREN) & (F.col("_deepest") > level))
            .select(*node, F.lit(True).alias("_wide"))
        )
        active = store(spark, active.join(wide, node, "left"), "nodes")
        left = F.concat("_template", F.expr(f"slice(_shape, {level + 1}, size(_shape))"))
        done = active.where(F.col("_wide").isNull()).select("_host", "_shape", left.alias("_template"))
        found = done if found is None else found.unionByName(done)
        active = active.where("_wide").drop("_wide")
        if active.isEmpty():
            break
        child = F.get("_shape", F.lit(level))
        children = store(
            spark,
            active.where(child.isNotNull()).groupBy(*node, child.alias("_child")).agg(F.sum("_pages").alias("_pages")),
            "children",
        )
        many = (
            children.groupBy(*node)
            .agg(F.count(F.lit(1)).alias("_children"), F.sum("_pages").alias("_all"))
            .where(F.col("_children") > MANY_CHILDREN)
        )
        large = F.col("_pages") > RARE_SHARE * F.col("_all")
        # fewer than 1 / RARE_SHARE children of a node are large
        wild = (
            children.join(many, node)
            .groupBy(*node)
            .agg(F.count_if(~large).alias("_rare"), F.collect_list(F.when(large, F.col("_child"))).alias("_large"))
            .where(F.col("_rare") > MANY_CHILDREN)
            .select(*node, "_large")
        )
        step = F.when(child.isNull(), F.array().cast("array<string>")).when(
            F.col("_large").isNotNull() & ~F.array_contains("_large", child), F.array(F.lit("*"))
        ).otherwise(F.array(child))
        active = active.join(wild, node, "left").select(
            "_host", "_shape", "_pages", F.concat("_template", step).alias("_template")
        )
        level += 1
    found = found.select(
        F.col("_host").alias("_h"), F.col("_shape").alias("_s"), F.concat(F.lit("/"), F.array_join("_template", "/")).alias("_template")
    )
    met = (F.col("_host") == F.col("_h")) & (F.col("_shape") == F.col("_s"))
    return shaped.join(found, met).drop("_h", "_s", "_shape")


def _smoothed(blocked: Column, labelled: Column, prior: Column) -> Column:
    return (blocked + PRIOR_PAGES * prior) / (labelled + PRIOR_PAGES)


def _node_ids() -> str:
    """SQL ARRAY<STRING>: ids of a template's nodes from the root to itself.

    An id is made of sums over the segments and their places, so that all ids of a long
    path take little more than one pass over it.
    """

    def sums(seed: int) -> str:
        hashes = f"transform(segments, (s, i) -> pmod(xxhash64({seed}, i, s), {1 << 42}L))"
        return prefix_sums(f"concat({hashes}, array(0L))", "0L")

    ids = f"zip_with({sums(1)}, {sums(2)}, (x, y) -> concat(hex(x), ':', hex(y)))"
    return let("segments", "filter(split(_template, '/'), s -> s <> '')", ids)


def _tree(branches: DataFrame) -> DataFrame:
    """Branches with ``_nodes``: the nodes from the root to them where paths part.

    The last one is the branch itself; a node that only one path passes is left out.
    """
    spark = branches.sparkSession
    whole = branches.withColumn("_nodes", F.expr(let("ids", _node_ids(), "concat(ids, array(concat(ids[size(ids) - 1], '$')))")))
    steps = whole.select(
        "_host",
        "_template",
        F.expr("inline(transform(slice(_nodes, 1, size(_nodes) - 1), (x, i) -> struct(i AS _depth, x AS _node, _nodes[i + 1] AS _child)))"),
    )
    parting = steps.groupBy("_host", "_node").agg(F.min("_child").alias("_one"), F.max("_child").alias("_other"))
    kept = (
        steps.join(parting.where("_one <> _other"), ["_host", "_node"], "left_semi")
        .groupBy("_host", "_template")
        .agg(F.expr("transform(array_sort(collect_list(struct(_depth, _node))), x -> x._node)").alias("_parting"))
    )
    own = F.slice("_nodes", -1, 1)
    nodes = F.when(F.col("_parting").isNull(), own).otherwise(F.concat("_parting", own))
    return store(
        spark, whole.join(kept, ["_host", "_template"], "left").withColumn("_nodes", nodes).drop("_parting"), "tree"
    )


def _merged(tree: DataFrame) -> DataFrame:
    """``_host, _node, _joined, _n, _b`` of every node: whether it joined its parent's
    pool, and the labels of its own pool, from the deepest level up."""
    spark = tree.sparkSession
    depth = tree.agg(F.max(F.size("_nodes"))).first()[0] or 0
    siblings = Window.partitionBy("_host", "_parent")
    found, below = None, None
    for level in range(depth, 0, -1):
        here = tree.where(F.size("_nodes") == level).select("_host", "_nodes", "_n", "_b", "_n_else", "_b_else")
        here = here if below is None else here.unionByName(below)
        here = here.select(
            "*", F.element_at("_nodes", -1).alias("_node"), F.expr(f"get(_nodes, {level - 2})").alias("_parent")
        )
        # what speaks for the node: its own labels, else its template's on other hosts
        n, b = (F.when(F.col("_n") > 0, F.col(x)).otherwise(F.col(f"{x}_else")) for x in ("_n", "_b"))
        rest_n, rest_b = (F.sum(x).over(siblings) - F.col(x) for x in ("_n", "_b"))
        joined = _similar(n, b, rest_n, rest_b) & F.col("_parent").isNotNull()
        here = store(spark, here.withColumn("_joined", joined), "level")
        nodes = here.select("_host", "_node", "_joined", "_n", "_b")
        found = nodes if found is None else found.unionByName(nodes)
        below = (
            here.where(F.col("_parent").isNotNull())
            .groupBy("_host", F.slice("_nodes", 1, level - 1).alias("_nodes"))
            .agg(
                *(F.coalesce(F.sum(F.when(F.col("_joined"), F.col(x))), F.lit(0)).alias(x) for x in ("_n", "_b")),
                *(F.lit(0).cast("bigint").alias(x) for x in ("_n_else", "_b_else")),
            )
        )
    return found


def _similar(n: Column, b: Column, rest_n: Column, rest_b: Column) -> Column:
    """Whether two shares differ by chance; so does a share without pages from any."""
    pooled = F.try_divide(b + rest_b, n + rest_n)
    spread = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), n) + F.try_divide(F.lit(1.0), rest_n)))
    near = F.abs(F.try_divide(b, n) - F.try_divide(rest_b, rest_n)) <= SIMILAR_Z * spread + 1e-9
    return F.coalesce(near, F.lit(True))


def branch_verdicts(pages: DataFrame) -> DataFrame:
    """``_host, _template, share, rejected`` from ``pages(_host, _template, _label)``.

    ``_label`` is 1 for blocked, 0 for allowed and NULL for unlabelled pages.  A branch
    is a template of a host.  It takes the labels of the pool it was merged into: that
    of its farthest ancestor which it reaches through nodes that joined their parents'.
    A node joins unless the share of its pool differs from its siblings' (a branch
    without labels is taken to have those of its template on all hosts).  The prior is
    the share of the template on all hosts, whose prior in turn is the overall share.
    """
    spark = pages.sparkSession
    sums = [F.count("_label").alias("_n"), F.coalesce(F.sum("_label"), F.lit(0)).cast("bigint").alias("_b")]
    branches = store(spark, pages.groupBy("_host", "_template").agg(*sums), "branches")
    everywhere = branches.groupBy("_template").agg(F.sum("_n").alias("_n_else"), F.sum("_b").alias("_b_else"))
    tree = _tree(branches.join(everywhere, "_template"))
    total = branches.agg(F.sum("_n").alias("n"), F.sum("_b").alias("b")).first()
    overall = F.lit((total.b + 1) / (total.n + 2) if total.n else 0.5)
    nodes = _merged(tree)
    if nodes is None:
        return tree.select("_host", "_template", overall.alias("share"), F.lit(False).alias("rejected"))
    steps = tree.select("_host", "_template", "_n_else", "_b_else", F.posexplode("_nodes").alias("_depth", "_node"))
    pools = (
        steps.join(nodes, ["_host", "_node"])
        .where(~F.col("_joined"))
        .groupBy("_host", "_template", "_n_else", "_b_else")
        .agg(F.max_by(F.struct("_n", "_b"), "_depth").alias("_pool"))
    )
    n, b = F.col("_pool._n"), F.col("_pool._b")
    prior = _smoothed(F.col("_b_else"), F.col("_n_else"), overall)
    enough = F.greatest(n, F.col("_n_else")) >= LEAST_LABELLED
    return pools.withColumn("share", _smoothed(b, n, prior)).select(
        "_host", "_template", "share", (enough & (F.col("share") >= REJECTED_SHARE)).alias("rejected")
    )


def url_filter(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """``id_col, host, path, rule, verdict, template, share`` of every page.

    A rule fits its host, all subdomains, and paths that start with its own; the longest
    decides.  Pages without a rule are blocked if their branch of the tree is rejected.
    NULL and unparsable URLs have host '' and path '', and are a branch like any other.
    Repeated rows each get their row, ids may be NULL, other columns are ignored.
    """
    host, path = host_and_path("_url")
    parsed = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url")).select(
        "_id", host.alias("_host"), path.alias("_path")
    )
    ruled = parsed.withColumn("_rule", rule_of(F.col("_host"), F.col("_path"), rules)).withColumn(
        "_label", (F.col("_rule.verdict") == "block").cast("int")
    )
    placed = templates(ruled)
    verdicts = branch_verdicts(placed).select(
        F.col("_host").alias("_h"), F.col("_template").alias("_t"), "share", "rejected"
    )
    judged = F.when(F.col("rejected"), "block").otherwise("allow")
    return placed.join(verdicts, (F.col("_host") == F.col("_h")) & (F.col("_template") == F.col("_t"))).select(
        F.col("_id").alias(id_col),
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", judged).alias("verdict"),
        F.col("_template").alias("template"),
        "share",
    )


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``url_filter`` of ``pages``."""
    return url_filter(spark.read.parquet(f"{sf_dir}/pages.parquet"))
