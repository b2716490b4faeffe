"""URL filters: rules by host and path, and a path-template tree per host for all other pages.

What the rules decided labels a page. The tree of a host has a level per path segment. A segment
stays a literal where its pages can be told from the rest of their node: by a fair share of them,
or by a share of blocked ones that differs from the rest's, as far as statistics can tell. All
others, such as ids, become one wildcard. Branches that differ in one literal and are equally pure
are merged, and a template is rejected by the smoothed share of blocked pages. Under a wildcard,
where different segments stand together, pages without a label speak against rejection.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tieout.llm.common import stored

#: Levels of a tree; what lies deeper is one last wildcard.
MAX_DEPTH = 8
#: A literal has at least this many pages, and either this share of its node's, or a share of
#: blocked ones that a two-sided test at five per cent tells from the rest of the node.
MIN_PAGES = 10
LITERAL_SHARE = 1 / 16
#: Branches are merged only if each has this many labelled pages and the test does not tell them
#: apart.
MIN_LABELLED = 10
SIGNIFICANT = 1.96
#: Pseudo-counts of blocked and of allowed pages, and the smoothed share that rejects.
SMOOTHING = 1.0
REJECT_FROM = 0.9

Rule = tuple[str, str]


def parsed(url: Column) -> dict[str, Column]:
    """Host and path; both empty for a null url and for one without `://`."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return {
        "host": F.translate(host, string.ascii_uppercase, string.ascii_lowercase),
        "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
    }


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest (pattern, verdict) that fits: its host or a subdomain, and its path's start."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for pattern, verdict in sorted(rules, key=lambda r: len(r[0])):
        name, slash, below = pattern.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(
            path, F.lit(slash + below)
        )
        here = F.struct(F.lit(pattern).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, here).otherwise(found)
    return found


def differs(n: Column, b: Column, n0: Column, b0: Column) -> Column:
    """Whether b of n and b0 of n0 are different shares, by the test; false if either is empty."""
    both = F.try_divide(b + b0, n + n0)
    error = F.sqrt(both * (1 - both) * (F.try_divide(F.lit(1), n) + F.try_divide(F.lit(1), n0)))
    gap = F.abs(F.try_divide(b, n) - F.try_divide(b0, n0))
    return F.coalesce(gap > SIGNIFICANT * error, F.lit(False))


def templates(paths: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """`paths` (host, path, pages, blocked, …) with `template`, level by level from the hosts down.

    A literal that begins with * or = has a = before it, so that a wildcard is nothing else.
    """
    # Empty segments, as of a last slash, say nothing.
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    rows = paths.withColumn("segments", segments).withColumn("template", F.lit(""))
    deepest = min(max_depth, rows.agg(F.max(F.size("segments"))).first()[0] or 0)
    node = ["host", "template"]
    for depth in range(deepest):
        rows = rows.withColumn("segment", F.get("segments", F.lit(depth)))
        inner = rows.where(F.col("segment").isNotNull())
        sums = [F.sum("pages").alias("n"), F.sum("blocked").alias("b")]
        children = inner.groupBy(*node, "segment").agg(*sums)
        totals = inner.groupBy(*node).agg(*(s.alias(f"all_{c}") for s, c in zip(sums, "nb")))
        n, b, all_n, all_b = (F.col(c) for c in ("n", "b", "all_n", "all_b"))
        told = (n >= all_n * LITERAL_SHARE) | differs(n, b, all_n - n, all_b - b)
        literals = (
            children.where(n >= MIN_PAGES)
            .join(totals, node)
            .where(told)
            .select(*node, "segment", F.lit(True).alias("literal"))
        )
        name = F.regexp_replace("segment", r"^([*=])", "=$1")
        step = F.when(F.col("segment").isNull(), F.lit("")).otherwise(
            F.concat(F.lit("/"), F.when(F.col("literal"), name).otherwise("*"))
        )
        met = rows.join(literals, [*node, "segment"], "left")
        met = met.withColumn("template", F.concat("template", step))
        rows = stored(met.drop("segment", "literal"), f"templates-{depth}")
    deeper = F.size("segments") > max_depth
    return rows.withColumn(
        "template", F.when(deeper, F.concat("template", F.lit("/**"))).otherwise(F.col("template"))
    ).drop("segments")


def merged(branches: DataFrame) -> DataFrame:
    """`branches` (host, template, labelled, blocked) with these two summed over what is merged.

    Branches of a shape, which differ in their last literal, are taken by purity; neighbours that
    the test cannot tell apart join.
    """
    parts = F.split("template", "/")
    last = F.array_max(
        F.transform(parts, lambda s, i: F.when((s != "") & ~s.startswith("*"), i).otherwise(-1))
    )
    shape = F.array_join(
        F.transform(parts, lambda s, i: F.when(i == last, F.lit("?")).otherwise(s)), "/"
    )
    # Branches with too few labels stand alone, after those that can merge.
    known = F.col("labelled") >= MIN_LABELLED
    share = F.try_divide(F.col("blocked"), F.col("labelled"))
    rows = branches.withColumns({"shape": shape, "known": known, "share": share})
    place = ["host", "shape", "known"]
    order = Window.partitionBy(*place).orderBy("share", "template")
    n, b = F.col("labelled"), F.col("blocked")
    n0, b0 = F.lag("labelled").over(order), F.lag("blocked").over(order)
    opens = F.when(F.col("known") & n0.isNotNull() & ~differs(n, b, n0, b0), 0).otherwise(1)
    rows = rows.withColumn("opens", opens)
    group = Window.partitionBy(*place, "group")
    return (
        rows.withColumn("group", F.sum("opens").over(order))
        .select(
            "host", "template", F.sum("labelled").over(group).alias("labelled"),
            F.sum("blocked").over(group).alias("blocked"),
        )
    )


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    id_column: str = "page_id",
    url_column: str = "url",
    max_depth: int = MAX_DEPTH,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, template) of every row.

    A page that a rule fits gets the rule's verdict. Any other is blocked if its template is
    rejected and allowed otherwise; a template without labelled pages is allowed. Of equally long
    rules the last in `rules` wins. Null urls have host and path empty, and a null page_id is kept;
    repeated rows count and are answered as often as they occur. Other columns are not read, and
    an empty table gives an empty table. The tree is built from the different paths and how many
    pages each has, so copies of a page cost nothing there.
    """
    rows = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"))
    rows = rows.withColumns(parsed(F.col("url"))).drop("url")
    paths = rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("pages"))
    paths = paths.withColumn("r", rule_of(F.col("host"), F.col("path"), rules)).select(
        "host", "path", "pages", "r.rule", F.col("r.verdict").alias("ruled")
    )
    counted_for = F.when(F.col("ruled") == "block", F.col("pages")).otherwise(F.lit(0).cast("bigint"))
    placed = templates(stored(paths.withColumn("blocked", counted_for), "paths"), max_depth)
    # Under a wildcard every page counts, elsewhere those with a label.
    counts = F.col("ruled").isNotNull() | F.contains("template", F.lit("/*"))
    branches = placed.groupBy("host", "template").agg(
        F.coalesce(F.sum(F.when(counts, F.col("pages"))), F.lit(0).cast("bigint")).alias("labelled"),
        F.sum("blocked").alias("blocked"),
    )
    share = (F.col("blocked") + SMOOTHING) / (F.col("labelled") + 2 * SMOOTHING)
    rejected = (
        merged(branches).where(share >= REJECT_FROM).select("host", "template")
        .withColumn("rejected", F.lit(True))
    )
    judged = placed.join(rejected, ["host", "template"], "left")
    verdict = F.coalesce(
        "ruled", F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow"))
    )
    answers = judged.select("host", "path", "rule", verdict.alias("verdict"), "template")
    return rows.join(answers, ["host", "path"]).select(
        "page_id", "host", "path", "rule", "verdict", "template"
    )


def judge_sql(rules: Sequence[Rule], max_depth: int = MAX_DEPTH) -> str:
    """DuckDB SQL for (page_id, host, path, rule, verdict) of table `pages`."""
    fits = [
        f"SELECT '{pattern}' AS pattern, '{verdict}' AS ruling, {len(pattern)} AS size, {i} AS nth, "
        f"'{pattern.partition('/')[0]}' AS name, '/{pattern.partition('/')[2]}' AS below"
        for i, (pattern, verdict) in enumerate(rules)
    ]
    apart = (
        "coalesce(abs({b} / {n} - {b0} / {n0}) > {z} * sqrt((({b} + {b0}) / ({n} + {n0})) * "
        "(1 - ({b} + {b0}) / ({n} + {n0})) * (1 / {n} + 1 / {n0})), false)"
    )
    from_rest = apart.format(b="b", n="n", b0="(all_b - b)", n0="nullif(all_n - n, 0)", z=SIGNIFICANT)
    levels = []
    for depth in range(1, max_depth + 1):
        levels.append(f"""c{depth} AS MATERIALIZED (
  SELECT *, segments[{depth}] AS segment,
    count(*) OVER (PARTITION BY host, template, segments[{depth}])::DOUBLE AS n,
    count(*) FILTER (ruling = 'block') OVER (PARTITION BY host, template, segments[{depth}])::DOUBLE AS b,
    count(segments[{depth}]) OVER (PARTITION BY host, template)::DOUBLE AS all_n,
    count(*) FILTER (ruling = 'block' AND segments[{depth}] IS NOT NULL)
      OVER (PARTITION BY host, template)::DOUBLE AS all_b
  FROM l{depth - 1}),
l{depth} AS MATERIALIZED (
  SELECT page_id, host, path, rule, ruling, segments, template || CASE WHEN segment IS NULL THEN ''
    WHEN n >= {MIN_PAGES} AND (n >= all_n / {1 / LITERAL_SHARE} OR {from_rest})
    THEN '/' || regexp_replace(segment, '^([*=])', '=\\1') ELSE '/*' END AS template
  FROM c{depth})""")
    join_before = apart.format(b="blocked", n="labelled", b0="b0", n0="n0", z=SIGNIFICANT)
    return (
        f"""WITH rules AS ({" UNION ALL ".join(fits)}),
u AS (
  SELECT row_number() OVER () AS row, page_id, CASE WHEN instr(url, '://') > 0
         THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM (SELECT page_id, coalesce(url, '') AS url FROM pages)),
h AS (
  SELECT row, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
best AS (
  SELECT row, arg_max({{'rule': pattern, 'ruling': ruling}}, size * 1000 + nth) AS r
  FROM h JOIN rules ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, below)
  GROUP BY row),
l0 AS (
  SELECT page_id, host, path, r.rule, r.ruling, '' AS template,
         list_filter(string_split(path, '/'), lambda x: x <> '') AS segments
  FROM h LEFT JOIN best USING (row)),
"""
        + ",\n".join(levels)
        + f""",
t AS MATERIALIZED (
  SELECT * EXCLUDE (template),
         template || CASE WHEN len(segments) > {max_depth} THEN '/**' ELSE '' END AS template
  FROM l{max_depth}),
branches AS (
  SELECT host, template, count(*) FILTER (ruling IS NOT NULL OR contains(template, '/*'))::DOUBLE
         AS labelled, count(*) FILTER (ruling = 'block')::DOUBLE AS blocked
  FROM t GROUP BY ALL),
parts AS (
  SELECT *, string_split(template, '/') AS p, labelled >= {MIN_LABELLED} AS known,
         blocked / nullif(labelled, 0) AS share FROM branches),
last AS (
  SELECT *, coalesce(list_max(list_filter(range(1, len(p) + 1),
              lambda i: p[i] <> '' AND NOT starts_with(p[i], '*'))), 0) AS last FROM parts),
shaped AS (
  SELECT *, array_to_string(list_transform(range(1, len(p) + 1),
              lambda i: CASE WHEN i = last THEN '?' ELSE p[i] END), '/') AS shape FROM last),
lagged AS (
  SELECT *, lag(labelled) OVER w AS n0, lag(blocked) OVER w AS b0 FROM shaped
  WINDOW w AS (PARTITION BY host, shape, known ORDER BY share NULLS FIRST, template)),
opened AS (
  SELECT *, CASE WHEN known AND n0 IS NOT NULL AND NOT {join_before} THEN 0 ELSE 1 END AS opens
  FROM lagged),
numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY host, shape, known ORDER BY share NULLS FIRST, template) AS grp
  FROM opened),
rejected AS (
  SELECT host, template, (sum(blocked) OVER g + {SMOOTHING})
         / (sum(labelled) OVER g + 2 * {SMOOTHING}) >= {REJECT_FROM}::DOUBLE AS rejected
  FROM numbered WINDOW g AS (PARTITION BY host, shape, known, grp))
SELECT page_id, host, path, rule,
       coalesce(ruling, CASE WHEN rejected THEN 'block' ELSE 'allow' END) AS verdict
FROM t JOIN rejected USING (host, template)
"""
    )
