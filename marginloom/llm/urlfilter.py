"""URL filters: rules for hosts and paths, and a tree of path templates per host (native).

Paths are first reduced by shape (numbers and hexadecimal names become wildcards), which makes the branches of
a host few before anything is joined. From the root down, segments that are rare among many siblings become
wildcards, unless their labels say that they differ from their siblings. From the leaves up, branches whose labels
don't differ by more than chance are merged and share their counts: a branch inside which nothing differs is one
group, whatever its depth. A page is allowed if the share of good labels of its group, smoothed towards its host
and that towards all pages, is high enough. The tree is as deep as its paths; no segment is left out by its position.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginloom.llm.common import ascii_lower, cut

#: A segment is generalised if its parent has so many different segments and it holds so small a share of them.
MANY_SEGMENTS, RARE_SHARE = 20, 0.05
#: Branches whose shares of good labels are closer than so many standard errors are alike, as are those where either side has fewer labels.
STANDARD_ERRORS, MIN_LABELS = 1.96, 5
#: Levels to which the SQL that the query is checked against generalises segments; the operator has no such bound.
SQL_LEVELS = 8
#: Labels that the prior counts as, and the least purity of an allowed template.
PRIOR_LABELS, MIN_PURITY = 10.0, 0.5
NUMBER, HEXADECIMAL, VARIABLE = "{n}", "{h}", "{v}"


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``; written host + path."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased; NULL or no ``://``: empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or NULL; of equally long ones that of the longer host.

    The rules are a list of the caller's, compared row by row without moving pages.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host))):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def shapes(path: Column) -> Column:
    """The segments of a path by shape: numbers and hexadecimal names as wildcards, endings kept."""
    segments = F.split(F.regexp_replace(path, r"^/", ""), "/", -1)
    return F.transform(segments, lambda s: F.when(s.rlike(r"^[0-9]+(\.[A-Za-z0-9]+)?$"), F.regexp_replace(s, r"^[0-9]+", NUMBER))
                       .when(s.rlike(r"^[0-9a-f-]*[0-9][0-9a-f-]*(\.[A-Za-z0-9]+)?$") & s.rlike(r"^[0-9a-f-]{8}"),
                             F.regexp_replace(s, r"^[0-9a-f-]+", HEXADECIMAL)).otherwise(s))


def _apart(known: Column, good: Column, all_known: Column, all_good: Column) -> Column:
    """Whether a branch's share of good labels differs from that of the rest of its siblings by more than chance."""
    rest, rest_good = all_known - known, all_good - good
    pooled = all_good / all_known
    differs = F.abs(good / known - rest_good / rest) > STANDARD_ERRORS * F.sqrt(pooled * (1 - pooled) * (1 / known + 1 / rest))
    return F.when((known >= MIN_LABELS) & (rest >= MIN_LABELS), differs).otherwise(False)


def _common(a: Column, b: Column) -> Column:
    """How many first elements two arrays share."""
    same = F.zip_with(F.slice(a, 1, F.least(F.size(a), F.size(b))), F.slice(b, 1, F.least(F.size(a), F.size(b))), lambda x, y: x == y)
    return F.when(F.array_position(same, False) > 0, (F.array_position(same, False) - 1).cast("int")).otherwise(F.size(same))


def templates(branches: DataFrame) -> DataFrame:
    """Adds ``template`` to (host, shape, n, known, good): rare segments among many siblings are generalised, from the root down.

    Each turn looks at the next level where the paths below a node part, so a long way without a fork is one turn, and a
    branch is done as soon as fewer paths than MANY_SEGMENTS are left in it. A turn is one join by node.
    """
    own = ["host", "shape", "n", "known", "good", "template"]
    out = branches.withColumn("template", F.col("shape")).withColumn("level", F.lit(0))
    done = []
    while True:
        node = ["host", "level", "above"]
        step = out.withColumn("above", F.array_join(F.slice("template", F.lit(1), F.col("level")), "/")).withColumn("own", F.get("template", F.col("level")))
        children = step.where(F.col("own").isNotNull()).groupBy(*node, "own").agg(
            F.sum("n").alias("c_n"), F.sum("known").alias("c_known"), F.sum("good").alias("c_good"), F.count("*").alias("paths"),
            F.min("template").alias("low"), F.max("template").alias("high"))
        parents = children.groupBy(*node).agg(F.count("*").alias("kinds"), F.sum("c_n").alias("total"), F.sum("c_known").alias("p_known"), F.sum("c_good").alias("p_good"))
        rare = ((F.col("kinds") >= MANY_SEGMENTS) & (F.col("c_n") <= RARE_SHARE * F.col("total")) & ~F.col("own").startswith("{")
                & ~_apart(F.col("c_known"), F.col("c_good"), F.col("p_known"), F.col("p_good")))
        # where a branch parts next; one that is generalised meets others, so its next level is looked at
        after = F.when(rare, F.col("level") + 1).when(F.col("paths") >= MANY_SEGMENTS, F.greatest(F.col("level") + 1, _common(F.col("low"), F.col("high"))))
        judged = children.join(parents, node).select(*node, "own", rare.alias("rare"), after.alias("after"))
        general = F.concat(F.slice("template", F.lit(1), F.col("level")), F.array(F.lit(VARIABLE)), F.slice("template", F.col("level") + 2, F.size("template")))
        turned = cut(step.join(judged, [*node, "own"], "left").select(
            *own[:-1], F.when(F.col("rare"), general).otherwise(F.col("template")).alias("template"), F.col("after").alias("level")))
        done.append(turned.where(F.col("level").isNull()).select(own))
        out = turned.where(F.col("level").isNotNull())
        if out.isEmpty():
            break
    for more in done[1:]:
        done[0] = done[0].unionByName(more)
    return done[0]


def _nodes(rows: DataFrame) -> DataFrame:
    """(host, tid, known, good, depth, a, b, up_a, up_b): every template with every node on its way, its end as the last.

    A node is named by its depth and two sums of 40-bit hashes of the segments down to it; without a segment's own
    hashes they name the node above, the root being zero.
    """
    whole = rows.groupBy("host", "template").agg(F.sum("known").alias("known"), F.sum("good").alias("good"))
    steps = whole.select("host", F.struct(F.xxhash64("host", "template").alias("x"), F.xxhash64(F.lit(1), "host", "template").alias("y")).alias("tid"),
                         "known", "good", F.posexplode(F.concat("template", F.array(F.lit(None).cast("string")))).alias("pos", "seg"))
    bits = F.lit((1 << 40) - 1)
    way = Window.partitionBy("tid").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    hashed = steps.withColumn("ha", F.xxhash64("pos", F.col("seg").isNull(), "seg").bitwiseAND(bits)).withColumn(
        "hb", F.xxhash64(F.col("seg").isNull(), "seg", "pos").bitwiseAND(bits))
    return (hashed.withColumn("a", F.sum("ha").over(way)).withColumn("b", F.sum("hb").over(way))
            .select("host", "tid", "known", "good", (F.col("pos") + 1).alias("depth"), "a", "b", (F.col("a") - F.col("ha")).alias("up_a"), (F.col("b") - F.col("hb")).alias("up_b")))


def groups(rows: DataFrame) -> DataFrame:
    """(tid, host, known, good, group): the group of alike branches that each template of (host, template, known, good) is in.

    A node is mixed if a node below it is apart from its siblings. A template belongs to the uppermost node on its way
    that isn't mixed: alone if that node is apart, else together with the alike nodes under the same parent; where nothing
    in a host is apart, the host is one group.
    """
    ways = cut(_nodes(rows))
    node, above = ["host", "depth", "a", "b"], ["host", "depth", "up_a", "up_b"]
    counted = ways.groupBy(*node, "up_a", "up_b").agg(F.sum("known").alias("known"), F.sum("good").alias("good"))
    family = counted.groupBy(*above).agg(F.sum("known").alias("p_known"), F.sum("good").alias("p_good"))
    apart = cut(counted.join(family, above).where(_apart(F.col("known"), F.col("good"), F.col("p_known"), F.col("p_good"))).select(*node, F.lit(True).alias("apart")))
    deepest = ways.join(apart, node).groupBy("tid").agg(F.max("depth").alias("deepest"))
    mixed = ways.join(deepest, "tid").where(F.col("depth") < F.col("deepest")).select(*node).distinct().withColumn("mixed", F.lit(True))
    hosts = apart.select("host").distinct().withColumn("parted", F.lit(True))
    top = ways.join(mixed, node).groupBy("tid").agg((F.max("depth") + 1).alias("mixed_to"))
    chosen = (ways.join(top, "tid", "left").join(hosts, "host", "left")
              .where(F.col("depth") == F.coalesce("mixed_to", F.lit(1))).join(apart, node, "left"))
    alone = F.struct(F.col("depth").alias("d"), F.col("a").alias("a"), F.col("b").alias("b"), F.lit(True).alias("alone"))
    alike = F.struct(F.col("depth").alias("d"), F.col("up_a").alias("a"), F.col("up_b").alias("b"), F.lit(False).alias("alone"))
    return chosen.select("tid", "host", "known", "good", F.when(F.col("apart"), alone).when(F.col("parted"), alike).alias("group"))


def judged_templates(branches: DataFrame) -> DataFrame:
    """(host, shape, template, purity) from (host, shape, n, known, good)."""
    rows = templates(branches)
    placed = cut(groups(rows))
    counts = [F.sum("known").alias("known"), F.sum("good").alias("good")]
    hosts = placed.groupBy("host").agg(F.sum("known").alias("h_known"), F.sum("good").alias("h_good"))
    total = placed.agg(*counts).first()
    everywhere = total["good"] / total["known"] if total["known"] else 1.0
    prior = (F.col("h_good") + PRIOR_LABELS * F.lit(float(everywhere))) / (F.col("h_known") + PRIOR_LABELS)
    purity = (F.col("good") + PRIOR_LABELS * prior) / (F.col("known") + PRIOR_LABELS)
    # the group of a whole host has no name of its own
    named = placed.withColumn("group", F.coalesce("group", F.struct(*[F.lit(v).alias(n) for n, v in (("d", 0), ("a", 0), ("b", 0), ("alone", False))])))
    pure = named.groupBy("host", "group").agg(*counts).join(hosts, "host").select("host", "group", purity.alias("purity"))
    of = named.select("host", "tid", "group").join(pure, ["host", "group"]).select("tid", "purity")
    ids = rows.withColumn("tid", F.struct(F.xxhash64("host", "template").alias("x"), F.xxhash64(F.lit(1), "host", "template").alias("y")))
    return ids.join(of, "tid").select("host", "shape", F.array_join("template", "/").alias("template"), "purity")


def judge_urls(pages: DataFrame, rules: Sequence[Rule], url_col: str = "url", good_col: str | None = None) -> DataFrame:
    """Input rows plus host, path, rule, template, purity and verdict (allow or block).

    The longest rule that fits decides; else the purity of the group that the path's template is in. ``good_col`` holds the labels:
    1 good, 0 bad, NULL unknown; without labels every template is pure. A NULL URL and one without ``://`` have an
    empty host and path, which are judged like any other. Repeated rows are judged and counted one by one;
    an empty table gives no rows. Columns of the six names are replaced.
    """
    good = F.col(good_col).cast("long") if good_col else F.lit(None).cast("long")
    names = ("host", "path", "rule", "template", "purity", "verdict")
    rows = pages.select(F.struct(*[F.col(c) for c in pages.columns if c not in names]).alias("row"), host_of(F.col(url_col)).alias("host"),
                        path_of(F.col(url_col)).alias("path"), good.alias("label"))
    rows = rows.withColumn("shape", shapes(F.col("path")))
    branches = rows.groupBy("host", "shape").agg(F.count("*").alias("n"), F.count("label").alias("known"), F.coalesce(F.sum("label"), F.lit(0)).alias("good"))
    judged = cut(judged_templates(branches))
    rule = matched_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("purity") >= MIN_PURITY, "allow").otherwise("block")
    return rows.join(judged, ["host", "shape"]).select(
        "row.*", "host", "path", rule["rule"].alias("rule"), "template", "purity", F.coalesce(rule["verdict"], method).alias("verdict"))


RULES = (Rule("com", "/", "allow"), Rule("example.com", "/en/", "block"), Rule("www.example.com", "/en/", "allow"),
         Rule("net", "/es/", "block"), Rule("net", "/fr/", "block"))


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Pages with ``good``: the quality label of the document whose number ends the path, where there is one."""
    number = F.regexp_extract(path_of(F.col("url")), r"/([0-9]{1,18})(?:\.[A-Za-z0-9]+)?/?$", 1)
    marks = labels.where(F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").alias("of")).agg(F.max("quality").alias("good"))
    return pages.withColumn("number", number.try_cast("bigint")).join(
        marks, F.col("number") == F.col("of"), "left").drop("number", "of")


def _lower(column: str) -> str:
    return f"translate({column}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def oracle() -> str:
    """DuckDB SQL for the verdicts of ``RULES`` and the templates over ``pages`` and ``labels``, for paths of up to SQL_LEVELS segments."""
    ctes = [rf"""
marks AS (SELECT doc_id, max(quality) AS good FROM labels WHERE quality IN (0, 1) GROUP BY doc_id),
parts AS (
    SELECT page_id, coalesce({_lower("regexp_extract(url, '://([^/?#]*)', 1)")}, '') AS host,
           coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
labelled AS (
    SELECT p.*, m.good FROM parts p LEFT JOIN marks m
    ON m.doc_id = try_cast(nullif(regexp_extract(p.path, '/([0-9]{{1,18}})(?:\.[A-Za-z0-9]+)?/?$', 1), '') AS BIGINT)),
shaped AS (
    SELECT *, list_transform(string_split(regexp_replace(path, '^/', ''), '/'), lambda s: CASE
        WHEN regexp_matches(s, '^[0-9]+(\.[A-Za-z0-9]+)?$') THEN regexp_replace(s, '^[0-9]+', '{{n}}')
        WHEN regexp_matches(s, '^[0-9a-f-]*[0-9][0-9a-f-]*(\.[A-Za-z0-9]+)?$') AND regexp_matches(s, '^[0-9a-f-]{{8}}')
        THEN regexp_replace(s, '^[0-9a-f-]+', '{{h}}') ELSE s END) AS shape FROM labelled),
t0 AS (SELECT host, shape, shape AS template, count(*) AS n, count(good) AS known, coalesce(sum(good), 0) AS good
       FROM shaped GROUP BY host, shape)"""]
    apart = (f"known >= {MIN_LABELS} AND pk - known >= {MIN_LABELS} AND abs(good / known - (pg - good) / (pk - known)) "
             f"> {STANDARD_ERRORS} * sqrt(pg / pk * (1 - pg / pk) * (1 / known + 1 / (pk - known)))")
    for i in range(SQL_LEVELS):
        ctes.append(f"""
s{i} AS (SELECT *, array_to_string(list_slice(template, 1, {i}), '/') AS above, template[{i + 1}] AS own FROM t{i}),
c{i} AS (SELECT host, above, own, sum(n) AS n, sum(known) AS known, sum(good) AS good FROM s{i} WHERE own IS NOT NULL GROUP BY ALL),
r{i} AS (SELECT host, above, own FROM (SELECT *, count(*) OVER w AS kinds, sum(n) OVER w AS total, sum(known) OVER w AS pk, sum(good) OVER w AS pg
                                       FROM c{i} WINDOW w AS (PARTITION BY host, above))
         WHERE kinds >= {MANY_SEGMENTS} AND n <= {RARE_SHARE} * total AND NOT starts_with(own, '{{') AND NOT ({apart})),
t{i + 1} AS (SELECT s.host, s.shape, CASE WHEN r.own IS NULL THEN s.template ELSE
             list_concat(list_slice(template, 1, {i}), ['{{v}}'], list_slice(template, {i + 2}, len(template))) END AS template, n, known, good
             FROM s{i} s LEFT JOIN r{i} r ON s.host = r.host AND s.above = r.above AND s.own = r.own)""")
    ctes.append(f"""
sums AS (SELECT host, template, sum(known) AS known, sum(good) AS good FROM t{SQL_LEVELS} GROUP BY ALL),
ways AS (SELECT *, list_slice(list_append(template, NULL), 1, d) AS node, list_slice(list_append(template, NULL), 1, d - 1) AS up
         FROM (SELECT *, unnest(range(1, len(template) + 2)) AS d FROM sums)),
nodes AS (SELECT host, d, node, up, sum(known) AS known, sum(good) AS good FROM ways GROUP BY ALL),
family AS (SELECT *, sum(known) OVER w AS pk, sum(good) OVER w AS pg FROM nodes WINDOW w AS (PARTITION BY host, up)),
lone AS (SELECT host, d, node FROM family WHERE {apart}),
mixed AS (SELECT DISTINCT host, list_slice(node, 1, k) AS node FROM (SELECT host, node, unnest(range(0, d)) AS k FROM lone)),
chosen AS (SELECT host, template, known, good, min_by(struct_pack(d := d, node := node, up := up), d) AS c
           FROM (SELECT host, template, known, good, 0 AS d, template[:0] AS node, NULL AS up FROM sums
                 UNION ALL SELECT host, template, known, good, d, node, up FROM ways) w
           WHERE NOT EXISTS (SELECT 1 FROM mixed m WHERE m.host = w.host AND m.node IS NOT DISTINCT FROM w.node) GROUP BY ALL),
grouped AS (SELECT c.*, CASE WHEN c.c.d = 0 THEN 'host' WHEN l.host IS NULL THEN 'alike' || CAST(c.c.up AS VARCHAR)
            ELSE 'alone' || CAST(c.c.node AS VARCHAR) END AS grp FROM chosen c LEFT JOIN lone l ON l.host = c.host AND l.node IS NOT DISTINCT FROM c.c.node),
levels AS (SELECT host, sum(known) AS hk, sum(good) AS hg FROM sums GROUP BY host),
overall AS (SELECT CASE WHEN sum(known) > 0 THEN sum(good) / sum(known) ELSE 1 END AS g0 FROM sums),
pure AS (SELECT g.host, grp, (sum(good) + {PRIOR_LABELS} * (any_value(hg) + {PRIOR_LABELS} * any_value(g0)) / (any_value(hk) + {PRIOR_LABELS}))
         / (sum(known) + {PRIOR_LABELS}) AS purity FROM grouped g JOIN levels USING (host), overall GROUP BY ALL),
verdicts AS (SELECT t.host, t.shape, CASE WHEN purity >= {MIN_PURITY} THEN 'allow' ELSE 'block' END AS method
             FROM t{SQL_LEVELS} t JOIN grouped g ON g.host = t.host AND g.template = t.template JOIN pure p ON p.host = g.host AND p.grp = g.grp),
ruled AS (SELECT *, '.' || host AS dotted FROM shaped)""")
    fits = "ends_with(dotted, '.{}') AND starts_with(path, '{}')"
    known = [("www.example.com", "/en/", "allow"), ("example.com", "/en/", "block"), ("net", "/es/", "block"), ("net", "/fr/", "block"), ("com", "/", "allow")]
    rule = " ".join(f"WHEN {fits.format(h, p)} THEN '{h}{p}'" for h, p, _ in known)
    verdict = " ".join(f"WHEN {fits.format(h, p)} THEN '{v}'" for h, p, v in known)
    return (f"WITH {','.join(ctes)}\nSELECT page_id, r.host, path, CASE {rule} END AS rule, CASE {verdict} ELSE method END AS verdict "
            "FROM ruled r JOIN verdicts v ON v.host = r.host AND v.shape = r.shape")
