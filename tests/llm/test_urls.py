"""URL rules and path templates."""

import math
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check import compare
from marginloom.llm import urlfilter

SF = "/root/testdata/sf0.001"


def test_query_equals_sql(spark, duck):
    name = "op9_judge_urls"
    status, rows, _, note = compare(spark, duck, name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert status == "ok" and rows, note


@pytest.mark.parametrize("url, host, path, rule, verdict", [
    (None, "", "", None, "allow"), ("no scheme/at all", "", "", None, "allow"), ("", "", "", None, "allow"),
    ("http://A.Example.COM/en/x?q#f", "a.example.com", "/en/x", "example.com/en/", "block"),
    ("http://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("http://x.www.example.com/en/y", "x.www.example.com", "/en/y", "www.example.com/en/", "allow"),
    ("http://example.com", "example.com", "", None, "allow"), ("http://example.com/EN/", "example.com", "/EN/", "com/", "allow"),
    ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"), ("https://a.net/fr/?x", "a.net", "/fr/", "net/fr/", "block"),
    ("x://net/es/://y", "net", "/es/://y", "net/es/", "block"), ("x://?a", "", "", None, "allow"), ("http://É.net/a", "É.net", "/a", None, "allow")])
def test_rules(spark, url, host, path, rule, verdict):
    pages = spark.createDataFrame([(1, url), (1, url)], "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("shape", F.lit(3))
    got = urlfilter.judge_urls(pages, urlfilter.RULES).collect()
    assert len(got) == 2 and {(r.host, r.path, r.rule, r.verdict, r["shape"]) for r in got} == {(host, path, rule, verdict, 3)}


def test_templates_learn_from_labels(spark):
    rows = [(i, f"http://h.org/spam/{i}.html", 0 if i % 5 else None) for i in range(60)]
    rows += [(100 + i, f"http://h.org/news/{i}", 1 if i % 2 else None) for i in range(60)]
    rows += [(200 + i, f"http://h.org/tags/name-{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}/x", 1) for i in range(80)]
    rows += [(300 + i, f"http://new.org/{i}/a/b/c/d/e/f", None) for i in range(5)]
    rows += [(400, "http://h.org/" + "deep/" * 50_000, None)]
    got = urlfilter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, good int"), (), good_col="good").collect()
    by = {r.page_id: r for r in got}
    assert len(by) == len(rows)
    assert {by[i].verdict for i in range(60)} == {"block"} and {by[i].template for i in range(60)} == {"spam/{n}.html"}
    assert {by[100 + i].verdict for i in range(60)} == {"allow"}
    assert {by[200 + i].template for i in range(80)} == {"tags/{v}/x"}
    assert by[300].template == "{n}/a/b/c/d/e/f" and by[300].verdict == "allow" and by[400].verdict in ("allow", "block")
    assert urlfilter.judge_urls(spark.createDataFrame([], "page_id long, url string, good int"), urlfilter.RULES, good_col="good").collect() == []


def brute_verdicts(rows):
    """Verdicts by one dict of counts per node, straight from the definition; segments hold letters only. rows: (path, label)."""
    def apart(known, good, all_known, all_good):
        rest, rest_good = all_known - known, all_good - good
        if known < 5 or rest < 5:
            return False
        share = all_good / all_known
        return abs(good / known - rest_good / rest) > 1.96 * math.sqrt(share * (1 - share) * (1 / known + 1 / rest))

    ways = [tuple(path.split("/")[1:]) for path, _ in rows]
    labels = [label for _, label in rows]
    for level in range(max(map(len, ways))):
        kids = {}
        for way, label in zip(ways, labels):
            if len(way) > level:
                c = kids.setdefault(way[:level], {}).setdefault(way[level], [0, 0, 0])
                c[0] += 1
                c[1] += label is not None
                c[2] += label or 0
        for i, way in enumerate(ways):
            if len(way) > level:
                family = kids[way[:level]]
                n, known, good = family[way[level]]
                total, all_known, all_good = (sum(c[j] for c in family.values()) for j in range(3))
                if len(family) >= 20 and n <= 0.05 * total and not way[level].startswith("{") and not apart(known, good, all_known, all_good):
                    ways[i] = way[:level] + ("{v}",) + way[level + 1:]
    ways = [way + (None,) for way in ways]
    counts = {}
    for way, label in zip(ways, labels):
        for d in range(len(way) + 1):
            c = counts.setdefault(way[:d], [0, 0])
            c[0] += label is not None
            c[1] += label or 0
    below = {}
    for node in counts:
        if node:
            below.setdefault(node[:-1], []).append(node)
    lone = {n for family in below.values() for n in family
            if apart(*counts[n], sum(counts[m][0] for m in family), sum(counts[m][1] for m in family))}
    mixed = {n[:d] for n in lone for d in range(len(n))}
    group = []
    for way in ways:
        node = next(way[:d] for d in range(len(way) + 1) if way[:d] not in mixed)
        group.append(node if node in lone or not node else (node[:-1], "alike"))
    known, good = counts[()]
    overall = good / known if known else 1.0
    prior = (good + 10 * overall) / (known + 10)
    sums = {}
    for g, label in zip(group, labels):
        c = sums.setdefault(g, [0, 0])
        c[0] += label is not None
        c[1] += label or 0
    return ["allow" if (sums[g][1] + 10 * prior) / (sums[g][0] + 10) >= 0.5 else "block" for g in group]


def letters(i):
    return "".join("abcdefghij"[int(c)] for c in str(i))


def judge_paths(spark, rows):
    pages = spark.createDataFrame([(i, f"http://h.org{p}", label) for i, (p, label) in enumerate(rows)], "page_id long, url string, good int")
    return [r.verdict for r in urlfilter.judge_urls(pages, (), good_col="good").orderBy("page_id").collect()]


def test_deep_and_rare_branches(spark):
    """Labels far below the root decide, and a rare section whose labels are all bad isn't pooled with the good ones."""
    deep = [(f"/2024/05/03/{kind}/{i}", int(kind == "news")) for kind in ("spam", "news") for i in range(100)]
    assert judge_paths(spark, deep) == ["block"] * 100 + ["allow"] * 100
    sections = [(f"/s{letters(s)}/{i}", int(s != 7)) for s in range(30) for i in range(100)]
    got = judge_paths(spark, sections)
    assert [v for v, (_, label) in zip(got, sections) if not label] == ["block"] * 100 and got.count("block") == 100
    # a way of 300 segments without a fork, then one that matters
    far = [("/x" * 300 + f"/{kind}/{i}", int(kind == "good")) for kind in ("bad", "good") for i in range(60)]
    assert judge_paths(spark, far) == ["block"] * 60 + ["allow"] * 60


def test_alike_branches_share_counts(spark):
    """Few labels of a branch don't decide alone where its siblings are alike, on inner levels too."""
    rows = [(f"/en/{k}/{i}", 0 if i < 4 else None) for k in ("a", "b", "c") for i in range(6)]
    rows += [(f"/fr/{k}/{i}", 0 if i < 4 else None) for k in ("a", "b", "c") for i in range(6)] + [(f"/ok/{i}", 1) for i in range(80)]
    got = judge_paths(spark, rows)
    assert got[:36] == ["block"] * 36 and got[36:] == ["allow"] * 80


@pytest.mark.parametrize("seed", range(4))
def test_verdicts_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    tilt = {}
    rows = []
    for _ in range(1500):
        way = []
        for level in range(rnd.randint(1, 6)):
            way.append(letters(int(rnd.paretovariate(0.7))) if rnd.random() < (0.5 if level else 0.3) else rnd.choice("xyz"))
        bad = tilt.setdefault(tuple(way[:2]), rnd.choice([0.05, 0.1, 0.9]))
        rows.append(("/" + "/".join(way), None if rnd.random() < 0.3 else int(rnd.random() > bad)))
    got, want = judge_paths(spark, rows), brute_verdicts(rows)
    assert got == want and 0 < want.count("block") < len(want)
