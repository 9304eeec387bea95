import collections
import math
import random

import plain
import pytest
from cardex.llm import urls as U
from llm_data import odd

URLS = [
    None,
    "",
    "no scheme/com/",
    "http://",
    "://x.com",
    "http://COM/a",
    "https://a.Example.COM/en/1?x#y",
    "http://example.com/en",
    "http://www.example.com/en/7.html",
    "http://x.www.example.com/en/",
    "http://notexample.com/en/1",
    "http://a.net/es/1",
    "http://a.net?/es/",
    "http://a.net#/fr/",
    "http://x.org/http://y.com/",
    "HTTP://É.COM/é/İ",
    "http://a.com:80/b",
    "http://a.net/fr/" + "deep/" * 3000,
]


@pytest.fixture(scope="module")
def pages(spark):
    def make(rows):
        full = [(i, u, "x", "x", "x", "x") for i, u in rows]
        return spark.createDataFrame(
            full, "page_id bigint, url string, html string, _host string, host string, _template string"
        )

    return make


def test_hosts_paths_and_rules(pages):
    rows = [*enumerate(URLS), (None, "http://a.net/es/"), (3, URLS[6]), (3, URLS[6])]
    expected = []
    for i, url in rows:
        host, path = plain.url_parts(url)
        rule = plain.url_rule(host, path, U.RULES)
        expected.append((i, host, path, *(rule or (None, None))))
    found = U.url_filter(pages(rows)).collect()
    ruled = [(r.page_id, r.host, r.path, r.rule, r.verdict if r.rule else None) for r in found]
    assert odd(ruled) == odd(expected)
    assert {r.verdict for r in found} <= {"allow", "block"}


def test_branches(pages):
    rules = [("block", "bad.org", "/spam/"), ("allow", "good.org", "/")]
    rows = [(i, f"http://bad.org/spam/{i}") for i in range(50)]
    rows += [(100 + i, f"http://good.org/news/{i}") for i in range(50)]
    rows += [(200, "http://new.org/spam/7"), (201, "http://new.org/news/7"), (202, "http://new.org/other")]
    found = {r.page_id: r for r in U.url_filter(pages(rows), rules=rules).collect()}
    assert found[200].template == "/spam/{n}"
    assert [found[i].verdict for i in (200, 201, 202)] == ["block", "allow", "allow"]


def test_variable_segments_become_wildcards(pages):
    words = ["".join(chr(97 + (i * k) % 26) for k in (3, 5, 7, 11, 1)) for i in range(60)]
    rows = [(i, f"http://a.org/user/{w}/home") for i, w in enumerate(words)]
    rows += [(100 + i, f"http://b.org/{x}/home") for i, x in enumerate(["one", "two"] * 20)]
    found = {r.page_id: r.template for r in U.url_filter(pages(rows)).collect()}
    assert {found[i] for i in range(60)} == {"/user/*/home"}
    assert {found[i] for i in range(100, 140)} == {"/one/home", "/two/home"}


def test_a_hot_child_stays_beside_the_wildcard(pages):
    words = ["".join(chr(97 + (i * k) % 26) for k in (3, 5, 7, 11, 1)) for i in range(60)]
    rows = [(i, f"http://a.com/en/{w}") for i, w in enumerate(words)]
    rows += [(100 + i, "http://a.com/en/about") for i in range(30)]
    rows += [(200 + i, f"http://b.org/en/{w[::-1]}x") for i, w in enumerate(words)]
    rows += [(300 + i, f"http://c.org/fr/{w}") for i, w in enumerate(words)]
    rules = [("block", "com", "/en/")]
    found = {r.page_id: r for r in U.url_filter(pages(rows), rules=rules).collect()}
    assert {found[i].template for i in [*range(60), *range(200, 260)]} == {"/en/*"}
    assert {found[i].template for i in range(100, 130)} == {"/en/about"}
    assert {found[i].verdict for i in range(200, 260)} == {"block"}
    assert {found[i].verdict for i in range(300, 360)} == {"allow"}


def test_similar_branches_share_their_labels(spark):
    rows = [("h", "/a/{n}", 1)] * 30 + [("h", "/a/{n}.html", 1)] * 2 + [("h", "/a/new", None)]
    rows += [("g", "/b/{n}", 0)] * 30 + [("g", "/c/{n}", 0)] * 10
    # branches that differ stay apart, and one without labels takes the rest's
    rows += [("f", "/a/x", 1)] * 40 + [("f", "/a/y", 1)] * 20 + [("f", "/b/x", 0)] * 50 + [("f", "/a/z", None)]
    pages = spark.createDataFrame(rows, "_host string, _template string, _label int")
    found = {(r._host, r._template): r.rejected for r in U.branch_verdicts(pages).collect()}
    assert found["h", "/a/{n}.html"] and found["h", "/a/{n}"] and found["h", "/a/new"]
    assert not found["g", "/b/{n}"]
    assert [found["f", t] for t in ("/a/x", "/a/y", "/a/z", "/b/x")] == [True, True, True, False]


def test_an_unlabelled_sibling_takes_its_parents_pool(pages):
    rules = [("block", "h.org", "/x/old/")]
    rows = [(i, f"http://h.org/x/old/{i}") for i in range(50)] + [(100 + i, f"http://h.org/x/new/{i}") for i in range(50)]
    found = U.url_filter(pages(rows), rules=rules).collect()
    assert len(found) == 100 and {r.verdict for r in found} == {"block"}


def test_deep_segments_decide(pages):
    rules = [("block", "h.org", "/a/b/c/d/e/spam/"), ("allow", "h.org", "/a/b/c/d/e/news/")]
    rows = [(i, f"http://h.org/a/b/c/d/e/{('spam', 'news')[i % 2]}/{i}") for i in range(100)]
    rows += [(200, "http://new.org/a/b/c/d/e/spam/7"), (201, "http://new.org/a/b/c/d/e/news/7")]
    found = {r.page_id: r for r in U.url_filter(pages(rows), rules=rules).collect()}
    assert found[200].template == "/a/b/c/d/e/spam/{n}"
    assert (found[200].verdict, found[201].verdict) == ("block", "allow")
    words = ["".join(chr(97 + (i * k) % 26) for k in (3, 5, 7, 11, 1)) for i in range(60)]
    rows = [(i, f"http://h.org/1/2/3/4/5/6/7/{w}/end") for i, w in enumerate(words)]
    assert {r.template for r in U.url_filter(pages(rows)).collect()} == {"/{n}" * 7 + "/*/end"}


def plain_templates(shapes):
    """{shape: template} of one host's {shape: pages}."""
    found = {}

    def grow(group, template, level):
        below = {s: n for s, n in group.items() if len(s) > level}
        found.update({s: template for s in group if s not in below})
        children = collections.Counter()
        for s, n in below.items():
            children[s[level]] += n
        rare = {c for c, n in children.items() if n <= U.RARE_SHARE * sum(children.values())}
        if len(rare) <= U.MANY_CHILDREN:
            rare = set()
        parts = collections.defaultdict(dict)
        for s, n in below.items():
            parts["*" if s[level] in rare else s[level]][s] = n
        for name, part in parts.items():
            grow(part, (*template, name), level + 1)

    grow(shapes, (), 0)
    return found


def plain_similar(n, b, rest_n, rest_b):
    if not n or not rest_n:
        return True
    p = (b + rest_b) / (n + rest_n)
    return abs(b / n - rest_b / rest_n) <= U.SIMILAR_Z * math.sqrt(p * (1 - p) * (1 / n + 1 / rest_n)) + 1e-9


def plain_shares(branches):
    """{(host, template): (share, rejected)} of {(host, template): (labelled, blocked)}."""
    everywhere, total = collections.defaultdict(lambda: [0, 0]), [0, 0]
    for (_, t), (n, b) in branches.items():
        everywhere[t][0] += n
        everywhere[t][1] += b
        total = [total[0] + n, total[1] + b]
    overall = (total[1] + 1) / (total[0] + 2) if total[0] else 0.5
    found = {}

    def merge(host, group, level):
        """Pool of a node, and what it holds: (pool, [(leaf, own pool or None), ...])."""
        own = [t for t in group if len(t) == level]
        parts = collections.defaultdict(list)
        for t in group:
            if len(t) > level:
                parts[t[level]].append(t)
        if len(parts) + len(own) == 1 and not own:
            return merge(host, group, level + 1)
        children = [merge(host, part, level + 1) for part in parts.values()]
        children += [(branches[host, t], everywhere[t], [(t, None)]) for t in own]
        if len(children) == 1:
            return children[0]
        n_all, b_all = (sum(c[0][k] for c in children) for k in (0, 1))
        pool, leaves = [0, 0], []
        for (n, b), other, held in children:
            seen = (n, b) if n else other
            joins = plain_similar(*seen, n_all - n, b_all - b)
            pool = [pool[0] + n * joins, pool[1] + b * joins]
            leaves += [(t, own if own or joins else (n, b)) for t, own in held]
        return tuple(pool), (0, 0), leaves

    for host in {h for h, _ in branches}:
        pool, _, leaves = merge(host, [t for h, t in branches if h == host], 0)
        for t, own in leaves:
            n, b = own or pool
            n_else, b_else = everywhere[t]
            prior = (b_else + U.PRIOR_PAGES * overall) / (n_else + U.PRIOR_PAGES)
            share = (b + U.PRIOR_PAGES * prior) / (n + U.PRIOR_PAGES)
            enough = max(n, n_else) >= U.LEAST_LABELLED
            found[host, "/" + "/".join(t)] = (round(share, 9), enough and share >= U.REJECTED_SHARE)
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_plain_tree(spark, seed):
    choice = random.Random(seed)

    def path():
        parts = [choice.choice("abc"), choice.choice(["x", "y", "".join(choice.choices("fghij", k=3))])]
        return parts[: choice.randrange(1, 3)] + ["".join(choice.choices("klm", k=4))] * choice.randrange(2) + ["q"] * choice.randrange(2)

    rows = []
    for i in range(1500):
        host, own = f"h{choice.randrange(4)}", path()
        odds = {"a": 0.95, "b": 0.1, "c": 0.5}[own[0]]
        label = None if host == "h0" or choice.random() < 0.3 else int(choice.random() < odds)
        rows.append((i, host, "/" + "/".join(own) + "/", label))
    pages = spark.createDataFrame(rows, "page_id long, _host string, _path string, _label int")
    placed = U.templates(pages)
    leaves = {r.page_id: r._template for r in placed.collect()}
    branches, expected = collections.defaultdict(lambda: [0, 0]), {}
    for host in {r[1] for r in rows}:
        shapes = collections.Counter(tuple(p.strip("/").split("/")) for _, h, p, _ in rows if h == host)
        templates = plain_templates(shapes)
        for i, h, p, label in rows:
            if h == host:
                template = templates[tuple(p.strip("/").split("/"))]
                expected[i] = "/" + "/".join(template)
                counts = branches[host, template]
                counts[0] += label is not None
                counts[1] += label or 0
    assert leaves == expected and any("*" in t for t in leaves.values())
    verdicts = {(r._host, r._template): (round(r.share, 9), r.rejected) for r in U.branch_verdicts(placed).collect()}
    assert verdicts == plain_shares(branches)
    assert len({v for _, v in verdicts.values()}) == 2


def test_repeated_rows(pages):
    rules = [("block", "h.org", "/x/")]
    rows = [(1, "http://h.org/x/1")] * 9 + [(2, "http://g.org/x/1")] * 3 + [(None, None)] * 2
    found = U.url_filter(pages(rows), rules=rules).collect()
    assert len(found) == 14 and {r.verdict for r in found if r.page_id == 2} == {"block"}


def test_empty_table(pages):
    assert U.url_filter(pages([(1, "x")]).where("false")).collect() == []
