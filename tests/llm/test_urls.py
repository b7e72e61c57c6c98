import pytest

from retentio.llm import urls as U

from . import brute

PAGES = [
    (1, "https://a.example.org/en/1x?q#f", '<a href="https://B.example.com/x">'), (2, "http://example.org/es/", None),
    (3, "http://EXAMPLE.org/es/1?a=/x", "<a HREF='http://bad.net'>"), (4, "https://x.com/fr/", '<a href=http://good.org/>'),
    (5, "https://x.com/de/", '<a href="/local"><a href="https://bad.net/">'), (6, "https://x.com/en/", "x"), (7, None, "x"), (8, "no scheme", None),
    (9, "http://notexample.org/es/", ""), (10, "http://bad.net", '<a href="https://x.com">'), (11, "ftp://", ""), (12, "http://h?x/y", ""),
    (13, "http://org/", ""), (14, "http://sub.x.com/en/a#b", '<a href="https://bad.net/"><a href="https://bad.net/q">'),
    (15, "http://x.org", ""), (16, "http://a://b/c", ""), (16, "http://a://b/c", ""), (17, "http://good.org/x", '<a href="http://sub.x.com">'),
    (18, "http://y.com/de/1", ""), (19, "http://spam.net/a", "<a href='http://y.com/'>")]


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    k = next((k for k, c in enumerate(rest) if c in "/?#"), len(rest))
    tail = rest[k:]
    return brute.lower(rest[:k]), tail[:next((j for j, c in enumerate(tail) if c in "?#"), len(tail))]


def rule_of(host, path):
    fits = [r for r in U.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def frame(spark):
    return spark.createDataFrame([(*p, "v") for p in PAGES], "page_id long, url string, html string, verdict string")


def test_parts_and_rules(spark):
    for r in U.judge(frame(spark)).collect():
        url = next(u for i, u, _ in PAGES if i == r.page_id)
        rule = rule_of(*parse(url))
        assert (r.host, r.path) == parse(url) and r.rule == (rule.text if rule else None)
        assert rule is None or r.verdict == rule.verdict
    assert U.judge(frame(spark)).count() == len(PAGES)


def test_trust_matches_brute_force(spark):
    import re
    got = {r.host: r for r in U.judge(frame(spark)).collect()}
    hosts, edges = {}, {}
    for _, u, html in PAGES:
        h, p = parse(u)
        rule = rule_of(h, p)
        if h:
            hosts.setdefault(h, []).append(rule.verdict if rule else None)
        for dst in set(re.findall(U.LINK, html or "")):
            dst = brute.lower(dst)
            if h and dst != h:
                edges[h, dst] = edges.get((h, dst), 0) + 1
    names = set(hosts) | {b for _, b in edges} | {""}
    ups = set()
    for n in names:
        parts = n.split(".")
        ups |= {(".".join(parts[k:]), ".".join(parts[k + 1:])) for k in range(len(parts) - 2)}
    for c, p in ups:
        edges[c, p] = edges.get((c, p), 0) + 1
        edges[p, c] = edges.get((p, c), 0) + 1
    share = {v: {h: sum(x == v for x in xs) / len(xs) for h, xs in hosts.items()} for v in ("allow", "block")}
    seeds = {v: {h: s / sum(share[v].values()) for h, s in share[v].items()} for v in share}
    trust = brute.pagerank(edges, seeds["allow"], U.DAMPING, 120)
    distrust = brute.pagerank({(b, a): w for (a, b), w in edges.items()}, seeds["block"], U.DAMPING, 120)
    assert any(r.verdict == "block" and r.rule is None for r in got.values())
    for h, r in got.items():
        assert r.trust == pytest.approx(trust.get(h, 0.0), abs=U.TOLERANCE) and r.distrust == pytest.approx(distrust.get(h, 0.0), abs=U.TOLERANCE)
        if r.rule is None:
            assert r.verdict == ("block" if distrust.get(h, 0.0) > trust.get(h, 0.0) else "allow")


def test_edges(spark):
    """Empty tables, pages without links, null in every column, a very long page."""
    assert U.judge(frame(spark).limit(0)).collect() == []
    odd = spark.createDataFrame([(None, None, None), (1, "http://x.org/" + "p" * 200_000, "y" * 500_000)], "page_id long, url string, html string")
    assert sorted(r.verdict for r in U.judge(odd).collect()) == ["allow", "allow"]


def test_long_chains_are_followed(spark):
    """Distrust reaches every host of a chain that ends at a blocked one, however long."""
    n = 40
    pages = [(k, f"http://h{k}.net/", f'<a href="http://h{k + 1}.net/">') for k in range(n)] + [(n, f"http://h{n}.net/de/", "")]
    rules = (U.Rule(f"h{n}.net", "/de/", "block"),)
    got = {r.host: r.verdict for r in U.judge(spark.createDataFrame(pages, "page_id long, url string, html string"), rules).collect()}
    assert got == {f"h{k}.net": "block" for k in range(n + 1)}


@pytest.mark.parametrize("scale", [1.0, 1e-13, 1e9])
def test_ranks_scale_with_the_seeds(spark, scale):
    """No mass is lost to rounding, however small a seed's share is."""
    edges = spark.createDataFrame([("t", "a", "b", 1), ("t", "b", "c", 1), ("t", "a", "c", 3), ("t", "c", "a", 1)], "kind string, src string, dst string, w long")
    rank = {r.host: r.rank / scale for r in U.pagerank(edges, spark.createDataFrame([("t", "a", scale)], "kind string, host string, s double")).collect()}
    want = brute.pagerank({("a", "b"): 1, ("b", "c"): 1, ("a", "c"): 3, ("c", "a"): 1}, {"a": 1.0}, U.DAMPING, 150)
    assert all(rank[h] == pytest.approx(want[h], abs=1e-4) and rank[h] > 0 for h in want)


def test_links_of_one_part_are_not_dealt_out(spark, monkeypatch):
    """A round over few links is one task, whatever the least number of parts a deal by key may have."""
    edges = spark.createDataFrame([("t", "a", "b", 1), ("t", "b", "c", 1), ("t", "c", "a", 1)], "kind string, src string, dst string, w long")
    deal, cut, parts = type(edges).repartition, U.cut, []
    monkeypatch.setattr(type(edges), "repartition", lambda self, n, *by: deal(self, max(n, 211), *by))

    def seen(df):
        out = cut(df)
        if "p" in out.columns:
            parts.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(U, "cut", seen)
    got = {r.host: r["rank"] for r in U.pagerank(edges, spark.createDataFrame([("t", "a", 1.0)], "kind string, host string, s double")).collect()}
    assert set(got) == {"a", "b", "c"} and got["a"] > got["b"] > got["c"] and parts[-1] == 1
