from __future__ import annotations

import pytest

from recordloom.llm import urlfilter


def rows(spark, data, extra=True):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, (u, h) in enumerate(data)], "page_id long, url string, html string, host string, n int")


def link(*hosts):
    return "".join(f'<a href="https://{h}/x">y</a> <a href="/local">z</a>' for h in hosts)


def test_rules_hosts_and_paths(spark):
    data = [
        ("http://A.Example.COM/en/728?x#y", None), ("http://example.com/en/5", None), ("//example.com/en/7", None), (None, None), ("", None),
        ("x://b.example.net/de/81#a", None), ("x://net/de/1", None), ("http://example.org?q=/es/", None), ("http://example.org/es/", None), ("http://notexample.com:80/EN/", None), ("http://u://v/w", None),
    ]
    got = {r.page_id: r for r in urlfilter.filtered(rows(spark, data)).collect()}
    assert [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in range(len(data))] == [
        ("a.example.com", "/en/728", "example.com/en/7", "allow"),
        ("example.com", "/en/5", "com/en/", "block"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("b.example.net", "/de/81", "example.net/de/8", "block"),
        ("net", "/de/1", "net/de/", "allow"),
        ("example.org", "", None, "block"),
        ("example.org", "/es/", "org/es/", "block"),
        ("notexample.com:80", "/EN/", None, "allow"),
        ("u:", "//v/w", None, "allow"),
    ]


def test_links_carry_trust_and_distrust(spark):
    good, bad = "http://good.net/de/1", "http://bad.com/en/1"
    data = [
        (good, link("friend.io", "friend.io", "far.io")), (bad, link("victim.io")), ("http://friend.io/", link("far.io", "bad.com")),
        ("http://liker.io/", link("bad.com")), ("http://liker2.io/", link("liker.io")), ("http://victim.io/", None), ("http://far.io/", ""),
        ("http://liker.io/", link("bad.com")),
    ]
    df = rows(spark, data)
    got = {r.page_id: r for r in urlfilter.filtered(df).collect()}
    assert {got[i].host: got[i].verdict for i in range(8)} == {"good.net": "allow", "bad.com": "block", "friend.io": "allow", "liker.io": "block", "liker2.io": "block", "victim.io": "allow", "far.io": "allow"}
    # power iteration in plain Python
    edges = {}
    for u, h in data:
        src = u.split("/")[2]
        for part in (h or "").split('href="https://')[1:]:
            dst = part.split("/")[0]
            edges.setdefault(src, {}).setdefault(dst, 0)
            edges[src][dst] += 1
    rank = seed = {"good.net": 1.0}
    for _ in range(300):
        new = {h: (1 - urlfilter.DAMPING) * m for h, m in seed.items()}
        for s, out in edges.items():
            for d, n in out.items():
                if s in rank and s != d:
                    new[d] = new.get(d, 0) + urlfilter.DAMPING * rank[s] * n / sum(out.values())
        rank = new
    for i in range(8):
        assert abs(got[i].trust - rank.get(got[i].host, 0)) < 1e-9
    assert urlfilter.filtered(df.limit(0)).count() == 0


def test_repeated_rows_stay(spark):
    df = rows(spark, [("http://a.com/en/", None)]).selectExpr("cast(null as long) as page_id", "url", "html")
    assert urlfilter.filtered(df.unionAll(df)).count() == 2


def test_chains_longer_than_ten_hosts_settle(spark):
    n = 13
    data = [("http://bad.com/en/1", None), ("http://h1.io/", link("bad.com"))] + [(f"http://h{k}.io/", link(f"h{k - 1}.io")) for k in range(2, n + 1)]
    got = {r.host: r for r in urlfilter.filtered(rows(spark, data)).collect()}
    for k in range(1, n + 1):
        assert got[f"h{k}.io"].verdict == "block" and abs(got[f"h{k}.io"].distrust - 0.15 * 0.85**k) < 1e-9, k
    loop = spark.createDataFrame([("a", "b", 1.0), ("b", "a", 1.0)], "src string, dst string, w double")
    seed = spark.createDataFrame([("a", 1.0)], "host string, mass double")
    with pytest.raises(RuntimeError):
        urlfilter.propagated(seed, loop, 3)


def test_verdicts_do_not_depend_on_the_size_of_masses(spark):
    judged = spark.createDataFrame([("good", "allow"), ("bad", "block")], "host string, ruled string")
    edges = spark.createDataFrame([("liker", "bad", 1), ("bulk", "bad", 10**13)], "src string, dst string, n long")
    got = {r.host: r for r in urlfilter.trust(judged, edges).collect()}
    assert got["liker"].distrust == 0 and got["liker"].blocked and got["bulk"].blocked and not got["good"].blocked
    edges = spark.createDataFrame([("good", "even", 1), ("even", "bad", 1)], "src string, dst string, n long")
    assert not {r.host: r.blocked for r in urlfilter.trust(judged, edges).collect()}["even"]


def test_links_of_any_case_and_without_quotes(spark):
    forms = ['<A HREF="https://bad.com/x">', "<a href=https://bad.com/x>", "<a Href = 'HTTP://BAD.com/x'>", "<a class=x href=//bad.com>", "<link href='//bad.com/y'/>" + "z" * 3_000_000]
    data = [("http://bad.com/en/1", None)] + [(f"http://h{i}.io/", f) for i, f in enumerate(forms)] + [("http://h9.io/", "xhref=https://bad.com/ <a href='/bad.com'>")]
    got = {r.host: r.verdict for r in urlfilter.filtered(rows(spark, data)).collect()}
    assert [got[f"h{i}.io"] for i in (0, 1, 2, 3, 4, 9)] == ["block"] * 5 + ["allow"]


def test_sql_says_the_same_of_linked_hosts(spark, tmp_path):
    import duckdb

    chain = [(f"http://h{k}.io/", link(f"h{k - 1}.io", "h1.io")) for k in range(2, 12)]
    data = [("http://bad.com/en/1", None), ("http://good.net/de/1", "<a HREF=//h9.io/>" + link("h5.io", "h2.io")), ("http://h1.io/", link("bad.com")), *chain, (None, None)]
    df = rows(spark, data).select("page_id", "url", "html")
    df.coalesce(1).write.parquet(f"{tmp_path}/pages")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages/*.parquet')")
    cur = con.execute(urlfilter.sql())
    names = [c[0] for c in cur.description]
    show = lambda r: str([f"{v:.9f}" if isinstance(v, float) else v for v in r])
    assert sorted(map(show, cur.fetchall())) == sorted(show(r) for r in urlfilter.filtered(df).select(*names).collect())
