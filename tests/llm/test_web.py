import random

from lakemart.llm import reputation, revisits
from lakemart.llm.queries import URL_RULES

RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block"}


def test_hosts_paths_and_rules(spark):
    cases = {"http://WWW.Example.com/en/1?q#f": ("www.example.com", "/en/1", "www.example.com/en/"),
             "https://a.example.com/en/": ("a.example.com", "/en/", "example.com/en/"), "https://notexample.com/en/": ("notexample.com", "/en/", "com/"),
             "x://h.net/es/9": ("h.net", "/es/9", "net/es/"), "x://h.net/ES/9": ("h.net", "/ES/9", None), "http://h.com": ("h.com", "", None),
             "http://h.com?x": ("h.com", "", None), "no scheme": ("", "", None), None: ("", "", None), "://É.com/": ("É.com", "/", "com/"), "": ("", "", None)}
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(cases)], "page_id long, url string, host string, RULE string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.url: (r.host, r.path, r.rule) for r in reputation.judge_pages(df, labels, RULES).collect()}
    assert got == cases
    assert reputation.judge_pages(df.limit(0), labels, URL_RULES).count() == 0


def test_shrinkage_blocks_on_evidence_only(spark):
    pages, labels, n = [], [], 0
    for host, good, bad in (("good.site.org", 80, 2), ("bad.site.org", 5, 90), ("few.site.org", 0, 1), ("new.site.org", 0, 0), ("other.org", 50, 1), ("x.co.uk", 3, 0)):
        for i in range(max(1, good + bad)):
            pages.append((n, f"http://{host}/en/{n}.html"))
            if good + bad:
                labels.append((n, 1, int(i < bad)))
            n += 1
    labels += [(n + 1, None, None), (None, 0, 0), (0, 1, 0)]
    p = spark.createDataFrame(pages, "page_id long, url string")
    out = reputation.judge_pages(p, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {})
    verdict = {r.host: r.verdict for r in out.select("host", "verdict").distinct().collect()}
    assert verdict["bad.site.org"] == "block"
    assert {verdict[h] for h in ("good.site.org", "new.site.org", "other.org", "x.co.uk")} == {"allow"}
    mean = {r.host: r.bad_mean for r in out.select("host", "bad_mean").distinct().collect()}
    assert mean["other.org"] < mean["new.site.org"] < mean["bad.site.org"] and mean["few.site.org"] < 1
    domain, suffix = reputation.registered_domain(out["host"])
    assert {tuple(r) for r in out.select(domain, suffix).distinct().collect()} >= {("x.co.uk", "co.uk"), ("site.org", "org")}


def test_canonical_urls(spark):
    same = ["http://www.A.com/x/?utm_source=q&b=2&a=1#f", "https://a.com:443/x?a=1&b=2", "https://A.COM/x/?gclid=3&b=2&a=1"]
    df = spark.createDataFrame([(u,) for u in [*same, None, "nothing", "http://a.com"]], "url string")
    got = [r[0] for r in df.select(revisits.canonical_url(df.url)).collect()]
    assert got == ["a.com/x?a=1&b=2"] * 3 + [None, None, "a.com"]


def test_revisits_against_brute_force(spark):
    r = random.Random(8)
    rows = []
    for i in range(1500):                                # one URL holds most captures and spans many partitions
        url = "http://hot.com/" if r.random() < 0.6 else f"http://h{r.randint(0, 30)}.com/p"
        kind = "response" if r.random() < 0.1 else "revisit"
        tag = r.choice(['"a"', 'W/"a"', '"b"', None])
        head = r.choice([None, {"etag": '"a"', "x": "1"}, {"date": f"d{i}", "content-length": "0"}])
        rows.append((i, r.choice([url, url, None if r.random() < 0.05 else url]), r.choice([None, r.randint(0, 400), r.randint(0, 400)]) if r.random() < 0.1
                     else r.randint(0, 400), kind, tag, r.choice([None, "m1", "m2"]), head))
    schema = "record_id long, url string, ts long, kind string, etag string, last_modified string, headers map<string,string>"
    df = spark.createDataFrame(rows, schema)
    got = {x.record_id: x for x in revisits.resolve_revisits(df).collect()}
    assert len(got) == sum(x[3] == "revisit" for x in rows)
    full = [x for x in rows if x[3] == "response" and x[1] and x[2] is not None]
    tag = lambda t: t.removeprefix("W/")
    for x in rows:
        if x[3] != "revisit":
            continue
        g = got[x[0]]
        base = max((f for f in full if x[1] == f[1] and x[2] is not None and f[2] < x[2]), key=lambda f: (f[2], f[0]), default=None)
        assert g.base_record_id == (base and base[0])
        if base is None:
            want = "no_base"
        elif x[4] and base[4]:
            want = "resolved" if tag(x[4]) == tag(base[4]) else "mismatch"
        elif x[5] and base[5]:
            want = "resolved" if x[5] == base[5] else "mismatch"
        else:
            want = "unverified"
        assert g.status == want
        merged = None
        if want == "resolved":
            merged = dict(base[6] or {}) | {k: v for k, v in (x[6] or {}).items() if k in revisits.PERMITTED}
        assert g.headers == merged
    assert revisits.resolve_revisits(df.limit(0)).count() == 0
