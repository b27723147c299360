from textlake.llm.url_filter import judge


def rows(spark, data):
    return spark.createDataFrame(data, "page_id long, url string, host string, rule string")


LABELS = [("http://good%d.cheap-pills.example.com/en/%d" % (i % 7, i), i % 10 != 0) for i in range(60)] + [("http://good%d.example.com/en/%d" % (i % 7, i), i % 9 == 0) for i in range(120)] + [("http://%s.example.com/en/%d" % (w, i), False) for w in ("cheap", "pills") for i in range(60)]


def test_mined_rules_and_listed_rules(spark):
    labels = spark.createDataFrame(LABELS + [(None, True), ("x", None)], "url string, bad boolean")
    pages = [
        (1, "https://M.X.Cheap-Pills.example.com/fr/9", None, None),
        (2, "https://cheap.example.com/fr/9", None, None),
        (3, "http://pills.cheap.net/", None, None),
        (4, "http://example.net/en/1?x", None, None),
        (5, "http://notexample.com/de/", None, None),
        (6, "HTTP://EXAMPLE.com/de/#f", None, None),
        (7, None, "h", "r"),
        (8, "cheap.pills.example.com", None, None),
        (9, "", None, None),
        (9, "", None, None),
        (10, "http://a.net", None, None),
        (11, "http://a.org/fr/" + "x" * 50000, None, None),
    ]
    out = sorted((r.page_id, r.host, r.path[:4], r.rule, r.verdict) for r in judge(rows(spark, pages), labels, ["page_id"], least_rows=20).collect())
    assert out == [
        (1, "m.x.cheap-pills.example.com", "/fr/", None, "block"),
        (2, "cheap.example.com", "/fr/", None, "allow"),
        (3, "pills.cheap.net", "/", "net/", "block"),
        (4, "example.net", "/en/", "example.net/en/", "allow"),
        (5, "notexample.com", "/de/", None, "allow"),
        (6, "example.com", "/de/", "example.com/de/", "block"),
        (7, "", "", None, "allow"),
        (8, "", "", None, "allow"),
        (9, "", "", None, "allow"),
        (9, "", "", None, "allow"),
        (10, "a.net", "", None, "allow"),
        (11, "a.org", "/fr/", "org/fr/", "allow"),
    ]


def test_all_parts_make_rules(spark):
    bad = [("http://1xbet.example%d.org/a%d" % (i, i), True) for i in range(30)] + [("http://b%d.org/en/shop/casino/x/%d" % (i, i), True) for i in range(30)] + [("http://c%d.org/?id=%d&kind=pills" % (i, i), True) for i in range(30)]
    long = [("http://d.org/" + "/".join(f"deep{k}" for k in range(40)), True)] * 30  # 2 ** 40 sets of tokens
    good = [("http://e%d.org/en/shop/books/x/%d?id=%d&kind=books" % (i, i, i), False) for i in range(300)]
    pages = [(1, "http://www.1xbet.com/"), (2, "http://z.com/de/q/casino"), (3, "http://z.com/?kind=pills#x"), (4, "http://z.com/deep7"), (5, "http://z.com/en/shop/1?id=2&kind=books"), (6, "http://xbet.com/2/3.4")]
    out = judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(bad + long + good, "url string, bad boolean"), ["page_id"], rules=())
    assert {r.page_id: r.verdict for r in out.collect()} == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "allow"}


def test_shuffled_join_gives_the_same(spark):
    labels, pages = spark.createDataFrame(LABELS, "url string, bad boolean"), rows(spark, [(i, u, None, None) for i, (u, _) in enumerate(LABELS)])
    a = judge(pages, labels, ["page_id"], least_rows=20).collect()
    b = judge(pages, labels, ["page_id"], least_rows=20, broadcast_bytes=0).collect()
    assert sorted(a) == sorted(b) and {r.verdict for r in a} == {"allow", "block"}


def test_empty(spark):
    none = spark.createDataFrame([], "url string, bad boolean")
    assert [r.verdict for r in judge(rows(spark, [(1, "http://a.b/c", None, None)]), none, ["page_id"]).collect()] == ["allow"]
    assert judge(rows(spark, []), none, ["page_id"]).count() == 0


def test_query_with_mined_rules_equals_sql(spark, tmp_path):
    """Tables whose listed and labelled URLs give rules, which then decide unlisted URLs; against SQL that tries all token sets."""
    import duckdb

    from textlake.llm import url_filter as U

    urls = [(i, f"http://{'m.' * (i % 2)}a{i % 4}.example.{('net', 'com', 'org')[i % 3]}/{('de', 'en', 'fr', 'es')[i // 3 % 4]}/x{i % 5}/{i}{('', '?ref=x&page=2', '?kind=pills')[i % 7 % 3]}") for i in range(600)] + [(600, None), (601, "x"), (600, None), (602, "http://b.org/q/w/e/shop?kind=pills&z=1#top")]
    labels = [(i, 0 if "pills" in u else 1, 0) for i, u in urls[:500] if u and i % 3] + [(3, None, None), (9999, 0, 1)]
    spark.createDataFrame(urls, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = sorted(map(repr, map(tuple, U.query(spark, str(tmp_path)).collect())))
    c = duckdb.connect()
    for t in ("pages", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    assert got == sorted(map(repr, c.sql(U.SQL).fetchall()))
    assert "'http" not in got[0] and sum(r.endswith("None, 'block')") for r in got) > 20 and any(r.startswith("(602,") and r.endswith("'block')") for r in got)


def deep(k):
    """Bad URLs of k path parts, each without another part, and good ones with two of the parts."""
    parts = [f"part{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(k)]
    bad = [("http://d.org/" + "/".join(p for j, p in enumerate(parts) if j != i % k), True) for i in range(60)]
    return bad + [(f"http://d.org/{parts[i % 2]}/other/page{chr(97 + i % 26)}", False) for i in range(80)]


def brute(labelled, confidence=0.8, lift=1.5, least=20):
    """Minimal rules by trying every set of reps, from the definition."""
    from itertools import combinations

    n, bad = len(labelled), sum(b for _, b in labelled)
    where = {}
    for i, (tokens, _) in enumerate(labelled):
        for t in tokens:
            where.setdefault(t, set()).add(i)
    reps = {}
    for t in sorted(where):
        if len(where[t]) >= least:
            reps.setdefault(frozenset(where[t]), t)
    rows, rules = {t: r for r, t in reps.items()}, []
    for size in range(1, len(rows) + 1):
        for c in combinations(sorted(rows), size):
            if any(set(r) <= set(c) for r in rules):
                continue
            both = frozenset.intersection(*(rows[t] for t in c))
            hits = sum(labelled[i][1] for i in both)
            if hits >= least and hits / len(both) >= confidence and hits / len(both) / (bad / n) >= lift:
                rules.append(c)
    return sorted(rules)


def test_deep_paths_are_mined_in_seconds_and_as_by_brute_force(spark):
    import time

    from pyspark.sql import functions as F

    from textlake.llm import url_filter as U
    from textlake.llm.scratch import scope

    def mined(urls):
        host, path = U.host_and_path(F.col("url"))
        labelled = spark.createDataFrame(urls, "url string, bad boolean").select(U.tokens(host, path, F.col("url")).alias("tokens"), "bad")
        with scope(spark):
            return labelled.collect(), sorted(tuple(r.antecedent) for r in U.mine(labelled)[0].collect())

    rows, rules = mined(deep(10))
    assert rules == brute([(r.tokens, r.bad) for r in rows]) and any(len(r) == 2 for r in rules) and any(len(r) == 1 for r in rules)
    began = time.time()
    assert len(mined(deep(30))[1]) >= 28
    assert time.time() - began < 60
