import re

import duckdb

from clientele.llm import queries, url_filter

URLS = [
    None, "", "no scheme", "http://", "http://Example.COM/en/a", "http://www.example.com/en/", "https://a.b.net/es/x?y",
    "http://net/fr/", "http://xnet/fr/", "http://com", "http://com?x", "http://com/", "ftp://a.org/porn/x", "http://a.org/pornx",
    "http://a.org/casino?poker=1", "http://a.org/casino/casino", "http://a.org/free-download#loan", "http://PORN.org",
    "http://a.org:80/x", "://a.org/b://c", "http://a.org/\nes\n/x", "http://a.org/" + "x" * 200_000 + "/xxx", "http://é.net/es/ü",
    "http://a.org/bet-cheap", "http://a.org/alphabet-cheap", "http://a.org/éxxxé",
]


def write(spark, path, urls):
    frame = spark.createDataFrame(
        [(i, u, "h", "r") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string"
    )
    frame.write.parquet(f"{path}/pages.parquet")


def slow(url):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in url or "")
    return sum(
        w
        for t, w in url_filter.VOCABULARY.items()
        if re.search(rf"(?<![a-z0-9]){re.escape(t)}(?![a-z0-9])", low)
    )


def test_weights_against_regular_expressions():
    terms = tuple(sorted(url_filter.VOCABULARY.items()))
    for url in URLS:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in url or "")
        assert url_filter.weight(low, terms) == slow(url), url


def test_query_against_sql(spark, tmp_path):
    write(spark, tmp_path, URLS + URLS[:6])
    got = queries.op7_url_filter(spark, str(tmp_path)).collect()
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = duck.execute(queries.REFERENCE_SQL["op7_url_filter"]).fetchall()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    by = {URLS[r.page_id]: r for r in got if r.page_id < len(URLS)}
    assert by[None].host == by["no scheme"].path == "" and by[None].verdict == "allow"
    assert by["http://com?x"].rule is None and by["http://com/"].rule == "com/"
    assert by["http://www.example.com/en/"].verdict == "allow"
    assert by["http://Example.COM/en/a"].verdict == "block"
    assert by["http://a.org/casino?poker=1"].verdict == "block"
    assert by["http://a.org/casino/casino"].verdict == "allow"


def test_empty_table_and_empty_vocabulary(spark, tmp_path):
    write(spark, tmp_path, [])
    assert queries.op7_url_filter(spark, str(tmp_path)).count() == 0
    one = spark.createDataFrame([(1, "http://a.org/porn")], "page_id long, url string")
    assert url_filter.judge_urls(one, vocabulary={}).first().verdict == "allow"
