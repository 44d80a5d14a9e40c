"""URL filters: the trie against brute force, the join and SQL."""

import random

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import catalog, url_filters
from tidemark.llm.url_filters import A_TO_Z, ENTRIES, Entry, Trie

SF = "/root/testdata/sf0.01"


def brute(entries, host, path):
    fitting = [
        (len(e.host.split(".")) if e.host else 0, len(e.path), e.verdict == "block", e.host + e.path, e.verdict)
        for e in entries
        if (not e.host or host == e.host or host.endswith("." + e.host)) and path.startswith(e.path)
    ]
    return max(fitting)[3:] if fitting else None


def place(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut].translate(A_TO_Z), rest[cut:]
    cut = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return host, rest[:cut]


HOSTS = st.lists(st.sampled_from(["a", "b", "www", ""]), max_size=4).map(".".join)
PATHS = st.one_of(st.just(""), st.lists(st.sampled_from(["x", "xy", "", "y"]), min_size=1, max_size=4).map(lambda p: "/" + "/".join(p)))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.builds(Entry, HOSTS, PATHS, st.sampled_from(["allow", "block"])), max_size=8), st.lists(st.tuples(HOSTS, PATHS), max_size=6))
def test_trie_against_brute_force(entries, places):
    trie = Trie(entries)
    assert [trie.judge(*p) for p in places] == [brute(entries, *p) for p in places]


def test_pages_match_sql_and_brute_force(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    result = con.execute(catalog.oracle_sql()["op11_url_filters"])
    names = [c[0] for c in result.description]
    found = catalog.op11_url_filters(spark, SF)
    assert found.columns == names
    rows = sorted(map(tuple, found.collect()))
    assert rows == sorted(result.fetchall()) and len(rows) == 250
    urls = dict(con.execute("SELECT page_id, url FROM pages").fetchall())
    for page, host, path, rule, verdict in rows:
        assert (host, path) == place(urls[page])
        assert (rule, verdict) == (brute(ENTRIES, host, path) or (None, "allow"))


ODD = [
    None, "", "example.com/en/", "http://", "http://EXAMPLE.com/en/x?y", "https://a.b.Example.com/en/#t",
    "http://www.example.com/en/", "http://x.www.example.com/en/1", "http://com", "http://com/", "http://com?x=/en/",
    "ftp://user@example.com:8080/en/", "http://net/es/", "http://net/es", "http://example.net/fr/a/b/c", "http://notcom/",
    "http://.com/", "http://com./", "a://b://example.com/en/", "http://ÄB.com/É/En/", "http://example.com/EN/x",
    "http://example.com/en/" + "z" * 300_000, "http://" + "sub." * 3000 + "example.net/es/",
]


def test_odd_urls_clashing_columns_and_the_join(spark):
    rows = [(i, u, "mine", "own", 1) for i, u in enumerate(ODD)] + [(None, ODD[4], "x", "y", 2)] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, Host string, of string, number int")
    for entries in (ENTRIES, [*ENTRIES, Entry("", "", "block"), Entry("", "/É", "allow"), Entry("Com", "/", "block")]):
        trie = url_filters.judge_urls(df, entries)
        assert trie.columns == ["page_id", "url", "of", "number", "host", "path", "rule", "verdict"]
        found = sorted(map(str, trie.collect()))
        assert found == sorted(map(str, url_filters.judge_urls(df, entries, most_bytes=0).collect()))
        table = spark.createDataFrame(entries, "host string, path string, verdict string")
        assert found == sorted(map(str, url_filters.judge_urls(df, table).collect()))
        lower = [e._replace(host=e.host.lower()) for e in entries]
        for r in trie.collect():
            assert (r.host, r.path) == place(r.url) and r["of"] in ("own", "y")
            assert (r.rule, r.verdict) == (brute(lower, r.host, r.path) or (None, "allow"))
    assert url_filters.judge_urls(df.limit(0), ENTRIES).collect() == []
    assert {r.verdict for r in url_filters.judge_urls(df, [], otherwise="block").collect()} == {"block"}


@pytest.mark.parametrize("seed", range(2))
def test_many_entries(spark, seed):
    draw = random.Random(seed)
    host = lambda: ".".join(draw.choice("abcd") for _ in range(draw.randint(1, 4)))
    path = lambda: "".join("/" + draw.choice(["p", "q", "pq"]) for _ in range(draw.randint(0, 3)))
    entries = [Entry(host(), path(), draw.choice(["allow", "block"])) for _ in range(300)]
    df = spark.createDataFrame([(i, f"http://{host()}{path()}") for i in range(400)], "page_id long, url string")
    for most in (1 << 20, 0):
        for r in url_filters.judge_urls(df, entries, most_bytes=most).collect():
            assert (r.rule, r.verdict) == (brute(entries, r.host, r.path) or (None, "allow"))
