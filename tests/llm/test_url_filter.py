import random
import re

import pytest

from pairloom.llm import url_filter


def brute(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest).group()
        path = re.match("[^?#]*", rest[len(host) :]).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0]) + len(r[1]), len(r[0])), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


@pytest.fixture(scope="module")
def pages(spark):
    rnd = random.Random(1)
    labels, paths = ["com", "net", "example", "www", "a", "b", "ex", "org", "EXAMPLE", "é"], ["/", "/en/", "/e", "/es/x", "/en/a/", "?q=/en/", "#x", "/fr"]
    rows = [(i, rnd.choice(["http://", "x://", "", "ftp:/"]) + ".".join(rnd.choice(labels) for _ in range(rnd.randint(1, 4))) + "".join(rnd.choice(paths) for _ in range(rnd.randint(0, 3)))) for i in range(1500)]
    rows += [(9000, None), (9001, ""), (9002, "http://"), (9003, "a://b://c/d"), (5, "http://www.example.com/en/x"), (5, "http://www.example.com/en/x")]
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, host string, html string")


def rule_set():
    rnd = random.Random(2)
    made = {(".".join(rnd.choice(["com", "net", "example", "www", "a", "b"]) for _ in range(rnd.randint(1, 3))), rnd.choice(["/", "/en/", "/e", "", "/en/a/"])) for _ in range(120)}
    return [(*r, rnd.choice(["allow", "block"])) for r in sorted(made)]


@pytest.mark.parametrize("local", [10, 10**6])
@pytest.mark.parametrize("kind", ["fixed", "list", "table"])
def test_against_brute_force(spark, pages, local, kind):
    rules = url_filter.RULES if kind == "fixed" else rule_set()
    given = spark.createDataFrame(rules, "host string, path string, verdict string") if kind == "table" else rules
    got = url_filter.judge(pages, given, local_rules=local).collect()
    want = [(r["page_id"], *brute(r["url"], rules)) for r in pages.collect()]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_no_rows_and_no_rules(spark, pages):
    assert url_filter.judge(pages.limit(0), url_filter.RULES).count() == 0
    assert {r["verdict"] for r in url_filter.judge(pages, []).collect()} == {"allow"}
    assert url_filter.judge(pages, rule_set(), local_rules=3).count() == pages.count()


def test_query_against_its_sql(spark):
    import os

    import duckdb
    from helpers import same_rows

    from pairloom.llm.queries import ORACLE_SQL

    from .conftest import DATA

    if not os.path.isdir(DATA):
        pytest.skip("no test data")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{DATA}/pages.parquet'")
    df, found = url_filter.op5_url_filter(spark, DATA), con.sql(ORACLE_SQL["op5_url_filter"])
    same_rows(df.collect(), df.columns, found.fetchall(), found.columns)
