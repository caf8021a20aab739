import pytest

from pageloom.llm.urls import filter_urls, rule_tokens

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
SCHEMA = "page_id long, url string, rule string, token string"


@pytest.fixture(scope="module")
def judged(spark):
    rows = [
        (1, "http://a.example.net/en/5?x=1"), (2, "HTTP://A.NET/x"), (3, "http://a.net"), (4, "http://notexample.net/en/"),
        (5, "https://example.com/de/"), (6, "https://example.com/den"), (7, "https://x.org/fr/#top"), (8, None), (9, ""),
        (10, "no address"), (11, "a://b://net/"), (12, "http://net/"), (13, "http://xnet/"), (14, "s://ÄB.Net/en"),
        (14, "s://ÄB.Net/en"), (None, "http://a.net/"), (15, "http://x.net/" + "a/" * 5000), (16, "http://x.net\n/y\nz")]
    df = spark.createDataFrame([(i, u, "clash", "clash") for i, u in rows], SCHEMA)
    return sorted(map(tuple, filter_urls(df, RULES).collect()), key=repr)


def test_verdicts(judged):
    by = {r[0]: r[1:] for r in judged}
    assert by[1] == ("a.example.net", "/en/5", "example.net/en/", "allow")
    assert by[2] == ("a.net", "/x", "net/", "block")
    assert by[3] == ("a.net", "", None, "allow")
    assert by[4][2:] == ("net/", "block")
    assert by[5][2:] == ("example.com/de/", "block") and by[6][2:] == (None, "allow")
    assert by[7][2:] == ("org/fr/", "allow")
    assert by[8] == by[9] == by[10] == ("", "", None, "allow")
    assert by[11] == ("b:", "//net/", None, "allow")
    assert by[12][2] == "net/" and by[13][2] is None
    assert by[14] == ("Äb.net", "/en", "net/", "block")
    assert by[None][2] == "net/" and by[15][2] == "net/"
    assert by[16] == ("x.net\n", "/y\nz", None, "allow")


def test_repeated_rows_stay(judged):
    assert sum(r[0] == 14 for r in judged) == 2 and len(judged) == 18


def test_empty_table_and_rules(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert filter_urls(empty, RULES).collect() == []
    one = spark.createDataFrame([(1, "http://a/b", "", "")], SCHEMA)
    assert filter_urls(one, []).collect()[0].verdict == "allow"
    assert filter_urls(one, [("", "block")], "allow").collect()[0].verdict == "block"


def test_tokens_are_whole_parts():
    assert rule_tokens("example.net/en/x") == ["h:example", "h:net", "p:en"]
