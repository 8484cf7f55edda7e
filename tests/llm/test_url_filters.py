"""URL filters against running every rule on every URL."""

import re

import pytest

from aislekit.llm import url_filters as U

URLS = [None, "", "no scheme", "http://", "HTTP://A.ORG", "http://A.ORG/", "http://x.Example.org/es/1", "http://example.org/en/1",
        "http://example.org/en/199?x", "http://example.org/en/2", "http://notexample.org/es/", "http://x.com/fr/", "http://x.com/FR/",
        "http://x.com/de", "http://x.com/de/?a=1#b", "http://spam-farm.net/x", "http://www.SPAM-farm.org/x", "http://xspam-farm.net/",
        "http://a.net/wp-login.php", "http://a.net/q?next=/wp-login.php", "http://a.net/malware/x/Y.exe", "http://a.net/malware/y.exes",
        "http://a.net/malware/y.exe?", "http://popunder-1.b.net", "http://user@x.org:80/", "http://x.org:80/", "x://y://z.org/",
        "http://x.com/fr/\nline", "http://" + "a" * 50_000 + ".org/" + "b" * 50_000, "http://x.com/fr/", "http://org", "http://a.org?x=/"]


def by_hand(url, rules, default):
    text = url or ""
    at = text.find("://")
    rest = text[at + 3:] if at >= 0 else ""
    host = re.match(r"[^/?#]*", rest).group()
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    subject = low + rest[len(host):]
    fits = []
    for i, r in enumerate(rules):
        if r.host_path:
            h, _, p = r.name.partition("/")
            ok = (low == h or low.endswith("." + h)) and path.startswith("/" + p)
        else:
            ok = url is not None and re.search(r.regex, subject) is not None
        if ok:
            fits.append((r.host_path, r.length, -i, r))
    best = max(fits)[3] if fits else None
    name = best.name if best else None
    return (low, path, name if best and best.host_path else None, best.verdict if best else default,
            name if best and not best.host_path else None)


@pytest.fixture(scope="module")
def make_pages(spark):
    def make(urls):
        return spark.createDataFrame([(i, u, None, "clash", 0) for i, u in enumerate(urls)],
                                     "page_id long, url string, html string, host string, rule_id int")

    return make


@pytest.mark.parametrize("broadcast", [0, 50_000])
def test_equals_running_every_rule(make_pages, monkeypatch, broadcast):
    monkeypatch.setattr(U, "BROADCAST_RULES", broadcast)
    rules = [*U.TASK_RULES, *U.DEFAULT_PATTERNS, U.pattern_rule("q?next", "block"), U.pattern_rule("*z.org*", "allow")]
    got = U.judge(make_pages(URLS), rules).collect()
    assert {r["page_id"]: tuple(r)[1:] for r in got} == {i: by_hand(u, rules, "allow") for i, u in enumerate(URLS)}
    assert len(got) == len(URLS)


def test_rules_are_filed_under_their_rarest_token(spark, make_pages):
    pages = make_pages([f"http://h{i}.example.org/{'es' if i < 2 else 'en'}/{i}" for i in range(9)])
    subjects = pages.select("url", U.subject_of("url").alias("subject"))
    tokens = subjects.select("url", "subject", U.F.explode(U.tokens_of("subject")).alias("token"))
    rules = [*U.TASK_RULES[:3], U.pattern_rule("abc", "block")]
    index = U.index_rules(U.rule_table(spark, rules), tokens).collect()
    assert {r["name"]: r["token"] for r in index} == {"org/": "org", "example.org/es/": "es", "example.org/en/1": "en",
                                                      "abc": ""}


def test_no_python_runs(make_pages):
    plan = U.op6_url_filters(make_pages(URLS))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|ExternalRDD|Cartesian|NestedLoop", plan)


def test_empty_table(make_pages):
    assert U.op6_url_filters(make_pages([])).collect() == []
