"""op9 on link graphs that are deeper than the rounds of its SQL."""

from __future__ import annotations

import pytest

from tidemark.llm.url_filters import Rule, propagate, url_filter


def brute(seeds, links, damping=0.85):
    """(trust, distrust) by host, until nothing changes."""
    hosts = {h for s, d, _ in links for h in (s, d)} | set(seeds)
    sent, got = dict.fromkeys(hosts, 0), dict.fromkeys(hosts, 0)
    for s, d, n in links:
        sent[s] += n
        got[d] += n
    rank = {h: seeds.get(h, (0.0, 0.0)) for h in hosts}
    while True:
        new = {h: list(seeds.get(h, (0.0, 0.0))) for h in hosts}
        for s, d, n in links:
            new[d][0] += damping * rank[s][0] * n / sent[s]
            new[s][1] += damping * rank[d][1] * n / got[d]
        change = max(abs(a - b) for h in hosts for a, b in zip(new[h], rank[h]))
        rank = {h: tuple(v) for h, v in new.items()}
        if change < 1e-13:
            return rank


def test_deep_links_reach_the_end(spark):
    # Two hosts that link to each other build up distrust, twelve and more link on to them one after the other.
    chain = [(f"h{k + 1}.io", f"h{k}.io", 1) for k in range(14)]
    links = [("bad.com", "worse.com", 1), ("worse.com", "bad.com", 1), ("h0.io", "bad.com", 1), *chain]
    seeds = {"bad.com": (0.0, 1.0), "h14.io": (0.5, 0.0)}
    expected = brute(seeds, links)
    found = propagate(spark.createDataFrame([(h, *v) for h, v in seeds.items()], "host string, trust double, distrust double"),
                      spark.createDataFrame(links, "src string, dst string, n long"))
    found = {r.host: (r.trust, r.distrust) for r in found.collect()}
    assert set(found) == set(expected)
    for host, values in expected.items():
        assert found[host] == pytest.approx(values, abs=1e-6)


def test_verdicts_of_hosts_on_a_chain(spark):
    pages = [("http://bad.com/", "worse.com"), ("http://worse.com/", "bad.com"), ("http://h0.io/", "bad.com")]
    pages += [(f"http://h{k + 1}.io/", f"h{k}.io") for k in range(14)]
    rows = [(k, url, f'<a href="http://{host}/">') for k, (url, host) in enumerate(pages)]
    found = url_filter(spark.createDataFrame(rows, "page_id long, url string, html string"), [Rule("block", "bad.com", "/"), Rule("block", "worse.com", "/")])
    links = [(url.split("/")[2], host, 1) for url, host in pages]
    ranks = brute({"bad.com": (0.0, 1.0), "worse.com": (0.0, 1.0)}, links)
    verdicts = {h: "block" if d - t >= 0.25 else "allow" for h, (t, d) in ranks.items()}
    assert verdicts["h9.io"] == "block" and "allow" in verdicts.values()
    assert {r.host: r.verdict for r in found.collect()} == verdicts


def test_rounds_without_end_are_refused(spark):
    empty = spark.createDataFrame([], "host string, trust double, distrust double")
    with pytest.raises(ValueError):
        propagate(empty, spark.createDataFrame([], "src string, dst string, n long"), damping=1.0)
