import math
import re
from collections import defaultdict

import numpy as np
import pytest

from odd import empty_documents, rows
from tidemill.llm import language as L
from tidemill.llm import url_trust as U

SF_DIR = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string, verdict string, host string"


def link(*hosts):
    return "".join(f'<a href="https://{h}/x">x</a>' for h in hosts)


def pages():
    return [
        (1, "https://A.Example.com/fr/1?q", link("friend.org", "b.org"), "v", "h"),
        (2, "http://example.com/en/2", "", "v", "h"),
        (3, "http://www.example.com/en/2#x", None, "v", "h"),
        (4, "https://bad.net/es/1", "", "v", "h"), (5, "https://bad.net/de/1", "", "v", "h"), (6, "https://notnet/es/", "", "v", "h"),
        (7, "https://friend.org/a", link("second.org"), "v", "h"), (8, "https://second.org/", "", "v", "h"),
        (9, "https://spam.org/a", link("bad.net", "spam2.org"), "v", "h"), (10, "https://spam2.org/a", "<a href='//spam.org'>", "v", "h"),
        (11, None, None, "v", "h"), (12, "no scheme", "", "v", "h"), (13, "x://", "", "v", "h"), (14, "https://alone.org", "", "v", "h"),
        (14, "https://alone.org", "", "v", "h"), (15, "https://sub.bad.net?x=/es/", "", "v", "h"),
    ]


def by_hand(settings):
    """Ranks of the hosts by the power method."""
    out = {
        "a.example.com": {"friend.org", "b.org", "example.com"}, "example.com": {"a.example.com", "www.example.com"},
        "www.example.com": {"example.com"}, "friend.org": {"second.org"}, "spam.org": {"bad.net", "spam2.org"}, "spam2.org": {"spam.org"},
        "sub.bad.net": {"bad.net"}, "bad.net": {"sub.bad.net"},
    }
    into = {}
    for a, ends in out.items():
        for b in ends:
            into.setdefault(b, set()).add(a)
    hosts = set(out) | set(into)
    trust0 = {"a.example.com": 1.0, "www.example.com": 1.0}
    distrust0 = {"example.com": 1.0, "bad.net": 0.5}

    def walk(seed, edges):
        now = {h: seed.get(h, 0.0) for h in hosts}
        for _ in range(400):
            after = {h: (1 - settings.damping) * seed.get(h, 0.0) for h in hosts}
            for a, ends in edges.items():
                for b in ends:
                    after[b] += settings.damping * now[a] / len(ends)
            now = after
        return now

    return walk(trust0, out), walk(distrust0, into)


@pytest.mark.parametrize("block_rows", [500_000, 12, 3])
def test_rules_and_ranks(spark, block_rows):
    """One block or many: the ranks are the same."""
    settings = U.Settings(block_rows=block_rows)
    found = {r.page_id: r for r in U.judged(spark.createDataFrame(pages(), PAGES), settings).collect()}
    assert len(found) == 15
    assert (found[1].host, found[1].path, found[1].rule, found[1].verdict) == ("a.example.com", "/fr/1", "com/", "allow")
    assert (found[2].rule, found[2].verdict) == ("example.com/en/", "block")
    assert (found[3].rule, found[3].verdict) == ("www.example.com/en/", "allow")
    assert (found[4].rule, found[4].verdict) == ("net/es/", "block")
    assert found[5].rule is found[6].rule is None
    assert [(found[k].host, found[k].path, found[k].verdict) for k in (11, 12, 13)] == [("", "", "allow")] * 3
    assert (found[15].host, found[15].path, found[15].rule) == ("sub.bad.net", "", None)
    trust, distrust = by_hand(settings)
    for r in found.values():
        if r.host in trust:
            assert r.trust == pytest.approx(trust[r.host], abs=1e-9), r
            assert r.distrust == pytest.approx(distrust[r.host], abs=1e-9), r
            if r.rule is None:
                assert r.verdict == ("block" if round(distrust[r.host], 12) > round(trust[r.host], 12) else "allow")
    assert found[7].trust > found[8].trust > 0 and found[9].distrust > 0 and found[9].verdict == "block"
    assert found[14].verdict == "allow"
    assert U.judged(spark.createDataFrame([], PAGES)).count() == 0


@pytest.mark.parametrize("block_rows", [500_000, 100])
def test_distrust_reaches_the_end_of_a_long_chain(spark, block_rows):
    """Each host of the chain has ten links to it, so that the last one's rank is about 1e-22."""
    chain = ["bad.net"] + [f"c{n}.org" for n in range(1, 21)]
    said = [(0, "https://bad.net/es/1", "", "v", "h")]
    for n in range(1, 21):
        said.append((n, f"https://{chain[n]}/a", link(chain[n - 1]), "v", "h"))
        said += [(100 * n + k, f"https://o{n}x{k}.org/a", link(chain[n - 1]), "v", "h") for k in range(9)]
    found = {r.page_id: r for r in U.judged(spark.createDataFrame(said, PAGES), U.Settings(block_rows=block_rows)).collect()}
    for n in range(21):
        assert found[n].distrust == pytest.approx(0.15 * 0.085**n, rel=1e-6) and found[n].verdict == "block"


def test_a_large_domain_is_split_over_blocks(spark):
    hosts = [(f"h{n}.one.org",) for n in range(300)] + [("one.org",)]
    nodes = spark.createDataFrame(hosts, "host string")
    none = nodes.limit(0)
    places, blocks = U.placed(nodes, none, U.Settings(block_rows=50))
    sizes = [r["count"] for r in places.groupBy("block").count().collect()]
    assert blocks == 7 and sum(sizes) == 301 and max(sizes) < 150


def test_equal_trust_and_distrust_allow(spark):
    """A host linked from a trusted one and to a blocked one in the same shares, and a long page."""
    said = [
        (1, "https://good.com/a", link("tie.org"), "v", "h"), (2, "https://tie.org/", link("bad.net"), "v", "h"),
        (3, "https://bad.net/es/1", "", "v", "h"), (4, "https://long.org/", "<p>x</p>" * 300_000 + link("bad.net"), "v", "h"),
    ]
    found = {r.page_id: r for r in U.judged(spark.createDataFrame(said, PAGES)).collect()}
    assert found[2].trust == pytest.approx(0.15 * 0.85) and found[2].distrust == pytest.approx(0.15 * 0.85 / 2)
    assert found[4].distrust == found[2].distrust and (found[2].verdict, found[4].verdict) == ("allow", "block")
    tied = spark.createDataFrame([*said[:3]], PAGES)
    found = {r.page_id: r for r in U.judged(tied).collect()}
    assert found[2].trust == found[2].distrust and found[2].verdict == "allow"


def test_language_follows_all_evidence(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    table = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    truth = {r.page_id: r.url.split("://")[1].split("/")[1] for r in table.collect()}
    found = L.identified(table, docs).collect()
    assert len(found) == len(truth)
    assert sum(r.language == truth[r.page_id] for r in found) >= 0.97 * len(found)
    assert all(0 <= r.confidence <= 1 + 1e-9 for r in found)


def cells_by_hand(text, bits):
    codes = [c + 0x20 if 0x41 <= c <= 0x5A else (0x20 if c < 0x41 else c) for c in text.encode()]
    found = []
    for a, b, c in zip(codes, codes[1:], codes[2:]):
        cell = (a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D) % 2**32
        found.append(((cell ^ cell >> 15) * 0x2C1B3C6D % 2**32) >> (32 - bits))
    return found


def language_by_hand(pages, docs, s):
    """(page_id, host, declared, suffix, language, confidence, text_language) by plain loops."""
    size = 1 << s.bits
    counts = {}
    for _, text, lang in docs:
        if lang is not None and text is not None:
            for cell in cells_by_hand(text, s.bits):
                held = counts.setdefault(lang, defaultdict(int))
                held[cell] += 1
    langs = sorted(counts)
    whole = {lang: sum(counts[lang].values()) + s.smoothing * size for lang in langs}
    read = []
    for page_id, url, html in pages:
        rest = (url or "").partition("://")[2]
        host = re.match("[^/?#]*", rest)[0].lower()
        labels = host.split(".")
        said = re.search(L.DECLARED, html or "")
        text = re.sub(L.MARKUP, " ", html or "")
        odds = [sum(math.log((counts[lang][c] + s.smoothing) / whole[lang]) for c in cells_by_hand(text, s.bits)) for lang in langs]
        odds = np.maximum((np.array(odds) - max(odds)) * s.trust, -s.strongest)
        shares = np.exp(odds - odds.max())
        read.append((page_id, host, said[1].lower() if said else None, labels[-1], ".".join(labels[-2:]), odds, shares / shares.sum()))
    sums = [defaultdict(lambda: np.zeros(len(langs))) for _ in range(4)]
    groups = lambda r: (r[1], r[4], r[2] or "", r[3])
    for r in read:
        for table, key in zip(sums, groups(r)):
            table[key] += r[6]
    every = sum((r[6] for r in read), np.zeros(len(langs)))
    every = (every + s.smoothing) / (every.sum() + s.smoothing * len(langs))
    out = []
    for r in read:
        own = [np.maximum(table[key] - r[6], 0) for table, key in zip(sums, groups(r))]
        smooth = lambda part, coarser: (part + s.prior * coarser) / (part.sum() + s.prior)
        prior = smooth(own[0], smooth(own[1], every))
        fused = r[5] + np.log(prior) + np.log(smooth(own[2], every) / every) + np.log(smooth(own[3], every) / every)
        found = np.exp(fused - fused.max())
        found /= found.sum()
        out.append((r[0], r[1], r[2], r[3], langs[found.argmax()], found.max(), langs[r[6].argmax()]))
    return out


def test_language_equals_the_sums_by_hand(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang").limit(60).collect()]
    table = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url", "html").collect()][:25]
    table += [(900, None, "<p>x</p>"), (900, None, "<p>x</p>"), (901, "https://new.org/x", None), (902, "https://new.org/y", '<HTML LANG=xx><script>a</script>' + "wort " * 20_000)]
    frame = spark.createDataFrame([(*r, "v", "h") for r in table], PAGES).repartition(3)
    found = L.identified(frame, spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()
    key = lambda r: (r[0], r[1])
    expected = sorted(language_by_hand(table, docs, L.Settings()), key=key)
    for mine, theirs in zip(sorted((tuple(r) for r in found), key=key), expected, strict=True):
        assert mine[:4] == theirs[:4] and mine[5] == pytest.approx(theirs[5], rel=1e-6)
        assert mine[4] == theirs[4] and mine[6] == theirs[6]


def test_host_and_markup_decide_where_text_is_silent(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang")
    spoken = {r.lang: r.text for r in docs.where("length(text) > 300").collect()}
    german = spoken["de"][:300]
    said = [(n, f"https://h.example.org/{n}", f'<html lang="de"><p>{german}</p>', "v", "h") for n in range(6)]
    said += [(n, f"https://k.example.com/{n}", f"<html lang='en'><p>{spoken['en'][:300]}</p>", "v", "h") for n in range(10, 16)]
    odd = [(20, "https://h.example.org/x", None, "v", "h"), (21, "https://new.org/x", '<html lang="de">', "v", "h"), (22, None, "", "v", "h"), (22, None, "", "v", "h")]
    frame = spark.createDataFrame(said + odd, PAGES)
    found = {r.page_id: r for r in L.identified(frame, docs).collect()}
    assert {found[n].language for n in range(6)} == {"de"} and {found[n].language for n in range(10, 16)} == {"en"}
    assert found[20].language == "de" and found[20].declared is None
    assert found[21].language == "de" and found[22].host == ""
    assert L.identified(frame, docs).count() == len(said) + len(odd)
    silent = L.identified(frame, empty_documents(spark)).collect()
    assert {r.language for r in silent} == {None} and len(silent) == len(said) + len(odd)
    assert rows(L.identified(frame.limit(0), docs)) == []
