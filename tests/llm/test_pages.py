"""URL filters and WARC archives, the registered queries and the pipeline."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import random
import re
import zlib
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from turnweave.llm import oracle, queries, store, url_rules, warc
from turnweave.llm.common import shared_dir

SMALL = "/root/testdata/sf0.001"

URLS = [
    "https://Shop.Example.NET/de/1?q=1", "http://example.net/en/x", "http://a.example.net/english", "http://notexample.net/en/", "https://x.net", "http://example.com/de/", "http://sub.example.com/de/5#f",
    "http://example.org/fr/9", "http://org/fr/1", "http://xorg/fr/1", "no scheme", "", None, "a://b://c/d", "http://É.com/de/", "//example.net/", "http://h?x=1/2", "http://h#://y/z", "http://example.net/EN/a",
]


def by_hand(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    host = host.translate({i: i + 32 for i in range(65, 91)})
    best = None
    for rule in queries.URL_RULES:
        domain, _, tail = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + tail) and (best is None or len(rule) > len(best)):
            best = rule
    return host, path, best


def test_rules_of_the_list(spark):
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(URLS)] + [(None, URLS[0], 1), (0, URLS[0], 1)], "page_id long, url string, host int")
    got = url_rules.judge_urls(pages, queries.URL_RULES, []).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        host, path, rule = by_hand(URLS[r.page_id or 0])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (queries.URL_RULES[rule] if rule else "allow")


def test_mined_rules_block_combinations(spark):
    rows = [(f"http://{'bad' if k % 2 else 'good'}.site{k % 5}.com/{'win' if k % 3 == 0 else 'news'}/{k}", k % 2 == 1 and k % 3 == 0) for k in range(300)]
    labelled = spark.createDataFrame([*rows, ("http://x.y/z", None), (None, False)], "url string, blocked boolean")
    mined = url_rules.mine_rules(labelled, min_support=0.02)
    tokens = {frozenset(t) for t, _ in mined}
    assert frozenset({"host:bad", "path:win"}) in tokens and not any(len(t) > 2 and t > {"host:bad", "path:win"} for t in tokens)
    pages = spark.createDataFrame([(1, "http://bad.new.com/win/5"), (2, "http://bad.new.com/news/5"), (3, "http://good.new.com/win/5"), (4, "http://bad.new.net/win/5")], "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_rules.judge_urls(pages, {"net/": "allow"}, mined).collect()}
    assert got == {1: "block", 2: "allow", 3: "allow", 4: "allow"}
    index = url_rules.inverted_index(mined)
    for url, _ in rows:
        have = set(re.findall(r"bad|win", url))
        brute = max((c for t, c in mined if all(x.split(":")[1] in have or x.split(":")[1] in url for x in t)), default=None)
        assert (url_rules.best_confidence([x for t, _ in mined for x in t if x.split(":")[1] in url], index) is None) == (brute is None)


def test_mining_keeps_within_its_bound(spark):
    labelled = spark.createDataFrame([(f"http://a{k % 4}.b.com/p{k % 3}/q{k % 2}", True) for k in range(60)], "url string, blocked boolean")
    assert len(url_rules.mine_rules(labelled, min_support=0.01, max_rules=8)) <= 8
    assert url_rules.mine_rules(labelled.limit(0)) == []


def test_more_rules_than_a_broadcast_holds(spark):
    rows = [(f"http://{'bad' if k % 2 else 'good'}.site{k % 5}.com/{'win' if k % 3 == 0 else 'news'}/{'abcd'[k % 4]}", k % 2 == 1 and k % 3 == 0) for k in range(240)]
    rows += [(f"http://x{c}.y{c}/p{c}", True) for c in "abcdefgh" for _ in range(5)]
    labelled = spark.createDataFrame(rows, "url string, blocked boolean")
    few = url_rules.mine_rules(labelled, min_support=0.015)
    many = url_rules.mine_rules(labelled, min_support=0.015, max_rules=3)
    assert len(few) > 3 and sorted((sorted(t), c) for t, c in few) == sorted((r.tokens, r.confidence) for r in many.collect())
    pages = spark.createDataFrame([(k % 250, u) for k, (u, _) in enumerate(rows)] + [(None, None), (1, "http://xa.new.org/"), (2, "http://bad.a.net/win")], "page_id long, url string")
    got = [sorted(map(tuple, url_rules.judge_urls(pages, {"net/": "allow"}, m).collect()), key=repr) for m in (few, many)]
    assert got[0] == got[1] and {r[-1] for r in got[0]} == {"allow", "block"}


def minimal_rules(rows, min_support, min_confidence=0.8):
    """By trying every set of up to five tokens of every row."""
    found = {}
    for have, _ in set(rows):
        for size in range(1, 6):
            for some in map(frozenset, combinations(sorted(have), size)):
                if some not in found:
                    both = [blocked for tokens, blocked in rows if some <= tokens]
                    found[some] = (sum(both), sum(both) / len(both))
    rules = {t: c for t, (n, c) in found.items() if n >= min_support * len(rows) and c >= min_confidence}
    return {t: c for t, c in rules.items() if not any(u < t and rules[u] >= c for u in rules)}


def test_tokens_that_always_go_together(spark):
    rows = [(f"http://{'bad' if k % 2 else 'fine'}.site.com/{'win/prize' if k % 3 == 0 else 'news'}", k % 2 == 1 and k % 3 == 0) for k in range(60)]
    rows += [(f"http://good.site.org/{c}/", c == "a") for c in "abc" for _ in range(4)]
    labelled = spark.createDataFrame(rows, "url string, blocked boolean")
    tokens = [(frozenset(r.t), r.blocked) for r in labelled.select(url_rules.tokens_of(F.col("url")).alias("t"), "blocked").collect()]
    mined = url_rules.mine_rules(labelled, min_support=0.02)
    assert dict(mined) == minimal_rules(tokens, 0.02) and frozenset({"host:bad", "path:prize"}) in dict(mined)
    # A template of so many tokens has 2^40 sets of them.
    wide = [f"{a}{b}" for a in "pqrs" for b in "abcdefghij"]
    labelled = labelled.union(spark.createDataFrame([("http://t.u.net/" + "/".join(wide), True)] * 5, "url string, blocked boolean"))
    mined = url_rules.mine_rules(labelled, min_support=0.02)
    assert {frozenset({f"path:{w}"}) for w in wide} <= set(dict(mined)) and max(len(t) for t, _ in mined) <= 5
    many = url_rules.mine_rules(labelled, min_support=0.02, max_rules=3)
    assert sorted((sorted(t), c) for t, c in mined) == sorted((r.tokens, r.confidence) for r in many.collect())
    pages = spark.createDataFrame([(1, "http://bad.new.de/prize"), (2, "http://fine.new.de/prize"), (3, "http://x.y/sj"), (4, "http://x.y/zz")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in url_rules.judge_urls(pages, {}, mined).collect()} == {1: "block", 2: "allow", 3: "block", 4: "allow"}


def test_urls_of_an_empty_table(spark):
    assert url_rules.judge_urls(spark.createDataFrame([], "page_id long, url string"), queries.URL_RULES, []).count() == 0


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(5, "http://a/ b\n", "same"), (3, None, "same"), (9, "http://c", "same"), (4, "u", None), (6, "u", ""), (7, "é", "ü\r\n\r\nWARC/1.1\r\n" * 50), (8, "u", "x" * 3_000_000), (None, "u", "same"), (10, "u", "only"), (10, "u", "only")]
    return spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")


def expected(rows, minimum=0):
    first = {}
    for k, html in rows:
        b = (html or "").encode()
        if k is not None and len(b) >= minimum:
            first[b] = min(first.get(b, k), k)
    out = []
    for k, html in rows:
        b = (html or "").encode()
        to = first.get(b)
        again = to is not None and to != k
        out.append((k, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", to if again else None))
    return sorted(out, key=repr)


def test_warc_round_trip(pages):
    rows = [(r.page_id, r.html) for r in pages.collect()]
    for minimum in (0, 5):
        got = warc.warc_round_trip(pages, minimum=minimum)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(rows, minimum)
    assert warc.warc_round_trip(pages.limit(0)).count() == 0


def test_normalised_archives_are_plain_warc(spark, pages):
    folder = shared_dir(spark, "w")
    archives = warc.write_archives(pages, folder, archive_bytes=1000)
    before = {a.uri: store.read_file(a.uri) for a in archives.collect()}
    out = warc.normalise(archives, folder, keep_source=True).collect()
    assert len(out) == len(before) > 1 and sum(r.records for r in out) == 10
    plain = sorted(gzip.decompress(b) for b in before.values())
    assert sorted(gzip.decompress(store.read_file(r.uri)) for r in out) == plain
    for b in before.values():  # one member holds the whole file
        d = zlib.decompressobj(31)
        d.decompress(b)
        assert d.eof and not d.unused_data


def test_records_by_offset_and_damage(spark):
    one, two = warc.record(1, "http://a", b"x" * 10, warc.sha1_base32(b"x" * 10)), warc.record(2, None, b"", warc.sha1_base32(b""), 1, True)
    found = list(warc.split_records(iter([(one + two)[k : k + 7] for k in range(0, len(one + two), 7)])))
    assert [f["warc-type"] for f, _, _ in found] == ["response", "revisit"] and b"".join(w for _, _, w in found) == one + two
    with pytest.raises(ValueError, match="record"):
        list(warc.split_records(iter([one[:-5]])))
    packed = gzip.compress(one) + gzip.compress(two)
    assert b"".join(warc.inflate(io.BytesIO(packed))) == one + two
    for cut in (len(packed) - 1, len(packed) - 8, len(gzip.compress(one)) - 9, len(gzip.compress(one)) + 3):
        with pytest.raises(ValueError, match="gzip member"):
            list(warc.inflate(io.BytesIO(packed[:cut])))
    assert b"".join(warc.inflate(io.BytesIO(b""))) == b""


def test_one_record_by_its_place(spark, pages):
    folder = shared_dir(spark, "w")
    (out,) = warc.normalise(warc.write_archives(pages.coalesce(1), folder), folder).limit(1).collect()
    entries = [json.loads(x) for x in store.read_file(out.index_uri).splitlines()]
    for e in reversed(entries):
        fields, content = warc.read_record(out.uri, e["offset"], e["length"])
        assert (fields["warc-record-id"], fields["warc-type"]) == (e["id"], e["type"]) and content.startswith(b"HTTP/1.1")


def test_registered_queries(spark):
    names = set(queries.queries())
    assert {f"op{n}" for n in range(1, 11)} == {n.split("_")[0] for n in names if n.startswith("op")} and "pipeline" in names
    assert set(oracle.SQL) <= names


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = docs.withColumn("component", F.lit(1))
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        out = spark.createDataFrame(out.collect(), out.schema)
        seen.append(out.count())
        docs = out
    assert seen == sorted(seen, reverse=True) and 0 < seen[-1] < spark.read.parquet(f"{SMALL}/documents.parquet").count()
    run = sorted((r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, SMALL).collect())
    assert run == sorted((r.doc_id, r.ids_sha256) for r in docs.collect())


def test_stages_leave_columns_alone(spark):
    """Columns named like results keep their values; of rows of one id with different texts a defined one stays."""
    import corpus_pipeline

    clash = ["kept", "n_words", "pii", "rep", "row", "contaminated", "component_id", "char_hist", "__row", "n"]
    rng = random.Random(5)
    line = lambda: " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(5)) if k % 5 else "the" for k in range(90))
    texts = [line() for _ in range(6)]
    rows = [(k, t, "en", *(f"{c}-{k}" for c in clash)) for k, t in enumerate(texts)] + [(0, line(), "en", *clash), (9, texts[1], "en", *clash)]
    names = ["doc_id", "text", "lang", *clash]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, " + ", ".join(f"{c} string" for c in clash))
    results = {}
    for given in (docs, spark.createDataFrame(rows[::-1], docs.schema)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, given, SMALL)
            assert out.columns == names
            rest = {tuple(r) for r in out.collect()}
            assert rest <= {tuple(r) for r in rows}
            assert results.setdefault(name, rest) == rest
    assert {r[0] for r in results["jaccard_join"]} == set(range(6)) and len(results["jaccard_join"]) == 6
    assert len(results["decontamination"]) == len(results["pii"]) == len(rows)


def test_pipeline_stages_take_odd_rows(spark):
    import corpus_pipeline

    rng = random.Random(1)
    text = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(5)) if k % 5 else "the" for k in range(90))
    rows = [(1, text, "en"), (1, text, "en"), (2, text + " more", "en"), (None, text, "en"), (4, None, None), (5, "", "en")]
    for table in (rows, []):
        docs = spark.createDataFrame(table, "doc_id long, text string, lang string")
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SMALL)
            docs = spark.createDataFrame(out.collect(), out.schema)
        assert sorted(((r.doc_id) for r in docs.collect()), key=repr) == ([1, None] if table else [])
