"""Quality rules, near duplicates, language model, decontamination and personal data against brute force."""

from __future__ import annotations

import collections
import hashlib
import math
import pathlib
import random
import re
import uuid

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from turnweave import store
from turnweave.llm import backoff, components, decontamination, jaccard, pii, quality
from turnweave.llm.common import discard, materialize, scratch, shared_dir, table

SMALL = "/root/testdata/sf0.001"
LOWER = {i: i + 32 for i in range(65, 91)}


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def docs(spark):
    """The small table with odd rows: null id, null and empty text, white space, repeated row, long text, clashing names."""
    real = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(2)
    long = " ".join(rng.choice(["the", "of", "run", "é", "x1"]) for _ in range(30_000))
    extra = [(None, "one two three four five six seven", "en"), (9000, None, "en"), (9001, "", None), (9002, " \n\t ", "xx"), (9003, "few words", "en"), (9004, "few words", "de"), (9005, long, "en"), (9006, "FEW words", None), (9007, "a b c d e f g h", "en"), (9007, "a b c d e f g h", "en")]
    odd = spark.createDataFrame(extra, "doc_id long, text string, lang string")
    return real.union(odd).withColumn("n", F.lit("x")).withColumn("kept", F.lit("y")).withColumn("pii", F.lit(1)).withColumn("rep", F.lit(0)).cache()


def rows_of(docs):
    return [(r.doc_id, r.text, r.lang) for r in docs.collect()]


# Quality rules


def measured(text):
    w = split(text)
    lines, repeated = set(), 0
    for line in (text or "").split("\n"):
        if split(line):
            repeated += line in lines
            lines.add(line)
    threes = list(zip(w, w[1:], w[2:], strict=False))
    count = collections.Counter(threes)
    inside = {i + k for i, g in enumerate(threes) if count[g] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), repeated, len(inside)


def distance(counts, reference):
    n = sum(counts)
    p = [c / n for c in counts]
    m = [(a + b) / 2 for a, b in zip(p, reference, strict=True)]
    kl = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m, strict=True) if a > 0)
    return math.sqrt(max(0.0, (kl(p) + kl(reference)) / 2))


def judged(text, lang, references):
    w = split(text)
    t = text or ""
    chars = [len(re.findall(c, t)) for c in ("[a-z]", "[A-Z]", "[0-9]", r"[\x20\x09-\x0D]", r"[#*$%&|<>]", r"[^\x00-\x7F]")]
    chars.append(len(t) - sum(chars))
    by_class = by_word = None
    if lang in references:
        common = quality.COMMON_WORDS[lang]
        found = [w.count(c) for c in common]
        if len(t) >= quality.MIN_CHARS:
            by_class = distance(chars, references[lang][0])
        if len(w) >= quality.MIN_WORDS:
            by_word = distance([*found, len(w) - sum(found)], references[lang][1])
    return by_class, by_word


def test_quality(spark, docs):
    references = quality.fit_references(docs, table(spark, SMALL, "labels"))
    assert set(references) <= set(quality.COMMON_WORDS) and references
    assert all(abs(sum(x) - 1) < 1e-9 for pair in references.values() for x in pair)
    got = quality.quality_rules(docs, references).collect()
    assert len(got) == docs.count()
    rejected = 0
    for r in got:
        n, chars, symbols, lines, repeat = measured(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeat)
        assert r.base_failed == (n < 50 or 100 * repeat > 50 * n)
        by_class, by_word = judged(r.text, r.lang, references)
        for a, b in ((r.class_distance, by_class), (r.word_distance, by_word)):
            assert (a is None) == (b is None) and (a is None or abs(a - b) < 1e-9)
        diverges = (by_class or 0) > quality.MAX_CLASS_DISTANCE or (by_word or 0) > quality.MAX_WORD_DISTANCE
        assert r.kept == (not r.base_failed and not diverges)
        rejected += diverges and not r.base_failed
    assert rejected


def test_quality_rejects_other_languages_and_gibberish(spark, docs):
    labels = table(spark, SMALL, "labels")
    references = quality.fit_references(docs, labels)
    rng = random.Random(5)
    gibberish = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(5)) for _ in range(200))
    german = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(4)) if k % 4 else rng.choice(["der", "die", "und", "das"]) for k in range(200))
    rows = [(k, t, lang) for k, t in enumerate((gibberish, german)) for lang in references if (k, lang) != (1, "de")]
    got = quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string"), references).collect()
    assert len(got) == len(rows) and not any(r.kept or r.base_failed for r in got)
    good = docs.join(labels.where("quality = 1 and toxic = 0").select("doc_id").distinct(), "doc_id", "left_semi")
    assert quality.quality_rules(good, references).where("not base_failed and word_distance > 0.31").count() == 0


def test_quality_without_labels_or_rows(spark, docs):
    labels = table(spark, SMALL, "labels")
    assert quality.fit_references(docs, labels.limit(0)) == {}
    assert quality.fit_references(docs.limit(0), labels) == {}
    out = quality.quality_rules(docs, {})
    assert out.where("kept = base_failed").count() == 0
    assert quality.quality_rules(docs.limit(0), {}).count() == 0


def test_quality_stage_keeps_what_the_rules_keep(spark, docs):
    from turnweave.llm import queries

    kept = queries.stage_quality(spark, docs, SMALL)
    assert kept.columns == docs.columns
    want = quality.quality_rules(docs, quality.fit_references(docs, table(spark, SMALL, "labels"))).where("kept").count()
    assert 0 < kept.count() == want < docs.count()


# Near duplicates


def shingles(text):
    w = split((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows):
    sets = collections.defaultdict(list)
    for d, t in rows:
        sets[d].append(shingles(t))
    parent = {d: d for d in sets if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    flat = [(d, s) for d, ss in sets.items() if d is not None for s in ss if s]
    index = collections.defaultdict(list)
    for k, (d, s) in enumerate(flat):
        hits = collections.Counter(e for g in s for e in index[g])
        for e, common in hits.items():
            if 100 * common >= 80 * (len(s) + len(flat[e][1]) - common):
                a, b = sorted((root(d), root(flat[e][0])))
                parent[b] = a
        for g in s:
            index[g].append(k)
    return sorted(((d, len(shingles(t)), None if d is None else root(d)) for d, t in rows), key=repr)


def components_of(df, **options):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(df, **options).collect()), key=repr)


def test_near_duplicates(docs):
    rows = [(d, t) for d, t, _ in rows_of(docs)]
    got = components_of(docs)
    assert got == brute_components(rows)
    assert sum(d != c for d, _, c in got) > 5


def near_copies(seed, groups, size, words):
    rng = random.Random(seed)
    rows, i = [], 0
    for _ in range(groups):
        w = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice(words))]
        for _ in range(size):
            v = list(w)
            for _ in range(rng.randrange(0, 1 + len(w) // 25)):
                v[rng.randrange(len(v))] = f"x{rng.randrange(10**6)}"
            if rng.random() < 0.5:
                v = v[: len(v) - rng.randrange(0, 1 + len(v) // 6)]
            rows.append((i, " ".join(v)))
            i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_of_all_sizes(spark, seed):
    rows = near_copies(seed, 60, 6, [5, 6, 7, 8, 9, 10, 12, 15, 20, 40, 100, 300, 900])
    rows += [(10_000 + k, "one very common passage that many documents of this table share between them all " * 2 + " ".join(f"u{k}x{j}" for j in range(12))) for k in range(60)]
    assert components_of(spark.createDataFrame(rows, "doc_id long, text string")) == brute_components(rows)


def test_a_chain_is_one_component(spark):
    words = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(words[4 * k : 4 * k + 120])) for k in range(40)]
    rows += [(100 + k, rows[0][1]) for k in range(50)]
    got = components_of(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == brute_components(rows) and {c for _, _, c in got} == {0}


def test_no_documents_and_repeated_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert components_of(empty) == []
    rows = [(5, "a b c d e f g"), (5, "p q r s t u v"), (3, "a b c d e f g"), (4, "p q r s t u v"), (2, None), (1, "")]
    got = dict((d, c) for d, _, c in components_of(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == {5: 3, 3: 3, 4: 3, 2: 2, 1: 1}


def links_of(df):
    return {(r.doc_id, r.n_shingles): r.n_links for r in jaccard.jaccard_components(df).collect()}


@pytest.mark.parametrize("block", [256, 7])
def test_every_link_is_counted(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "LINK_SETS", block)
    base = [f"w{k}" for k in range(200)]
    rows = [(k, " ".join([*base[: 200 - k % 5], f"x{k}"])) for k in range(100)] + [(100, " ".join([*base, "x0"])), (101, None)]
    rows += [(d + 1000, t) for d, t in near_copies(3, 20, 6, [8, 20, 100, 300])]
    sets = {d: shingles(t) for d, t in rows}
    want = {(d, len(s)): sum(d != e and bool(s) and 100 * len(s & t) >= 80 * len(s | t) for e, t in sets.items()) for d, s in sets.items()}
    got = links_of(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert got == want and all(got[k, len(sets[k])] == 100 for k in range(101))


def test_texts_of_one_id_have_their_own_links(spark):
    a, b = " ".join(f"a{k}" for k in range(100)), " ".join(f"b{k}" for k in range(100))
    rows = [(5, a), (3, a), (5, b), (4, b + " near"), (5, b + " by far"), (5, ""), (9, "c d e f g"), (9, "p q r s t u v"), (8, "p q r s t u v"), (4, b + " near")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {d: c for d, _, c in components_of(df)} == {3: 3, 4: 3, 5: 3, 9: 8, 8: 8}
    got = collections.Counter((r.doc_id, r.n_shingles, r.n_links) for r in jaccard.jaccard_components(df).collect())
    assert got == {(5, 96, 1): 2, (3, 96, 1): 1, (4, 97, 2): 2, (5, 98, 1): 1, (5, 0, 0): 1, (9, 1, 0): 1, (9, 3, 1): 1, (8, 3, 1): 1}


def folders(spark):
    return {p.name for p in pathlib.Path(shared_dir(spark, "x").removeprefix("file://")).parent.glob("*")}


def test_only_the_result_stays_in_the_shared_folder(spark):
    before = folders(spark)
    df = spark.createDataFrame(near_copies(1, 5, 4, [20, 100]), "doc_id long, text string")
    out = jaccard.jaccard_components(df)
    assert [f.rsplit("-", 1)[0] for f in folders(spark) - before] == ["components"] and out.count() == 20
    discard(out)
    assert folders(spark) == before
    with pytest.raises(AnalysisException, match="no_such_column"):
        jaccard.jaccard_components(df, text="no_such_column")
    with pytest.raises(ZeroDivisionError), scratch(spark) as keep:
        keep(materialize(df, "kept"))
        1 / 0
    assert folders(spark) == before


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(3)
    for _ in range(50):
        common, a, b = (np.unique(rng.integers(0, 1 << 48, n).astype(np.uint64)) for n in (200, 30, 20))
        s, t = np.union1d(common, a), np.union1d(common, b)
        x = np.frombuffer(jaccard.folded(s), np.uint64) ^ np.frombuffer(jaccard.folded(t), np.uint64)
        assert np.bitwise_count(x).sum() <= len(np.setxor1d(s, t))


def test_components_of_paths_and_stars(spark):
    rng = random.Random(4)
    edges = [(k, k + 1) for k in range(0, 30)] + [(100, 100 + k) for k in range(1, 40)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(7, 7)]
    parent = {x: x for e in edges for x in e if e[0] != e[1]}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            lo, hi = sorted((root(a), root(b)))
            parent[hi] = lo
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}


# Language model


@pytest.mark.parametrize(("order", "block_words"), [(1, 10**6), (2, 5000), (3, 20_000)])
def test_backoff(docs, order, block_words):
    rows = rows_of(docs)
    count, n_all = collections.Counter(), 0
    for _, t, _ in rows:
        w = split((t or "").translate(LOWER))
        n_all += len(w)
        for n in range(1, order + 1):
            count.update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    want = collections.Counter()
    for d, t, _ in rows:
        w, s = split((t or "").translate(LOWER)), 0.0
        for i in range(len(w)):
            p = count[(w[i],)] / n_all
            for n in range(2, min(order, i + 1) + 1):
                g = tuple(w[i - n + 1 : i + 1])
                p = count[g] / count[g[:-1]] if count[g] >= 2 else 0.4 * p
            s += math.log10(p)
        want[(d, len(w), round(s, 4))] += 1
    out = backoff.stupid_backoff(docs, order=order, block_words=block_words).collect()
    assert collections.Counter((r.doc_id, r.n_words, round(r.log10_score, 4)) for r in out) == want
    assert all((r.log10_mean is None) == (r.n_words == 0) for r in out)


def test_backoff_of_nothing(docs):
    assert backoff.stupid_backoff(docs.limit(0)).count() == 0
    out = backoff.stupid_backoff(docs.where("doc_id in (9000, 9001)")).collect()
    assert sorted((r.doc_id, r.n_words, r.log10_score, r.log10_mean) for r in out) == [(9000, 0, 0.0, None), (9001, 0, 0.0, None)]


def test_the_query_scores_by_contexts_of_two_words(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "a b c"), (3, "x b d"), (4, "x b d")], "doc_id long, text string")
    got = {r.doc_id: r.log10_score for r in backoff.stupid_backoff(df).collect()}
    assert all(abs(got[k] - math.log10(2 / 12)) < 1e-9 for k in got)  # a word that follows two known ones is certain


def test_backoff_of_equal_blocks(spark):
    df = spark.createDataFrame([(1, "a b c a b"), (2, "b c")], "doc_id long, text string")
    for block_words in (10**6, 1):
        got = backoff.stupid_backoff(df.union(df), block_words=block_words).collect()
        assert sorted(r.doc_id for r in got) == [1, 1, 2, 2]
        assert len({(r.doc_id, r.log10_score) for r in got}) == 2


def test_backoff_of_many_small_parts(spark, docs, tmp_path, monkeypatch):
    """No file of Spark's writers on the way, and no group for each part; the scores don't depend on the parts."""
    want = collections.Counter((r.doc_id, r.n_words, round(r.log10_score, 6)) for r in backoff.stupid_backoff(docs.coalesce(1)).collect())
    folder = lambda spark, label: f"file://{tmp_path}/{label}-{uuid.uuid4().hex}"
    monkeypatch.setattr(backoff, "shared_dir", folder)
    monkeypatch.setattr(store, "shared_dir", folder)
    out = backoff.stupid_backoff(docs.repartition(40))
    assert not list(tmp_path.rglob("part-*"))
    rows = out.withColumn("part", F.spark_partition_id()).collect()
    assert collections.Counter((r.doc_id, r.n_words, round(r.log10_score, 6)) for r in rows) == want
    assert len({r.part for r in rows}) == 1


def test_gathered_rows_leave_no_shuffle_files(spark):
    files = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    before = files()
    assert sorted(r.k for r in store.gather(df)) == list(range(7))
    assert files() <= before


def test_blocks_are_put_together_up_to_a_bound():
    assert backoff.together([("a", 3), ("b", 2), ("c", 1), ("d", 9), ("e", 0), ("f", 5)], 5) == [["a", "b"], ["c"], ["d"], ["e", "f"]]
    assert backoff.together([], 5) == []


# Decontamination


def benchmark_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_contamination(rows, items):
    windows = collections.defaultdict(set)
    for i, t in items:
        w = benchmark_words(t)
        if i is not None and w:
            for k in range(max(1, len(w) - 12)):
                windows[tuple(w[k : k + 13])].add(i)
    out = []
    for d, t in rows:
        w = benchmark_words(t)
        hit, found = set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                g = tuple(w[k : k + size])
                if g in windows:
                    hit.update(range(k, k + size))
                    found |= windows[g]
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def test_decontamination(spark, docs):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    odd = spark.createDataFrame([(None, "the of"), (900, None), (901, ""), (902, "few WORDS"), (902, "b c d"), (903, "x1"), (904, "few words"), (905, "a b a b a b")], "item_id long, text string")
    items = bench.union(odd).withColumn("n_words", F.lit(1))
    want = brute_contamination([(d, t) for d, t, _ in rows_of(docs)], [(r.item_id, r.text) for r in items.collect()])
    for words in (10**6, 100):
        out = decontamination.contamination(docs, items, block_words=words)
        got = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in out.collect()), key=repr)
        assert got == want
    assert any(r[-1] for r in want) and set(docs.columns) <= set(out.columns)
    named = items.select(F.concat(F.lit("x"), F.col("item_id").cast("string")).alias("item_id"), "text")
    want = brute_contamination([(d, t) for d, t, _ in rows_of(docs)], [(r.item_id, r.text) for r in named.collect()])
    for words in (10**6, 100):
        got = decontamination.contamination(docs, named, block_words=words).select("doc_id", *decontamination.RESULTS)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_decontamination_without_items_or_documents(docs, spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contamination(docs, items).where("contaminated or n_hit > 0").count() == 0
    assert decontamination.contamination(docs.limit(0), spark.createDataFrame([(1, "few words")], "item_id long, text string")).count() == 0


# Personal data


def luhn(number):
    d = [int(c) for c in number if c.isdigit()][::-1]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


TEXTS = [
    "Card 4539148803436467, again 4539 1488 0343 6467; not a card 4539148803436468 or 12345.",
    "On 2024-02-29, 31/12/1999, 30.02.2001 and 2023/07/04 at 10.20.30.40, 999.1.1.1 or 1.2.3.4.5",
    "Call +1 (212) 555-1234 or 212-555-1234, write jane.Doe99@mail.example.com; 078-05-1120, 000-12-3456",
    'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"###',
    "Nothing private: version 4.0, 12 apples, a@b",
    "@" * 5000 + "9" * 5000 + "a." * 3000,
    "",
    None,
]


@pytest.fixture(scope="module")
def private(spark):
    return spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], 1), (None, TEXTS[0], 1)], "doc_id long, text string, pii int")


def test_pseudonyms(private):
    out = pii.pseudonymise(private, "key").collect()
    by = {r.doc_id: r for r in out}
    values = {v.value: (v.kind, v.pseudonym) for r in out for v in r.pii}
    kinds = {k: v[0] for k, v in values.items()}
    assert kinds == {
        "4539148803436467": "card", "4539 1488 0343 6467": "card", "2024-02-29": "date", "31/12/1999": "date", "2023/07/04": "date", "10.20.30.40": "address",
        "+1 (212) 555-1234": "phone", "212-555-1234": "phone", "jane.Doe99@mail.example.com": "email", "078-05-1120": "ssn", "04dbebab91ab85687d33eeaaf9ac699e1188f962": "secret",
    }
    shape = lambda x: re.sub("[0-9]", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", x)))
    for value, (kind, new) in values.items():
        assert new != value
        if kind not in ("address", "secret"):
            assert shape(new) == shape(value)
        if kind == "card":
            assert luhn(new)
    digits = lambda x: re.sub("[^0-9]", "", x)
    assert digits(values["4539148803436467"][1]) == digits(values["4539 1488 0343 6467"][1])
    assert digits(values["+1 (212) 555-1234"][1])[-10:] == digits(values["212-555-1234"][1])
    assert by[4].text == TEXTS[4] and by[6].text == "" and by[7].text is None and by[7].pii == []
    assert "30.02.2001" in by[1].text and "999.1.1.1" in by[1].text and "4539148803436468" in by[0].text
    assert [r.text for r in out if r.doc_id == 0] == [by[0].text] * 2 == [r.text for r in out if r.doc_id is None] * 2


def test_values_that_end_oddly_or_are_written_otherwise(spark):
    mails = ["jane@example.com-based", "jane@example.com--", "jane@example.com- x", "jane@example.com.1", "jane@mail.example.com-based.org now"]
    days = [f"{m:02}/{d:02}/{y}" for y in (1800, 1900, 1999, 2000, 2199) for m in range(1, 13) for d in range(13, 32)]
    valid = [x for x in days if not (x[:5] in ("02/30", "02/31") or x[:5] == "02/29" and x[6:] != "2000" or x[3:5] == "31" and x[:2] in ("04", "06", "09", "11"))]
    secrets = ["9233A8EC" * 5, "9233A8ec" * 5]
    df = spark.createDataFrame(list(enumerate(mails + days + secrets)), "doc_id long, text string")
    there = pii.pseudonymise(df, "key")
    out = {r.doc_id: r for r in there.collect()}
    found = [v.value for k in range(len(mails)) for v in out[k].pii]
    assert found == ["jane@example.com"] * 4 + ["jane@mail.example.com-based.org"] and not any("jane" in out[k].text for k in range(len(mails)))
    dates = {v.value: v.pseudonym for r in out.values() for v in r.pii if v.kind == "date"}
    assert set(dates) == set(valid) and len(set(dates.values())) == len(valid)
    assert all(re.fullmatch(r"(0[1-9]|1[0-2])/(1[3-9]|2[0-9]|3[01])/(1[89]|2[01])[0-9]{2}", x) for x in dates.values())
    assert [v.kind for k in (-2, -1) for v in out[len(out) + k].pii] == ["secret"] * 2 and re.fullmatch("[0-9A-F]{40}", out[len(out) - 2].text)
    back = pii.pseudonymise(there.select("doc_id", "text"), "key", sign=-1)
    assert sorted(back.select("doc_id", "text").collect()) == sorted(df.collect())


def test_values_of_other_countries(spark):
    """IBANs (check digits by plain arithmetic), telephone numbers, IPv6, names beyond ASCII, days of one digit."""
    rows = {
        "iban": ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "FR14 2004 1010 0505 0001 3M02 606"],
        "phone": ["+44 20 7946 0958", "+33 1 23 45 67 89", "01 23 45 67 89", "+442079460958"],
        "address6": ["2001:db8::8a2e:370:7334", "2001:0DB8:85A3:0000:0000:8A2E:0370:7334"],
        "email": ["jané@example.com"],
        "date": ["3.7.2021", "7/25/2021", "12/31/1999"],
    }
    flat = [(k, v) for k, vs in rows.items() for v in vs]
    clean = ["DE89 3704 0044 0532 0130 01", "std::add 12:30:45 a::b::c", "31.31.2021 99/99/2021", "version 1.2.3 +1"]
    df = spark.createDataFrame([(k, f"see {v}, please") for k, (_, v) in enumerate(flat)] + [(100 + k, t) for k, t in enumerate(clean)], "doc_id long, text string")
    out = pii.pseudonymise(df, "key")
    got = {r.doc_id: r for r in out.collect()}
    for k, (kind, v) in enumerate(flat):
        (found,) = got[k].pii
        assert (found.kind, found.value) == (kind, v) and found.pseudonym != v, (v, found)
        assert got[k].text == f"see {found.pseudonym}, please"
        if kind != "date":
            assert [c.isdigit() for c in found.pseudonym] == [c.isdigit() for c in v] or kind == "address6"
            assert len(found.pseudonym) == len(v)
        if kind == "iban":
            plain = found.pseudonym.replace(" ", "")
            assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1 and plain[:2] == v[:2]
    assert all(got[100 + k].text == t for k, t in enumerate(clean))
    back = {r.doc_id: r.text for r in pii.pseudonymise(out, "key", sign=-1).collect()}
    assert all(back[k] == f"see {v}, please" for k, (kind, v) in enumerate(flat) if kind != "date")
    assert digits_of(got[3 + 0].pii[0].pseudonym)[2:] == digits_of(got[6].pii[0].pseudonym)[2:]  # written otherwise, the same


def digits_of(text):
    return re.sub("[^0-9]", "", text)


def test_pseudonyms_can_be_inverted(private, docs):
    for df in (private.select("doc_id", "text"), docs.select("doc_id", "text")):
        there = pii.pseudonymise(df, "key")
        back = pii.pseudonymise(there.select("doc_id", "text"), "key", sign=-1)
        assert sorted((r.text or "" for r in back.collect())) == sorted((r.text or "" for r in df.collect()))
        other = pii.pseudonymise(df, "other key")
        assert sorted(r.text or "" for r in other.collect()) != sorted(r.text or "" for r in there.collect())


def test_numbers_are_permuted(spark):
    df = spark.range(7 * 11).select((F.col("id") % 7).alias("a"), F.floor(F.col("id") / 7).alias("b"))
    out = df.select(pii.feistel_numbers(F.col("a"), F.col("b"), (7, 11), "k", "t").alias("s")).select("s.l", "s.r")
    assert out.distinct().count() == 77 and out.where("l >= 7 or r >= 11 or l < 0 or r < 0").count() == 0


def test_pseudonyms_of_nothing(private):
    assert pii.pseudonymise(private.limit(0), "key").count() == 0
