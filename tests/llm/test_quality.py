"""Quality rules and language identification against plain Python."""

import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docloom.llm import language, quality
from tests.llm.conftest import ROWS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_of(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    n = len(words)
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": n < 10 or 100 * len(covered) > 20 * n,
    }


def buckets_of(text, n=quality.BUCKETS):
    numbers = [zlib.crc32(w.encode()) for w in WORD.findall(text or "")]
    return [h % n for h in numbers] + [(a * quality.PAIR + b) % n for a, b in zip(numbers, numbers[1:])]


def rated(docs, trusted, threshold=quality.THRESHOLD):
    raw, good = Counter(), Counter()
    for doc, text in docs:
        raw.update(buckets_of(text))
        if doc in trusted:
            good.update(buckets_of(text))
    n_raw, n_good = (sum(c.values()) + quality.BUCKETS for c in (raw, good))
    weight = [round(1000 * math.log((good[b] + 1) * n_raw / ((raw[b] + 1) * n_good))) for b in range(quality.BUCKETS)]
    out = []
    for doc, text in docs:
        grams, base = buckets_of(text), base_of(text)
        score = sum(weight[b] for b in grams)
        kept = not base["base_failed"] and score >= threshold * len(grams)
        out.append((doc, *base.values(), len(grams), score, kept))
    return out


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_grams", "score", "kept"]


def rows_of(df):
    return sorted((tuple(r[c] for c in ["doc_id", *COLUMNS]) for r in df.collect()), key=repr)


def test_quality_equals_brute_force(spark, sample, texts):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").where("quality = 1")
    trusted = {r["doc_id"] for r in labels.collect()}
    got = rows_of(quality.rated(sample, quality.trusted_ids(labels)))
    assert got == sorted(rated(list(texts.items()), trusted), key=repr)
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)


def test_quality_awkward_rows(spark, awkward):
    trusted = spark.createDataFrame([(1,), (1,), (None,)], "doc_id bigint")
    got = rows_of(quality.rated(awkward, quality.trusted_ids(trusted)))
    assert got == sorted(rated([(r[0], r[1]) for r in ROWS], {1}), key=repr)
    assert quality.rated(awkward.limit(0), quality.trusted_ids(trusted)).count() == 0
    none = quality.trusted_ids(trusted.limit(0))
    assert rows_of(quality.rated(awkward, none)) == sorted(rated([(r[0], r[1]) for r in ROWS], set()), key=repr)


def test_trusted_ids_are_bounded(spark):
    labels = spark.range(50_000).withColumnRenamed("id", "doc_id")
    assert quality.trusted_ids(labels).count() == 50_000
    assert abs(quality.trusted_ids(labels, most=5_000).count() - 5_000) < 500


def test_all_trusted_ids_count(spark, sample, monkeypatch):
    labels = spark.range(300_000).withColumnRenamed("id", "doc_id")
    assert quality.trusted_ids(labels).count() == 300_000
    trusted = sample.select("doc_id").where("doc_id % 3 = 0")
    weights = quality.weights(sample, trusted)
    monkeypatch.setattr(quality, "broadcast_if_small", lambda df: df.hint("merge"))
    assert quality.weights(sample, trusted) == weights


def test_quality_runs_without_python(sample, spark):
    plan = quality.rated(sample, sample.select("doc_id"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_text_alone_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = language.fit(docs.where("doc_id % 2 = 0"), "lang")
    held_out = docs.where("doc_id % 2 = 1")
    got = language.identify(held_out, model).join(held_out.withColumnRenamed("lang", "own").drop("text"), "doc_id")
    row = got.agg(F.avg((F.col("lang") == F.col("own")).cast("int")).alias("right"), F.count("*").alias("n")).first()
    assert row["n"] == held_out.count() and row["right"] > 0.99


def fused(model, rows):
    """The fusion in plain Python: rows of (text, declared, suffix, host, domain)."""
    k = len(model.languages)
    text = language.likelihoods(model, [r[0] or "" for r in rows]).tolist()

    def soft(s):
        e = [math.exp(x - max(s)) for x in s]
        return [x / sum(e) for x in e]

    share = [[math.floor(1000 * p + 0.5) for p in soft(t)] for t in text]

    def sums(pick):
        out = {}
        for r, s in zip(rows, share):
            if (key := pick(r)) is not None:
                n, c = out.setdefault(key, [0, [0] * k])
                out[key] = [n + 1, [x + y for x, y in zip(c, s)]]
        return out

    def smooth(counts, n, parent):
        return [(c / 1000 + language.STRENGTH * p) / (n + language.STRENGTH) for c, p in zip(counts, parent)]

    total = [sum(s[i] for s in share) / 1000 for i in range(k)]
    root = [(t + language.STRENGTH / k) / (sum(total) + language.STRENGTH) for t in total]
    place = {x: i for i, x in enumerate(model.languages)}
    said = sums(lambda r: place.get(r[1].split("-")[0].lower(), k) if r[1] else None)
    heard = [sum(c[i] for _, c in said.values()) / 1000 for i in range(k)]
    suffixes, hosts = sums(lambda r: r[2]), sums(lambda r: (r[3], r[4]) if r[3] else None)
    domains = sums(lambda r: r[4] if r[3] else None)
    n_suffix = sum(n for n, _ in suffixes.values())
    of = [sum(c[i] for _, c in suffixes.values()) / 1000 for i in range(k)]
    out = []
    for r, t, s in zip(rows, text, share):
        score = list(t)
        if r[1]:
            d = place.get(r[1].split("-")[0].lower(), k)
            count = said[d][1]
            score = [x + math.log((c / 1000 + language.SMOOTH) / (h + language.SMOOTH * (k + 1))) for x, c, h in zip(score, count, heard)]
        if r[2]:
            n, c = suffixes[r[2]]
            e = n / n_suffix
            score = [x + math.log((y / 1000 + language.STRENGTH * e) / ((o + language.STRENGTH) * e)) for x, y, o in zip(score, c, of)]
        prior = root
        if r[3]:
            if r[4]:
                prior = smooth(domains[r[4]][1], domains[r[4]][0], root)
            n, c = hosts[r[3], r[4]]
            prior = smooth([x - y for x, y in zip(c, s)], n - 1, prior)
        out.append(soft([x + math.log(p) for x, p in zip(score, prior)]))
    return out


def test_fusion_equals_plain_python(spark, sample):
    model = language.fit(sample, "lang")
    pages = [r["text"] for r in sample.orderBy("doc_id").limit(40).collect()]
    rows = [
        (t[: 5 + 3 * i] if i % 5 else "ab", ["en", "de-DE", "xx", None, ""][i % 5], [None, "de", "fr"][i % 3],
         [None, "h1", "h2", "h1"][i % 4], [None, "d1"][i % 2])
        for i, t in enumerate(pages)
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "doc_id int, text string, declared string, suffix string, host string, domain string")
    got = language.identify(df, model, F.col("declared"), F.col("suffix"), F.col("host"), F.col("domain"))
    found = {r["doc_id"]: r for r in got.collect()}
    for i, p in enumerate(fused(model, rows)):
        known = p[:-1] if 1 - p[-1] >= 0.5 else p[-1:]
        assert found[i]["probability"] == pytest.approx(max(known), abs=2e-6)
        assert found[i]["kept"] == (len(known) > 1)
        if sorted(p)[-1] - sorted(p)[-2] > 1e-6:
            assert found[i]["lang"] == model.languages[p.index(max(known))]


def test_evidence_decides_short_texts(spark, sample):
    model = language.fit(sample, "lang")
    rows = [(i, "ab", "de", "host-de") for i in range(30)] + [(99, "ab", None, "host-de"), (100, "ab", "fr", None)]
    long = [(200 + i, r["text"], r["lang"], "host-" + r["lang"]) for i, r in enumerate(sample.collect())]
    df = spark.createDataFrame(rows + long, "doc_id int, text string, declared string, host string")
    got = {r["doc_id"]: r["lang"] for r in language.identify(df, model, F.col("declared"), host=F.col("host")).collect()}
    assert got[0] == "de" and got[100] == "fr"


def test_language_awkward_rows(awkward):
    got = language.of_documents(awkward).collect()
    assert len(got) == len(ROWS)
    assert all(not r["kept"] and r["lang"] == "und" for r in got if r["doc_id"] in (3, 4, 5))
    left = language.keep_known(awkward)
    assert left.columns == awkward.columns and 0 < left.count() < len(ROWS)
    assert language.of_documents(awkward.limit(0)).count() == 0


def test_numbers_and_addresses_are_no_evidence(spark, sample):
    model = language.fit(sample, "lang")
    rows = [
        (1, "With +1 (807) 555-5623 of qxz.06@mail4.example.com the 39.73.140.133 and.", "en"),
        (2, "das 4045650754681188 +1 (227) 555-6608 xk.70@mail5.example.com", "de"),
        (3, "это текст на русском языке и он не подходит", None),
        (4, "a1 b2 c3", "fr"),
        (5, "12 34 !!", "fr"),
    ]
    df = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    got = {r["doc_id"]: (r["lang"], r["kept"]) for r in language.identify(df, model, F.col("lang")).collect()}
    assert got[1] == ("en", True) and got[2][1] and got[4][1]
    assert got[3] == ("und", False) and got[5] == ("und", False)


def test_rare_and_many_labels_are_languages(spark, sample):
    rare = [(10**6 + i, "это текст на русском языке и он подходит", "ru") for i in range(3)]
    many = [(2 * 10**6 + i, f"word{'abcdefghij'[i % 10]}", f"x{i:03d}") for i in range(250)]
    rows = spark.createDataFrame(rare, "doc_id bigint, text string, lang string")
    often = sample.select("doc_id", "text", "lang").where("lang = 'en'").crossJoin(spark.range(60).withColumnRenamed("id", "n"))
    often = often.select((F.col("doc_id") * 60 + F.col("n")).alias("doc_id"), "text", "lang")
    docs = often.unionByName(rows)
    model = language.fit(docs, "lang", rows=200)
    assert model.languages == ["en", "ru", "und"]
    got = language.identify(rows, model, F.col("lang")).collect()
    assert len(got) == 3 and all(r["lang"] == "ru" and r["kept"] for r in got)
    model = language.fit(docs.unionByName(spark.createDataFrame(many, docs.schema)), "lang", rows=200)
    assert len(model.languages) == 253


def test_rows_per_label():
    assert language.rows_per_label([300, 10**6, 5 * 10**6], 20_000) == 9_850
    assert language.rows_per_label([300, 20], 20_000) == 300
    assert language.rows_per_label([10**6] * 1000, 20_000) == 100
    assert language.rows_per_label([], 20_000) == 100


def test_clean_documents_stay(sample):
    assert language.keep_known(sample).count() == sample.count()
