"""Host rules, ranked search and phrase mining against brute force in plain Python, and on odd rows."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratamart.llm import host_rules, phrases, ranked
from stratamart.llm.queries import queries
from stratamart.sources.listings import read_table
from tests.llm.test_queries import SF_DIR

DOCS = "doc_id long, text string, lang string, source string, host string, host_key string, n_words int, docs int, _doc int, n int, terms string, block int, words int, `a.b` int"
MORE = ("h", "k", 1, 2, 3, 4, "t", 5, 6, 7)
SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    """(doc_id, text, lang, source) with columns that clash with the operators' own."""
    return spark.createDataFrame([(*r, *MORE) for r in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    long = "one two. Three four, five six\nseven eight; " * 8_000
    texts = [None, "", "   \n\t ", "a", "a b c a b c", "a b c a b c", "é ü x\x0by\x00z", "x\ny\nx\n\nx\n \n", "AbC ÀÉ 1,2 a_b", long, "#$ % && <x>" * 20, "w " * 60]
    rows = [(i, t, ["en", None, "und", "fr"][i % 4], ["s", None, "t"][i % 3]) for i, t in enumerate(texts)]
    return rows + [(4, "a b c a b c", "en", "s"), (None, "a b c", None, None), (None, "a b c", None, None)]


def plain_signals(text):
    words = SPACES.findall(text or "")
    lines = [line for line in (text or "").split("\n") if SPACES.search(line)]
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {i + step for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for step in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines), len(lines) - len(set(lines)), len(repeated))


def test_signals(spark, odd):
    got = host_rules.signals(frame(spark, odd), F.col("source")).collect()
    assert Counter(tuple(r) for r in got) == Counter((d, s, *plain_signals(t)) for d, t, _, s in odd)


def test_signals_of_given_documents(spark):
    docs = read_table(spark, SF_DIR, "documents")
    got = {r["doc_id"]: tuple(r)[2:] for r in host_rules.signals(docs, F.col("source")).collect()}
    assert got == {r["doc_id"]: plain_signals(r["text"]) for r in docs.collect()}


def test_windows_are_compared_themselves():
    """Equal windows in one row are found whatever else there is, and only these."""
    random = np.random.default_rng(1)
    rows, words = np.sort(random.integers(0, 5, 400)), random.integers(0, 4, 400)
    seen = Counter((rows[i], *words[i:i + 3]) for i in range(398) if rows[i] == rows[i + 2])
    want = {i + step for i in range(398) if rows[i] == rows[i + 2] and seen[(rows[i], *words[i:i + 3])] > 1 for step in range(3)}
    assert set(np.flatnonzero(host_rules._repeated(rows, words)).tolist()) == want


def plain_rates(measured):
    """rule -> host -> shrunk rate, from rows of (host, failed by rule)."""
    rates = {}
    for i, rule in enumerate(host_rules.RULES):
        hosts = defaultdict(lambda: [0, 0])
        for host, fails in measured:
            hosts[host][0] += 1
            hosts[host][1] += fails[i]
        n, k = (sum(v[j] for v in hosts.values()) for j in (0, 1))
        mean, free = k / n, len(hosts) - 1
        room = n - sum(v[0] ** 2 for v in hosts.values()) / n - free
        alike = 0.0
        if room > 0 and 0 < mean < 1:
            spread = sum(v[0] * (v[1] / v[0] - mean) ** 2 for v in hosts.values())
            alike = min((spread / (mean * (1 - mean)) - free) / room, 1 - 1e-9)
        for host, (docs, failed) in hosts.items():
            strength = 1 / alike - 1 if alike > 0 else None
            rates[rule, host] = mean if strength is None else (failed + mean * strength) / (docs + strength)
    return rates


def test_hosts(spark):
    """Bad hosts of many documents are condemned, one bad document of a small host condemns nobody, a hot host is judged by its own."""
    clean, bad = " ".join(f"word{i} again{i}" for i in range(60)), " ".join(f"wrd{i}#$ vrd{i}%" for i in range(60))
    rows = [(i, clean, "en", f"good{i % 12}") for i in range(240)] + [(1000 + i, bad, "en", f"bad{i % 2}") for i in range(40)]
    rows += [(2000 + i, clean, "en", "hot") for i in range(200)] + [(3000, bad, "en", "small"), (3001, clean, "en", None), (3002, clean, "en", "bad0"), (3003, "short", "en", "hot")]
    docs = frame(spark, rows)
    got = {r["doc_id"]: (r["base_failed"], r["host_failed"], r["kept"]) for r in host_rules.judge(docs, F.col("source")).collect()}
    assert len(got) == len(rows)
    assert all(got[d] == (False, False, True) for d in [*range(240), *range(2000, 2200), 3001])
    assert all(got[1000 + i] == (False, True, False) for i in range(40)) and got[3002] == (False, True, False)
    assert got[3003] == (True, False, False)
    measured = host_rules.signals(docs, F.col("source"))
    tested = measured.select("host", *[F.expr(t).alias(r) for r, t in host_rules.RULES.items()]).collect()
    want = plain_rates([("null" if r["host"] is None else "=" + r["host"], tuple(r)[1:]) for r in tested])
    found = {(r["rule"], r["host_key"]): r["rate"] for r in host_rules.host_rates(measured).collect()}
    assert found.keys() == want.keys() and all(abs(found[k] - want[k]) < 1e-6 for k in want)
    # A host seen once is drawn to the others, whose documents fail less.
    assert found["symbols", "=small"] < 1 and found["symbols", "=bad0"] > 0.5


def test_hosts_on_odd_rows(spark, odd):
    got = host_rules.judge(frame(spark, odd), F.col("source"))
    assert Counter(r["doc_id"] for r in got.collect()) == Counter(d for d, *_ in odd)
    assert host_rules.judge(frame(spark, []), F.col("source")).collect() == []
    alone = host_rules.judge(frame(spark, [(1, "w " * 60, "en", "only")]), F.col("source")).collect()
    assert [(r["host_failed"], r["kept"]) for r in alone] == [(True, False)]  # the common rate is this host's own


def plain_terms(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain_ranking(docs, items, k):
    held = [(d, Counter(plain_terms(t))) for d, t in docs]
    n = sum(bool(c) for _, c in held)
    total = sum(sum(c.values()) for _, c in held)
    df = Counter(term for _, c in held for term in c)
    weight = {term: math.floor(1000 * math.log((2 * n + 2) / (2 * f + 1))) for term, f in df.items()}
    out = []
    for item, text in items:
        scores = []
        for doc, counts in held:
            m = 100 - 25 + 25 * sum(counts.values()) * n // max(total, 1)
            score = sum(weight[t] * (10**9 * counts[t] // (1000 * counts[t] + 12 * m)) for t in plain_terms(text) if t in counts)
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(scores)[:k], 1)]
    return out


@pytest.mark.parametrize("shard, step", [(1 << 14, 128), (7, 2)])
def test_ranked_search(spark, monkeypatch, shard, step):
    monkeypatch.setattr(ranked, "SHARD_DOCS", shard)
    monkeypatch.setattr(ranked, "STEP", step)
    docs, items = read_table(spark, SF_DIR, "documents"), read_table(spark, SF_DIR, "benchmark")
    plain = plain_ranking(*([tuple(r) for r in t.select(i, "text").collect()] for t, i in ((docs, "doc_id"), (items, "item_id"))), 20)
    assert sorted(tuple(r) for r in queries()["op12_ranked_search"](spark, SF_DIR).collect()) == sorted(plain)


def test_shards_prune(spark):
    """The bounds leave most documents unopened, and ties go to the smaller id."""
    random = np.random.default_rng(5)
    docs, terms = np.arange(5_000) * 3, 30
    lists, numbers = (random.integers(0, n, 60_000) for n in (5_000, terms))
    pairs = np.unique(lists * terms + numbers)
    impacts = random.integers(1, 9, len(pairs))
    shard = ranked.Shard(docs, pairs // terms, pairs % terms, impacts)
    opened = []
    places = shard.places
    shard.places = lambda t, d: (opened.append(len(d)), places(t, d))[1]
    wanted, weights = np.array([1, 4, 9, 20]), np.array([9, 3, 50, 1])
    empty = np.zeros(0, dtype=np.int64)
    scores, found = shard.search(wanted, weights, 20, empty, empty)
    dense = np.zeros((5_000, terms), dtype=np.int64)
    dense[pairs // terms, pairs % terms] = impacts
    every = dense[:, wanted] @ weights
    want = sorted((-int(s), int(d)) for s, d in zip(every, docs))[:20]
    assert list(zip((-scores).tolist(), found.tolist())) == want
    assert sum(opened) < 2_500


def test_search_on_odd_rows(spark, odd, monkeypatch):
    items = [(1, "abc a b"), (1, "abc a b"), (2, None), (3, ""), (4, "nowhere"), (None, "c"), (5, "one one three"), (6, "z y Ü x")]
    queries_ = spark.createDataFrame([(*r, 1, 2, "x") for r in items], "item_id long, text string, _query int, _id int, term string")
    found = lambda: Counter(tuple(r) for r in ranked.search(frame(spark, odd), queries_, 3).collect())
    want = Counter(plain_ranking([r[:2] for r in odd], items, 3))
    assert found() == want
    monkeypatch.setattr(ranked, "BLOCK_TERMS", 4)  # several blocks of queries
    assert found() == want
    assert ranked.search(frame(spark, []), queries_).collect() == [] == ranked.search(frame(spark, odd), queries_.limit(0)).collect()


def plain_phrases(docs, least, longest=5):
    counts, n = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = set()
    for lang, f in counts.items():
        many = {p: a for p, a in f.items() if a >= least}
        inside = {p[i:i + j] for p, a in many.items() for j in range(1, len(p)) for i in range(len(p) - j + 1) if a >= many[p[i:i + j]]}
        for p, a in many.items():
            if len(p) > 1 and p not in inside:
                score, _, l, r = min((1000 * a * n[lang] // (many[p[:k]] * many[p[k:]]), k, many[p[:k]], many[p[k:]]) for k in range(1, len(p)))
                out.add((lang, " ".join(p), len(p), a, l, r, n[lang], score))
    return out


@pytest.mark.parametrize("least, block", [(100, 1 << 18), (5, 500), (2, 64)])
def test_phrases(spark, least, block):
    docs = read_table(spark, SF_DIR, "documents")
    if least == 2:
        docs = docs.where("length(text) < 400")
    want = plain_phrases([tuple(r) for r in docs.select("text", "lang").collect()], least)
    got = [tuple(r) for r in phrases.mine(docs, least, block_words=block).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_best_phrases(spark):
    mined = spark.createDataFrame([("en", "b", 5, 9), ("en", "a", 5, 9), ("en", "é", 5, 10), ("en", "c", 4, 90), ("fr", "x", 1, 1)], "lang string, phrase string, a long, score long")
    got = [(r["lang"], r["rank"], r["phrase"]) for r in phrases.best(mined, 3).collect()]
    assert sorted(got) == [("en", 1, "c"), ("en", 2, "é"), ("en", 3, "a"), ("fr", 1, "x")]


def test_phrases_on_odd_rows(spark, odd):
    for least in (1, 2):
        got = Counter(tuple(r) for r in phrases.mine(frame(spark, odd), least).collect())
        assert got == Counter(plain_phrases([(t, lang) for _, t, lang, _ in odd], least))
    assert phrases.mine(frame(spark, []), 1).collect() == [] == phrases.mine(frame(spark, odd[:3]), 1).collect()


def test_packed_numbers():
    values = [np.array([], dtype=np.int32), np.array([2**40, 0, 5]), np.arange(300, dtype=np.uint8)]
    back = phrases.unpack(phrases.pack(*values))
    assert [b.dtype for b in back] == [v.dtype for v in values] and all((a == b).all() for a, b in zip(values, back))
