"""Lexical search, tokenizer alignment and quality rules against brute force; odd rows of every kind."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from veriframe.llm import alignment, lexical, quality

ODD = [None, "", " \n\t", "é😀 \x00x ▁ <s> <|endoftext|>", "word " * 30_000, "same line of text here\nsame line of text here", "x" * 40_000, "a a a a\n a a a a\n\n"]
NAMES = "text_key string, windows int, rank int, n_a string, row string, score double, rows int, kept string, _text_key int"


def with_names(spark, rows, more="lang string"):
    """Rows with columns named after working and result columns."""
    return spark.createDataFrame([(*r, "u", 1, 2, "v", "w", 3.0, 4, "x", 5) for r in rows], f"doc_id long, text string, {more}, {NAMES}")


@pytest.fixture
def odd(spark):
    return with_names(spark, [(k, t, "en") for k, t in enumerate(ODD)] + [(5, ODD[5], "en"), (None, "no id", None), (None, None, None)])


# lexical search

def ranked(docs, items, k):
    split = {n: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for n, (_, t) in enumerate(docs)}
    n_docs, n_terms = sum(1 for s in split.values() if s), sum(map(len, split.values()))
    df = Counter(t for s in split.values() for t in set(s))
    out = []
    for item, text in items:
        wanted = set(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
        found = []
        for n, (doc, _) in enumerate(docs):
            tf = Counter(split[n])
            m = 100 - 90 + 90 * len(split[n]) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m)) for t in wanted if tf[t])
            if score > 0 and doc is not None:
                found.append((-score, doc))
        out += [(item, rank, doc, -score) for rank, (score, doc) in enumerate(sorted(found)[:k], 1)]
    return out


def test_search_equals_brute_force(spark):
    draw = random.Random(3)
    words = [f"W{k}" for k in range(60)]
    pick = lambda n: " ".join(draw.choices(words, [1 / (k + 1) for k in range(60)], k=n))
    docs = [(k, pick(draw.randint(0, 60))) for k in range(300)]
    docs += [(900 + k, docs[7][1]) for k in range(80)] + [(400, "É-W1_w2 ß"), (401, None), (None, "w1 w2 w59")]  # copies tie, ids decide
    items = [(k, pick(12)) for k in range(12)] + [(50, None), (51, "é ?"), (52, "nowhere"), (53, "W1 w1")]
    found = lexical.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(tuple(r) for r in found.select("item_id", "rank", "doc_id", "score").collect()) == sorted(ranked(docs, items, 10))


@pytest.mark.parametrize("leaf", [1, 2, 7])
def test_small_leaves_lose_nothing(monkeypatch, leaf):
    import numpy as np

    monkeypatch.setattr(lexical, "LEAF", leaf)
    draw = np.random.default_rng(leaf)
    tf = (draw.random((120, 15)) < np.linspace(0.9, 0.1, 15)) * draw.integers(1, 5, (120, 15))
    tf[40:60] = tf[40]
    tf[0] = 0
    m = draw.integers(10, 200, 120)
    paths = [np.flatnonzero(row) for row in tf]
    tree = lexical.Tree(paths, [row[p] for row, p in zip(tf, paths)], m, np.arange(120), 15)
    for node, kids in enumerate(tree.children):
        if kids is not None:
            assert [tree.low[k] for k in kids] + [tree.high[node]] == [tree.low[node]] + [tree.high[k] for k in kids]
        else:
            assert tree.high[node] - tree.low[node] <= leaf
    for _ in range(20):
        columns = np.sort(draw.choice(15, 4, replace=False))
        weights = draw.integers(0, 5000, 4)
        slow = sorted((-int(sum(w * (10**9 * int(t) // (1000 * int(t) + 8 * int(m[d]))) for w, t in zip(weights, tf[d, columns]))), d) for d in range(120))
        assert tree.search(columns, weights, [], 10) == [s for s in slow if s[0] < 0][:10]


def test_search_takes_odd_rows(spark, odd):
    items = spark.createDataFrame([(1, "Word x"), (1, "Word x"), (None, "word"), (2, None), (3, "no such term but same")], "item_id long, text string")
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    expected = ranked(docs, [(1, "Word x"), (3, "no such term but same")], 10)
    found = lexical.search(odd, items)
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected)
    for left, right in ((odd.limit(0), items), (odd, items.limit(0))):
        empty = lexical.search(left, right)
        assert empty.count() == 0 and empty.columns == ["item_id", "rank", "doc_id", "score"]


# alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def aligned(rows):
    """Token by token, pair by pair."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    alphabet = alignment._byte_alphabet()
    held, counts = [], Counter()
    for _, text in rows:
        left = right = []
        if text:
            left, right = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            x = [bytes(alphabet[c] for c in a.id_to_token(k)) for k in left]
            y = [bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode() for k in right]
            if not b"".join(x) == b"".join(y) == (" " + text).encode():
                left = right = []
        links, groups, i, j, pa_, pb = [], [], 0, 0, 0, 0
        ga, gb = [], []
        if left:
            ea, eb = pa_ + len(x[0]), pb + len(y[0])
            ga, gb = [left[0]], [right[0]]
            while True:
                links.append((left[i], right[j]))
                if ea == eb:
                    groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
                    i, j = i + 1, j + 1
                    if i == len(left):
                        break
                    ga, gb = [left[i]], [right[j]]
                    ea, eb = ea + len(x[i]), eb + len(y[j])
                elif ea < eb:
                    i += 1
                    ga.append(left[i])
                    ea += len(x[i])
                else:
                    j += 1
                    gb.append(right[j])
                    eb += len(y[j])
        held.append((left, right, links, groups))
        counts.update(set(links))
    most = defaultdict(int)
    for (k, _), n in counts.items():
        most[k] = max(most[k], n)
    return [(doc, len(l), len(r), len(g), len(links), sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links), ";".join(g))
            for (doc, _), (l, r, links, g) in zip(rows, held)]


def test_alignment_equals_token_by_token(spark, sf, odd):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    rows += [(500 + k, rows[3][1]) for k in range(40)] + [tuple(r)[:2] for r in odd.collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = aligned(rows)
    plain = alignment.align(docs, A, B)
    columns = ["doc_id", *alignment.MEASURES, "groups"]
    key = lambda r: str(r)
    assert sorted((tuple(r) for r in plain.select(columns).collect()), key=key) == sorted(expected, key=key)
    digests = alignment.align(docs, A, B, digest=True)
    hashed = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in expected]
    assert sorted((tuple(r) for r in digests.select(columns).collect()), key=key) == sorted(hashed, key=key)


def test_alignment_counts_in_blocks(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").limit(30)
    whole = sorted(tuple(r) for r in alignment.align(docs, A, B, digest=True).collect())
    monkeypatch.setattr(alignment, "BLOCK_PAIRS", 700)
    assert sorted(tuple(r) for r in alignment.align(docs, A, B, digest=True).collect()) == whole


def test_alignment_takes_odd_rows(spark, odd):
    found = alignment.align(odd, A, B)
    assert found.count() == odd.count()
    assert found.columns == [c for c in odd.columns if c != "n_a"] + [*alignment.MEASURES, "groups"]
    none = found.where("text is null or text = ''").collect()
    assert none and all(r.n_a == r.n_links == r.count_sum == 0 and r.groups == "" for r in none)
    assert alignment.align(odd.limit(0), A, B).count() == 0
    assert alignment.align(odd.where("text is null"), A, B).count() == odd.where("text is null").count()


# quality

def measures(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", text or "")
    at = defaultdict(list)
    for k in range(len(words) - 2):
        at[tuple(words[k:k + 3])].append(k)
    covered = {k + d for places in at.values() if len(places) > 1 for k in places for d in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
            sum(x in lines[:k] for k, x in enumerate(lines)), len(covered), len(lines))


def test_measures_equal_brute_force(spark, sf, odd):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(80).select("doc_id", "text")
    more = [(1000, "a b c a b c a b"), (1001, "a a a"), (1002, "a a a a"), (1003, "#|<é\n\n#|<é\x0b\n#|<é"), (1004, "one"), (1005, "a b a b\x1ca b a b\xa0c")]
    docs = docs.unionAll(spark.createDataFrame(more, "doc_id long, text string")).unionAll(odd.select("doc_id", "text"))
    found = quality.measured(docs).select("row.doc_id", "row.text", *quality.MEASURES).collect()
    assert len(found) == 80 + len(more) + odd.count()
    for r in found:
        assert tuple(r)[2:] == measures(r.text), r.doc_id


def tail(n, k, p):
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def test_most_rejected_is_the_exact_bound(spark):
    cases = [(n, p, d) for n in (0, 1, 10, 59, 300, 1000, 3000) for p in (0.01, 0.05) for d in (0.05, 0.0025)]
    for n, p, d in cases:
        most = spark.range(1).select(quality.most_rejected(F.lit(n).cast("long"), p, d)).first()[0]
        assert most == max([k for k in range(n) if k <= n * p and tail(n, k, p) <= d], default=-1), (n, p, d)


def learnt(rows, risk, delta):
    """Cutoffs of each stratum by trying every grade."""
    rules = {
        "symbols": lambda m: 1000 * m[2] // max(1, m[0]) // 10, "short_words": lambda m: (1000 - 100 * m[1] // max(1, m[0])) // 10,
        "long_words": lambda m: (100 * m[1] // max(1, m[0]) - 400) // 10, "repeated_lines": lambda m: 1000 * m[3] // max(1, m[5]) // 10,
        "repeated_words": lambda m: 1000 * m[4] // max(1, m[0]) // 10}
    texts = {}
    for text, stratum, good in rows:
        texts[stratum, text] = texts.get((stratum, text), True) and good
    held = [(s, good, measures(t)) for (s, t), good in texts.items() if not (measures(t)[0] < 50 or 100 * measures(t)[4] > 50 * measures(t)[0])]
    strata, out = {s for s, _, _ in held}, {}
    for s in strata:
        n = sum(g for t, g, _ in held if t == s)
        for rule, f in rules.items():
            best = (0, None)
            for cut in range(200, 0, -1):
                hit = [g for t, g, m in held if t == s and min(200, f(m)) >= cut]
                if tail(n, sum(hit), risk / 5) > delta / (5 * len(strata)):
                    break
                if len(hit) - 2 * sum(hit) > best[0]:
                    best = (len(hit) - 2 * sum(hit), cut)
            out[s, rule] = best[1]
    return out, rules


@pytest.fixture
def graded(spark):
    draw = random.Random(5)
    rows = []
    for k in range(900):
        stratum = draw.choice(["en", "en", "en", None, "rare" if k % 40 == 0 else "en"])
        bad = draw.random() < 0.2
        words = ["".join(draw.choices("abcdefg", k=draw.randint(2, 8))) + ("#" if bad and draw.random() < 0.5 or draw.random() < 0.01 else "") for _ in range(draw.randint(40, 90))]
        rows.append((k, " ".join(words), stratum, int(not bad)))
    return rows + [(1000 + k, *rows[0][1:]) for k in range(300)]  # copies of one text


def test_cutoffs_equal_brute_force_and_limit_the_loss(spark, graded):
    docs = spark.createDataFrame([r[:3] for r in graded], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in graded if r[0] % 2 or r[0] < 300] + [(None, 1), (7, None)], "doc_id long, quality long")
    known = {r[0] for r in labels.collect() if r[1] is not None}
    found = {r.doc_id: r for r in quality.keep_good(docs, labels, risk=0.3, delta=0.2).select("row.*", *quality.MEASURES, "base_failed", "kept").collect()}
    cutoffs, rules = learnt([(t, s, q == 1) for d, t, s, q in graded if d in known], 0.3, 0.2)
    assert any(cutoffs.values()) and all(v is None for (s, _), v in cutoffs.items() if s == "rare")
    lost = clean = caught = bad = 0
    for doc, text, stratum, good in graded:
        m = measures(text)
        base = m[0] < 50 or 100 * m[4] > 50 * m[0]
        rejected = any((cut := cutoffs.get((stratum, rule))) is not None and min(200, f(m)) >= cut for rule, f in rules.items())
        assert (found[doc].base_failed, found[doc].kept) == (base, not base and not rejected)
        if doc not in known and not base:
            clean, lost = clean + good, lost + (good and rejected)
            bad, caught = bad + (not good), caught + (not good and rejected)
    assert lost <= 0.3 * clean and caught > 0.5 * bad


def test_quality_takes_odd_rows(spark, odd):
    labels = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (6, None)], "doc_id long, quality long")
    for marks in (labels, labels.limit(0)):
        found = quality.keep_good(odd, marks)
        assert found.count() == odd.count() and not found.where("kept is null or base_failed is null").count()
        assert {r.doc_id for r in found.select("row.doc_id", "kept").collect() if r.kept} == set()
    assert [f.name for f in found.schema["row"].dataType] == [c for c in odd.columns if c != "text"]
    assert quality.keep_good(odd.limit(0), labels).count() == 0
