"""The text operators against brute force, exact round trips and held-out rows; odd rows of every kind."""

from __future__ import annotations

import base64
import collections
import hashlib
import math
import re
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from compare import difference, oracle_connection, oracle_rows, spark_rows
from veriframe.llm import byte_bpe, components, decontaminate, language_id, line_dedup, masked_lm, pii, queries, similar, simhash, topk, toxicity, warc

ODD = [None, "", " \n\t", "é😀 \x00x", "word " * 30_000, "same line of text here\nsame line of text here", "x" * 40_000]


@pytest.fixture
def odd(spark):
    """Odd texts, a repeated row, a null id, and columns with the names of results and of working columns."""
    rows = [(k, t) for k, t in enumerate(ODD)] + [(5, ODD[5]), (None, "no id"), (None, None)]
    names = ["_doc", "_kept", "_stays", "_lines", "_left", "_one", "_other", "_toxicity", "one", "other", "c0"]
    more = "words string, ids int, score double, place string, " + ", ".join(f"{n} int" for n in names)
    return spark.createDataFrame([(*r, "a", 1, 2.0, "z", *range(len(names))) for r in rows], f"doc_id long, text string, {more}")


@pytest.fixture
def empty(odd):
    return odd.limit(0)


def texts(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("key", sorted(queries.SQL))
def test_query_equals_its_sql(spark, sf, key):
    assert difference(spark_rows(queries.QUERIES[key](spark, sf)), oracle_rows(oracle_connection(sf), queries.SQL[key])) is None


# line dedup

def word_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def deduped(rows):
    """Every line against every earlier one."""
    first = {}
    for doc, text in sorted(r for r in rows if r[1] is not None):
        for no, line in enumerate(text.split("\n")):
            if words := tuple(w for w in re.split(r"[ \t\r\f\x0b]+", line) if w):
                first.setdefault(words, (doc, no))
    near = {w for w, at in first.items() if len(w) >= 5 for o, before in first.items()
            if before < at and len(o) >= 5 and abs(len(o) - len(w)) <= 1 and word_edits(w, o) == 1}
    out = []
    for doc, text in rows:
        if text is None:
            out.append((doc, None))
            continue
        left, some, stays = [], False, False
        for no, line in enumerate(text.split("\n")):
            words = tuple(w for w in re.split(r"[ \t\r\f\x0b]+", line) if w)
            some |= bool(words)
            if not words or first[words] == (doc, no) and words not in near:
                stays |= bool(words)
                left.append(line)
        out.append((doc, "" if some and not stays else "\n".join(left)))
    return out


def test_line_dedup_equals_brute_force(spark, rows):
    draw = np.random.default_rng(1)
    lines = ["", " ", "short", "a a a a a a", "a a a a a"] + [" ".join(draw.choice(["a", "b", "c"], draw.integers(4, 9))) for _ in range(150)]
    docs = [(k, "\n".join(draw.choice(lines, draw.integers(1, 5)))) for k in range(60)] + [(60, None), (61, "")]
    assert rows(line_dedup.dedup_lines(texts(spark, docs))) == sorted(deduped(docs), key=str)


def test_line_dedup_of_odd_rows(odd, empty):
    found = line_dedup.dedup_lines(odd, counts=("n", "score"))
    assert found.columns == [c for c in odd.columns if c != "score"] + ["n", "score"]
    got = [(r["doc_id"], r["text"], r["n"], r["score"]) for r in found.collect()]
    assert (0, None, 0, 0) in got and (1, "", 0, 0) in got and (2, " \n\t", 0, 0) in got and (None, None, 0, 0) in got
    assert got.count((5, "same line of text here", 2, 1)) == 2
    assert line_dedup.dedup_lines(empty).collect() == []


def test_line_dedup_tells_rows_without_id_apart(spark):
    docs = texts(spark, [(None, "one two\nx y"), (None, "three four\nx y"), (7, "x y")])
    assert sorted(r["text"] for r in line_dedup.dedup_lines(docs).collect()) == ["one two", "three four", "x y"]


def test_line_dedup_runs_no_python(spark, sf):
    plan = queries.op1(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# language

def test_languages_of_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    found = queries.op2(spark, folder).join(docs, "doc_id").toPandas()
    held = found[found.held_out]
    assert len(held) > 200 and (held.lang == held.lang_pred).mean() > 0.97
    assert found.score.between(0, 1).all()
    assert (found.held_out == found.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 3 == 1)).all()


def test_chain_probabilities_equal_enumeration():
    from itertools import product

    draw = np.random.default_rng(2)
    model = {"step": draw.normal(size=(3, 3)), "start": draw.normal(size=3)}
    scores, size = draw.normal(size=(2, 4, 3)), np.array([4, 2])
    got, moves = language_id.posteriors(scores, size, model, True)
    all_moves = np.zeros((3, 3))
    for c in range(2):
        weights = {}
        for path in product(range(3), repeat=int(size[c])):
            weights[path] = np.exp(model["start"][path[0]] + sum(scores[c, t, k] for t, k in enumerate(path)) + sum(model["step"][a, b] for a, b in zip(path, path[1:])))
        total = sum(weights.values())
        want = np.zeros((4, 3))
        for path, w in weights.items():
            for t, k in enumerate(path):
                want[t, k] += w / total
            for a, b in zip(path, path[1:]):
                all_moves[a, b] += w / total
        assert np.allclose(got[c], want)
    assert np.allclose(moves, all_moves)


def test_words_of_text_that_changes_language(spark, odd, empty):
    rows = [("the house of the man and the dog with it is the", "en"), ("der hund und die katze in dem haus von der frau", "de")] * 20
    model = language_id.fit(rows)
    docs = texts(spark, [(1, "the house of the man und die katze in dem haus")])
    words = language_id.predict(docs, model, words="w").first()["w"]
    assert [w["lang"] for w in words] == ["en"] * 5 + ["de"] * 6
    got = language_id.predict(odd, model, words="words").collect()
    assert [r["lang_pred"] for r in got[:3]] == ["und"] * 3 and len(got) == 10
    assert len(next(r for r in got if r["doc_id"] == 4)["words"]) == 30_000
    assert language_id.predict(empty, model).collect() == []
    assert {r["lang_pred"] for r in language_id.predict(odd, language_id.fit([])).collect()} == {"und"}


# byte BPE

@pytest.fixture(scope="module")
def encoding():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


BPE = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def test_ids_equal_the_public_library(spark, sf, encoding):
    draw = np.random.default_rng(3)
    pool = list("ab cde \n\r\t \x1c\x85\xa0 　é漢😀0٣²!?._'s'll")
    made = ["".join(draw.choice(pool, draw.integers(0, 60))) for _ in range(800)] + ["a" * 3000, "abcdefgh" * 500, " " * 500, "é" * 300, "x" * 128, "x" * 129, " a", "a ", "a  b", "\na b"]
    docs = texts(spark, list(enumerate(made)) + [(k + 5000, r["text"]) for k, r in enumerate(spark.read.parquet(f"{sf}/documents.parquet").collect())])
    for r in byte_bpe.encode(docs, *BPE, decoded="d").collect():
        assert r["ids"] == encoding.encode_ordinary(r["text"]), r["text"][:80]
        assert bytes(r["d"]) == r["text"].encode()


def test_bpe_of_odd_rows(odd, empty, encoding):
    found = byte_bpe.encode(odd, *BPE)
    assert [r["ids"] for r in found.collect()] == [encoding.encode_ordinary(t or "") for t in [*ODD, ODD[5], "no id", None]]
    back = byte_bpe.decode(found, BPE[0], out="score")
    assert [bytes(r["score"]).decode() for r in back.collect()] == [t or "" for t in [*ODD, ODD[5], "no id", None]]
    assert byte_bpe.encode(empty, *BPE).collect() == []
    row = queries.bpe_digests(odd.where("doc_id = 3")).first()
    ids = encoding.encode_ordinary(ODD[3])
    assert (row["n_tokens"], row["ids_sha256"], row["decoded_sha256"]) == (
        len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(ODD[3].encode()).hexdigest())


# personal data

def base_spans(text):
    """The base kinds by their patterns as they are stated."""
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(s):
        return sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(s))) % 10 == 0

    found = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [("card", m) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    found += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(((k, m.start(), m.end()) for k, m in found), key=lambda s: (s[1], pii.BASE.index(s[0])))


def test_base_spans_equal_the_stated_patterns(spark, sf):
    draw = np.random.default_rng(4)
    made = ["".join(draw.choice(list("a.@-+ 0123%()é"), draw.integers(0, 40))) for _ in range(4000)]
    made += ["a@b.c%d@e.f", "1.2.3.4.5.6.7.8", "001.2.3.4", "4111 1111 1111 1111 x 4111-1111-1111-1112", "+49 (30) 123-4567.", "é x@y.zz", "0" * 5000 + ".1.1.1"]
    made += [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    for text in made:
        if "0" * 5000 in text:
            assert [s[0] for s in pii.spans(text)] == ["ip"]
            continue
        assert [s[:3] for s in pii.spans(text) if s[0] in pii.BASE] == base_spans(text), text[:80]


def test_context_and_checksums():
    assert [s[0] for s in pii.spans("IBAN DE89 3704 0044 0532 0130 00 now")] == ["iban"]
    assert pii.spans("DE89 3704 0044 0532 0130 01") == []
    assert pii.spans("part 123-45-6789") == [] and [s[0] for s in pii.spans("SSN 123-45-6789")] == ["ssn"]
    assert pii.spans("card 4111111111111111")[0][3] > pii.spans("order 4111111111111111")[0][3]


def test_context_decides():
    account, key = "DE89 3704 0044 0532 0130 00", "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    kinds = lambda text: [s[0] for s in pii.spans(text)]
    assert kinds(f"see {account} now") == ["iban"] and kinds(f"hash {account} now") == [] and kinds(f"hash of account {account} now") == ["iban"]
    assert kinds(f'token = "{key}"') == ["secret"] and kinds(f"see {key}") == [] and kinds(f"commit {key} of token") == []
    assert kinds("token " + "a1" * 20) == [] and kinds("password " + "longwordwithoutanynumbersinit") == []
    assert pii.spans(f'é token = "{key}"')[0] == ("secret", 11, 51, 0.6)


def test_of_spans_over_the_same_characters_the_best_stays():
    inside = "token card 4012888888881881abcdefghKLMNOP"
    assert [s[0] for s in pii.spans(inside)] == ["card"]  # 1.0 against 0.6, the base span stays anyway
    assert [s[0] for s in pii.spans("token order 4012888888881881abcdefghKLMNOP")] == ["card", "secret"]  # 0.4 against 0.6
    assert [s[0] for s in pii.spans("bank token DE89370400440532013000")] == ["iban"]  # 0.7 against 0.6


def test_pii_of_odd_rows(odd, empty):
    assert all(r["ids"] == [] for r in pii.find_pii(odd, out="ids").collect())
    assert pii.find_pii(empty).collect() == []


# top-k

def test_top_k_equals_brute_force(spark):
    draw = np.random.default_rng(5)
    vectors = [(k, [float(x) for x in draw.normal(size=7)]) for k in range(300)]
    vectors += [(k, [0.5] * 7) for k in range(300, 420)] + [(500, [0.5] * 7), (500, [0.5] * 7), (600, None), (700, [1.0, None] + [0.0] * 5), (800, [float("nan")] * 7), (900, []), (None, [1.0] * 7)]
    frame = spark.createDataFrame([(*v, "x") for v in vectors], "vec_id long, embedding array<float>, score string")
    got = [tuple(r) for r in topk.top_k(frame, frame.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect()]
    good = {i: np.floor(1024 * np.array(v, np.float32).astype(float)).astype(int) for i, v in vectors if i is not None and v and None not in v and np.isfinite(v).all()}
    want = []
    for q in sorted(i for i in good if i % 100 == 0):
        best = sorted((-int(good[q] @ v), i) for i, v in good.items() if i != q)[:10]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert got == want
    assert topk.top_k(frame.limit(0), frame.limit(0)).collect() == []
    assert topk.top_k(frame.limit(3), frame.limit(1), 10).count() == 2


def test_top_k_of_large_components_equals_brute_force(spark):
    draw = np.random.default_rng(7)
    sizes = [1.0, 40_000.0, 5e9, 1e20]
    vectors = [(k, [float(np.float32(x)) for x in draw.normal(size=6) * sizes[k % 7 % 4]]) for k in range(60)]
    vectors += [(100, [40_000.0] + [0.0] * 5), (101, [-40_000.25] + [0.0] * 5), (102, [1.7e308] * 6), (103, [-1.7e308] * 6), (104, [float("inf")] * 6), (105, [0.1] * 6)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(frame, frame.where("vec_id % 5 = 0"), 4).orderBy("query_id", "rank").collect()]
    good = {i: [math.floor(1024 * Fraction(x)) for x in v] for i, v in vectors if np.isfinite(v).all()}
    want = []
    for q in sorted(i for i in good if i % 5 == 0):
        best = sorted((-sum(x * y for x, y in zip(good[q], v)), i) for i, v in good.items() if i != q)[:4]
        want += [(q, n, i, -s if abs(s) < 1 << 63 else None) for n, (s, i) in enumerate(best, 1)]
    assert got == want


def test_bounds_never_pass_the_distance():
    draw = np.random.default_rng(6)
    a, b = draw.integers(-500, 500, (20, 13)), draw.integers(-500, 500, (20, 13))
    exact = ((a - b) ** 2).sum(1)
    last = np.zeros(20)
    for segments in (1, 2, 4, 13):
        low = topk.least_distances(topk.statistics(a, segments), topk.statistics(b, segments), np.arange(20), np.arange(20))
        assert (low <= exact + 1e-6).all()
        last = low
    assert np.allclose(last, exact)


# language model

def slow_log_probs(w, hashes):
    """Log-probabilities of the classes of a text's words, one by one."""
    classes = [int(c) for c in masked_lm.classes_of(hashes)]
    out = []
    for t, c in enumerate(classes):
        at = lambda i: classes[i] if 0 <= i < len(classes) else masked_lm.CLASSES
        x = w["bias"].astype(float)
        for k in range(masked_lm.WINDOW):
            x = x + w["near_left"][k] * w["left"][at(t - 1 - k)] + w["near_right"][k] * w["right"][at(t + 1 + k)]
        h = np.tanh(x)
        total = 0.0
        for digit, name, z in ((c // masked_lm.DIGIT, "high", h), (c % masked_lm.DIGIT, "low", h + w["given"][c // masked_lm.DIGIT])):
            s = z @ w[name] + w[name + "_bias"]
            total += s[digit] - np.log(np.exp(s).sum())
        out.append(total)
    return out


@pytest.mark.parametrize("frequent", [1 << 20, 4])
def test_log_probs_equal_slow_sums(spark, odd, empty, monkeypatch, frequent):
    monkeypatch.setattr(masked_lm, "FREQUENT", frequent)  # with 4, only words that are more than a quarter of all
    rows = [(1, "the cat sat on the mat"), (2, "one"), (3, "the dog sat on the log"), (4, "The the")]
    docs = texts(spark, rows)
    model = masked_lm.train(docs)
    n = collections.Counter(w for _, t in rows for w in t.lower().split())
    assert sorted(r["n"] for r in model["counts"].collect()) == sorted(n.values())
    of = {w: int(masked_lm.classes_of(masked_lm.hashes_of([w])[0])[0]) for w in [*n, "bird"]}
    assert len(masked_lm.frequent_words(model)[0]) == (len(n) if frequent > 4 else sum(c * 4 > sum(n.values()) for c in n.values()))
    scored = [*rows, (5, "the bird sat"), (5, "the bird sat")]
    got = masked_lm.score(texts(spark, scored), model).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == sorted(scored)
    for r in got:
        words = r["text"].lower().split()
        total = sum(slow_log_probs(model["weights"], masked_lm.hashes_of([r["text"]])[0]))
        for w in words:
            same = [v for v in n if of[v] == of[w]]
            total += math.log((n[w] + 1) / (sum(n[v] for v in same) + len(same) + 1))
        assert r["n_words"] == len(words) and r["log_prob"] == pytest.approx(total, rel=1e-4)
    found = masked_lm.score(odd, model, out="score")
    assert found.columns == [c for c in odd.columns if c != "score"] + ["n_words", "score"] and found.count() == odd.count()
    assert {r["score"] for r in found.where("text is null or text = ''").collect()} == {0.0}
    assert "text" not in masked_lm.score(odd, model, carry=False).columns
    assert masked_lm.score(empty, masked_lm.train(empty)).collect() == []


def test_the_model_does_not_depend_on_the_split(spark, sf, monkeypatch):
    monkeypatch.setattr(masked_lm, "UNIT_WORDS", 3000)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    answers = []
    for split in (docs.coalesce(1), docs.repartition(4), docs.orderBy(F.desc("doc_id")).repartition(13, "doc_id")):
        model = masked_lm.train(split, spread=["doc_id"])
        scores = {r["doc_id"]: r["log_prob"] for r in masked_lm.score(split, model, carry=False).collect()}
        answers.append((masked_lm.flat(model["weights"]), scores))
    for weights, scores in answers[1:]:
        assert (weights == answers[0][0]).all()
        assert scores == pytest.approx(answers[0][1], rel=1e-6)  # single precision in the network
    plain = masked_lm.initial()
    assert sum(answers[0][1].values()) > sum(r["log_prob"] for r in masked_lm.score(docs, {**model, "weights": plain}, carry=False).collect())


def test_copies_are_likelier_than_texts_of_their_kind(spark):
    draw = np.random.default_rng(9)
    word = lambda: "".join(draw.choice(list("abcdefghij"), 7))
    common = [word() for _ in range(40)]
    made = [" ".join(draw.choice(common) if k % 2 else word() for k in range(60)) for _ in range(300)]  # as many rare words in each
    rows = list(enumerate(made)) + [(1000 + k, made[k]) for k in range(30)]
    docs = texts(spark, rows)
    scores = {r["doc_id"]: r["log_prob"] / r["n_words"] for r in masked_lm.score(docs, masked_lm.train(docs, spread=["doc_id"])).collect()}
    copies, others = [scores[k] for k in range(30)], [scores[k] for k in range(30, 300)]
    assert sum(c > o for c in copies for o in others) > 0.95 * len(copies) * len(others)


def test_learning_follows_the_slope():
    model = masked_lm.initial()
    squares = {n: np.full(s, 1e-8, np.float32) for n, s in masked_lm.SHAPES.items()}
    classes, place = masked_lm.padded(*masked_lm.hashes_of(["a b c d e f g h"] * 200))
    before = masked_lm.class_log_probs(model, classes)[place].sum()
    for _ in range(30):
        masked_lm.learn(model, squares, classes, masked_lm.WINDOW, len(classes) - masked_lm.WINDOW)
    assert masked_lm.class_log_probs(model, classes)[place].sum() > before / 4


# decontamination

def least_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return min(row)


def test_passages_equal_brute_force(spark, rows):
    draw = np.random.default_rng(7)
    word = lambda: "".join(draw.choice(list("abcdefg"), draw.integers(2, 6)))
    items = [(k, " ".join(word() for _ in range(14))) for k in range(6)]
    docs = []
    for k in range(60):
        text = list(items[k % 6][1])
        for _ in range(int(draw.integers(0, 9))):
            text[int(draw.integers(len(text)))] = "z" if draw.random() < 0.6 else ""
        docs.append((k, " ".join(word() for _ in range(5)) + "\n " + "".join(text).upper() + " " + word()))
    docs += [(60, None), (61, ""), (1, docs[1][1])]
    benchmark = spark.createDataFrame(items + [(8, None), (9, " "), (None, "abc")], "item_id long, text string")
    got = rows(decontaminate.contaminated(texts(spark, docs), benchmark), "doc_id", "item_id", "distance")
    want = []
    for doc, text in docs:
        for item, passage in items:
            distance = least_distance(decontaminate.normal(passage), decontaminate.normal(text))
            if distance <= decontaminate.budget(len(passage)):
                want.append((doc, item, distance))
    assert got == sorted(want, key=str) and len(want) > 20
    left = {r["doc_id"] for r in decontaminate.decontaminated(texts(spark, docs), benchmark).collect()}
    assert left == {d for d, _ in docs} - {w[0] for w in want}


def test_decontamination_of_odd_rows(spark, odd, empty):
    benchmark = spark.createDataFrame([(1, "no id")], "item_id long, text string")
    assert [tuple(r)[:2] for r in decontaminate.contaminated(odd, benchmark).collect()] == [(None, 1)]
    assert decontaminate.decontaminated(odd, benchmark).count() == 9
    assert decontaminate.contaminated(empty, benchmark).collect() == decontaminate.contaminated(odd, benchmark.limit(0)).collect() == []


# toxicity

def test_toxicity_of_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    found = queries.op8(spark, folder).join(labels, "doc_id").toPandas()
    held = found[found.held_out]
    flagged = held[held.predicted == 1]
    assert flagged.toxic.mean() > 0.9 and flagged.toxic.sum() > 0.6 * held.toxic.sum()
    assert ((found.score >= toxicity.THRESHOLD) == (found.predicted == 1)).all() and found.score.between(0, 1).all()


def test_weights_equal_slow_coordinates():
    """FTRL-proximal one coordinate at a time, over features made word by word, in the order of the draw."""
    draw = np.random.default_rng(9)
    said = [" ".join(draw.choice(["good", "Bad", "ugly", "été", "x1"], draw.integers(0, 9))) for _ in range(60)]
    labels = [int("bad" in t.lower()) for t in said]

    def slow_features(text):
        words, mask = [zlib.crc32(w.encode()) for w in re.findall(r"[^\W_]+", text.lower())], (1 << 64) - 1
        found = {w * 0x9E3779B97F4A7C15 & mask for w in words}
        for gap in toxicity.GAPS:
            for a, b in zip(words, words[gap:]):
                found.add((a * 0xC2B2AE3D27D4EB4F + b * 0x165667B19E3779F9 + gap) * 0x9E3779B97F4A7C15 & mask)
        return sorted({f >> 46 for f in found})

    z, n = collections.defaultdict(float), collections.defaultdict(float)

    def weight(k):
        least = 0.0 if k == "constant" else toxicity.L1
        if abs(z[k]) <= least:
            return 0.0
        return -(z[k] - math.copysign(least, z[k])) / ((toxicity.BETA + math.sqrt(n[k])) / toxicity.ALPHA + toxicity.L2)

    rows, order = [[*slow_features(t), "constant"] for t in said], np.random.default_rng(7)
    for _ in range(toxicity.PASSES):
        for r in order.permutation(len(rows)):
            held = {k: weight(k) for k in rows[r]}
            g = 1 / (1 + math.exp(-sum(held.values()))) - labels[r]
            for k, w in held.items():
                z[k] += g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / toxicity.ALPHA * w
                n[k] += g * g
    numbers, values, constant = toxicity.fit(said, labels)
    want = {k: weight(k) for k in z if k != "constant" and weight(k)}
    assert want and sorted(want) == numbers.tolist()
    assert np.allclose(values, [want[k] for k in sorted(want)], rtol=1e-5) and math.isclose(constant, weight("constant"), rel_tol=1e-6)


def test_toxicity_of_odd_rows(spark, odd, empty):
    model = toxicity.fit(["you idiot", "good day"] * 40, [1, 0] * 40)
    assert 0 < len(model[0]) < 10  # L1 leaves few weights
    got = toxicity.score(odd, model).collect()
    assert len(got) == 10 and got[0]["score"] == got[1]["score"] == pytest.approx(1 / (1 + np.exp(-model[2])))
    assert toxicity.score(empty, model).collect() == []
    bare = toxicity.train(odd, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r["score"] for r in toxicity.score(odd, bare).collect()} == {0.5}


# SimHash

def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids, prints):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = {}
    for k, i in enumerate(ids):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [least.get(find(k)) for k in range(len(ids))]


def test_components_equal_brute_force(spark, rows):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id < 400").collect()]
    docs += [(1000 + k, t) for k, t in enumerate(ODD)] + [(3, "again"), (None, "again"), (None, "alone without id")]
    prints = [slow_fingerprint(t) for _, t in docs]
    want = [(i, f"{p:016x}", c) for (i, _), p, c in zip(docs, prints, slow_components([i for i, _ in docs], prints))]
    assert rows(simhash.near_duplicates(texts(spark, docs))) == sorted(want, key=str)


def test_links_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(simhash, "GROUP", 20)  # so that large groups are dealt out
    draw = np.random.default_rng(8)
    prints = {0}
    for _ in range(300):
        base = sorted(prints)[draw.integers(len(prints))] if draw.random() < 0.8 else int(draw.integers(1 << 62))
        for b in draw.choice(64, 2):
            base ^= 1 << int(b)
        prints.add(base)
    some = sorted(p if p < 1 << 63 else p - (1 << 64) for p in prints)
    frame = spark.createDataFrame([(p,) for p in some], "fingerprint long")
    nodes = {r["node"]: r["root"] for r in components.components(simhash.links(frame)).collect()}
    unsigned = [p & (1 << 64) - 1 for p in some]
    classes = slow_components(list(range(len(some))), unsigned)
    for i in range(len(some)):
        for j in range(i):
            assert (classes[i] == classes[j]) == (nodes.get(some[i], some[i]) == nodes.get(some[j], some[j]))


def test_long_paths_are_one_component(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(0, 60)] + [(100, 101), (7, 7)], "a long, b long")
    found = {r["node"]: r["root"] for r in components.components(edges).collect()}
    assert found == {**{k: 0 for k in range(61)}, 100: 100, 101: 100}


def test_one_document_of_each_group_stays(spark, odd, empty):
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["0", "3", "4", "5", "6"] + ["None"]
    assert simhash.one_of_each(empty).collect() == [] and simhash.near_duplicates(empty).collect() == []


def test_rows_without_id_and_of_one_id_are_judged_one_by_one(spark):
    rng = np.random.default_rng(9)
    a, b, c, d, e = (" ".join(f"w{k}" for k in rng.integers(0, 1000, 60)) for _ in range(5))
    rows = [(None, a), (None, b), (7, c), (7, d), (7, c), (3, d), (None, d), (None, a), (None, None), (8, e), (8, e)]
    kept = simhash.one_of_each(texts(spark, rows)).collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, [(None, a), (None, b), (7, c), (3, d), (None, None), (8, e)]))


def test_near_copies_by_five_words_equal_brute_force(spark, odd, empty, monkeypatch):
    monkeypatch.setattr(similar, "GROUP", 3)  # so that groups are dealt out
    rng = np.random.default_rng(10)
    rows = []
    for k in range(12):
        base = [f"w{x}" for x in rng.integers(0, 5000, 120)]
        for copy in range(6):
            words = list(base)
            for at in rng.choice(120, (0, 1, 2, 3, 5, 8)[copy], replace=False):
                words[at] = f"v{rng.integers(5000)}"
            rows.append((100 * copy + k if copy != 4 else None, " ".join(words)))
    rows += [(2000 + k, t) for k, t in enumerate(ODD)] + [(1, "a B c"), (3000, "A b  c"), (3001, rows[5][1]), (None, "alone")]

    def grams(text):
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
        return {tuple(words[k:k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())

    sets = [grams(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] == sets[j] or 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    left = corpus_pipeline.without_near_duplicates(spark, texts(spark, rows), "").collect()
    where = {(i, t): g for (i, t), g in zip(rows, group)}
    assert sorted(where[tuple(r)] for r in left) == sorted(set(group))
    for r in left:
        ids = [i for (i, _), g in zip(rows, group) if g == where[tuple(r)] and i is not None]
        assert r["doc_id"] == (min(ids) if ids else None)
    assert similar.one_of_each(odd).columns == odd.columns and similar.one_of_each(empty).collect() == []


def test_near_copies_come_by_simhash(spark):
    """Without a min-hash key what SimHash proposes is linked if it is alike, and all of the radius is proposed."""
    rng = np.random.default_rng(11)
    rows = []
    for k in range(8):
        words = [f"w{x}" for x in rng.integers(0, 5000, 200)]
        rows += [(10 * k, " ".join(words)), (10 * k + 1, " ".join([*words[:-1], "other"])), (10 * k + 2, " ".join(words[::-1]))]
    frame = texts(spark, rows).select(simhash.row_of("doc_id", "text").alias("row"), "text")
    sketches = similar._sketches(frame).withColumn("keys", F.expr("cast(array() as array<bigint>)")).cache()
    of = {r["node"]: (r["id"], similar.shingles(dict(rows)[r["id"]])) for r in sketches.select("node", "row.id").collect()}
    prints = {n: simhash.fingerprint_of(s) for n, (_, s) in of.items()}
    assert {r["node"]: r["fingerprint"] % (1 << 64) for r in sketches.collect()} == prints

    def share(a, b):
        both = len(np.intersect1d(of[a][1], of[b][1]))
        return both / (len(of[a][1]) + len(of[b][1]) - both)

    near = {(a, b) for a in of for b in of if a < b and (prints[a] ^ prints[b]).bit_count() <= similar.RADIUS and share(a, b) >= 0.8}
    found = {(min(r), max(r)) for r in similar.links(sketches, frame).collect()}
    assert len(near) >= 6 and found == near


def test_alike_fingerprints_of_unlike_texts_are_no_link(spark):
    rows = [(1, " ".join(f"a{k}" for k in range(50))), (2, " ".join(f"b{k}" for k in range(50))), (3, " ".join(f"a{k}" for k in range(49)))]
    frame = texts(spark, rows).select(simhash.row_of("doc_id", "text").alias("row"), "text")
    sketches = similar._sketches(frame).withColumns({"keys": F.expr("cast(array() as array<bigint>)"), "fingerprint": F.expr("row.id % 2")})
    ids = {r["node"]: r["id"] for r in sketches.select("node", "row.id").collect()}
    assert [sorted(ids[n] for n in r) for r in similar.links(sketches, frame).collect()] == [[1, 3]]


def test_blocks_of_words_overlap(monkeypatch):
    text = " ".join(f"w{k}" for k in range(500))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_BLOCK", 64)
    assert simhash.fingerprint(text) == whole == slow_fingerprint(text)


# WARC

def pages(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, html string, payload string")


def test_archives_round_trip(spark, tmp_path):
    draw = np.random.default_rng(9)
    made = [(k, "".join(draw.choice(["\r\n", "\r", "\n", "WARC/1.1\r\n", "é", "a", "0\r\n\r\n"], draw.integers(0, 60)))) for k in range(300)]
    made += [(400, "x" * 100_000), (401, "y\r\n\r\n" * 30_000), (402, "x" * 100_000), (403, None), (404, ""), (5, made[5][1]), (None, "without id")]
    path = str(tmp_path / "archives")
    warc.write_archives(pages(spark, made), path)
    got = sorted((tuple(r) for r in warc.resolved(warc.read_archives(spark, path)).collect()), key=str)
    first = {}
    for i, t in made:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    want = []
    for i, t in made:
        data, least = (t or "").encode(), first.get(t or "")
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if i == least else "revisit", None if i == least else least))
    assert got == sorted(want, key=str)
    segments = warc.read_segments(spark, path)
    assert segments.where("type = 'continuation'").count() > 10
    broken = warc.reassembled(segments.where("not (type = 'continuation' and number = 2)"))
    assert broken.where("not complete").count() == segments.where("number = 2").count()


def test_archives_of_any_bytes_in_many_segments(spark, tmp_path):
    path, data = str(tmp_path / "bytes"), np.random.default_rng(3).integers(0, 256, 300_000, dtype=np.uint8).tobytes()
    warc.write_archives(spark.createDataFrame([(1, data)], "page_id long, html binary"), path, segment=100)
    row = warc.read_archives(spark, path).first()
    assert bytes(row.payload) == data and warc.read_segments(spark, path).count() > 3_000


def test_archives_of_nothing(spark, tmp_path):
    path = str(tmp_path / "none")
    warc.write_archives(pages(spark, []), path)
    assert warc.resolved(warc.read_archives(spark, path)).collect() == []


def test_broken_frames_are_told():
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.unchunked(b"4\r\nabc\r\n0\r\n\r\n")


# pipeline

def alike(found):
    """Groups of texts that pairs of a similarity of 0.8 or more connect, each pair compared."""
    sets = []
    for text in found:
        words = [w for w in re.split(r"[ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
        sets.append({tuple(words[k:k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set()))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    return [find(k) for k in range(len(sets))]


def test_pipeline_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = {r["doc_id"]: r for r in corpus_pipeline.run(spark, folder).collect()}
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, queries.toxic_model(spark, folder)).collect()}
    left = deduped([(r["doc_id"], r["text"]) for r in docs.collect() if scores[r["doc_id"]] < toxicity.THRESHOLD])
    classes = alike([t for _, t in left])
    least = {}
    for (i, _), c in zip(left, classes):
        least[c] = min(i, least.get(c, i))
    left = [d for d, c in zip(left, classes) if d[0] == least[c]]
    items = [(r["item_id"], decontaminate.normal(r["text"])) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    clean = [(i, t) for i, t in left if not any(p in decontaminate.normal(t) for _, p in items)]
    assert set(found) <= {i for i, _ in clean}
    for i in {i for i, _ in clean} - set(found):  # what else goes has a passage with edits
        text = decontaminate.normal(dict(clean)[i])
        assert any(least_distance(p, text) <= decontaminate.budget(len(p)) for _, p in items)
    for i, text in clean:
        if i in found:
            assert found[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_stages_keep_the_columns_and_bear_odd_rows(spark, odd, empty):
    for docs in (odd, empty):
        docs = docs.withColumn("n_chars", docs["ids"].cast("long"))
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, "/root/testdata/sf0.001")
            assert out.columns == docs.columns, name
            for r in out.collect():  # extra columns keep their values
                assert (r["_doc"], r["_kept"], r["_one"], r["_toxicity"], r["c0"], r["place"]) == (0, 1, 5, 7, 10, "z"), name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001").count() == docs.count()
