"""Quality rules with risk-controlled cutoffs: labelled documents bound, per stratum, how many good ones a rule may reject.

Everything is built from DataFrame expressions; no Python runs in a task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriframe.llm.shared import stored

#: Least words of a text, and the most words in a hundred that may lie in repeated windows.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: The share of good documents of a stratum that all rules together may reject, and the chance that any cutoff breaks its share.
RISK, DELTA = 0.05, 0.05
#: Measures of a text in the order they are returned.
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
#: Each rule's grade of a text, from the measures: whole numbers from 0 to ``GRADES``, worse when higher, fixed before any label is seen.
GRADES = 200
RULES = {
    "symbols": "(1000 * n_symbols) div greatest(1, n_words) div 10",
    "short_words": "(1000 - (100 * word_chars) div greatest(1, n_words)) div 10",
    "long_words": "((100 * word_chars) div greatest(1, n_words) - 400) div 10",
    "repeated_lines": "(1000 * n_dup_lines) div greatest(1, n_lines) div 10",
    "repeated_words": "(1000 * n_repeat_words) div greatest(1, n_words) div 10",
}
_SPACE = r"[\x20\x09-\x0D]+"


def _free(taken: Sequence[str], *names: str) -> list[str]:
    """The names, each with as many underscores before it as make it unlike all taken ones."""
    lower, out = {t.lower() for t in taken}, []
    for name in names:
        while name.lower() in lower:
            name = f"_{name}"
        out.append(name)
    return out


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (a struct of all columns of the document) and the ``MEASURES`` of its whole text, as longs.

    A word is a run of anything but ASCII white space. ``n_repeat_words`` counts the
    words that lie in a window of three words which the text holds twice or more;
    a word in several such windows counts once. Windows are compared as text, not
    as hashes: a text's windows are sorted and neighbours compared. ``n_dup_lines``
    counts lines with a word that equal an earlier line, ``n_lines`` all lines with
    a word. Null and empty texts have zeros.
    """
    columns = [_col(c) for c in docs.columns]
    split = docs.select(F.struct(*columns).alias("row"), F.coalesce(_col(text), F.lit("")).alias("text"))
    words = split.select(
        "row", "text",
        F.array_remove(F.split("text", _SPACE), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    count = F.greatest(F.size("words") - 2, F.lit(0))
    sorted_windows = words.select(
        "row", "words", "lines",
        F.length(F.translate("text", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.sort_array(F.transform(
            F.arrays_zip(*[F.slice("words", k, count).alias(f"w{k}") for k in (1, 2, 3)]),
            lambda w, place: F.struct(F.concat_ws(" ", w["w1"], w["w2"], w["w3"]).alias("window"), place.alias("place")))).alias("windows"))
    places = sorted_windows.select(
        "row", "word_chars", "n_symbols",
        F.size("words").cast("long").alias("n_words"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.sort_array(F.flatten(F.filter(
            F.zip_with("windows", F.slice("windows", 2, F.greatest(F.size("windows"), F.lit(1))),
                       lambda a, b: F.when(a["window"] == b["window"], F.array(a["place"], b["place"]))),
            lambda pair: pair.isNotNull()))).alias("places"))
    covered = F.aggregate(
        "places", F.struct(F.lit(-3).alias("last"), F.lit(0).alias("words")),
        lambda held, place: F.struct(place.alias("last"), (held["words"] + F.least(F.lit(3), place - held["last"])).alias("words")))
    return places.withColumn("n_repeat_words", covered["words"].cast("long")).select("row", *MEASURES)


def base_failed() -> Column:
    return F.expr(f"n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words")


def grade(rule: str) -> Column:
    """The rule's grade of a text by its measures."""
    return F.expr(f"cast(greatest(0, least({GRADES}, {RULES[rule]})) as int)")


def most_rejected(n: Column, risk: float, delta: float) -> Column:
    """Of ``n`` good documents the most that a cutoff may reject, so that a true rejection rate above ``risk``
    would show so few with a probability of at most ``delta``; -1 if none is few enough.

    The exact lower tail of the binomial distribution, summed up to the mean in logarithms.
    """
    start = F.struct(
        (n * math.log1p(-risk)).alias("log_term"), F.exp(n * math.log1p(-risk)).alias("tail"),
        F.when(F.exp(n * math.log1p(-risk)) <= delta, 0).otherwise(-1).cast("long").alias("most"))
    odds = math.log(risk) - math.log1p(-risk)

    def step(held, k):
        log_term = held["log_term"] + F.log((n - k + 1) / k) + odds
        tail = held["tail"] + F.exp(log_term)
        return F.struct(log_term.alias("log_term"), tail.alias("tail"), F.when(tail <= delta, k).otherwise(held["most"]).alias("most"))

    upto = F.floor(n * risk).cast("long")
    steps = F.when(upto >= 1, F.sequence(F.lit(1).cast("long"), upto)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(steps, start, step)["most"]


def calibrate(holdout: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """``stratum`` and for each rule the least grade that it rejects (null: it rejects nothing), learnt from labelled rows.

    ``holdout`` has ``stratum, good`` (boolean) and the ``MEASURES``, one row per
    distinct text: copies aren't independent draws. Rows that fail the base are left
    out. The risk is split evenly over the rules, the error probability over all
    rules and strata (Bonferroni). Within a rule cutoffs are tested from the loosest
    to the strictest and the first that fails ends the sequence, so they need no
    further correction. Of the cutoffs that hold, the one is taken that rejects the
    most bad documents less the good ones; of equals the loosest. A rule for which
    that is not above zero, or a stratum with too few good documents to prove
    anything, gets no cutoff. Unlabelled strata give no row.
    """
    rows = holdout.where(F.col("good").isNotNull() & ~base_failed())
    grades = F.array(*[F.struct(F.lit(r).alias("rule"), grade(r).alias("grade")) for r in RULES])
    counts = stored(
        rows.select("stratum", "good", F.inline(grades)).groupBy("stratum", "rule", "grade")
        .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")), "grades")
    strata = counts.where(F.col("rule") == next(iter(RULES))).groupBy("stratum").agg(F.sum("good").alias("n"))
    tests = max(1, strata.count() * len(RULES))
    allowed = strata.withColumn("most", most_rejected(F.col("n"), risk / len(RULES), delta / tests)).where("most >= 0")
    tails = counts.alias("c").join(counts.alias("d"), F.expr("c.stratum <=> d.stratum and c.rule = d.rule and d.grade >= c.grade")).groupBy(
        "c.stratum", "c.rule", "c.grade").agg(F.sum("d.good").alias("good"), F.sum("d.bad").alias("bad"))
    held = tails.alias("t").join(allowed.alias("a"), F.expr("t.stratum <=> a.stratum")).where("t.grade > 0 and t.good <= a.most and t.bad > t.good")
    best = held.groupBy("t.stratum", "t.rule").agg(F.max(F.struct(F.expr("t.bad - t.good").alias("gain"), "t.grade")).alias("best"))
    return best.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("best.grade"))).alias(r) for r in RULES])


def labelled(measures: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality") -> DataFrame:
    """The holdout: ``stratum, good`` and the measures of every distinct labelled text, good if all labels of all its copies are 1.

    ``measures`` has ``doc_id, stratum, text_key`` and the measures. Labels without
    an id or a value are left out; a repeated label counts once.
    """
    marks = labels.select(F.col(doc_id).alias("doc_id"), (F.col(label) == 1).alias("good")).where("good is not null").groupBy("doc_id").agg(F.min("good").alias("good"))
    return measures.join(marks, "doc_id").groupBy("stratum", "text_key", *MEASURES).agg(F.min("good").alias("good"))


def judge(measures: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """The rows of ``measures`` (with ``stratum``) with ``base_failed`` and ``kept``: false if the base fails or a rule of the stratum rejects.

    The cutoffs hold one row per stratum; Spark broadcasts them if their measured
    size allows and shuffles otherwise.
    """
    rejected = F.coalesce(F.greatest(*[F.coalesce(grade(r) >= F.col(f"cut.{r}"), F.lit(False)) for r in RULES]), F.lit(False))
    rows = measures.join(cutoffs.select(F.col("stratum").alias("of"), F.struct(*RULES).alias("cut")), F.expr("stratum <=> of"), "left")
    return rows.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~rejected).drop("of", "cut")


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", stratum: str = "lang", label: str = "quality",
              risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """Every document with its measures (``MEASURES``), ``base_failed`` and ``kept``; its own columns are in the struct ``row``.

    Texts are measured once and written without the text itself: the measures are
    some bytes a document. A null stratum is a stratum of its own. Null texts fail
    the base. Repeated rows and rows without an id stay, each with its own verdict;
    empty tables give no row, an empty label table rejects by the base alone.
    """
    kept = [c for c in docs.columns if c != text]
    key = _free(docs.columns, "text_key")[0]
    with_key = docs.withColumn(key, F.xxhash64(_col(text)))
    found = measured(with_key, text)
    narrow = found.select(
        F.struct(*[F.col("row")[c].alias(c) for c in kept]).alias("row") if kept else F.struct(F.lit(True).alias("row")).alias("row"),
        F.col("row")[doc_id].alias("doc_id"), F.col("row")[stratum].alias("stratum"), F.col("row")[key].alias("text_key"), *MEASURES)
    measures = stored(narrow, "measures")
    cutoffs = stored(calibrate(labelled(measures, labels, doc_id, label), risk, delta), "cutoffs")
    return judge(measures, cutoffs).drop("stratum", "text_key", "doc_id")
