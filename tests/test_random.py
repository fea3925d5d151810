"""Seeded random groups: Spark verdicts against plain Python, all groups in one job."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest

from veriframe.operators import row_checks as rc
from veriframe.operators.distinct import check_constant_by
from veriframe.operators.profile import metric, profile
from veriframe.operators.sets import check_sets, date_gaps

GROUPS = 80


@pytest.fixture(scope="module", params=[1, 2])
def groups(request):
    rng = random.Random(request.param)
    made = {}
    for g in range(GROUPS):
        pool = rng.choice([[None], [1], [1, None], [1, 2], [0, 1, 2, 3, None], list(range(20))])
        made[g] = [rng.choice(pool) for _ in range(rng.randint(1, 12))]
    return made


@pytest.fixture(scope="module")
def table(spark, groups):
    return spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g int, a int").cache()


def verdicts(df):
    return {(r.g, r.check): (r.status, r.violations) for r in df.collect()}


def test_row_checks(table, groups):
    found = verdicts(rc.run_row_checks(table, [
        rc.no_null("a"), rc.value_range("a", 1, 5), rc.allowed_values("a", [0, 1, 2]), rc.constant("a"),
    ], ["g"]))
    for g, values in groups.items():
        present = [v for v in values if v is not None]
        outside = sum(not 1 <= v <= 5 for v in present)
        foreign = sum(v not in (0, 1, 2) for v in present)
        nulls = len(values) - len(present)
        single = len(set(values)) == 1
        assert found[g, "no_null"] == ("fail" if nulls else "pass", nulls)
        assert found[g, "value_range"] == ("error" if not present else "fail" if outside else "pass", outside)
        assert found[g, "allowed_values"] == ("fail" if foreign else "pass", foreign)
        assert found[g, "constant"] == ("pass" if single else "fail", 0 if single else 1)


def test_constant_by_group(table, groups):
    found = verdicts(check_constant_by(table, "a", ["g"]))
    for g, values in groups.items():
        more = len(set(values)) - 1
        assert found[g, "constant"] == ("fail" if more else "pass", more)


def test_distinct_metrics(table, groups):
    names = ("CountDistinct", "Distinctness", "Uniqueness", "UniqueValueRatio")
    found = {(r.g, r.name): r.value for r in profile(table, [metric(n, "a") for n in names], ["g"]).collect()}
    for g, values in groups.items():
        present = [v for v in values if v is not None]
        if not present:
            assert [found[g, n] for n in names] == [0, None, None, None]
            continue
        kinds = set(present)
        once = sum(present.count(v) == 1 for v in kinds)
        assert found[g, "CountDistinct"] == len(kinds)
        assert found[g, "Distinctness"] == pytest.approx(len(kinds) / len(present))
        assert found[g, "Uniqueness"] == pytest.approx(once / len(present))
        assert found[g, "UniqueValueRatio"] == pytest.approx(once / len(kinds))


def test_mutual_information_of_groups(spark, groups):
    rng = random.Random(9)
    rows = [(g, v, rng.choice("xy")) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g int, a int, b string")
    found = {r.g: r.value for r in profile(df, [metric("MutualInformation", "a", "b")], ["g"]).collect()}
    for g in groups:
        pairs = [(a, b) for k, a, b in rows if k == g and a is not None]
        if not pairs:
            assert found[g] is None
            continue
        n = len(pairs)
        left, right = [a for a, _ in pairs], [b for _, b in pairs]
        expected = sum(
            pairs.count(p) / n * math.log(pairs.count(p) * n / (left.count(p[0]) * right.count(p[1]))) for p in set(pairs)
        )
        assert found[g] == pytest.approx(expected, abs=1e-9)


def test_sets(spark, groups, table):
    rng = random.Random(5)
    wanted = {g: {rng.choice([None, 0, 1, 2, 3]) for _ in range(3)} for g in groups}
    expected = spark.createDataFrame([(g, v) for g, vs in wanted.items() for v in vs], "g int, a int")
    found = {r.g: (r.missing, r.unexpected) for r in check_sets(table, expected, "a", ["g"]).collect()}
    assert found == {g: (len(wanted[g] - set(vs)), len(set(vs) - wanted[g])) for g, vs in groups.items()}


def test_date_gaps(spark, groups):
    start, end = dt.date(2024, 2, 26), dt.date(2024, 3, 8)
    first = start - dt.timedelta(days=3)
    rows = [(g, None if v is None else first + dt.timedelta(days=v)) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g int, d date")
    found = {}
    for r in date_gaps(df, "d", ["g"], start, end).collect():
        assert r.days == (r.gap_end - r.gap_start).days + 1
        found.setdefault(r.g, []).extend(r.gap_start + dt.timedelta(days=n) for n in range(r.days))
    whole = [start + dt.timedelta(days=n) for n in range((end - start).days + 1)]
    for g in groups:
        loaded = {d for k, d in rows if k == g}
        assert sorted(found.get(g, [])) == [d for d in whole if d not in loaded]
