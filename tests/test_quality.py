from __future__ import annotations

import pytest

from tidemark.operators.quality import Rule, expect, expectations, row_filter, violations

RULES = {"positive": "v > 0", "small": "v < 10"}


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.createDataFrame([(1,), (-1,), (20,), (None,)], "v int")


@pytest.mark.parametrize("action", ["expect", "expect_all"])
def test_warn_keeps_rows_and_counts(numbers, action):
    df, counters = expect(numbers, RULES, action)
    assert df.count() == 4
    assert counters.get == {"rows": 4, "positive": 2, "small": 2}


@pytest.mark.parametrize("action", ["expect_or_drop", "expect_all_or_drop"])
def test_drop_counts_before_dropping_and_null_is_a_violation(numbers, action):
    df, counters = expect(numbers, RULES, action)
    assert [r.v for r in df.collect()] == [1]
    assert counters.get == {"rows": 4, "positive": 2, "small": 2}


@pytest.mark.parametrize("action", ["expect_or_fail", "expect_all_or_fail"])
def test_fail_names_the_rule_and_publishes_nothing(spark, numbers, tmp_path, action):
    df, _ = expect(numbers, RULES, action)
    with pytest.raises(Exception, match="expectation violated: (positive|small)"):
        df.write.parquet(str(tmp_path / "out"))
    assert not (tmp_path / "out" / "_SUCCESS").exists()
    good, _ = expect(numbers.filter("v = 1"), RULES, action)
    assert good.count() == 1


def test_mixed_actions_on_one_row(numbers):
    rules = [
        Rule("warned", "v <> 1", "expect"),
        Rule("dropped", "v > 0", "expect_or_drop"),
        Rule("failing", "v < 100 or v is null", "expect_or_fail"),
    ]
    df, counters = expectations(numbers, rules)
    assert sorted(r.v for r in df.collect()) == [1, 20]
    assert counters.get == {"rows": 4, "warned": 2, "dropped": 2, "failing": 0}


def test_bad_rules():
    with pytest.raises(ValueError):
        Rule("x", "true", "expect_nothing")
    with pytest.raises(ValueError):
        Rule("", "true")


def test_rule_names_must_differ(numbers):
    with pytest.raises(ValueError):
        expectations(numbers, [Rule("a", "v > 0"), Rule("a", "v > 1")])


def test_violations_in_one_pass(numbers):
    found = {r.rule: (r.rows, r.violations) for r in violations(numbers, [Rule(d, c) for d, c in RULES.items()]).collect()}
    assert found == {"positive": (4, 2), "small": (4, 2)}
    with pytest.raises(ValueError):
        violations(numbers, [])


def test_row_filter(numbers):
    assert row_filter(numbers, "v > 0").count() == 2
    assert row_filter(numbers, None).count() == 4
