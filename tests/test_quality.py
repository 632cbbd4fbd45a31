"""One passing and one failing configuration per check."""

from datetime import datetime

import pytest

from candlewright.quality.checks import CHECKS
from candlewright.quality.suite import report_with_samples, QualityError, check, gate, report, unexpected_rows

CASES = {
    "column_not_null": ({"column": "id"}, {"column": "gap"}),
    "columns_not_null": ({"columns": ["id", "gap"], "mostly": 0.5}, {"columns": ["id", "gap"]}),
    "column_be_null": ({"column": "void"}, {"column": "id"}),
    "columns_be_null": ({"columns": ["void"]}, {"columns": ["void", "gap"]}),
    "column_non_null_proportion_between": ({"column": "gap", "min_value": 0.7, "max_value": 0.8}, {"column": "gap", "min_value": 0.9, "max_value": 1}),
    "row_has_at_least_one_non_null": ({"columns": ["gap", "id"]}, {"columns": ["gap", "void"]}),
    "column_a_greater_than_b": ({"column_a": "x", "column_b": "id"}, {"column_a": "x", "column_b": "id", "or_equal": False}),
    "multicolumn_sum_to_equal": ({"column_list": ["id", "rest"], "sum_total": 5}, {"column_list": ["id", "x"], "sum_total": 5}),
    "group_consistency": ({"group_col": "grp", "value_col": "same"}, {"group_col": "grp", "value_col": "gap"}),
    "column_datetime_range": ({"column": "t", "start_time": "2024-01-01", "end_time": "2024-01-04"},
                              {"column": "t", "start_time": "2024-01-01", "end_time": "2024-01-04", "strict_start": True}),
    "column_values_between": ({"column": "id", "min_value": 1, "max_value": 4}, {"column": "id", "min_value": 1, "strict_min": True}),
    "column_max_between": ({"column": "id", "max_value": 4}, {"column": "id", "max_value": 4, "strict_max": True}),
    "column_min_between": ({"column": "id", "min_value": 1}, {"column": "id", "min_value": 2}),
    "column_mean_between": ({"column": "id", "min_value": 2.5, "max_value": 2.5}, {"column": "id", "min_value": 3}),
    "column_median_between": ({"column": "id", "min_value": 2.5, "max_value": 2.5}, {"column": "id", "max_value": 2}),
    "column_kl_divergence_less_than": ({"column": "grp", "partition_object": {"values": ["a", "b"], "weights": [0.5, 0.5]}, "threshold": 0.01},
                                       {"column": "grp", "partition_object": {"values": ["a", "c"], "weights": [0.5, 0.5]}, "threshold": 9}),
    "column_quantile_values_to_be_between": ({"column": "id", "quantile_ranges": {"quantiles": [0, 1], "value_ranges": [[1, 1], [None, 4]]}},
                                             {"column": "id", "quantile_ranges": {"quantiles": [0.5], "value_ranges": [[4, 5]]}}),
    "column_stdev_to_be_between": ({"column": "id", "min_value": 1.29, "max_value": 1.3}, {"column": "id", "max_value": 1.2}),
    "column_sum_to_be_between": ({"column": "id", "min_value": 10, "max_value": 10}, {"column": "id", "min_value": 10, "strict_min": True}),
    "column_value_zscores_to_be_less_than": ({"column": "id", "threshold": 2}, {"column": "id", "threshold": 1}),
    "columns_to_match_set": ({"column_set": ["id", "x"], "exact_match": False}, {"column_set": ["id", "x"]}),
    "columns_to_match_ordered_list": ({"column_list": ["id", "x", "rest", "gap", "void", "grp", "same", "word", "t"]}, {"column_list": ["x", "id"]}),
    "table_column_count_equal": ({"value": 9}, {"value": 8}),
    "column_values_to_be_in_type_list": ({"column": "id", "type_list": ["int", "bigint"]}, {"column": "id", "type_list": ["string"]}),
    "column_values_to_be_of_type": ({"column": "word", "expected_type": "string"}, {"column": "word", "expected_type": "int"}),
    "column_to_exist": ({"column": "id"}, {"column": "nope"}),
    "table_column_count_between": ({"min_value": 1, "max_value": 9}, {"max_value": 8}),
    "column_values_in_set": ({"column": "grp", "value_set": ["a", "b"]}, {"column": "grp", "value_set": ["a"]}),
    "column_most_common_value_in_set": ({"column": "grp", "value_set": ["a"], "ties_okay": True}, {"column": "grp", "value_set": ["a"]}),
    "column_value_lengths_to_equal": ({"column": "grp", "value": 1}, {"column": "word", "value": 1}),
    "column_value_lengths_between": ({"column": "word", "min_value": 2, "max_value": 5}, {"column": "word", "max_value": 4}),
    "column_pair_values_in_set": ({"column_a": "grp", "column_b": "same", "value_pairs_set": [("a", 1), ("b", 2)]},
                                  {"column_a": "grp", "column_b": "same", "value_pairs_set": [("a", 1)]}),
    "column_pair_values_equal": ({"column_a": "gap", "column_b": "gap"}, {"column_a": "gap", "column_b": "id"}),
    "column_values_match_regex": ({"column": "word", "regex": "^[a-z]+$"}, {"column": "word", "regex": "^a"}),
    "column_values_match_regex_list": ({"column": "word", "regex_list": ["^a", "e"]}, {"column": "word", "regex_list": ["^a", "e"], "match_on": "all"}),
    "column_values_match_like_list": ({"column": "word", "like_pattern_list": ["a%", "%e%"]}, {"column": "word", "like_pattern_list": ["a%"]}),
    "column_values_not_in_set": ({"column": "grp", "value_set": ["z"]}, {"column": "grp", "value_set": ["a"]}),
    "column_values_not_match_regex": ({"column": "word", "regex": "[0-9]"}, {"column": "word", "regex": "e"}),
    "column_values_not_match_regex_list": ({"column": "word", "regex_list": ["[0-9]", "Z"]}, {"column": "word", "regex_list": ["[0-9]", "e"]}),
    "column_values_unique": ({"column": "gap"}, {"column": "grp"}),
    "compound_columns_unique": ({"column_list": ["grp", "id"]}, {"column_list": ["grp", "same"]}),
    "column_distinct_values_in_set": ({"column": "grp", "value_set": ["a", "b", "c"]}, {"column": "grp", "value_set": ["a"]}),
    "column_distinct_values_to_equal_set": ({"column": "grp", "value_set": ["a", "b"]}, {"column": "grp", "value_set": ["a", "b", "c"]}),
    "column_distinct_values_contain_set": ({"column": "grp", "value_set": ["a"]}, {"column": "grp", "value_set": ["a", "c"]}),
    "select_column_values_unique_within_record": ({"column_list": ["id", "word"]}, {"column_list": ["id", "x"]}),
    "column_unique_value_count_to_be_between": ({"column": "grp", "min_value": 2, "max_value": 2}, {"column": "grp", "min_value": 3}),
    "column_proportion_of_unique_values_to_be_between": ({"column": "grp", "max_value": 0.5}, {"column": "grp", "max_value": 0.5, "strict_max": True}),
    "table_row_count_between": ({"min_value": 4}, {"min_value": 4, "strict_min": True}),
    "table_row_count_to_equal": ({"value": 4}, {"value": 5}),
}


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(1, 1, 4, 7, None, "a", 1, "apple", datetime(2024, 1, 1)), (2, 2, 3, 8, None, "a", 1, "beet", datetime(2024, 1, 2)),
            (3, 3, 2, None, None, "b", 2, "chere", datetime(2024, 1, 3)), (4, 4, 1, 9, None, "b", 2, "re", datetime(2024, 1, 4))]
    return spark.createDataFrame(rows, "id int, x int, rest int, gap int, void string, grp string, same int, word string, t timestamp").cache()


def test_every_check_has_a_case():
    assert set(CASES) == set(CHECKS) and len(CHECKS) == 49


@pytest.mark.parametrize("name", list(CASES))
def test_check(frame, name):
    good, bad = CASES[name]
    assert check(frame, name, **good) is frame
    with pytest.raises(QualityError):
        check(frame, name, **bad)


def test_missing_keys_and_columns_are_errors(frame):
    with pytest.raises(KeyError):
        check(frame, "column_not_null")
    with pytest.raises(ValueError):
        check(frame, "column_not_null", column="nope")
    with pytest.raises(KeyError):
        report(frame, [("no_such_check", {})])


def test_gate_lists_every_failure(frame):
    with pytest.raises(QualityError) as error:
        gate(frame, [("column_not_null", {"column": "gap"}), ("column_values_unique", {"column": "grp"}), ("column_to_exist", {"column": "id"})])
    assert "column_not_null" in str(error.value) and "column_values_unique" in str(error.value) and "column_to_exist" not in str(error.value)


def test_empty_frame_passes_row_checks(frame):
    empty = frame.limit(0)
    assert check(empty, "column_values_between", column="id", min_value=9) is empty
    with pytest.raises(QualityError):
        check(empty, "column_max_between", column="id", min_value=0)


def test_samples_of_unexpected_rows(frame):
    assert [r["id"] for r in unexpected_rows(frame, "column_not_null", column="gap").collect()] == [3]
    assert unexpected_rows(frame, "column_values_unique", column="grp").count() == 4


def test_failed_checks_carry_rows(spark):
    import json

    rows = [(i, "a" if i < 40 else "b", 1.0 + i % 3, "x" if i != 7 else "y") for i in range(60)] + [(60, "c", 999.0, None), (60, None, None, None)]
    df = spark.createDataFrame(rows, "id int, grp string, v double, same string")
    checks = [
        ("column_values_between", {"column": "id", "min_value": 0, "max_value": 9}), ("column_value_zscores_to_be_less_than", {"column": "v", "threshold": 5.0}),
        ("group_consistency", {"group_col": "grp", "value_col": "same"}), ("column_values_unique", {"column": "id"}),
        ("column_distinct_values_in_set", {"column": "grp", "value_set": ["a", "b"]}), ("column_mean_between", {"column": "v", "max_value": 1.0}),
        ("column_not_null", {"column": "id"}),
    ]
    got = {r["check"]: (r["success"], [json.loads(x) for x in r["sample"]]) for r in report_with_samples(df, checks).collect()}
    assert [c for c, (ok, _) in got.items() if ok] == ["column_not_null"] and got["column_not_null"][1] == []
    assert len(got["column_values_between"][1]) == 20 and all(r["id"] > 9 for r in got["column_values_between"][1])
    assert [r["v"] for r in got["column_value_zscores_to_be_less_than"][1]] == [999.0]
    assert len(got["group_consistency"][1]) == 20 and {r["grp"] for r in got["group_consistency"][1]} == {"a"}
    assert [r["id"] for r in got["column_values_unique"][1]] == [60, 60] and [r["grp"] for r in got["column_distinct_values_in_set"][1]] == ["c"]
    assert got["column_mean_between"][1] == []
    with pytest.raises(QualityError) as error:
        gate(df, checks)
    assert len(error.value.samples[("column_values_between", "id")]) == 20 and '"v":999.0' in str(error.value)
    assert unexpected_rows(df, "column_value_zscores_to_be_less_than", column="v", threshold=5.0).count() == 1
    assert unexpected_rows(df, "group_consistency", group_col="grp", value_col="same").count() == 20
