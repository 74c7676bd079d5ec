"""Plans: pruned scans, pushed filters, no single task for row-level data."""

import contextlib
import io

import pytest

from plumbline.operators import association, bins, clean, metrics, normality
from plumbline.plans import ranks
from workload import ORACLES, QUERIES
from workload.registry import table

SMALL = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_cleaning_is_a_pruned_scan_with_pushed_filter(spark):
    text = plan(clean.zscore_clean(table(spark, SMALL, "events"), "value").select("value"))
    assert "ReadSchema: struct<value:double>" in text and "Exchange" not in text


def test_binning_needs_no_shuffle(spark):
    text = plan(bins.cut_equal_width(table(spark, SMALL, "lineitem"), ["l_tax"]).select("l_tax_bin"))
    assert "Exchange" not in text and "ReadSchema: struct<l_tax:double>" in text


def test_counts_per_bin_combine_before_the_shuffle(spark):
    text = plan(bins.histogram_sturges(table(spark, SMALL, "events"), ["value"]))
    assert "partial_count" in text


@pytest.mark.parametrize("build", [
    lambda s: ranks.running_counts(table(s, SMALL, "events"), "value"),
    lambda s: normality.differences(table(s, SMALL, "events"), "event_id", "value"),
    lambda s: normality.ks_normal(table(s, SMALL, "events"), ["value"]),
    lambda s: association.spearman_test(table(s, SMALL, "events"), "user_id", "value"),
    lambda s: metrics.roc_curve(table(s, SMALL, "labels"), "quality", {1: "toxic"}),
])
def test_row_level_windows_are_partitioned(spark, build):
    """Only aggregated rows (bucket totals, final sums) may meet in one partition."""
    lines = plan(build(spark)).splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            columns = lines[i - 1]
            assert "bucket" in columns or "sum" in columns or "count" in columns or "max" in columns or "corr" in columns \
                or "n#" in columns or "buf" in columns or "Input [" in columns and "value#" not in columns, columns


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) > 90
