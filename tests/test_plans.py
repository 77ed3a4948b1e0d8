"""Physical-plan properties the design relies on (pruning, no row-level joins, shuffle counts)."""

import contextlib
import io

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


# The text operators' own queries run jobs of their own and are tested with them.
TEXT = set(E.llm_queries.QUERIES) if E.llm_queries else set()


@pytest.mark.parametrize("key", sorted(set(E.oracle_sql()) - TEXT))
def test_no_row_pairing_joins(spark, key):
    p = plan(E.queries()[key](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "SortMergeJoin"):
        assert bad not in p, (key, bad)


def reads(p: str) -> list[str]:
    return [line for line in p.splitlines() if line.startswith("ReadSchema")]


def test_correlations_are_one_pruned_scan(spark):
    for key in ("corr_with_label", "corr_matrix"):
        p = plan(E.queries()[key](spark, SF))
        assert reads(p) == ["ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_discount:double,l_tax:double>"]
        # No copy of a row for a pair, no aggregate expression for a pair; Arrow batches, never rows, reach Python.
        assert "Generate" not in p and "Expand" not in p and "HashAggregate" not in p
        assert "MapInArrow" in p and "BatchEvalPython" not in p


def test_profiles_neither_sort_nor_copy_rows(spark):
    for key in ("profile_numeric", "profile_string"):
        p = plan(E.queries()[key](spark, SF))
        assert len(reads(p)) == 1
        assert "hashpartitioning" not in p
        assert not [x for x in p.splitlines() if x.lstrip("(0123456789) *+-:").startswith("Sort [")]


def test_split_has_no_shuffle(spark):
    p = plan(E.queries()["split_train"](spark, SF))
    assert "Exchange" not in p


def test_group_mean_model_reads_one_column(spark):
    p = plan(E.queries()["onehot_group_mean"](spark, SF))
    read = [line for line in p.splitlines() if line.startswith("ReadSchema")]
    assert read == ["ReadSchema: struct<l_returnflag:string>"]


def test_preview_is_a_top_n_not_a_full_sort(spark):
    p = plan(E.queries()["preview_topk"](spark, SF))
    assert "TakeOrderedAndProject" in p
