"""What plans must not do, for it would grow faster than the input or pass through one process."""

import tracemalloc
import weakref

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rolodeck import cluster
from rolodeck.operators import dedup, lookup, pages
from rolodeck.plans import catalogue

from .test_edges import leads


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_restoring_names_reads_a_url_once(spark, small):
    """A slug's steps are each written once: the URL, which the fixture makes of six texts, is not in them over and over."""
    assert len(plan(catalogue.queries()["name_restore"](spark, small)).split("/in/")) < 12


@pytest.mark.parametrize("name", ["name_slug", "name_slug_trim", "name_slug_split", "name_restore"])
def test_a_slug_is_made_once_a_row(spark, small, name):
    """Also in the queries that share name_restore's steps: the URL, which is the fixture's CASE, is stripped in one place of the plan."""
    assert plan(catalogue.queries()[name](spark, small)).count("regexp_replace(CASE WHEN") == 1


def test_merging_joins_no_table_of_all_keys(spark):
    """Rows and sources of a key come with its records. Such a table is small by its estimate, and was told to all tasks."""
    rows = [{"email": f"{i % 3}@x.lv", "city": str(i), "source": f"feed_{i % 2}"} for i in range(9)]
    assert "Join" not in plan(dedup.merged_by_email(leads(spark, rows)))
    few, many = (sorted(dedup.merged_by_email(leads(spark, rows), most=n).select("ord", "city", "source").collect()) for n in (2, 1000))
    assert few == many == [(1, "0", "feed_0,feed_1"), (2, "1", "feed_0,feed_1"), (3, "2", "feed_0,feed_1")]


def test_answers_are_dealt_out_before_they_are_sorted(spark):
    """One task may read all answers; it need not sort them. Nulls, equal answers and ties are as before."""
    rows = [(i % 3 if i % 4 else None, i % 2, ["a", str(i % 5)]) for i in range(60)] + [(1, 1, ["z"])] * 40
    answers = spark.createDataFrame(rows, "k int, nth int, v array<string>").coalesce(1)
    best = lookup.one_row_a_key(answers, F.col("k"), {"v": F.col("v")}, ("nth",))
    assert "RebalancePartitions" in plan(best)
    assert {r.key: r.value.v for r in best.collect()} == {k: max((n, v) for j, n, v in rows if j == k)[1] for k in (0, 1, 2)}


def test_a_batch_is_let_go_before_the_next(spark):
    """Of pages, Python holds one as text; of batches, a task holds one."""
    made = []

    def batches(n, each):
        for i in range(n):
            assert not made or made[-1]() is None
            made.append(weakref.ref(batch := pa.RecordBatch.from_pydict({"page_id": [i] * each, "html": [f"<main>{'word ' * 40_000}</main>"] * each})))
            yield batch
            del batch

    for part in cluster.row_slices(batches(3, 2), "html", 100):
        assert part.num_rows == 1
        del part

    class Table:
        columns = ("page_id", "html")
        schema = None
        drop = withColumn = lambda self, *_: self
        mapInArrow = lambda self, run, _: run

    made.clear()
    run = pages.with_text(Table(), pages.SECTION_RULES)
    source = [pa.RecordBatch.from_pydict({"page_id": list(range(60)), "html": [f"<main>{'word ' * 40_000}</main>"] * 60})]
    tracemalloc.start()
    texts = [t for b in run(iter(source)) for t in b.column("content").to_pylist()]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [len(t) for t in texts] == [3000] * 60 and most < 8 << 20  # the pages are 12 MB
