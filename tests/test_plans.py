"""Plans that must hold for large data: no pairwise joins, no one-task windows
over rows, partial top-k before the shuffle, filters and columns in the scan."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from coinsieve.operators.aggregate import category_distribution
from coinsieve.operators.dedupe import dedupe_exact, flag_duplicates
from coinsieve.operators.match import match_keywords, match_keywords_exact, match_rules
from coinsieve.streaming.ingest import stored_keys, upsert_batch
from registry.views import fixture_keywords, fixture_rules, txn_events, txn_lineitem

SF_DIR = "/root/testdata/sf0.001"
QUERIES = queries()
# Those that only read files they have just written show nothing of a plan.
LAZY = sorted(n for n in QUERIES if not n.startswith(("read_layout", "stream_", "run_", "rules_")))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_pairwise_join(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_containment_in_a_short_list_needs_no_shuffle(spark):
    text = plan(match_keywords_exact(txn_events(spark, SF_DIR), fixture_keywords(spark)))
    assert "Exchange" not in text and "Join" not in text and "Python" not in text


@pytest.mark.parametrize("match, entries", [(match_keywords, fixture_keywords), (match_rules, fixture_rules)])
def test_similarity_to_a_short_list_runs_without_python(spark, match, entries):
    text = plan(match(txn_events(spark, SF_DIR), entries(spark), matcher="edit"))
    assert "Python" not in text and "Arrow" not in text and "levenshtein" not in text  # scored before, per text


def test_exact_dedupe_is_one_shuffle(spark):
    assert plan(dedupe_exact(txn_events(spark, SF_DIR))).count("Exchange hashpartitioning") == 1


def test_flagging_reads_only_key_columns_for_counts(spark):
    text = plan(flag_duplicates(txn_events(spark, SF_DIR)).select("seq", "is_duplicate"))
    assert "Window" not in text and "user_id" not in text


def test_top_k_per_category_is_cut_before_the_shuffle(spark):
    text = plan(QUERIES["sample_examples"](spark, SF_DIR))
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_top_patterns_take_no_global_sort(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_patterns"](spark, SF_DIR))


def test_projection_reaches_the_scan(spark):
    text = plan(txn_lineitem(spark, SF_DIR).select(F.abs("amount")))
    assert "l_tax" not in text and "l_discount" not in text


def test_distributions_read_their_input_once(spark):
    df = txn_events(spark, SF_DIR).withColumn("category", F.col("source"))
    assert plan(category_distribution(df)).count("FileScan") == 1


def test_upsert_opens_the_files_of_the_batch_months(spark, tmp_path):
    store = str(tmp_path / "store")
    upsert_batch(store)(txn_events(spark, SF_DIR), 0)
    batch = txn_events(spark, SF_DIR).limit(1)
    keys = plan(stored_keys(spark, store, 1, batch))
    assert "month" in keys[keys.index("PartitionFilters") :].split("]")[0]
    with pytest.raises(Exception, match="(?i)scheme|FileSystem"):
        stored_keys(spark, "nosuch://store", 1, batch)
