"""How rows are laid out before and between steps."""

from unittest import mock

from tidemart.operators import tasks
from tidemart.plans import log_queries, stream_queries

SF_DIR = "/root/testdata/sf0.001"


def test_log_split_deals_events_before_they_are_records(spark):
    """The one split of the events is dealt before the parse, in the plan of the records and in that of their keys."""
    with mock.patch.object(tasks.dealt, "__defaults__", (100,)):
        plan = log_queries.log_split(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 2


def test_segments_are_cut_from_kept_lines(spark):
    """Three segments are taken from written lines, not from the events again each time."""
    with mock.patch.object(stream_queries, "append_segment") as append, mock.patch.object(stream_queries, "run_available"), \
            mock.patch.object(stream_queries, "topic_stream"):
        stream_queries.in_three_segments(spark, SF_DIR, "segments", lambda found: None)
    files = [f for call in append.call_args_list for f in call.args[0].inputFiles()]
    assert len(append.call_args_list) == 3 and files and not any("events.parquet" in f for f in files)
