from ledgerloom.llm import chat
from ledgerloom.plans.common import table


def test_records_are_read_once_for_all_layouts(spark):
    records = chat.as_records(chat.turn_rows(table(spark, "/root/testdata/sf0.001", "conversations")))
    plan = chat.json_turn_rows(records)[0]._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and plan.count("FileScan") == 1
