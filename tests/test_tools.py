from tools.plan_summary import summarise


def test_plan_summary_counts_and_scans():
    plan = "\n".join([
        "AdaptiveSparkPlan isFinalPlan=true",
        "+- Exchange hashpartitioning(id#1, 8), ENSURE_REQUIREMENTS",
        "   +- BroadcastHashJoin [id#1], [id#2], Inner, BuildRight",
        "      :- WindowGroupLimit [id#1], [v#3 DESC], row_number(), 5, Partial",
        "      :  +- HashAggregate(keys=[id#1], functions=[partial_count(1)])",
        "      :     +- FileScan parquet [id#1,v#3] Batched: true, Location: InMemoryFileIndex(1 paths)"
        "[file:/root/testdata/sf0.01/part.parquet], PartitionFilters: [], PushedFilters: [IsNotNull(id)], "
        "ReadSchema: struct<id:bigint,v:double>",
        "      +- BroadcastExchange HashedRelationBroadcastMode(List(input[0, bigint, true]),false)",
    ])
    text = "\n".join(summarise("q", plan))
    assert "shuffles (Exchange hashpartitioning/rangepartitioning): 1" in text
    assert "broadcast hash joins: 1; sort-merge joins: 0" in text
    assert "map-side top-k (WindowGroupLimit ... Partial): 1" in text
    assert "- `sf0.01/part.parquet` pushed [IsNotNull(id)] read `struct<id:bigint,v:double>`" in text
