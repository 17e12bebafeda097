"""The postings of op1, many for each fingerprint, are never broadcast, however small the table looks."""

from voxtally.llm import simhash


def test_postings_are_joined_without_a_broadcast(spark):
    prints = [5 << 40, 5 << 40 | 7, 1 << 63 | 12345, ~0]
    signed = [p - (1 << 64) if p >> 63 else p for p in (q & (1 << 64) - 1 for q in prints)]
    nodes = spark.createDataFrame([(p,) for p in signed], "fp bigint").repartition(2)
    found = simhash.links(nodes)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert {frozenset(r) for r in found.collect()} == {frozenset(signed[:2])}
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
