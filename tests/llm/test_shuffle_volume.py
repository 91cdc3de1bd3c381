"""Steps that move as little as they can: one shuffle of variants, tags only where they tell texts apart."""

import brute
from prose import prose

from wattframe.llm import simhash, suffix


def stages(module, monkeypatch):
    """The tables that ``module`` stages, by name, before they are written."""
    seen, write = {}, module.staged
    monkeypatch.setattr(module, "staged", lambda df, name: seen.setdefault(name, df) and write(df, name))
    return seen


def test_simhash_variants_are_shuffled_once(spark, monkeypatch):
    seen = stages(simhash, monkeypatch)
    base = 0x0123456789ABCDEF
    fps = spark.createDataFrame([(base ^ (1 << i) ^ (1 << j),) for i in range(30) for j in range(i)], "fp long")
    pairs = simhash.near_pairs(fps).count()
    plan = seen["met"]._jdf.queryExecution().executedPlan().toString()
    assert pairs and plan.count("Exchange") == 1 and "Join" not in plan


def test_simhash_balls_are_made_once_and_joined_with_nothing(spark):
    """Joined, 2,081 rows for each member of a crowded group counted as one and were sent to the driver."""
    base = 0x0123456789ABCDEF
    members = [base, *[base ^ (1 << i) for i in range(1, 60)]]
    pairs = simhash.near_pairs(spark.createDataFrame([(m,) for m in members], "fp long"))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate ") == 1 and plan.count("Join ") == 1
    found = {frozenset((p.a, p.b)) for p in pairs.collect()}
    assert all((a ^ b).bit_count() <= 4 for a, b in found)
    assert set(brute.components(members, [sorted(p) for p in found]).values()) == {min(members)}


def test_suffix_tags_only_ids_with_several_texts(spark, monkeypatch):
    seen = stages(suffix, monkeypatch)
    passage = prose(60, 1)
    rows = [(1, passage), (2, "a " + passage), (3, "b " + passage), (3, "c " + passage), (4, "d " + passage), (4, "d " + passage)]
    suffix.repeats(spark.createDataFrame(rows, "doc_id long, text string")).count()
    tags = {}
    for r in seen["blocks"].select("doc_id", "tag").distinct().collect():
        tags.setdefault(r.doc_id, set()).add(r.tag)
    assert tags[1] == tags[2] == tags[4] == {0} and len(tags[3]) == 2
