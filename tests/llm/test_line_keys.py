"""Near lines around the limit of long ones, beyond ASCII, and which texts are looked up."""

from wattframe.llm import linededup


def test_lines_around_the_limit_of_long_ones_still_link(spark):
    base = "ggggmmpp ünïcødé 🙂 " + "abcdefgh " * 11
    first = base + "x" * (linededup.LONG - 1 - len(base.encode()))
    near = [first, first + "yz", "p" + first, first.replace("🙂", "🙃"), first[:-2]]
    far = first[:60] + first[63:] + "k"
    docs = spark.createDataFrame(list(enumerate([*near, far])), "doc_id long, text string")
    links = linededup.line_links(docs)[1].selectExpr("a.doc_id a", "b.doc_id b").collect()
    assert {(0, i) for i in range(1, len(near))} <= set(map(tuple, links)) and (0, len(near)) not in set(map(tuple, links))


def test_few_other_texts_are_looked_up_and_none_is_shuffled(spark):
    docs = spark.range(20_000).selectExpr("id * 1000003 - 7 as doc_id", "'x' as text")
    ids = docs.where("pmod(doc_id, 37) = 0").select("doc_id")
    found = linededup.marked(docs, ids, ids.count())
    assert found.join(ids, "doc_id").count() == ids.count() and found.count() < docs.count() // 5
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
