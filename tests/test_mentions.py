"""Mentions of names: word groups meet the names by one hash, and only known groups are written out."""

from cartulary.operators import questions

NAMES = [(10, "Alto"), (20, "Rio Alto"), (30, "Alto, Rio"), (40, "a b c"), (50, "a b c d"), (60, "..."), (70, None), (5, "río alto")]


def test_groups_are_looked_up_by_hash_and_told_apart_for_each_id(spark):
    docs = spark.createDataFrame([(1, "Río Alto. rio alto"), (1, "ALTO"), (2, "x a B c d"), (3, None), (4, " ...!"), (5, "rio"), (None, "alto")], "d int, t string")
    found = questions.mentions(docs, "d", "t", spark.createDataFrame(NAMES, "i int, n string"), "n", "i", 3)
    assert {r["d"]: (r["n_names"], r["longest_name"], r["entity_id"]) for r in found.collect()} == {
        1: (3, "rio alto", 5), 2: (1, "a b c", 40), None: (1, "alto", 10)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "array_distinct" not in plan
    assert "(__h#" in plan and "__t#" in plan and " = __known#" in plan and "= __g#" not in plan
