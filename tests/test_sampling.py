"""A stratum's rows are left out before the window."""

from parallax.operators.sampling import stratified


def test_tasks_keep_the_first_rows_of_a_stratum(spark):
    items = spark.range(5_000).selectExpr("id", "if(id % 50 = 0, id % 3, 7) as stratum")
    sample = stratified(items, 30, ["stratum"], "id")
    assert "WindowGroupLimit" in sample._jdf.queryExecution().optimizedPlan().toString()
    ranked = sorted((r for r in items.selectExpr("id", "stratum", "xxhash64(20260815, id) as draw").collect()), key=lambda r: (r["draw"], r["id"]))
    seen, placed = {}, []
    sizes = {s: sum(r["stratum"] == s for r in ranked) for s in {r["stratum"] for r in ranked}}
    for r in ranked:
        seen[r["stratum"]] = seen.get(r["stratum"], 0) + 1
        placed.append((seen[r["stratum"]] > round(30 * sizes[r["stratum"]] / 5_000), r["draw"], r["id"]))
    assert {r["id"] for r in sample.collect()} == {i for _, _, i in sorted(placed)[:30]}
