"""Hand-written frames: ties, NULLs, empty input, zero denominators, brute-force baskets."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from salesmart.operators import anomaly, basket, cleaning, customers, enrich, features, forecast, ingest, items, marts, models, quality, reporting
from salesmart.operators.ingest import Field


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---- baskets ---------------------------------------------------------------


def baskets(spark, seed, orders=120, outlets=3, catalogue=9, hot=True):
    rng = random.Random(seed)
    out = set()
    for o in range(orders):
        items_ = rng.sample(range(catalogue), rng.randint(1, 5)) if not (hot and o % 3) else [0, 1, 2]
        out |= {(o % outlets, o, f"i{x}") for x in items_}
    return sorted(out), spark.createDataFrame(sorted(out), "outlet_id long, order_id long, item string")


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("threshold", [1, 4, 15])
def test_pair_counts_equal_brute_force(spark, seed, threshold):
    data, df = baskets(spark, seed)
    want = Counter()
    for (outlet, _), group in itertools.groupby(data, key=lambda r: r[:2]):
        for a, b in itertools.combinations(sorted(r[2] for r in group), 2):
            want[(outlet, a, b)] += 1
    want = sorted(((*k, n) for k, n in want.items() if n >= threshold), key=repr)
    assert rows(basket.pair_counts(df, threshold)) == want
    assert rows(basket.pair_counts(df, threshold, part=2)) == want  # nearly every order in parts


def test_itemsets_equal_brute_force(spark):
    data, df = baskets(spark, 5, orders=60)
    per_order = {}
    for _, o, i in data:
        per_order.setdefault(o, set()).add(i)
    want = Counter()
    for group in per_order.values():
        for n in range(1, len(group) + 1):
            want.update(itertools.combinations(sorted(group), n))
    limit = 0.1 * len(per_order)
    want = {k: n for k, n in want.items() if n >= limit}
    got = {tuple(r["items"]): r["freq"] for r in basket.frequent_itemsets(df, 0.1).collect()}
    assert got == want


def test_rules_equal_brute_force(spark):
    data, df = baskets(spark, 6, orders=50)
    per_order = {}
    for _, o, i in data:
        per_order.setdefault(o, set()).add(i)
    freq = Counter(c for g in per_order.values() for n in range(1, len(g) + 1) for c in itertools.combinations(sorted(g), n))
    sets = {c: n for c, n in freq.items() if n >= 0.08 * len(per_order)}
    want = {}
    for items, n in sets.items():
        for k in range(1, len(items)):
            for a in itertools.combinations(items, k):
                c = tuple(x for x in items if x not in a)
                want[a, c] = (n, n / len(per_order), n / freq[a], n * len(per_order) / (freq[a] * freq[c]))
    got = {(tuple(r["antecedent"]), tuple(r["consequent"])): (r["freq"], r["support"], r["confidence"], r["lift"])
           for r in basket.association_rules(basket.frequent_itemsets(df, 0.08), len(per_order)).collect()}
    assert max(map(len, sets)) >= 3 and got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)
    some = basket.association_rules(basket.frequent_itemsets(df, 0.08), len(per_order), min_confidence=0.5)
    assert some.count() == sum(v[2] >= 0.5 for v in want.values())


def test_a_very_long_order_is_never_one_row(spark):
    from salesmart.operators.basket import long_pairs

    n = 3000
    kept = spark.range(n).select(F.lit(1).alias("outlet_id"), F.lit(7).alias("order_id"), F.col("id").alias("item"))
    sizes = spark.createDataFrame([(1, 7, n)], "outlet_id int, order_id int, size long")
    pairs = long_pairs(kept, sizes, 100)
    assert "collect_list" in pairs._jdf.queryExecution().optimizedPlan().toString()
    found = pairs.groupBy("item_a", "item_b").count()
    assert (found.count(), found.agg(F.max("count")).first()[0], pairs.where("item_a >= item_b").count()) == (n * (n - 1) // 2, 1, 0)
    lists = kept.withColumn("at", F.pmod(F.xxhash64("item"), F.lit(30))).groupBy("at").count().agg(F.max("count")).first()[0]
    assert lists < 200


def test_one_order_with_every_item(spark):
    df = spark.createDataFrame([(1, 1, f"i{n:03d}") for n in range(60)], "outlet_id long, order_id long, item string")
    assert basket.pair_counts(df, 1).count() == 60 * 59 // 2
    assert basket.pair_counts(df, 2).count() == 0


# ---- cleaning --------------------------------------------------------------


def test_keep_and_quarantine_partition_the_input(data):
    for name, split in cleaning.clean_all(data, "1995-01-01", "2001-08-01").items():
        total = split.marked.count()
        assert split.good.count() + split.bad.count() == total > 0, name
        assert split.bad.where(F.col(cleaning.REASON) == "").count() == 0


def test_dedup_keeps_the_first_and_null_keys_are_equal(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (None, 3, "c"), (None, 2, "d"), (2, 9, "e")], "k long, o long, v string")
    assert sorted(r["v"] for r in cleaning.dedup_keep_first(df, ["k"], "o").collect()) == ["a", "d", "e"]


def test_first_failing_rule_names_the_reason(spark):
    df = spark.createDataFrame([(1, -1.0), (None, -1.0), (1, 1.0), (1, None)], "k long, x double")
    marked = cleaning.mark(df, [("no key", F.col("k").isNull()), ("negative", F.col("x") < 0)])
    assert [r[cleaning.REASON] for r in marked.collect()] == ["negative", "no key", None, None]


def test_empty_input(spark):
    empty = spark.createDataFrame([], "order_id long, x double")
    assert rows(quality.profile_table(empty, "t")) == [("t", 0, 2, 0)]
    assert rows(quality.check_pk(empty, "t", ["order_id"])) == [("t", "pk_duplicate", 0), ("t", "pk_null", 0)]
    assert rows(quality.count_failures(empty, "t", {"bad": F.col("x") < 0})) == [("t", "bad", 0)]


def test_null_foreign_key_is_an_orphan_unless_optional(spark):
    child = spark.createDataFrame([(1,), (1,), (7,), (None,)], "k long")
    parent = spark.createDataFrame([(1,)], "id long")
    assert quality.check_fk(child, "c", "k", parent, "id").first()["failures"] == 2
    assert quality.check_fk(child, "c", "k", parent, "id", optional=True).first()["failures"] == 1


# ---- series, anomalies, scores ---------------------------------------------


def orders_frame(spark, rows_):
    return spark.createDataFrame(rows_, "order_id long, customer_id long, outlet_id long, order_date date, order_hour int, order_status string, total_amount double").withColumn(
        "order_date", F.col("order_date").cast("date"))


def test_calendar_fills_gaps_and_trailing_mean_skips_today(spark):
    df = spark.sql("select * from values (date'2024-01-01', 10.0D, 1L), (date'2024-01-04', 40.0D, 2L) t(date, actual_sales, actual_orders)")
    series = enrich.daily_calendar(df, "date", ["actual_sales", "actual_orders"])
    got = forecast.trailing_means(series).orderBy("date").collect()
    assert [r["actual_sales"] for r in got] == [10.0, 0.0, 0.0, 40.0]
    assert [r["rev_7d_ma"] for r in got] == [None, 10.0, 5.0, pytest.approx(10 / 3)]


def test_single_day_has_no_zscore(spark):
    df = spark.sql("select 1L as outlet_id, date'2024-01-01' as order_date, 'Completed' as order_status, 5.0D as total_amount")
    assert anomaly.daily_zscore(df).first()["z_score"] is None


def test_constant_price_has_no_elasticity(spark):
    orders = spark.range(8).select(F.col("id").alias("order_id"), F.lit("Completed").alias("order_status"), F.add_months(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("order_date"))
    flat = spark.range(8).select(F.col("id").alias("order_id"), F.lit(1).cast("long").alias("item_id"), (F.col("id") + 1.0).alias("quantity"), F.lit(3.0).alias("unit_price"))
    assert items.price_elasticity(flat, orders).count() == 0
    falling = flat.withColumn("unit_price", 100.0 / F.col("quantity"))
    assert items.price_elasticity(falling, orders).first()["price_elasticity"] == -1.0


def test_equal_frequencies_score_three(spark):
    frame = spark.range(50).select(F.col("id").alias("customer_id"), F.col("id").alias("r_days"), F.lit(2.0).alias("f_orders"), (F.col("id") + 1.0).alias("m_spend"))
    scored = customers.rfm_scores(frame)
    assert {r["f_score"] for r in scored.collect()} == {3}
    assert {r["m_score"]: r["n"] for r in scored.groupBy("m_score").agg(F.count("*").alias("n")).collect()} == {1: 10, 2: 10, 3: 10, 4: 10, 5: 10}
    newest = scored.where("customer_id = 0").first()
    assert newest["r_score"] == 5 and scored.where("customer_id = 49").first()["r_score"] == 1


def test_one_order_customer_has_no_history(data):
    x = features.order_features(data.promo_orders, data.lines)
    single = x.where("total_orders = 0")
    assert single.count() > 0 and single.where("total_spend <> 0").count() == 0


def test_split_is_stable_and_excludes_held_out(spark):
    frame = spark.range(2000).withColumnRenamed("id", "k")
    a = features.ml_split(frame, "k", held_out=spark.range(100).withColumnRenamed("id", "k"))
    b = features.ml_split(frame.repartition(7), "k", held_out=spark.range(100).withColumnRenamed("id", "k"))
    assert a.count() == 1900 and rows(a) == rows(b)
    assert a.where("side = 'test'").count() == 380


@pytest.mark.parametrize("percent", [0, 1, 20, 50, 100])
def test_each_class_is_cut_to_the_nearest_row(spark, percent):
    sizes = {None: 7, "big": 4000, "one": 1, "two": 2, "mid": 333}
    frame = spark.createDataFrame([(f"{c}-{k}", c) for c, n in sizes.items() for k in range(n)], "k string, c string")
    side = features.ml_split(frame, "k", percent, label="c")
    test = {r["c"]: r["n"] for r in side.where("side = 'test'").groupBy("c").agg(F.count("*").alias("n")).collect()}
    assert {c: test.get(c, 0) for c in sizes} == {c: (n * percent + 50) // 100 for c, n in sizes.items()}
    again = features.ml_split(frame.repartition(5), "k", percent, label="c")
    assert side.exceptAll(again).isEmpty()


def test_rows_of_one_key_stay_together(spark):
    frame = spark.range(500).select((F.col("id") % 40).alias("k"), (F.col("id") % 2).alias("c"))
    sides = features.ml_split(frame, "k", label="c").groupBy("k", "c").agg(F.count_distinct("side").alias("n"))
    assert sides.where("n > 1").isEmpty()


def test_auc_and_f1_against_hand_values(spark):
    scored = spark.createDataFrame([(1, 1, 1, 0.9), (2, 1, 0, 0.4), (3, 0, 0, 0.4), (4, 0, 1, 0.6), (5, 0, 0, 0.1)], "order_id long, actual long, predicted long, probability double")
    got = models.evaluate(scored, models.ORDER_TASK).first()
    # pairs (positive, negative): 0.9 beats all three; 0.4 ties one, loses one, beats one
    assert got["roc_auc"] == pytest.approx((3 + 0.5 + 0 + 1) / 6)
    assert (got["accuracy"], got["f1"]) == (pytest.approx(0.6), pytest.approx(0.5))
    assert got["macro_f1"] == pytest.approx((0.5 + 4 / 6) / 2)


def test_both_ensemble_forms_agree(spark):
    task = models.Task("t", "k", ["x", "y"], "label")
    rows_ = spark.range(300).select(F.col("id").alias("k"), (F.col("id") % 11).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("y"),
                                    F.when(F.col("id") % 11 > 5, 1).otherwise(0).alias("label"), F.lit("train").alias("side"))
    a, b = models.train(task, rows_, "logistic"), models.train(task, rows_, "forest", 5)
    one_pass = models.ensemble_score(a, b, rows_, task)
    joined = models.ensemble(models.score(a, rows_, task), models.score(b, rows_, task), "k")
    assert rows(one_pass) == rows(joined)
    assert "Exchange" not in one_pass._jdf.queryExecution().executedPlan().toString()


def test_loss_trend_per_item_and_for_the_chain(spark):
    losses = spark.sql("""select * from values (1L, 'a', 1L, 1.0D, 10.0D, date'2024-01-05'), (1L, 'a', 1L, 1.0D, 30.0D, date'2024-05-05'),
        (2L, 'b', 1L, 1.0D, 30.0D, date'2024-01-05'), (2L, 'b', 1L, 1.0D, 1.0D, date'2024-05-05') t(item_id, item_name, outlet_id, quantity_wasted, estimated_cost, loss_date)""")
    lines = spark.sql("select 1L as order_id, 1L as item_id, 100.0D as quantity")
    orders = spark.sql("select 1L as order_id, 'Completed' as order_status")
    assert {r["trend_flag"] for r in items.loss_risk(losses, lines, orders).collect()} == {"decreasing"}
    per_item = {r["item_id"]: (r["trend_flag"], r["risk_level"]) for r in items.loss_risk(losses, lines, orders, per_item_trend=True).collect()}
    assert per_item == {1: ("increasing", "Low"), 2: ("decreasing", "High")}


def test_class_ensemble_takes_the_best_mean(spark):
    a = spark.createDataFrame([(1, [0.6, 0.4]), (2, [0.2, 0.8])], "item_id long, classes array<double>")
    b = spark.createDataFrame([(1, [0.1, 0.9]), (2, [0.7, 0.3])], "item_id long, classes array<double>")
    assert rows(models.ensemble_classes(a, b, "item_id", ["x", "y"]).select("item_id", "ensemble_class")) == [(1, "y"), (2, "y")]


# ---- reads and ingest ------------------------------------------------------


def test_order_search_is_literal(spark):
    df = spark.createDataFrame([(12, "a.b"), (120, "axb"), (7, None)], "order_id long, place string")
    found = lambda text: sorted(r["order_id"] for r in df.where(reporting.order_search(text, ["place"])).collect())
    assert found("a.b") == [12] and found("ORD-0012") == [12] and found("no. 7") == [7] and found("(") == [] and found("x12") == []


def test_pages_cover_everything_once(data):
    pages = [reporting.orders_page(data.orders, "amount_desc", page=p, size=100).collect() for p in range(1, 17)]
    ids = [r["order_id"] for page in pages for r in page]
    total = data.orders.count()
    assert len(ids) == len(set(ids)) == min(total, 1600) and pages[0][0]["total"] == total


def test_contract_reports_every_violation(spark):
    df = spark.createDataFrame([("1", "x", "5"), ("", "Completed", "-1"), ("1.5", "Completed", "Infinity")], "id string, status string, amount string")
    contract = {"id": Field("integer", required=True), "status": Field("enum", choices=("Completed",)), "amount": Field("number", low=0), "day": Field("date", required=True)}
    got = [r["rejects"] for r in ingest.ingest_validate(df, contract).collect()]
    assert got == [["missing:day", "invalid:status"], ["missing:day", "missing:id", "invalid:amount"], ["missing:day", "invalid:id", "invalid:amount"]]


def test_upsert_twice_changes_nothing_more(data):
    batch = data.customers.select((F.col("customer_id") + 3).alias("customer_id"), F.lit("WEB").alias("preferred_channel"))
    once = ingest.upsert_snapshot(data.customers, batch, "customer_id").drop("action")
    twice = ingest.upsert_snapshot(once, batch, "customer_id").drop("action")
    assert once.exceptAll(twice).count() == twice.exceptAll(once).count() == 0


def test_shares_sum_to_one(data):
    share = marts.category_revenue_share(data.lines, data.orders, data.items, data.categories)
    assert share.agg(F.sum("share")).first()[0] == pytest.approx(1.0)
    assert marts.payment_mix(data.outlet_orders).agg(F.sum("share")).first()[0] == pytest.approx(100.0)


def test_results_do_not_depend_on_shuffle_partitions(spark, data):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in ("1", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append(rows(marts.customer_analytics(data.customers, data.promo_orders, data.lines, data.items)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]


def test_no_cross_join_or_python_in_plans(spark, data):
    for df in (
        marts.customer_analytics(data.customers, data.promo_orders, data.lines, data.items),
        enrich.promo_window_join(data.outlet_orders, data.promotions), marts.item_behaviour(data.lines, data.promo_orders),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython"):
            assert word not in plan


def test_filters_and_columns_reach_the_scan(spark, data):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = marts.channel_monthly(data.between("2000-01-01", "2000-06-30").orders)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "EqualTo(o_orderstatus,F)" in pushed and "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed
    assert "o_custkey" not in plan
