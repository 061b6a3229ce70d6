import datetime as dt
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillspark import schemas
from tillspark.operators import warehouse as WH
from tillspark.operators.bitmaps import counts_of_bits, distinct_bits, merged_bits
from tillspark.operators.features import add_features
from tillspark.operators.lookup import heavy_keys, star_lookup
from tillspark.operators.store import LINE, Store
from tillspark.plans import kept as K
from tillspark.plans import reports as R
from tillspark.session import shared_path


def lines(n, seed, months=(1, 2, 3)):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        inv = rng.randint(1, n // 3)
        out.append((f"{inv}", f"A{rng.randint(1, 30):04d}", rng.choice(["Lamp", "Mug", "Vase", None]), rng.randint(1, 9),
                    dt.datetime(2011, months[inv % len(months)], 1 + inv % 27, 8 + inv % 10), Decimal(rng.randint(1, 500)) / 100,
                    rng.choice([None, 10, 11, 12, 500_000]), rng.choice(["EIRE", "EIRE", "USA", "Japan"])))
    return out


def sales(spark, rows):
    return add_features(spark.createDataFrame(rows, schemas.RAW_SALES))


def files(path, name):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(f"{path}/{name}") for f in fs if f.endswith(".parquet")}


def named(w):
    f = w.fact.join(w.dim_product, "product_key").join(w.dim_country, "country_key")
    return sorted(f.select("invoice_no", "date_key", "stock_code", "description", "customer_key", "country_name", "region", "quantity",
                           "unit_price", "total_revenue").collect(), key=repr)


@pytest.fixture(scope="module")
def grown(spark, tmp_path_factory):
    rows = lines(300, 1) + lines(40, 2, (4,))
    rows += rows[:15]                                            # equal lines, which count
    first = [r for r in rows if r[4].month <= 2]
    second = [r for r in rows if r[4].month >= 2]                # February comes twice
    path = str(tmp_path_factory.mktemp("store"))
    store = Store(spark, path)
    store.load(sales(spark, first))
    january = files(path, "fact_sales/month_key=201101")
    keys = {r.stock_code: r.product_key for r in store.read().dim_product.collect()}
    changed = store.load(sales(spark, second))
    return {"rows": rows, "store": store, "path": path, "january": january, "keys": keys, "changed": changed}


def test_two_overlapping_loads_equal_one(spark, grown, tmp_path):
    w = grown["store"].read()
    assert grown["changed"] == [201103, 201104]
    one = Store(spark, str(tmp_path / "one"))
    one.load(sales(spark, grown["rows"]))
    assert named(w) == named(one.read()) and w.fact.count() == len(grown["rows"])
    built = WH.build_warehouse(sales(spark, grown["rows"]))
    assert sorted(map(tuple, built.dim_date.collect())) == sorted(map(tuple, w.dim_date.select(*built.dim_date.columns).collect()))
    assert sorted(map(tuple, built.dim_customer.collect())) == sorted(map(tuple, w.dim_customer.collect()))


def test_old_months_keep_their_files_and_keys_go_on(grown):
    w = grown["store"].read()
    assert files(grown["path"], "fact_sales/month_key=201101") == grown["january"]
    ids = sorted(r.sale_id for r in w.fact.select("sale_id").collect())
    assert ids == list(range(1, len(grown["rows"]) + 1))
    keys = {r.stock_code: r.product_key for r in w.dim_product.collect()}
    assert all(keys[c] == k for c, k in grown["keys"].items()) and sorted(keys.values()) == list(range(1, len(keys) + 1))


def test_a_repeated_load_changes_nothing(spark, grown):
    before = files(grown["path"], "fact_sales")
    assert grown["store"].load(sales(spark, grown["rows"])) == []
    assert files(grown["path"], "fact_sales") == before


def test_a_load_that_failed_after_staging_is_completed(spark, tmp_path, monkeypatch):
    rows, store = lines(60, 4), Store(spark, str(tmp_path))
    store.load(sales(spark, rows[:30]))
    with monkeypatch.context() as m:
        m.setattr(Store, "refresh", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.load(sales(spark, rows))
    with pytest.raises(ValueError):
        store.read()
    store.load(sales(spark, rows))
    assert store.read().fact.count() == 60
    assert named(store.read()) == named(WH.build_warehouse(sales(spark, rows)))


def scanned(df):
    """Rows that the scan of a plan without exchanges has given out."""
    rows = df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return rows, leaf.metrics().apply("numOutputRows").value()


def test_point_lookups_skip_row_groups(spark, grown):
    store, lines = grown["store"], grown["rows"]
    for asked, want in (({"invoice_no": "7"}, [r for r in lines if r[0] == "7"]), ({"customer_id": 500_000}, [r for r in lines if r[6] == 500_000]),
                        ({"stock_code": "A0003"}, [r for r in lines if r[1] == "A0003"]), ({"stock_code": "none"}, []),
                        ({"customer_id": 11, "stock_code": "A0003"}, [r for r in lines if r[6] == 11 and r[1] == "A0003"])):
        assert store.lines_of(**asked).count() == len(want)
    all_lines = len(lines)
    rows, read = scanned(store.lines_of(invoice_no="1x"))     # between the least and the greatest, but absent
    assert rows == [] and read < all_lines / 3
    rows, read = scanned(store.lines_of(customer_id=400_000))
    assert rows == [] and read <= all_lines


def test_empty_batch_and_missing_store(spark, tmp_path):
    store = Store(spark, str(tmp_path / "none"))
    assert store.load(sales(spark, [])) == []
    with pytest.raises(ValueError):
        store.read()


@pytest.mark.parametrize("kept, report", [(K.q01_monthly_revenue, R.q01_monthly_revenue), (K.q08_monthly_product, R.q08_monthly_product),
                                          (K.q09_risk_trend, R.q09_risk_trend), (K.q10_kpis, R.q10_kpis), (K.inventory_risk, WH.inventory_risk)])
def test_kept_reports_equal_those_of_the_fact_without_reading_it(grown, kept, report):
    w = grown["store"].read()
    got, want = kept(w), report(w)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.select(*got.columns).collect()), key=repr)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "fact_sales" not in plan and "Expand" not in plan and "staging_sales" not in plan


def test_bitmaps_merge(spark):
    rng = random.Random(3)
    rows = [(rng.randint(1, 6), rng.choice([1, 5, 40_000, 3_000_000_000, None]), rng.randint(0, 99)) for _ in range(3_000)]
    df = spark.createDataFrame(rows, "d int, a bigint, b int")
    bits = distinct_bits(df, ["d"], {"a": F.col("a"), "b": F.col("b")})
    halves = merged_bits(bits.withColumn("h", F.col("d") > 3), ["h"])
    got = {r.h: (r.a, r.b) for r in counts_of_bits(halves, ["h"], ["a", "b"]).collect()}
    for h in (False, True):
        mine = [r for r in rows if (r[0] > 3) == h]
        assert got[h] == (len({r[1] for r in mine} - {None}), len({r[2] for r in mine}))
    assert tuple(counts_of_bits(halves, [], ["a", "b"]).first()) == (4, 100)
    assert tuple(counts_of_bits(bits.limit(0), [], ["a", "b"]).first()) == (0, 0)


def test_bitmaps_are_made_after_the_exchange(spark):
    """Begun in every task, they would be moved once a task: tasks x days x buckets of 4 KB."""
    df = spark.range(1000).selectExpr("cast(id % 7 as int) d", "cast(id % 3 as int) m", "id a")
    for deal in (None, ["m"]):
        bits = distinct_bits(df, ["m", "d"], {"a": F.col("a")}, deal=deal, parts=2)
        plan = bits._jdf.queryExecution().executedPlan().toString()
        assert "bitmap_construct_agg" in plan and "bitmap_construct_agg" not in plan[plan.index("Exchange"):]
        assert tuple(counts_of_bits(bits, [], ["a"]).first()) == (1000,)


def test_lines_of_new_months_are_not_compared_nor_dealt_again(spark, grown, tmp_path):
    store = grown["store"]
    assert store.staged_months() == {201101, 201102, 201103, 201104}
    batch = sales(spark, lines(30, 9, (6,))).withColumn("month_key", F.lit(201106)).select(*LINE, "month_key")
    plan = store.fresh_lines(batch, [201106])._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Exchange" not in plan
    days = files(grown["path"], "daily_product")
    assert len(days) == 4 and len(files(grown["path"], "distinct_bits")) == 4    # one part a month at this size


def test_star_lookup_equals_joins_on_a_hot_key(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice(["UK"] * 92 + [None] * 20 + [f"c{k}" for k in range(9)] + ["lost"])) for i in range(5_000)]
    facts = spark.createDataFrame(rows, "id int, country string")
    dim = spark.createDataFrame([("UK", 1, "x"), *((f"c{k}", k + 2, None) for k in range(9))], "country string, key bigint, note string")
    want = sorted(map(tuple, facts.join(dim, "country").select("id", "country", "key", "note").collect()), key=repr)
    for share in (0.5, 0.001, 2.0):
        got = star_lookup(facts, dim, "country", ["key", "note"], share=share).select("id", "country", "key", "note").collect()
        assert sorted(map(tuple, got), key=repr) == want
        kept = star_lookup(facts, dim, "country", ["key"], {"key": F.lit(-1)}, share=share)
        assert sorted((r.id, r.key) for r in kept.collect()) == sorted((i, {"UK": 1, **{f"c{k}": k + 2 for k in range(9)}}.get(c, -1)) for i, c in rows)
    assert [r.country for r in heavy_keys(facts, "country", 0.5).collect()] == ["UK"]


def test_lines_identify_a_stored_line():
    assert set(LINE) >= set(schemas.RAW_COLUMNS)


def test_monthly_revenue_comes_from_the_rollup(grown):
    """Same rows and types as the sums over the fact, for the forecast of catalog_constraints, without the fact."""
    w, whole = grown["store"].read(), grown["store"].read()
    want = WH.Warehouse.monthly_revenue.func(whole)
    w.fact = None
    assert w.monthly_revenue.schema == want.schema
    assert sorted(w.monthly_revenue.collect()) == sorted(want.collect()) and want.count() > 1
