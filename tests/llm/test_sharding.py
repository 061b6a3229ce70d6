import random

from helpers import ODD, table
from pyspark.sql import functions as F

from tillspark.llm import extendible_sharding as X


def brute(keys, limit):
    """Shards by splitting one bucket at a time."""
    done, todo = {}, [("", keys)] if keys else []
    while todo:
        prefix, rows = todo.pop()
        if sum(b for _, b in rows) <= limit or len(rows) == 1:
            done[prefix] = (sum(b for _, b in rows), len(rows))
            continue
        for bit in "01":
            part = [r for r in rows if r[0][len(prefix)] == bit]
            if part:
                todo.append((prefix + bit, part))
    return done


def check(keys, limit):
    rows = [(r.bits, r.bytes) for r in keys.collect()]
    shards = X.directory(keys, limit)
    got = {r.shard: (r.shard_bytes, r.shard_docs) for r in shards.collect()}
    assert got == brute(rows, limit)
    assigned = X.assign(keys, shards).collect()
    assert len(assigned) == len(rows) and all(r.bits.startswith(r.shard) for r in assigned)
    return got


def test_directory_equals_splitting_one_by_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(X, "FINER", 1)
    rng = random.Random(1)
    rows = [(rng.randint(-10 ** 6, 10 ** 6), "x" * rng.randint(0, 900)) for _ in range(400)] + [(9, "y" * 5000)]
    keys = X.keyed(table(spark, rows, tmp_path))
    assert len(check(keys, 1000)) > 100
    assert list(check(keys, 10 ** 9)) == [""]


def test_copies_of_one_key_and_odd_rows(spark, tmp_path):
    rows = [(7, "z" * 100)] * 60 + [(None, "n" * 300)] * 9 + [(100 + i, t) for i, t in enumerate(ODD)]
    shards = check(X.keyed(table(spark, rows, tmp_path)), 1000)
    assert all(size <= 1000 or n == 1 for size, n in shards.values()) and max(map(len, shards)) > 64


def test_written_shards_and_empty_table(spark, tmp_path):
    rows = [(i % 50, "t" * (i * 7 % 200)) for i in range(300)]
    docs = table(spark, rows, tmp_path).withColumn("shard", F.lit("own"))
    shards = {r.shard: r.shard_docs for r in X.write_shards(docs, f"{tmp_path}/out", 2000).collect()}
    back = spark.read.parquet(f"{tmp_path}/out")
    assert {r.shard[1:]: r["count"] for r in back.groupBy("shard").count().collect()} == shards
    assert sorted((r.doc_id, r.text) for r in back.collect()) == sorted(rows)
    assert X.op4_extendible_sharding(spark, str(tmp_path)).count() == 300
    empty = table(spark, [], tmp_path / "none")
    assert X.op4_extendible_sharding(spark, str(tmp_path / "none")).collect() == [] and X.directory(X.keyed(empty)).count() == 0
