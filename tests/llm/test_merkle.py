import hashlib
import zlib

import duckdb
import pytest
from helpers import ODD
from pyspark.sql import functions as F

from tillspark.llm import merkle as M

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(r, text):
    values = [r[0], r[3], r[2], r[4], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def lowered(t):
    return None if t is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def tree(hashes, fanout):
    """The root, and the siblings (left, right) of each leaf on the way up."""
    level, at, paths = hashes, list(range(len(hashes))), [[] for _ in hashes]
    while len(level) > 1:
        runs = [level[i:i + fanout] for i in range(0, len(level), fanout)]
        for p, i in zip(paths, at):
            run = runs[i // fanout]
            p.append(("".join(run[:i % fanout]), "".join(run[i % fanout + 1:])))
        level, at = [sha("".join(r)) for r in runs], [i // fanout for i in at]
    return level[0], paths


def expected(rows, fanout=16):
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    groups = []
    for s in sources:
        mine = sorted((r for r in rows if r[3] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[1])))
        groups.append((mine, *tree([leaf_of(r, r[1]) for r in mine], fanout)))
    root, tops = tree([g[1] for g in groups], fanout)
    out = []
    for (mine, subroot, paths), top in zip(groups, tops):
        for r, p in zip(mine, paths):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            cur = leaf_of(r, lowered(r[1]) if hit else r[1])
            for a, b in p + top:
                cur = sha(a + cur + b)
            out.append((r[0], leaf_of(r, r[1]), subroot, root, sha("".join(a + b for a, b in p + top)), cur, cur == root))
    return sorted(out, key=repr)


def written(spark, rows, folder):
    (spark.createDataFrame(rows, SCHEMA).withColumns({"g": F.lit(1), "idx": F.lit("x"), "h": F.lit(2), "leaf": F.lit(None).cast("int")})
     .repartition(3).write.parquet(f"{folder}/documents.parquet"))


def odd_rows():
    rows = [(i * 37 - 300, f"Text {i} of ÀB", "en", f"s{min(i % 9, 3)}", i) for i in range(300)]
    rows += [(1000 + i, t, None, None, len(t or "")) for i, t in enumerate(ODD)]
    rows += [(None, "No Id", "en", "s1", None), (None, None, None, "s1", None), (5, "One", "en", "é", 3), (-2**63, "a", "en", "", 1), (2**63 - 1, "B" * 200_000, "en", "", 1)]
    return rows + [rows[3]] * 20 + [(rows[3][0], "another text of that id", "en", rows[3][3], 1)] + [(9, "LONE", "en", f"host{i}", 4) for i in range(40)]


@pytest.mark.parametrize("seed_rows", [odd_rows(), [(7, "Only Row", "en", None, 8)]], ids=["odd", "one"])
def test_equals_a_plain_tree(spark, tmp_path, seed_rows):
    written(spark, seed_rows, tmp_path)
    got = M.op11_merkle_manifest(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=repr) == expected(seed_rows)


def test_oracle_equals_a_plain_tree(tmp_path, spark):
    rows = odd_rows()
    written(spark, rows, tmp_path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert sorted(con.execute(M.SQL["op11_merkle_manifest"]).fetchall(), key=repr) == expected(rows)


def test_empty_table(spark, tmp_path):
    written(spark, [], tmp_path)
    assert M.op11_merkle_manifest(spark, str(tmp_path)).collect() == []


def test_binary_tree_and_other_columns(spark):
    rows = [(i, f"t{i}", i % 2) for i in range(21)]
    docs = spark.createDataFrame(rows, "id bigint, body string, part int")
    got = M.verified(M.manifest(docs, columns=("id", "body"), group="part", order="id", fanout=2), F.col("leaf")).collect()
    hashes = {p: [sha(f"{len(str(i))}:{i}{len(t)}:{t}") for i, t, q in rows if q == p] for p in (0, 1)}
    roots = {p: tree(h, 2)[0] for p, h in hashes.items()}
    assert {r.root for r in got} == {sha(roots[0] + roots[1])} and all(r.verified for r in got)
    assert {r.carried.id: r.subroot for r in got} == {i: roots[p] for i, _, p in rows}
