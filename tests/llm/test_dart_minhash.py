import random
from collections import Counter

import numpy as np
import pytest
from helpers import ODD, table

from tillspark.llm import dart_minhash as D
from tillspark.llm.wordhash import Words


def shingles(text):
    w = (text or "").split()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def brute(rows):
    """Class of each row by all pairs of weighted Jaccard similarity 0.8 or more."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            shared = sum((sets[i] & sets[j]).values())
            total = sum((sets[i] | sets[j]).values())
            if (shared / total if total else 1.0) >= 0.8:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, least[find(i)]) for i, (d, _) in enumerate(rows))


def variants(rng, words, n, share):
    return [" ".join(rng.choice(VOCABULARY) if rng.random() < share else w for w in words) for _ in range(n)]


VOCABULARY = ["".join(chr(97 + (i * k) % 26) for k in (1, 3, 7)) + str(i) for i in range(400)]


def fixture(seed=4):
    rng = random.Random(seed)
    texts = list(ODD)
    for size, n, share in ((200, 12, 0.02), (120, 5, 0.01), (150, 30, 0.03), (400, 4, 0.05), (30, 6, 0.02)):
        words = [rng.choice(VOCABULARY) for _ in range(size)]
        texts += [" ".join(words)] * 2 + variants(rng, words, n, share)
    texts += [" ".join(rng.choice(VOCABULARY) for _ in range(rng.randint(1, 80))) for _ in range(40)]
    return list(enumerate(texts))


def test_classes_equal_brute_force(spark, tmp_path):
    rows = fixture()
    table(spark, rows, tmp_path)
    got = D.op2_minhash_near_dedup(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.class_id) for r in got) == brute(rows)
    sizes = Counter(r.class_id for r in got)
    assert all(r.class_size == sizes[r.class_id] for r in got)


def test_large_buckets_lose_no_link(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(D, "SMALL", 2)
    monkeypatch.setattr(D, "BLOCK", 3)
    rows = fixture(9)
    table(spark, rows, tmp_path)
    got = D.op2_minhash_near_dedup(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.class_id) for r in got) == brute(rows)


def test_signatures_estimate_weighted_similarity():
    rng = random.Random(2)
    words = [rng.choice(VOCABULARY[:60]) for _ in range(500)]
    texts = [" ".join(words), " ".join(words[:400] + [rng.choice(VOCABULARY) for _ in range(100)]), "one two", ""]
    elements, offsets = D.weighted_elements(Words(texts))
    s = D.dart_signatures(elements, offsets, 2000)
    a, b = shingles(texts[0]), shingles(texts[1])
    exact = sum((a & b).values()) / sum((a | b).values())
    assert abs((s[0] == s[1]).mean() - exact) < 0.05 and (s[0] != 0).all() and (s[2] != 0).all() and not s[3].any()
    assert len(np.unique(s[0])) > 500


def test_null_ids_and_empty_table(spark):
    schema = "doc_id bigint, text string, node int, class_id string"
    text = "one two three four five six seven"
    df = spark.createDataFrame([(None, text, 1, "x"), (5, text, 2, "y"), (None, "alone", 3, "z"), (5, text, 2, "y")], schema)
    got = [tuple(r) for r in D.near_duplicate_classes(df).select("doc_id", "class_size").collect()]
    assert sorted(got, key=str) == [(5, 3), (5, 3), (None, 1), (None, 3)]
    assert D.near_duplicate_classes(df.limit(0)).collect() == []


def test_one_doc_id_with_two_texts(spark):
    word = lambda k: " ".join(f"{k}{i}" for i in range(40))
    rows = [(3, word("a")), (5, word("a") + " end"), (5, word("b")), (5, word("c")), (7, word("c") + " end"), (9, word("d")),
            (9, word("d").replace(" ", "  ")), (9, word("d"))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = sorted((r.doc_id, r.text.split()[0]) for r in D.one_of_each_class(df).collect())
    assert kept == [(3, "a0"), (5, "b0"), (5, "c0"), (9, "d0")]
    got = D.near_duplicate_classes(df).collect()
    assert sorted((r.doc_id, r.class_id, r.class_size) for r in got) == [
        (3, 3, 2), (5, 3, 2), (5, 5, 1), (5, 5, 2), (7, 5, 2), (9, 9, 3), (9, 9, 3), (9, 9, 3)]
    assert len({(r.class_id, r.class_text_hash) for r in got}) == 4 and len({(r.doc_id, r.text_hash) for r in got}) == 7


def near_copies(rng, words, n, most):
    out = []
    for _ in range(n):
        copy = list(words)
        for i in rng.sample(range(len(words)), most):
            copy[i] = rng.choice(VOCABULARY)
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("edits", [2, 9])
def test_a_large_family_has_few_links(spark, tmp_path, monkeypatch, edits):
    """300 copies with few edits (all near each other), or with so many that few are near another."""
    rng = random.Random(edits)
    words = [rng.choice(VOCABULARY) for _ in range(200)]
    rows = list(enumerate([" ".join(words)] + near_copies(rng, words, 300, edits)))
    table(spark, rows, tmp_path)
    counted, write = {}, D.written

    def watched(df, name="table"):
        out = write(df, name)
        if name in ("pairs", "links"):
            counted[name] = max(counted.get(name, 0), out.count())
        return out
    monkeypatch.setattr(D, "written", watched)
    got = D.op2_minhash_near_dedup(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.class_id) for r in got) == brute(rows)
    assert counted.get("links", 0) < 3 * len(rows)


def test_spanning_links_are_fewer_than_nodes():
    names, labels = list("abcdef"), list("aabbcd")
    edges = [(i, j) for i in range(6) for j in range(6) if i != j]
    found = D.spanning(names, labels, edges)
    assert len(found) == 3  # four classes
    assert D.spanning(names, labels, [(0, 1), (2, 3)]) == []


def test_families_join_memberships_by_key_once(spark, monkeypatch):
    from tillspark.llm import graph as G
    rng = random.Random(8)
    rows = [(k, rng.randint(0, 60) + 100 * (k % 3)) for k in range(40) for _ in range(rng.randint(1, 9))] + [(99, 999)]
    asked = []
    whole = G.components
    monkeypatch.setattr(G, "components", lambda links: asked.append(links.count()) or whole(links))
    got = {r.node: r.label for r in G.families(spark.createDataFrame(rows, "key int, node int")).collect()}
    want = {n: n for _, n in rows}
    for _ in rows:
        for k in {k for k, _ in rows}:
            mine = [n for x, n in rows if x == k]
            low = min(want[n] for n in mine)
            want.update({n: low for n in mine})
    assert got == want and got[999] == 999
    assert len(asked) == 1 and asked[0] <= len({(n, min(m for x, m in rows if x == k)) for k, n in rows})


def test_rounds_of_components_join_ever_fewer_links(spark, monkeypatch):
    """Dense classes on a ring, named in mixed order: the joins of all rounds read less than four times the links."""
    from tillspark.llm import graph as G
    name = list(range(14 * 12))
    random.Random(3).shuffle(name)
    links = [(name[12 * k + i], name[12 * k + j]) for k in range(13) for i in range(12) for j in range(i)]
    links += [(name[12 * k], name[12 * (k + 1) + 5]) for k in range(12)] + [(name[13 * 12 + i], name[13 * 12 + i + 1]) for i in range(11)]
    df = spark.createDataFrame(links, "a int, b int")
    read, join = [], type(df).join
    monkeypatch.setattr(type(df), "join", lambda self, *on, **kw: read.append(self.count()) or join(self, *on, **kw))
    got = {r.node: r.label for r in G.components(df).collect()}
    assert got == {n: min(name[:13 * 12]) if i < 13 * 12 else min(name[13 * 12:]) for i, n in enumerate(name)}
    assert sum(read) < 4 * len(links)
