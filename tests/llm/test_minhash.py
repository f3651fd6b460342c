import random
import re

import pytest

from corpusmill.llm import common, minhash


def sets_of(rows, n):
    out = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        out.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    return out


def brute(rows, n, percent=80):
    sets = sets_of(rows, n)
    parent = {d: d for d, _ in rows}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, _) in enumerate(rows):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                x, y = top(a), top(rows[j][0])
                parent[max(x, y)] = min(x, y)
    return sorted((d, len(s), top(d), top(d) == d) for (d, _), s in zip(rows, sets))


def result(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect())


def corpus(seed, n):
    rng = random.Random(seed)
    base = [[f"w{rng.randint(0, 300)}" for _ in range(rng.choice([3, 20, 80, 200]))] for _ in range(12)]
    rows = []
    for i in range(n):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            words[rng.randrange(len(words))] = f"n{rng.randint(0, 50)}"
        rows.append((i * 3 % (n * 7), " ".join(words).title() if rng.random() < 0.2 else "\n".join(words)))
    return rows + [(10_000, ""), (10_001, None), (10_002, " \t"), (10_003, "one"), (10_004, "ONE"), (10_005, "É a"), (10_006, "é a"), (10_007, "x " * 5000), (10_008, "x " * 7000)]


@pytest.mark.parametrize("members,shingles", [(400, 400_000), (7, 500), (30, 3000)])
def test_brute_force(spark, monkeypatch, members, shingles):
    monkeypatch.setattr(minhash, "MEMBERS", members)
    monkeypatch.setattr(minhash, "SHINGLES", shingles)
    rows = corpus(1, 250)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert result(minhash.near_duplicates(docs, 4)) == brute(rows, 4)


def test_a_group_whose_hub_is_an_outlier(spark, monkeypatch):
    """A chain from the hub on: each text links with its neighbours only."""
    monkeypatch.setattr(minhash, "MEMBERS", 5)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[4 * i : 4 * i + 80])) for i in range(60)] + [(100 + i, " ".join(words[:80] + [f"x{i}"])) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = result(minhash.near_duplicates(docs, 4))
    assert got == brute(rows, 4) and len({g[2] for g in got}) == 1


@pytest.mark.parametrize("hubs", [1, 8])
def test_large_groups_of_many_trees(spark, monkeypatch, hubs):
    """Variants of one template that don't link with each other, clusters among them, and texts much longer and shorter."""
    monkeypatch.setattr(minhash, "MEMBERS", 6)
    monkeypatch.setattr(minhash, "HUBS", hubs)
    rng = random.Random(9)
    base, rows = [f"w{i}" for i in range(150)], []
    for c in range(25):
        own = [w if rng.random() > 0.03 else f"c{c}_{i}" for i, w in enumerate(base)]
        for k in range(rng.choice([1, 1, 2, 6])):
            words = [w if rng.random() > 0.006 else f"v{c}_{k}_{i}" for i, w in enumerate(own)]
            rows.append((len(rows) * 7 % 1000, " ".join(words[: rng.choice([150, 150, 135, 125, 110])])))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = result(minhash.near_duplicates(docs, 4))
    assert got == brute(rows, 4) and 3 < len({g[2] for g in got}) < len(rows)


def test_main_hubs():
    import pyarrow as pa

    def main(rows):
        return minhash._main_hubs((pa.scalar(5),), pa.table({"mask": pa.array([m for m, _ in rows], pa.int32()), "members": [n for _, n in rows]}))["main"][0].as_py()

    assert main([(0, 900), (1, 10), (6, 8), (4, 3), (3, 1)]) == 7 and main([(1, 4), (2, 3), (4, 2)]) == 1 and main([(0, 7)]) == 0


def test_a_repeated_id_with_an_empty_text(spark):
    text = "a b c d e f g h"
    docs = spark.createDataFrame([(5, ""), (5, text), (6, None), (6, text), (5, " ")], "doc_id bigint, text string")
    assert {(r["doc_id"], r["component_id"]) for r in minhash.near_duplicates(docs).collect()} >= {(5, 5), (6, 5)}


def test_odd_rows(spark):
    text = "a b c d e f g h"
    docs = spark.createDataFrame([(None, text, 1), (None, text, 2), (5, text, 3), (5, text, 4), (7, text, 5)], "doc_id bigint, text string, root int")
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect()), key=repr)
    assert got == sorted([(None, None, True), (None, None, True), (5, 5, True), (5, 5, True), (7, 5, False)], key=repr)
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(rng.randint(100, 200), rng.randint(100, 200)) for _ in range(80)] + [(500, i) for i in range(501, 560)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in common.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    near = {}
    for a, b in edges:
        if a is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)

    def reach(x):
        seen, todo = {x}, [x]
        while todo:
            for y in near[todo.pop()] - seen:
                seen.add(y)
                todo.append(y)
        return min(seen)

    assert got == {x: reach(x) for x in near}


def test_packed_hashes():
    import numpy as np

    for values in ([], [0], [5, 6, 2**40, 2**63]):
        x = np.array(values, np.uint64)
        assert common.unpack_sorted(common.pack_sorted(x)).tolist() == values


def test_query(spark, small):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert result(minhash.op8_minhash(spark, small)) == brute(rows, 4)
