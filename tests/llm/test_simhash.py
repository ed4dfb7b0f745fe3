import random

import xxhash
from pyspark.sql import functions as F

from trafficloom.llm import nearcopies, simhash
from trafficloom.llm.components import connected_components

from .util import corpus, frame


def brute_print(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else (" " if c in "\t\n\v\f\r" else c) for c in text or "").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(rows):
    prints = [brute_print(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 2:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {rows[i][0]: (prints[i], rows[find(i)][0]) for i in range(len(rows))}


def test_against_brute_force(spark):
    rows = corpus()
    got = {r.doc_id: (r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicate_groups(frame(spark, rows)).collect()}
    assert got == brute_groups(rows)


def test_links_keep_all_groups(spark):
    r = random.Random(1)
    base = [r.getrandbits(64) for _ in range(6)]
    prints = list({b ^ sum(1 << k for k in r.sample(range(64), r.randint(0, 5))) for b in base for _ in range(60)})
    rows = spark.createDataFrame([((p - (1 << 64)) if p >> 63 else p,) for p in prints], "fp long")
    got = connected_components(simhash.ball_links(rows)).groupBy("component").agg(F.collect_set("node").alias("g")).collect()
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in prints:
        for b in prints:
            if bin(a ^ b).count("1") <= 2:
                root[find(a)] = find(b)
    want = {}
    for p in prints:
        want.setdefault(find(p), set()).add(p)
    assert sorted(sorted(x & (1 << 64) - 1 for x in g.g) for g in got) == sorted(sorted(g) for g in want.values() if len(g) > 1)


def test_chain_hub_and_empty(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 201), (201, 200), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(41)) and all(got[k] == 100 for k in range(100, 140)) and got[201] == 200
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_table_and_keep_one(spark):
    assert simhash.near_duplicate_groups(frame(spark, [])).count() == 0
    rows = corpus()
    kept = simhash.keep_one(frame(spark, rows))
    groups = brute_groups(rows)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, c) in groups.items() if i == c)
    assert kept.columns == frame(spark, rows).columns


def test_repeated_and_null_ids(spark):
    long = [" ".join(f"{c}{k}" for k in range(60)) for c in "abcd"]
    rows = [(1, long[0]), (2, long[0]), (2, long[1]), (None, long[2]), (None, long[0]), (3, long[3]), (3, long[3])]
    kept = sorted((r.doc_id or 0, r.text) for r in simhash.keep_one(frame(spark, rows)).collect())
    assert kept == sorted([(1, long[0]), (2, long[1]), (0, long[2]), (3, long[3])])


def plain_print(text, width):
    words = text.lower().split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + width]), 42) for i in range(max(1, len(words) - width + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_balls_join_near_copies_without_bands(spark, monkeypatch):
    """Where no band speaks, the balls around the halves of the fingerprints alone bring near copies together, and the sets decide."""
    r = random.Random(8)
    rows, met = [], set()
    for k in range(40):
        words = [f"w{r.randrange(5000)}" for _ in range(250)]
        other = list(words)
        other[r.randrange(250)] = "edited"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
        d = plain_print(rows[-1][1], 5) ^ plain_print(rows[-2][1], 5)
        if min((d & (1 << 32) - 1).bit_count(), (d >> 32).bit_count()) <= 2:
            met.add(2 * k + 1)
    rows.append((100, " ".join(["spam spam spam spam spam"] * 80 + [f"a{k}" for k in range(60)])))  # unlike sets, equal fingerprints
    rows.append((101, " ".join(["spam spam spam spam spam"] * 80 + [f"b{k}" for k in range(60)])))
    assert plain_print(rows[-1][1], 5) == plain_print(rows[-2][1], 5) and 10 < len(met) < 40
    monkeypatch.setattr(nearcopies, "BANDS", 0)
    monkeypatch.setattr(nearcopies, "_FACTORS", nearcopies._FACTORS[:0])
    kept = simhash.keep_one(frame(spark, rows), similar=True)
    assert sorted(x.doc_id for x in kept.collect()) == sorted(i for i, _ in rows if i not in met)
