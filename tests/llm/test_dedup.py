"""Near-duplicates and repeated lines against quadratic searches."""

import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from chronolake.llm import line_dedup, simhash


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def grouped(prints):
    """Smallest index of each component of fingerprints within 3 bits."""
    label = list(range(len(prints)))
    for i, j in combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 3 and label[i] != label[j]:
            a, b = sorted((label[i], label[j]))
            label = [a if x == b else x for x in label]
    return label


def test_fingerprints_and_components(spark, docs):
    r = random.Random(1)
    base = [" ".join("".join(r.choices("abcdé", k=4)) for _ in range(r.randint(1, 80))) for _ in range(25)]
    texts = [None, "", " \n\t", "ONE", "one", "one two", "\x1cone\x85 two", "A " * 50_000] + base
    for b in base:
        w = b.split()
        for _ in range(4):
            w[r.randrange(len(w))] = "zz"
            texts.append(" ".join(w))
    rows = [(3 * i + 1, t, None) for i, t in enumerate(texts)] + [(10, texts[3], None), (None, texts[3], None), (None, "none like it", None)]
    rows.sort(key=lambda x: (x[0] is None, x[0] or 0))
    got = simhash.near_duplicates(docs(rows)).withColumn("hex", simhash.fingerprint_hex(F.col("fp"))).collect()
    prints = [fingerprint(t) for _, t, _ in rows]
    expected = [(rows[i][0], f"{prints[i]:016x}", rows[k][0]) for i, k in enumerate(grouped(prints))]
    assert sorted(map(repr, expected)) == sorted(repr((g.doc_id, g.hex, g.component_id)) for g in got)
    kept = simhash.drop_near_duplicates(docs(rows))
    assert kept.columns == docs(rows).columns
    assert sorted(x.doc_id for x in kept.where("doc_id IS NOT NULL").collect()) == sorted({i for i, _, c in expected if i is not None and i == c})
    assert simhash.near_duplicates(docs([])).count() == 0


def near_prints(seed):
    r = random.Random(seed)
    seeds = [r.getrandbits(64) for _ in range(6)] + [0, (1 << 64) - 1]
    prints = set(seeds)
    for s in seeds:  # dense clusters, and chains of 3-bit steps through all bytes
        for _ in range(60):
            x = s
            for bit in r.sample(range(0, 64, 9), r.randint(1, 4)):
                x ^= 1 << bit
            prints.add(x)
        for _ in range(20):
            for bit in r.sample(range(64), 3):
                s ^= 1 << bit
            prints.add(s)
    return sorted(prints)


@pytest.mark.parametrize("longest", [1024, 60, 20])  # no list is too long; some are; most are, for several rounds
def test_links_connect_all_near_fingerprints(spark, longest):
    prints = near_prints(longest)
    frame = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in prints], "fp long")
    edges = [(e.a % 2**64, e.b % 2**64) for e in simhash.links(frame, longest).collect()]
    at = {p: i for i, p in enumerate(prints)}
    label = simhash._labels(len(prints), np.array([at[a] for a, _ in edges]), np.array([at[b] for _, b in edges]))
    assert label.tolist() == grouped(prints)


def test_near_pairs_meet_in_the_lists():
    r = random.Random(8)
    masks = [simhash._of_bytes(t) for t in simhash.TRIPLES]
    for _ in range(6):
        for _ in range(300):
            x = sum(1 << b for b in r.sample(range(64), 3))
            assert any(x & m == 0 for m in masks)  # what differs lies outside of what a list fixes
        masks = [n for m in masks for n in simhash.narrower(m)]
    assert min(m.bit_count() for m in masks) >= 54  # what is free leaves a list 1,024 members at most
    for m in (simhash._of_bytes(t) for t in simhash.TRIPLES):
        parts = [n & ~m for n in simhash.narrower(m)]
        assert all(a & b == 0 for a, b in combinations(parts, 2))


def test_lists_are_tallied_whole_across_batches():
    prints = np.array(near_prints(3), np.uint64)
    mask = np.uint64(simhash._of_bytes((0, 1, 2)))
    order = np.argsort(prints & mask, kind="stable")
    fps = prints[order].view(np.int64)
    columns = [pa.array(np.full(len(fps), 7)), pa.array((prints[order] & mask).view(np.int64)), pa.array(fps)]
    want = {tuple(sorted((a, b))) for a, b in combinations(prints.tolist(), 2) if (a ^ b) & int(mask) == 0 and (a ^ b).bit_count() <= 3}
    for cuts in ([0, len(fps)], [0, 1, 2, 50, 50, 51, 300, len(fps)]):
        out = list(simhash._links(pa.RecordBatch.from_arrays([c[i:j] for c in columns], ["mask", "key", "fp"]) for i, j in zip(cuts, cuts[1:], strict=False)))
        got = [(a % 2**64, b % 2**64) for o in out for a, b in zip(*(c.to_pylist() for c in o.columns), strict=True)]
        at = {p: i for i, p in enumerate(prints.tolist())}
        both = [simhash._labels(len(prints), *(np.array([at[p[k]] for p in e], int) for k in (0, 1))).tolist() for e in (got, sorted(want))]
        assert both[0] == both[1]


def test_one_row_of_each_component_stays(spark, docs):
    long = " ".join(f"w{k}" for k in range(300))
    rows = [(1, "alpha beta gamma delta", "a"), (1, "quite another text than that", "a"), (2, long, "b"), (2, long, "b"), (2, long, "a"), (7, long + " end", "c"), (None, long, "d"), (None, long.upper(), "e"), (None, "only here without a name", "f"), (None, None, "g"), (9, "", "h"), (8, " ", "i")]
    prints = [fingerprint(t) for _, t, _ in rows]
    want = {}
    for i, k in enumerate(grouped(prints)):
        want.setdefault(k, []).append(rows[i])
    for frame in (docs(rows), docs(rows[::-1]).repartition(5)):
        got = sorted(map(repr, [(x.doc_id, x.text, x.lang) for x in simhash.drop_near_duplicates(frame).collect()]))
        assert len(got) == len(want)
        for own in want.values():  # the smallest id's, of its rows the smallest one
            first = [r for r in own if r[0] == min((r[0] for r in own if r[0] is not None), default=None)]
            assert any(repr(r) in got for r in first)
        assert repr((2, long, "a")) in got and repr((1, "quite another text than that", "a")) in got


def test_components_of_chains_and_stars(spark):
    r = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + k) for k in range(1, 60)] + [(5000 + r.randrange(300), 5000 + r.randrange(300)) for _ in range(150)] + [(7, 7), (3, 2)]
    got = {x.node: x.root for x in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = sorted({x for e in edges for x in e})
    label = simhash._labels(len(nodes), *np.array([[nodes.index(a), nodes.index(b)] for a, b in edges]).T)
    expected = {n: nodes[k] for n, k in zip(nodes, label.tolist(), strict=True) if nodes[k] != n}
    assert got == expected


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


@pytest.mark.parametrize("partitions", [1, 3, 9])
def test_lines(spark, docs, partitions):
    r = random.Random(7)
    lines = [f"line {k} " + "é" * r.choice([20, 33, 60]) for k in range(12)]
    every = "This line stands in every document of the table, more or less"
    rows = []
    for i in r.sample(range(400), 120):
        own = [r.choice(lines) for _ in range(r.randint(0, 6))] + [r.choice([every, "  " + every.upper() + "\t", "short", "", "\x1c" + every])] * r.randint(0, 3)
        r.shuffle(own)
        rows.append((i, "\n".join(own), None))
    rows += [rows[3], rows[3], (rows[4][0], rows[5][1], None), (None, every, None), (None, every + "\n" + lines[0], None), (900, None, None), (901, "", None), (902, "x" * 200_000, None), (903, "\n".join(["y" * 50] * 3000), None)]
    held = defaultdict(set)
    for i, t, _ in rows:
        for line in (t or "").split("\n"):
            held[key(line)].add(-1 if i is None else i)
    expected = []
    for i, t, _ in rows:
        own = (t or "").split("\n")
        kept = [x for x in own if not (len(key(x)) >= 40 and len(held[key(x)]) >= 5 and max(held[key(x)]) != (-1 if i is None else i))]
        expected.append((i, len(own), len(own) - len(kept), "\n".join(kept)))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7 if partitions == 3 else 10_000)
    try:
        frame = docs(rows)
        kept = line_dedup.apply_bitmaps(frame, line_dedup.keep_bitmaps(frame, held=1 if partitions < 9 else 20_000))
        got = kept.select("doc_id", "n_lines", "n_dropped", F.coalesce("text", F.lit(""))).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    assert sum(e[2] for e in expected) > 50
    assert line_dedup.line_dedup(docs([])).count() == 0


def test_rows_that_wait_are_bounded():
    """The stream over sorted rows, in batches of any size, with ids that have very many rows."""
    r = random.Random(11)
    keys, rows = [(1, 5), (1, 9), (4, 0), (7, 7)], []
    for key in keys:
        ids = r.sample(range(50), r.choice([1, 3, 4, 5, 9]))
        for i in sorted(ids, reverse=True):
            rows += [(*key, i, 1000 * i + k, [k]) for k in range(r.choice([1, 1, 2, 60]))]
        if r.random() < 0.8:
            rows += [(*key, None, k, [k]) for k in range(80)]
    want = set()
    for key in keys:
        own = [x for x in rows if x[:2] == key]
        if len({x[2] for x in own}) >= 5:
            want |= {x[:4] for x in own if x[2] != max(x[2] for x in own if x[2] is not None)}
    columns = list(zip(*rows, strict=True))
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
    whole = pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(columns, types, strict=True)), pa.array([0] * len(rows), pa.int32())], ["h1", "h2", "id", "text_hash", "lines", "part"])
    for size in (1, 2, 13, 100, len(rows)):
        for most in (0, 1, 5, 10_000):
            out = list(line_dedup._fallen({}, 5, most)(whole.slice(k, size) for k in range(0, len(rows), size)))
            said = [x for o in out for x in zip(*(c.to_pylist() for c in o.columns), strict=True)]
            falls = {x[1:3] for x in said if x[0] == line_dedup.VERDICT}
            got = [x[1:5] for x in said if x[0] == line_dedup.FALLEN or x[0] == line_dedup.OPEN and x[1:3] in falls]
            assert set(got) == want and len(got) == len(want), (size, most)
        ends = [x for o in line_dedup._edges(whole.select(["h1", "h2", "id", "part"]).slice(k, size) for k in range(0, len(rows), size)) for x in zip(*(c.to_pylist() for c in o.columns), strict=True)]
        assert ends == [(*k, len({x[2] for x in rows if x[:2] == k}), 0) for k in (keys[0], keys[-1])]


def test_bitmaps():
    for dropped in ([0], [7], [8], [3, 900], list(range(50))):
        bits = line_dedup.unpack(line_dedup.pack(dropped), 1000)
        assert np.flatnonzero(~bits).tolist() == dropped
    assert line_dedup.unpack(line_dedup.pack([2]), 3).tolist() == [True, True, False]
