"""Byte-level BPE, alignment and ranked search: the libraries, and plain loops."""

import base64
import hashlib
import math
import os
import random
import re
from array import array
from collections import Counter
from functools import cache

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from chronolake.llm import alignment, byte_bpe, lexical_search
from chronolake.llm import queries as llm
from chronolake.llm.queries import tokenizer_path

tiktoken = pytest.importorskip("tiktoken")
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
RANKS, JSON, MODEL = (tokenizer_path(n) for n in ("byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = ["a", "b", " ", "\n", "\t", "1", "'", "'ll", "é", "日本", "!", "  ", "x" * 30, "\x1c", "😀", " " * 20, "<|endoftext|>", "▁", "\x00", " "]


@cache
def ranks():
    return byte_bpe.ByteBPE.from_ranks(RANKS)


@cache
def library():
    with open(RANKS, "rb") as f:
        found = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=byte_bpe.PATTERN, mergeable_ranks=found, special_tokens={})


def unpacked(data):
    return array("I", data).tolist()


def odd_texts(seed, n, most=60):
    r = random.Random(seed)
    return ["".join(r.choices(ODD, k=r.randint(0, most))) for _ in range(n)]


@pytest.fixture(scope="module")
def table():
    if not os.path.isdir(SF):
        pytest.skip("no tables")
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())


def test_chunks_are_stitched_where_they_are_in_step():
    bpe = ranks()
    for text in [*odd_texts(1, 400), "a" * 300, " " * 300, "ab " * 100, "1" * 50 + " " * 50 + "b" * 50]:
        want = bpe.expression(text).findall(text)
        for chunk, overlap in ((5, 4), (7, 5), (16, 8), (64, 16)):
            assert [p for run in bpe.pieces(text, chunk, overlap) for p in run] == want


def test_ids_equal_the_library():
    texts = [*odd_texts(2, 400), "a" * 5000, "ab" * 700, "é" * 400, "".join(map(chr, range(1, 0x3000)))]
    assert [unpacked(p) for p in ranks().encode_many(texts)] == [library().encode_ordinary(t) for t in texts]
    tokenizers = pytest.importorskip("tokenizers")
    other = tokenizers.Tokenizer.from_file(JSON)
    other.encode_special_tokens = True
    mine = byte_bpe.ByteBPE.from_json(JSON).encode_many(texts)
    assert [unpacked(p) for p in mine] == [e.ids for e in other.encode_batch(texts, add_special_tokens=False)]


def test_many_pieces_merge_as_one_does():
    bpe = ranks()
    r = random.Random(3)
    pieces = list({bytes(r.choices(b"abetnrs \xc3\xa9", k=r.randint(1, 40))) for _ in range(800)})
    together = [unpacked(p) for p in bpe.pairs.merged(pieces)]
    assert together == [bpe._merged_long(p) for p in pieces]
    assert bpe.pairs.merged([]) == []


def test_long_texts_are_dealt(spark, docs):
    r = random.Random(4)
    words = ["the", "ship", "of", "don't", "  ", "\n\n", "1234", "日本", "!!", "é"]
    long = [" ".join(r.choices(words, k=400)) for _ in range(3)]
    apart = "a" * 900  # one piece over several parts: they do not meet
    texts = [*long, long[0], apart, apart, "x" * 64, "y" * 65, "z" * 128 + " b", "", None, "short"]
    rows = [(None if k % 4 == 3 else k, t, None) for k, t in enumerate(texts)]
    want = sorted((str(i), library().encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in rows)
    for deal in (64, 300, 1 << 16):
        out = byte_bpe.decode(byte_bpe.encode(docs(rows), ranks(), deal=deal), ranks())
        assert sorted((str(x.doc_id), list(x.ids), bytes(x.decoded)) for x in out.collect()) == want
    assert byte_bpe.encode(docs([]), ranks()).count() == 0


def test_op12_equals_the_library(spark, table):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in llm.op12_byte_bpe(spark, SF).collect()}
    assert got.keys() == table.keys()
    for i, t in table.items():
        ids = library().encode_ordinary(t or "")
        assert got[i] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())


@pytest.mark.parametrize("seed", range(6))
def test_cuts_by_bisection(seed):
    rng = np.random.default_rng(seed)
    size = [5, 60, 400, 3000, 3000, 2][seed]
    ends_a, ends_b, edges, total = [], [], [], 0
    for _ in range(4):
        n = int(rng.integers(1, size))
        share = rng.choice([0.02, 0.3, 0.9])
        places = np.arange(1, n + 1)
        a, b = (np.union1d(places[rng.random(n) < share], [n]) for _ in "ab")
        ends_a.append(a + total)
        ends_b.append(b + total)
        total += n
        edges.append(sum(map(len, ends_a)))
    a, b = np.concatenate(ends_a), np.concatenate(ends_b)
    assert alignment.shared_cuts(a, b, np.array(edges)).tolist() == np.flatnonzero(np.isin(a, b)).tolist()


def plain_alignment(texts):
    """Each text's tokens, groups and links with the libraries, and how many texts hold a pair."""
    tokenizers, sentencepiece = pytest.importorskip("tokenizers"), pytest.importorskip("sentencepiece")
    a_model = tokenizers.Tokenizer.from_file(JSON)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    token = {i: t for t, i in byte_bpe.ByteBPE.from_json(JSON).tokens.items()}
    piece = lambda i: bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode()
    out, held = [], Counter()
    for text in texts:
        a = a_model.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_model.encode(text) if text else []
        ends = [np.cumsum([len(f(i)) for i in ids]).tolist() for f, ids in ((token.__getitem__, a), (piece, b))]
        if b"".join(map(token.__getitem__, a)) != (" " + (text or "")).encode() or b"".join(map(piece, b)) != (" " + (text or "")).encode():
            a, b, ends = [], [], [[], []]
        groups, i, j = [], 0, 0
        for cut in sorted({*ends[0]} & {*ends[1]}):
            k, m = ends[0].index(cut) + 1, ends[1].index(cut) + 1
            groups.append((a[i:k], b[j:m]))
            i, j = k, m
        links = Counter((x, y) for g, h in groups for x in g for y in h)
        held.update(links.keys())
        out.append((len(a), len(b), groups, links))
    best = Counter()
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    rows = []
    for n_a, n_b, groups, links in out:
        told = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        rows.append((n_a, n_b, len(groups), sum(links.values()), sum(n for k, n in links.items() if held[k] == best[k[0]]), sum(n * held[k] for k, n in links.items()), hashlib.sha256(told.encode()).hexdigest() if told else ""))
    return rows


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_alignment(spark, docs, prose, monkeypatch):
    texts = [*odd_texts(7, 40, 25), prose("en", 1), prose("de", 2), prose("fr", 3), prose("en", 1), "", None, " ", "  a", "a  ", "\n", "<s> </s>", "日本語のテキスト", "a▁b", "ﬁne", "\x01\x02\x03" * 9]
    rows = [(None if k == 3 else k, t, None) for k, t in enumerate(texts)]
    want = sorted((str(i), *w) for (i, _, _), w in zip(rows, plain_alignment(texts), strict=True))
    a, b = byte_bpe.ByteBPE.from_json(JSON), alignment.Pieces.from_file(MODEL)
    for held in (alignment.HELD, 40, 1):  # beyond that the links are joined with their counts
        found = alignment.alignment_counts(docs(rows), a, b, held=held).collect()
        assert sorted((str(r.doc_id), *(r[c] for c in COLUMNS)) for r in found) == want
    assert alignment.alignment_counts(docs([]), a, b).count() == 0
    one = {r.doc_id: r for r in alignment.align(docs(rows), a, b).collect()}[texts.index("  a")]
    assert sum(x.times for x in one.links) == one.n_links and one.groups.count(";") == one.n_groups - 1


def test_links_of_wide_groups(monkeypatch):
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 50, 300), rng.integers(0, 20, 200)
    first, second, row = np.array([0, 1, 200, 300]), np.array([0, 1, 150, 200]), np.repeat([0, 1], [200, 100])
    want = Counter((int(row[first[g]]), int(x) * alignment.PAIR + int(y)) for g in range(3) for x in a[first[g] : first[g + 1]] for y in b[second[g] : second[g + 1]])
    for limit in (10, 500, 1 << 20):
        monkeypatch.setattr(alignment, "LINKS", limit)
        got = Counter()
        for r, p, n in alignment.token_links(first, second, a, b, row):
            for key in zip(r.tolist(), p.tolist(), n.tolist(), strict=True):
                got[key[:2]] += key[2]
        assert got == want


def test_op11_equals_the_libraries(spark, table):
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in llm.op11_alignment(spark, SF).collect()}
    assert got == dict(zip(table, plain_alignment(table.values()), strict=True))


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(rows, queries, k):
    counts = [Counter(terms(t)) for _, t in rows]
    n_docs, n_terms = sum(bool(c) for c in counts), sum(sum(c.values()) for c in counts)
    df = Counter(w for c in counts for w in c)
    out = []
    for item, text in dict.fromkeys(queries):
        scored = []
        for (i, _), c in zip(rows, counts, strict=True):
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // max(n_terms, 1)
            score = sum(n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1000000000 * c[w]) // (1000 * c[w] + 12 * m)) for w, n in Counter(terms(text)).items() if c[w])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return out


def test_ranked_search(spark, docs, prose):
    r = random.Random(5)
    words = [f"w{k}" for k in range(40)]
    weights = [1 / (k + 1) for k in range(40)]
    rows = [(k, " ".join(r.choices(words, weights, k=r.choice([0, 1, 5, 30, 90]))), None) for k in range(150)]
    rows += [(200 + k, "W0 w7, w7 w9", None) for k in range(30)] + [(None, "w7 w9", None), (None, "w7 w9", None), (500, None, None), (501, "", None), (7, "é w7", None)]
    asked = [(k, " ".join(r.choices(words, k=r.randint(1, 12)))) for k in range(12)] + [(50, "w7 w9 w9"), (51, ""), (52, None), (53, "nowhere"), (50, "w7 w9 w9"), (54, "É é w1")]
    queries = spark.createDataFrame(asked, "item_id long, text string")
    key = lambda x: tuple((v is None, v) for v in x)
    want = sorted(plain_search([x[:2] for x in rows], asked, 6), key=key)
    for options in ({}, {"query_bytes": 60}, {"block_bytes": 200}):
        got = lexical_search.ranked_search(docs(rows), queries, 6, **options)
        assert sorted(((x.item_id, x["rank"], x.doc_id, x.score) for x in got.collect()), key=key) == want
    assert lexical_search.ranked_search(docs([]), queries).count() == 0
    assert lexical_search.ranked_search(docs(rows), queries.where("false")).count() == 0
    named = lexical_search.ranked_search(docs(rows), queries.selectExpr("CAST(item_id AS STRING) AS item_id", "text"), 6, id_col="id")
    assert dict(named.dtypes) == {"item_id": "string", "rank": "int", "id": "string", "score": "bigint"}


def test_pair_bounds_skip_more_than_single_ones():
    r = random.Random(6)
    words = [f"w{k}" for k in range(30)]
    texts = [" ".join(r.choices(words, [1 / (k + 1) for k in range(30)], k=r.randint(5, 60))) for _ in range(600)]
    queries = lexical_search.Queries([(k, " ".join(r.sample(words, 8))) for k in range(40)])
    counts = [Counter(terms(t)) for t in texts]
    df = np.array([sum(w.decode() in c for c in counts) for w in queries.words])
    read = {}
    for pairs in (True, False):
        plan = lexical_search.Plan(queries, len(texts), sum(sum(c.values()) for c in counts), df, pairs)
        index = lexical_search.BlockIndex(plan, pa.array(texts))
        assert bool(index.joint) == pairs
        for unit, (docs, impacts, most) in index.joint.items():
            (s, n), (t, m) = unit
            singles = [dict(zip(*(x.tolist() for x in index.postings(w)), strict=True)) for w in (s, t)]
            assert {d: n * singles[0][d] + m * singles[1][d] for d in singles[0].keys() & singles[1].keys()} == dict(zip(docs.tolist(), impacts.tolist(), strict=True))
            assert index.bound(unit) == max(most, n * max(singles[0].values()), m * max(singles[1].values())) <= n * max(singles[0].values()) + m * max(singles[1].values())
        found = [index.search(units, 5, 0) for units in plan.units]
        read[pairs] = sum(f[2] for f in found), [sorted(zip((-f[1]).tolist(), f[0].tolist(), strict=True))[:5] for f in found]
    every = sum(len(index.postings(t)[0]) for terms_ in queries.terms for t, _ in terms_)
    assert read[True][1] == read[False][1]
    assert read[True][0] < read[False][0] < every


def test_op13_equals_a_plain_search(spark, table):
    asked = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    got = sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in llm.op13_lexical_search(spark, SF).collect())
    assert got == sorted(plain_search(list(table.items()), asked, lexical_search.TOP))
