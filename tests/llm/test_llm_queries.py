"""Registered queries of the training-data operators on the smallest tables: SQL, or a plain search of the same rows."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter, defaultdict
from functools import cache

import duckdb
import pytest
from test_dedup import fingerprint, grouped
from test_text import counts

from chronolake.llm import language_id, quality_classifier
from chronolake.llm import queries as llm
from chronolake.llm.queries import tokenizer_path

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def texts(db):
    return dict(db.sql("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall())


def rows_of(columns, rows):
    order = sorted(columns)
    return sorted(repr([r[columns.index(c)] for c in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_sql(spark, db, name):
    got = llm.queries()[name](spark, SF)
    want = db.sql(llm.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(want.columns, want.fetchall())


def test_op3_links_all_near_fingerprints(spark, texts):
    ids = sorted(texts)
    prints = [fingerprint(texts[i]) for i in ids]
    want = sorted((i, f"{p:016x}", ids[k]) for i, p, k in zip(ids, prints, grouped(prints), strict=True))
    assert sorted(tuple(r) for r in llm.op3_simhash(spark, SF).select("doc_id", "fingerprint", "component_id").collect()) == want


def test_op4_equals_the_library(spark, texts):
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(tokenizer_path())
    library.no_truncation()
    library.no_padding()
    want = []
    for i, t in texts.items():
        ids = library.encode(t or "", add_special_tokens=False).ids
        packed = b"".join(x.to_bytes(4, "little") for x in ids)
        back = library.decode(ids, skip_special_tokens=False).encode()
        want.append((i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(back).hexdigest()))
    assert sorted(tuple(r) for r in llm.op4_bpe(spark, SF).collect()) == sorted(want)


def test_op7_is_right_on_held_out_rows(spark, db):
    lang = dict(db.sql("SELECT doc_id, lang FROM documents").fetchall())
    got = llm.op7_language_id(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    told = [r for r in got if r.held_out and lang[r.doc_id] is not None and r.lang_pred != "und"]
    assert sum(r.lang_pred == lang[r.doc_id] for r in told) >= 0.9 * len(told) > 0


def grams(text):
    points = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    return [g for n in (2, 3, 4) for at in range(len(points) - n + 1) if " " not in (g := points[at : at + n])[1:-1] and not (n < 4 and g[0] == g[-1] == " ")]


def test_op7_equals_exact_sets(spark, db):
    """The filters against sets of the grams of two documents or more; what Bloom filters add by chance is taken off again."""
    rows = db.sql("SELECT doc_id, text, lang FROM documents").fetchall()
    seen = defaultdict(Counter)
    for i, text, lang in rows:
        if text is not None and lang is not None and zlib.crc32(str(i).encode()) % 3 != 1:
            seen[lang].update(set(grams(text)))
    held = {lang: {g for g, n in c.items() if n > 1} for lang, c in seen.items()}
    assert max(map(len, held.values())) <= language_id.GRAMS  # so that no profile is cut
    got = {r.doc_id: r for r in llm.op7_language_id(spark, SF).collect()}
    clear = 0
    for i, text, _ in rows:
        own = grams(text or "")
        if not own:
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        shares = sorted(((sum(g in h for g in own) / len(own), lang) for lang, h in held.items()), reverse=True)
        assert got[i].score == pytest.approx(shares[0][0], abs=0.02)
        if shares[0][0] - shares[1][0] > 0.04:
            clear += 1
            assert got[i].lang_pred == shares[0][1]
    assert clear > 0.9 * len(rows)


def plain_quality(rows):
    """op6 in plain Python: base rules, and the distances to references of every language with enough text."""
    stop, edges = ".,;:?'\"()-", b".,;:!?\"'()"

    def kind(c):
        if ord(c) >= 0x80:
            return "beyond"
        return "lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit() else "space" if c in " \t\n\x0b\x0c\r" else "stop" if c in stop else "other"

    def folded(text):
        return [w.strip(edges) for w in text.encode().lower().split()]

    def distance(p, q):
        n, m = sum(p.values()), sum(q.values())
        total = 0.0
        for k in p.keys() | q.keys():
            a, b = p.get(k, 0) / n, q.get(k, 0) / m
            total += sum(x * math.log2(2 * x / (a + b)) for x in (a, b) if x) / 2
        return math.sqrt(min(max(total - (sum(v > 0 for v in q.values()) - 1) / (8 * math.log(2) * n), 0), 1))

    classes, words = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang in rows:
        if lang is not None:
            classes[lang].update(map(kind, text or ""))
            words[lang].update(folded(text or ""))
    by_class = {lang: c for lang, c in classes.items() if c.total() >= 5000}
    by_word = {}
    for lang, c in words.items():
        if c.total() >= 1000:
            top = sorted((w for w in c if w), key=lambda w: (-c[w], w))[:50]
            by_word[lang] = {w: c[w] for w in top} | {None: c.total() - sum(c[w] for w in top)}
    out = {}
    for i, text, lang in rows:
        text = text or ""
        n, _, _, _, repeated = counts(text)
        failed = n < 10 or 100 * repeated > 20 * n
        near = True
        if len(text) >= 250 and (lang is None or lang in by_class) and by_class:
            near &= min(distance(Counter(map(kind, text)), q) for q in by_class.values()) <= 0.25
        own = folded(text)
        if len(own) >= 50 and (lang is None or lang in by_word) and by_word:
            near &= min(distance(Counter(w if w in q else None for w in own), q) for q in by_word.values()) <= 0.3
        out[i] = (n, *counts(text)[1:], failed, not failed and near)
    return out


def test_op6_equals_plain_rules(spark, db):
    want = plain_quality(db.sql("SELECT doc_id, text, lang FROM documents").fetchall())
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    got = {r.doc_id: tuple(r[c] for c in columns) for r in llm.op6_quality_rules(spark, SF).collect()}
    assert got == want
    assert len({w[-2:] for w in want.values()}) == 3  # kept, failed by the base rules, failed by divergence


def test_op10_scores_every_row(spark, db):
    ids = {r[0] for r in db.sql("SELECT doc_id FROM documents").fetchall()}
    got = llm.op10_quality_classifier(spark, SF).collect()
    assert {r.doc_id for r in got} == ids and len(got) == len(ids)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)


def test_op10_scores_are_means_over_features(spark, db, texts):
    """Each score from the trained table by loops over words and n-grams."""
    import pyarrow as pa

    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    odds, bias = quality_classifier.fit(docs, labels.where("crc32(cast(cast(doc_id AS STRING) AS BINARY)) % 5 <> 0"))
    bucket = cache(lambda s, last: int(quality_classifier.features(pa.array([s]))[0][-1 if last else 0]))
    got = {r.doc_id: r.score for r in llm.op10_quality_classifier(spark, SF).collect()}
    for i in sorted(texts, key=lambda i: len(texts[i] or ""))[:60]:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", texts[i] or "") if w]
        values = [odds[bucket(w, False)] for w in words] + [odds[bucket(w[k : k + n], True)] for w in words for n in (2, 3, 4) for k in range(len(w) - n + 1)]
        mean = sum(map(float, values)) / max(len(values), 1)
        assert got[i] == pytest.approx(1 / (1 + math.exp(-(mean + bias))), abs=1e-5)


def test_op10_ranks_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("no tables")
    label = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{folder}/labels.parquet' WHERE quality IS NOT NULL").fetchall())
    held = [(r.score, label[r.doc_id]) for r in llm.op10_quality_classifier(spark, folder).where("held_out").collect() if r.doc_id in label]
    good, bad = [s for s, q in held if q], [s for s, q in held if not q]
    assert sum((a > b) + (a == b) / 2 for a in good for b in bad) >= 0.9 * len(good) * len(bad) > 0
