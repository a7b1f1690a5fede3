"""Tokens, languages, quality and chats."""

import hashlib
import json
import math
import os
import random
import re
from array import array
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronolake.llm import bpe, chat_format, language_id, quality_classifier, quality_rules
from chronolake.llm.queries import tokenizer_path


SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def both():
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(tokenizer_path())
    return library, bpe.Tokenizer.from_file(tokenizer_path())


TEXTS = [None, "", " \n", "a", "It's THE ΣΑΣ's sré ti12", "x<|endoftext|>Y<|startoftext|>", "<|ENDOFTEXT|>", "ᲉꟋ\U00010d50 \U0001f600é", "\x1c\x85a​b", "é" * 3, "12345", "!!!???" * 400, "ab" * 20_000, "th" * 3000 + "e", "'s't're've'm'll'd''"]


def test_tokens_equal_the_library(spark, docs, both):
    library, _ = both
    r = random.Random(1)
    texts = TEXTS + ["".join(r.choice(r.choice(["thenring", "ab ", "éèç'n ", "$#%&*'. ", "XYΣς1 "])) for _ in range(r.choice([5, 300, 4000]))) for _ in range(60)]
    rows = [(i, t, None) for i, t in enumerate(texts)] + [(3, "a", None), (None, "a b", None)]
    expected = []
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected.append((i, ids, library.decode(ids, skip_special_tokens=False)))
    out = bpe.encode_decode(docs(rows), tokenizer_path())
    got = [(x.doc_id, list(array("I", x.ids_le)), x.decoded) for x in out.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))
    again = bpe.decode(out, tokenizer_path())
    assert sorted((repr(x.doc_id), x.decoded) for x in again.collect()) == sorted((repr(i), d) for i, _, d in expected)
    assert bpe.encode_decode(docs([]), tokenizer_path()).count() == 0


def test_pieces_of_a_text_change_nothing(both, monkeypatch):
    library, own = both
    r = random.Random(6)
    texts = ["".join(r.choice(["th", "ing ", "\u0301", " \u0301", "e\u0301", "\n\n", "\t ", "\u00a0", "\u3000 ", "12", "!?", "it's ", "<|endoftext|>", "\u03a3 ", "\u1100\u1161 "]) for _ in range(400)) for _ in range(40)]
    monkeypatch.setattr(bpe, "PIECE", 5)
    monkeypatch.setattr(bpe, "RUN", 3)
    for t in texts:
        ids = library.encode(t, add_special_tokens=False).ids
        assert list(own.encode(t)) == ids
        assert own.encode_decode(t) == (array("I", ids), library.decode(ids, skip_special_tokens=False))


def test_white_space_is_folded_alike(both):
    _, own = both
    plain = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
    r = random.Random(12)
    for _ in range(500):
        text = "".join(r.choices(["a", "b", " ", "\n", "\t", "\x85", "\u3000", "\x1c", "\x1f", "\x0b"] if r.random() < 0.3 else ["a", " ", "\n", "\u2009"], k=r.randint(0, 9)))
        assert own.normalize(text) == plain.sub(" ", text)


def test_memory_does_not_follow_the_text(both):
    import tracemalloc

    _, own = both
    words = ["".join(random.Random(k).choices("etaoin", k=k % 9 + 1)) for k in range(2000)]
    peaks = []
    for text in (" ".join(words) * 10, " ".join(words) * 200, "ab" * 1_000_000):
        own.encode("a")
        tracemalloc.start()
        assert sum(map(len, own.stream(text))) > 0
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert max(peaks) < 16 << 20, peaks


def random_merges(r, letters="abcd", n=60):
    """A merge list whose parts are older than their wholes, as training makes them."""
    tokens, merges = list(letters), []
    while len(merges) < n:
        a, b = r.choice(tokens), r.choice(tokens)
        if a + b not in tokens and len(a + b) <= 8:
            tokens.append(a + b)
            merges.append((a, b))
    return bpe.Merges({t: i for i, t in enumerate(tokens)}, merges, ""), {t: i for i, t in enumerate(tokens)}


def plain(merges, ids):
    ids = list(ids)
    while found := [(merges.rank[p], i) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in merges.rank]:
        (_, whole), i = min(found)
        ids[i : i + 2] = [whole]
    return ids


def test_transducer_needs_no_more_than_its_lookahead(monkeypatch):
    for seed in range(150):
        r = random.Random(seed)
        monkeypatch.setattr(bpe, "STEP", 1 + seed % 9)
        merges, vocab = random_merges(r, n=r.choice([5, 20, 60]))
        assert merges.lookahead is not None
        for _ in range(10):
            ids = [vocab[r.choice("abcd")] for _ in range(r.choice([1, 30, 49, 400]))]
            expected = plain(merges, ids)
            assert list(merges.stream(iter(ids))) == expected
            assert merges.apply(ids) == merges._apply_long(ids) == expected


def test_tokens_leave_before_their_word_has_ended(both):
    """Over the given texts, words of a few symbols stream: some tokens are emitted while symbols are still to come."""
    import duckdb

    if not os.path.isdir(SF):
        pytest.skip("no tables")
    _, own = both
    merges, (_, _, known) = own.merges, own.prepare()
    words = {w for (t,) in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet' WHERE text IS NOT NULL").fetchall() for run in own.words(t) for w in run}
    early = 0
    for word in words:
        symbols = list(known.symbols(word.encode()))
        taken = 0

        def counted():
            nonlocal taken
            for x in symbols:
                taken += 1
                yield x

        out = []
        for token in merges.stream(counted()):
            out.append(token)
            early += taken < len(symbols)
        assert out == merges.apply(symbols)
    assert early > 0


def test_unordered_merges_have_no_lookahead():
    merges = bpe.Merges({"a": 0, "b": 1, "ab": 2, "aba": 3}, [("ab", "a"), ("a", "b")], "")
    assert merges.lookahead is None and list(merges.stream([0, 1, 0])) == [3]


def test_byte_level_decoding_in_any_pieces(both):
    spec = json.load(open(tokenizer_path("byte_bpe_50k.json"), encoding="utf-8"))
    symbols = bpe.byte_symbols()
    tokens = {b: s for b, s in enumerate(symbols)}
    assert set(symbols) <= set(spec["model"]["vocab"])
    r = random.Random(2)
    for _ in range(300):
        data = bytes(r.choice(["é€😀a".encode(), bytes([r.randrange(256)])])[0:4] if r.random() < 0.5 else [r.randrange(256)]) * 1
        data = b"".join(r.choice([b"\xc3\xa9", b"\xe2\x82", b"\xf0\x9f\x98\x80", b"a", b"\xff", b"\xed\xa0\x80"]) for _ in range(8)) + data
        machine = bpe.Decoder(tokens, True)
        assert "".join([machine.feed([b]) for b in data] + [machine.finish()]) == data.decode("utf-8", "replace")


def test_unsupported_files_are_refused():
    spec = json.load(open(tokenizer_path(), encoding="utf-8"))
    for path, value in ((("model", "dropout"), 0.1), (("pre_tokenizer", "pretokenizers", 0, "pattern", "Regex"), r"\p{L}+\s|\p{L}+"), (("normalizer",), {"type": "Precompiled"}), (("decoder",), {"type": "Metaspace"})):
        bad = json.loads(json.dumps(spec))
        at = bad
        for p in path[:-1]:
            at = at[p]
        at[path[-1]] = value
        with pytest.raises(ValueError):
            bpe.Tokenizer(bad)


def test_language_id(spark, docs, prose):
    rows = [(i, prose(lang, i), lang) for i, lang in enumerate(["en", "de", "fr"] * 30)]
    filters = language_id.fit(docs(rows + [(500, None, "en"), (501, "text", None), (None, prose("en", 1), "en"), (0, rows[0][1], "en")]))
    assert filters.languages == ["de", "en", "fr"]
    new = [(1000 + i, prose(lang, 1000 + i), None) for i, lang in enumerate(["en", "de", "fr"] * 10)]
    odd = [(1, None, None), (2, "", None), (3, "12 34 !?", None), (None, prose("de", 5), None), (4, prose("fr", 8, 60_000), None), (4, prose("fr", 8), None)]
    got = language_id.predict(docs(new + odd), filters).collect()
    found = {x.doc_id: (x.lang_pred, x.score) for x in got}
    assert len(got) == len(new + odd)
    assert [found[i][0] for i, _, _ in new] == ["en", "de", "fr"] * 10
    assert found[1] == found[2] == found[3] == ("und", 0.0) and found[None][0] == "de" and found[4][0] == "fr"
    assert all(0 <= s <= 1 for _, s in found.values())
    kept = language_id.keep_known(docs(new + odd), filters)
    assert kept.columns == docs([]).columns and kept.count() == len(new) + 3
    assert language_id.predict(docs([]), filters).count() == 0
    nothing = language_id.fit(docs([(1, None, "en")]))
    assert {x.lang_pred for x in language_id.predict(docs(new), nothing).collect()} == {"und"}


def test_chunks_of_a_text_change_nothing(prose, monkeypatch):
    text = prose("fr", 1, 120) + " 12 \u0436\u0436\u0449 " + "x" * 90 + " a"
    whole = np.sort(np.concatenate(list(language_id.gram_hashes(text))))
    points = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    n = sum(" " not in g[1:-1] and not (len(g) < 4 and g[0] == g[-1] == " ") for k in (2, 3, 4) for at in range(len(points) - k + 1) if (g := points[at : at + k]))
    assert len(whole) == n
    for chunk in (1, 2, 3, 7, 100, len(text)):
        monkeypatch.setattr(language_id, "CHUNK", chunk)
        assert np.array_equal(np.sort(np.concatenate(list(language_id.gram_hashes(text)))), whole)


def test_null_ids_do_not_crowd_out_a_sample(spark, docs, prose):
    named = [(i, prose(lang, i), lang) for i, lang in enumerate(["en", "de", "fr"] * 5)]
    nameless = [(None, prose(lang, 100 + i), lang) for i, lang in enumerate(["en", "de", "fr"] * 40)]
    filters = language_id.fit(docs(named + nameless), per_language=4)
    assert filters.languages == ["de", "en", "fr"]
    new = [(1000 + i, prose(lang, 1000 + i), lang) for i, lang in enumerate(["en", "de", "fr"] * 5)]
    assert all(r.lang_pred == ("en", "de", "fr")[r.doc_id % 3 - 1] for r in language_id.predict(docs(new), filters).collect())


def test_languages_by_the_hundred_in_few_jobs(spark, docs, monkeypatch):
    """Filters of many languages are filled by partition, not by language, and are those of each language alone."""
    word = lambda i, k: "".join(chr(0x4E00 + 40 * i + (7 * k + j) % 40) for j in range(4))
    rows = docs([(3 * i + d, " ".join(word(i, k + d) for k in range(30)), f"x{i:03}") for i in range(150) for d in range(3)])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("languages", "languages")
    try:
        filters = language_id.fit(rows)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup("languages")) < 60
    assert filters.languages == [f"x{i:03}" for i in range(150)] and filters.masks.shape[1] == 3
    found = {r.doc_id: r.lang_pred for r in language_id.predict(rows, filters).collect()}
    assert found == {3 * i + d: f"x{i:03}" for i in range(150) for d in range(3)}
    monkeypatch.setattr(language_id, "SENT_ROWS", 0)  # a sample too large to be broadcast
    alone = language_id.fit(rows.where("lang = 'x070'"))
    assert ((filters.masks[:, 1] >> np.uint64(6)) & np.uint64(1)).tolist() == alone.masks[:, 0].tolist()


def test_language_sample_is_of_documents(spark, docs, prose):
    named = [(i, prose(lang, i), lang) for i, lang in enumerate(["en", "de", "fr"] * 20)]
    junk = "zq xj qz " * 5
    plain = language_id.fit(docs(named), per_language=20)
    # rows without id of one text, and rows of one id, take one place each
    crowd = [(None, junk, "en")] * 60 + [(i, junk, lang) for i, lang in ((900, "de"), (901, "fr")) for _ in range(60)]
    crowded = language_id.fit(docs(named + crowd), per_language=21)
    assert (plain.masks == crowded.masks).all()
    # different texts without ids are documents, beside named ones and alone
    for given in ([(i if lang == "en" else None, t, lang) for i, t, lang in named], [(None, t, lang) for _, t, lang in named]):
        filters = language_id.fit(docs(given), per_language=20)
        assert filters.languages == ["de", "en", "fr"] and (filters.masks == plain.masks).all()
    # of a repeated id the same row is read in any order
    several = named + [(0, prose("en", 500 + k), "en") for k in range(5)]
    assert (language_id.fit(docs(several)).masks == language_id.fit(docs(several[::-1])).masks).all()
    unlabelled = [(1, "some words", None), (None, "\u0434\u0430", None), (2, "12 !", None), (3, "", None), (4, None, None)]
    assert sorted(x.text for x in language_id.keep_known(docs(unlabelled), language_id.fit(docs(unlabelled))).collect()) == ["some words", "\u0434\u0430"]


def test_language_of_a_single_document(spark, docs, prose):
    rows = [(i, prose(lang, i), lang) for i, lang in enumerate(["en", "de"] * 20)] + [(100, prose("fr", 100), "fr")]
    filters = language_id.fit(docs(rows))
    assert filters.languages == ["de", "en", "fr"]
    new = [(1000 + i, prose("fr", 1000 + i), None) for i in range(10)]
    assert {x.lang_pred for x in language_id.predict(docs(new), filters).collect()} == {"fr"}
    assert language_id.keep_known(docs(rows + new), filters).count() == len(rows + new)


def test_bloom_filters_hold_what_was_learned():
    r = np.random.default_rng(1)
    grams = [r.integers(0, 2**63, 500).astype(np.uint64) for _ in range(70)]  # more languages than a mask word has bits
    masks = np.zeros((1 << 16, 2), np.uint64)
    for i, own in enumerate(grams):
        np.bitwise_or.at(masks[:, i // 64], language_id._slots_of(own, 1 << 16, 3).ravel(), np.uint64(1 << (i % 64)))
    filters = language_id.LanguageFilters([f"l{i:02}" for i in range(70)], masks, 3)
    for i, own in enumerate(grams):
        assert (filters.lookup(own)[:, i // 64] & np.uint64(1 << (i % 64))).all()
    assert (filters.chance < 0.001).all()


def counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = {k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            again += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(hit)


def test_quality_rules(spark, docs, prose):
    r = random.Random(3)
    clean = [(i, prose(lang, i, 300), lang) for i, lang in enumerate(["en", "de", "fr"] * 20)]
    junk = [(1000 + i, " ".join(w + r.choice(["$$$", "***", "|||"]) for w in prose("en", i, 300).split()), "en") for i in range(3)] + [(1100 + i, prose("en", i, 300).upper().replace(" ", "!! "), "en") for i in range(3)]
    odd = [(2000, None, "en"), (2001, "", None), (2002, "one\x1ctwo\x85 é\n\né\n \n \né", None), (2003, "a b c d e f " * 4, "en"), (2004, "a a a a a a", None), (2005, " ".join(map(str, range(3000))) * 3, None), (2006, "a b c d e x a b c d e", "xx"), (None, prose("de", 77, 300), None), (0, clean[0][1], "en")]
    rows = clean + junk + odd
    got = quality_rules.quality(docs(rows)).collect()
    assert sorted(map(repr, [(g.doc_id, g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) for g in got])) == sorted(repr((i, *counts(t))) for i, t, _ in rows)
    for g in got:
        assert g.base_failed == (g.n_words < 10 or 100 * g.n_repeat_words > 20 * g.n_words)
        assert not (g.base_failed and g.kept)
    kept = {g.doc_id: g.kept or g.base_failed for g in got}
    assert all(kept[i] for i, _, _ in clean) and kept[None] and not any(kept[i] for i, _, _ in junk)
    assert quality_rules.quality(docs([])).count() == 0
    assert quality_rules.quality(docs([(1, prose("en", 1), None)])).first().kept is not None


def test_quality_of_rare_languages(spark, docs, monkeypatch):
    def spoken(lang, seed, n=120):
        r = random.Random(f"{lang}{seed}")
        return " ".join(r.choices([f"{lang}{'abcdefghijklmnopqrstuvwxyz'[k]}x" for k in range(26)], k=n))

    rows = [(i, spoken("big", i), "big") for i in range(11_000)] + [(20_000 + i, spoken("rare", i), "rare") for i in range(10)] + [(30_000, spoken("lone", 1), "lone"), (30_001, spoken("lone", 2), None), (30_002, spoken("rare", 99), None), (30_003, spoken("lone", 3), "big")]
    frame = docs(rows).repartition(8).cache()
    for size in (quality_rules.BLOCK, 1):  # one block, and a block for each language
        monkeypatch.setattr(quality_rules.References.__init__, "__defaults__", (size,))
        got = {g.doc_id: g for g in quality_rules.quality(frame.where("doc_id % 11 = 0 or doc_id >= 20000") if size == 1 else frame).collect()}
        assert all(got[20_000 + i].kept for i in range(10)) and got[30_002].kept
        assert got[30_000].kept and got[30_000].word_distance is None  # too few words for a reference of its own
        assert not got[30_001].kept and not got[30_003].kept  # foreign to all references


def test_divergence():
    assert quality_rules.js_distance(np.array([1e9, 0.0]), np.array([0.0, 5.0])) == pytest.approx(1)
    assert quality_rules.js_distance(np.array([2.0, 6.0]) * 1e9, np.array([1.0, 3.0])) == pytest.approx(0)


def test_quality_classifier(spark, docs, prose):
    rows = [(i, prose("en", i, 60) if i % 3 else prose("en", i, 60).upper().replace(" ", "$ "), None) for i in range(300)]
    labels = spark.createDataFrame([(i, 1 if i % 3 else 0, 0) for i in range(300) if i < 200] + [(5000, 1, 0), (7, None, 0), (None, 1, 0), (8, 1, 1)], "doc_id long, quality int, toxic int")
    model = quality_classifier.fit(docs(rows), labels)
    odd = [(1001, None, None), (1002, "", None), (None, "x", None), (3, rows[3][1], None), (1003, "the " * 100_000, None)]
    got = quality_classifier.score(docs(rows + odd), model).collect()
    assert len(got) == 305 and all(0 <= g.score <= 1 for g in got)
    held = [(g.score >= quality_classifier.CUT) == bool(g.doc_id % 3) for g in got if 200 <= (g.doc_id or 0) < 300]
    assert sum(held) >= 97
    found = {g.doc_id: g.score for g in got}
    assert found[1001] == found[1002]
    assert quality_classifier.score(docs([]), model).count() == 0
    assert {g.score for g in quality_classifier.score(docs(rows), quality_classifier.fit(docs(rows), labels.limit(0))).collect()} == {0.5}


def plain_features(text, buckets):
    """Buckets of words and of n-grams of characters without white space, with repeats."""
    full = 1 << 64

    def mixed(h):
        h ^= h >> 31
        h = h * 0xBF58476D1CE4E5B9 % full
        return h ^ h >> 29

    out = []
    for word in re.findall(r"[^\x20\x09-\x0D]+", text or ""):
        points = [ord(c) for c in word]
        out.append(mixed(sum((c + 1) * pow(0x9E3779B97F4A7C15, k + 1, full) for k, c in enumerate(points)) % full) % buckets)
        for n in quality_classifier.GRAMS:
            for at in range(len(points) - n + 1):
                h = n
                for c in points[at : at + n]:
                    h = (h * 0x100000001B3 + c) % full
                out.append(mixed(h) % buckets)
    return out


def plain_training(labelled, buckets):
    """Vectors and layer trained example by example; the log odds that each bucket adds, and the bias."""
    d, rng = quality_classifier.DIMENSIONS, np.random.default_rng(quality_classifier.SEED)
    vectors = rng.uniform(-1 / d, 1 / d, (buckets, d)).tolist()
    layer, bias = [[0.0, 0.0] for _ in range(d)], [0.0, 0.0]
    counted = [(label, Counter(plain_features(text, buckets))) for text, label in labelled]
    pack = lambda values: array("i", values).tobytes()
    counted.sort(key=lambda e: (e[0], len(e[1]), pack(sorted(e[1])), pack(e[1][b] for b in sorted(e[1]))))
    size, step = quality_classifier.BATCH, 0
    steps = quality_classifier.EPOCHS * -(-len(counted) // size)
    for _ in range(quality_classifier.EPOCHS):
        order = rng.permutation(len(counted)).tolist()
        for at in range(0, len(order), size):
            rate, batch = quality_classifier.RATE * (1 - step / steps), [counted[i] for i in order[at : at + size]]
            step += 1
            layer_moves, bias_moves, vector_moves = [[0.0, 0.0] for _ in range(d)], [0.0, 0.0], {}
            for label, features in batch:
                total = max(sum(features.values()), 1)
                hidden = [sum(n / total * vectors[b][k] for b, n in features.items()) for k in range(d)]
                logits = [sum(hidden[k] * layer[k][c] for k in range(d)) + bias[c] for c in (0, 1)]
                odds = [math.exp(x - max(logits)) for x in logits]
                error = [odds[c] / sum(odds) - (label == c) for c in (0, 1)]
                for c in (0, 1):
                    bias_moves[c] += error[c] / len(batch)
                    for k in range(d):
                        layer_moves[k][c] += hidden[k] * error[c] / len(batch)
                for b, n in features.items():
                    for k in range(d):
                        own = vector_moves.setdefault(b, [0.0] * d)
                        own[k] += n / total * sum(error[c] * layer[k][c] for c in (0, 1))
            for c in (0, 1):
                bias[c] -= rate * bias_moves[c]
                for k in range(d):
                    layer[k][c] -= rate * layer_moves[k][c]
            for b, move in vector_moves.items():
                vectors[b] = [v - rate * m for v, m in zip(vectors[b], move, strict=True)]
    return [sum(v[k] * (layer[k][1] - layer[k][0]) for k in range(d)) for v in vectors], bias[1] - bias[0]


def test_quality_classifier_equals_plain_training(spark, docs, prose):
    rows = [(k, prose(("en", "de")[k % 2], k, 6 + k % 5), None) for k in range(40)] + [(40, "", None), (41, None, None), (42, "é 日本 日本", None)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(38)] + [(40, 1), (42, 0)], "doc_id long, quality int")
    buckets = 97
    model = quality_classifier.fit(docs(rows), labels, buckets=buckets)
    known = dict((k, k % 2) for k in range(38)) | {40: 1, 42: 0}
    odds, bias = plain_training([(t, known[i]) for i, t, _ in rows if i in known], buckets)
    for r in quality_classifier.score(docs(rows), model).collect():
        found = plain_features(rows[r.doc_id][1], buckets)
        want = 1 / (1 + math.exp(-(sum(odds[b] for b in found) / max(len(found), 1) + bias)))
        assert r.score == pytest.approx(want, abs=2e-4)


def test_features_are_of_characters():
    import pyarrow as pa

    texts = ["\u00e9t\u00e9 ab", None, "", " \t", "\U0001f600x \u0436", "ab"]
    bucket, row = quality_classifier.features(pa.array(texts))
    for i, t in enumerate(texts):
        words = (t or "").split()
        grams = [w[k : k + n] for w in words for n in (2, 3, 4) for k in range(len(w) - n + 1)]
        assert np.count_nonzero(row == i) == len(words) + len(grams)
    # the same word has the same features wherever it stands, beside ASCII or not
    assert set(bucket[row == 5]) <= set(bucket[row == 0])


def test_quality_classifier_reads_one_row_of_an_id(spark, docs, prose, monkeypatch):
    rows = [(i, prose("en", i, 60) if i % 3 else prose("en", i, 60).upper().replace(" ", "$ "), None) for i in range(90)]
    labels = spark.createDataFrame([(i, 1 if i % 3 else 0) for i in range(90)], "doc_id long, quality int")
    read, train = [], quality_classifier.train
    monkeypatch.setattr(quality_classifier, "train", lambda examples, buckets: read.append([(e[0], e[1].tobytes(), e[2].tobytes()) for e in examples]) or train(examples, buckets))
    quality_classifier.fit(docs(rows), labels, sample=90)
    hot = docs(rows).unionAll(docs([(0, rows[0][1], None)] * 400)).unionAll(docs([(0, None, None), (1, None, None)]))
    model = quality_classifier.fit(hot, labels, sample=90)
    assert read[0] == read[1] and len(read[1]) == 90 and {e[0] for e in read[1]} == {0, 1}
    held = [(g.score >= 0.5) == bool(g.doc_id % 3) for g in quality_classifier.score(docs(rows), model).collect()]
    assert sum(held) >= 87
    quality_classifier.fit(docs([(1, "a b", None), (1, "c d", None), (2, None, None)]), labels)
    quality_classifier.fit(docs([(2, None, None), (1, "c d", None), (1, "a b", None)]).repartition(3), labels)
    assert read[2] == read[3] and len(read[2]) == 2


CHATS = "conv_id long, turn long, role string, text string, conv string, node string"


def test_chats_round_trip(spark):
    marks = ["<|im_end|><|im_start|>assistant ok", "<\\|x", "<\\\\|", "<", "|", "a<", None, "", "é\n\n<|im_start|>user\n", "\\<|"]
    turns = [(1, k, ["user", "assistant", "system", None, "a\nb%<|"][k % 5], marks[k % len(marks)]) for k in range(23)]
    turns += [(2, 0, "assistant", "only"), (None, 5, "user", "x"), (None, None, "assistant", "first"), (3, 1, "user", "b"), (3, 1, "user", "a"), (3, 1, "user", "a")] + [(4, k, "user", "y" * 2000) for k in range(300)]
    frame = spark.createDataFrame([(*t, "c", "n") for t in turns], CHATS)
    got = chat_format.format_chats(chat_format.reply_chain(frame))
    got = got.withColumn("turns", chat_format.read_turns(F.col("formatted"))).withColumn("loss", chat_format.loss_text(F.col("segments"))).collect()
    expected = {}
    for c, t, role, text in sorted(turns, key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")):
        expected.setdefault(c, []).append((role or "", text or ""))
    assert {g.conv_id: [tuple(t) for t in g.turns] for g in got} == expected
    assert {g.conv_id: g.loss for g in got} == {c: "".join(x for role, x in own if role == "assistant") for c, own in expected.items()}
    assert all("".join(s.text for s in g.segments) == g.formatted and g.formatted.count("<|im_start|>") == len(g.turns) for g in got)
    assert chat_format.format_chats(chat_format.reply_chain(frame.limit(0))).count() == 0


def test_best_branches_of_reply_trees(spark):
    r = random.Random(9)
    rows = []
    for conv in (1, 2, None):
        for node in range(1, 60):
            rows.append((conv, node, r.choice([None, 999, *range(max(1, node - 3), node)]) if node > 2 else None, "user", f"t{node}", r.choice([0.0, 1.0, 2.0, None])))
    rows += [(1, 70, 71, "user", "round", 1.0), (1, 71, 70, "user", "round", 1.0), (1, 72, 70, "user", "below", 1.0), rows[0]]
    frame = spark.createDataFrame(rows, "conv long, node long, parent long, role string, text string, score double")
    for most in (1, 3):
        expected = set()
        for conv in (1, 2, None):
            own = {n: (p, s or 0.0) for c, n, p, _, _, s in rows if c == conv}
            replied, found = {p for p, _ in own.values()}, {}
            for leaf in own.keys() - replied:
                path, at = [], leaf
                while at in own and at not in path:
                    path.append(at)
                    at = own[at][0]
                if at not in path:
                    found.setdefault(path[-1], []).append((-sum(own[n][1] for n in path) / len(path), leaf, path[::-1]))
            for root, own_leaves in found.items():
                for rank, (_, leaf, path) in enumerate(sorted(own_leaves)[:most]):
                    expected |= {(conv, root, leaf, rank + 1, k + 1, n) for k, n in enumerate(path)}
        assert {(b.conv, b.root, b.leaf, b["rank"], b.place, b.node) for b in chat_format.branches(frame, most).collect()} == expected
    chats = chat_format.format_chats(frame, 3).collect()
    assert chats and all(c.formatted.startswith("<|im_start|>user\n") for c in chats)


def test_sha_of_ids_is_little_endian(spark, docs):
    out = bpe.encode_decode(docs([(1, "the", None)]), tokenizer_path()).select(F.sha2("ids_le", 256).alias("h"), "ids_le").first()
    assert out.h == hashlib.sha256(bytes(out.ids_le)).hexdigest() and len(out.ids_le) == 4
