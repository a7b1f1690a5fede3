"""The pipeline against a version of all its stages in plain Python."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from test_dedup import fingerprint, grouped, key
from test_scans import contaminated

import corpus_pipeline
from chronolake.llm.queries import tokenizer_path

PASSAGE = "seven grey herons waited beside a frozen weir while children counted lanterns along old brick walls"
EVERY = "This line is at the foot of every page of the printed edition"


def table(prose):
    """(doc_id, text, lang) with a case or more for each stage; the languages' words are those of ``prose``."""
    rows = [(10 * k + j, prose(lang, k, 60), lang) for k in range(14) for j, lang in enumerate(("en", "de", "fr"))]
    rows += [(500 + k, f"{prose('en', 50 + k, 80)}\n{EVERY}\n{prose('de', k, 9)}", "en") for k in range(6)]
    long = prose("fr", 77, 900)
    rows += [(600, long, "fr"), (601, long, "fr"), (602, long.upper(), "fr"), (603, long + " cap", "fr")]
    rows += [(700, PASSAGE, "en"), (701, PASSAGE.upper() + ". " + prose("en", 90, 30), "en"), (702, prose("en", 91, 900) + " " + PASSAGE, "en")]
    rows += [(800, None, "en"), (801, "", "en"), (802, "12345 !!! 678", "en"), (803, "жжщ щщж ыыы эээ ъъъ", None), (804, prose("de", 92, 50), None), (805, " \n ", None)]
    random.Random(3).shuffle(rows)
    return rows


def grams(text):
    points = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    for n in (2, 3, 4):
        for at in range(len(points) - n + 1):
            g = points[at : at + n]
            if " " not in g[1:-1] and not (n < 4 and g[0] == g[-1] == " "):
                yield g


def known(rows):
    """Documents of which a language's grams, those of two of its documents or more, make up enough."""
    seen = defaultdict(Counter)
    for _, text, lang in rows:
        if text is not None and lang is not None:
            seen[lang].update(set(grams(text)))
    held = {lang: {g for g, n in c.items() if n > 1} for lang, c in seen.items()}

    def share(text):
        own = list(grams(text))
        return max(sum(g in h for g in own) for h in held.values()) / len(own)

    return [r for r in rows if r[1] and any(map(str.isalpha, r[1])) and share(r[1]) >= 0.3]


def without_lines(rows):
    held = defaultdict(set)
    for i, text, _ in rows:
        for line in text.split("\n"):
            held[key(line)].add(i)
    falls = lambda i, line: len(key(line)) >= 40 and len(held[key(line)]) >= 5 and max(held[key(line)]) != i
    return [(i, "\n".join(x for x in text.split("\n") if not falls(i, x)), lang) for i, text, lang in rows]


def without_copies(rows):
    rows = sorted(rows)
    return [r for k, r in enumerate(rows) if grouped([fingerprint(t) for _, t, _ in rows])[k] == k]


def write(spark, docs, folder, rows, items):
    docs(rows).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_stages_take_effect(spark, docs, prose, tmp_path):
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(tokenizer_path())
    rows, items = table(prose), [(1, PASSAGE), (2, "--"), (3, None)]
    one = known(rows)
    two = without_lines(one)
    three = without_copies(two)
    four = [r for r in three if not contaminated(r[1], items)[3]]
    want = []
    for i, text, _ in four:
        ids = library.encode(text, add_special_tokens=False).ids
        packed = b"".join(x.to_bytes(4, "little") for x in ids)
        back = library.decode(ids, skip_special_tokens=False).encode()
        want.append((i, len(ids), packed, hashlib.sha256(packed).hexdigest(), hashlib.sha256(back).hexdigest()))
    # each stage has something to do, and leaves the clean ones alone
    assert {r[0] for r in rows} - {r[0] for r in one} == {800, 801, 802, 803, 805}
    assert sum(EVERY in r[1] for r in two) == 1
    assert {600} == {r[0] for r in three if 600 <= r[0] < 602} and len(three) < len(two)
    assert 702 in {r[0] for r in four} and not {700, 701} & {r[0] for r in four}
    got = corpus_pipeline.run(spark, write(spark, docs, tmp_path, rows, items))
    assert sorted(tuple(r) for r in got.select("doc_id", "n_tokens", "ids_le", "ids_sha256", "decoded_sha256").collect()) == sorted(want)


def test_stages_keep_the_columns_of_documents(spark, docs, prose, tmp_path):
    folder = write(spark, docs, tmp_path, table(prose), [(1, PASSAGE)])
    rows = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rows, folder)
        assert out.columns == rows.columns, name
        assert [f.dataType for f in out.schema] == [f.dataType for f in rows.schema], name
    cut = corpus_pipeline.without_repeated_lines(spark, rows, folder)
    assert all(r.n_chars == len(r.text or "") for r in cut.collect())


def test_empty_tables(spark, docs, tmp_path):
    assert corpus_pipeline.run(spark, write(spark, docs, tmp_path, [], [])).count() == 0
