import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, fp string, spans string, n_lines string, text_hash string, _id string"


@pytest.fixture
def docs(spark):
    """A table of documents, with columns whose names the operators use inside."""

    def make(rows):
        return spark.createDataFrame([(i, t, lang, "s", len(t or ""), "x", "x", "x", "x", "x", "x") for i, t, lang in rows], SCHEMA)

    return make


PROSE = {
    "en": "the ship of the line was to sail with the tide and then for the open water that is by the cape",
    "de": "das Schiff der Linie sollte mit der Flut und dann auf das offene Wasser das bei dem Kap ist",
    "fr": "le navire de la ligne devait partir avec la marée et puis pour les eaux ouvertes qui sont au cap",
}


@pytest.fixture
def prose():
    """Sentences of a language, shuffled by a seed."""
    import random

    def make(lang, seed, n=40):
        return " ".join(random.Random(f"{lang}{seed}").choices(PROSE[lang].split(), k=n))

    return make
