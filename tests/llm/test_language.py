import numpy as np
import pytest
from llm_words import no_documents, odd  # noqa: F401
from pyspark.sql import functions as F

from daybook.llm import language
from daybook.llm.language import features, fit, held_out, train, with_language

SAMPLES = {
    "en": "the weather is fine and the people of this town went to the river with their children",
    "de": "das wetter ist schön und die leute dieser stadt gingen mit ihren kindern an den fluss",
    "fr": "le temps est beau et les gens de cette ville sont allés à la rivière avec leurs enfants",
}


def labelled(spark, copies=30):
    rows = []
    for lang, text in SAMPLES.items():
        words = text.split()
        for k in range(copies):
            rows.append((len(rows), " ".join(words[(k * 3 + i * 7) % len(words)] for i in range(25)), lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def grams(text):
    """The n-grams of one to three letters, by the rules of the docstring."""
    kept = " " + "".join(c.lower() if c.isalpha() else " " for c in text) + " "
    while "  " in kept:
        kept = kept.replace("  ", " ")
    one = {c for c in kept if c != " "}
    return one | {kept[i : i + n] for n in (2, 3) for i in range(len(kept) - n + 1)}


def test_kernel_is_that_of_presence_up_to_collisions(monkeypatch):
    monkeypatch.setattr(language, "FEATURE_BITS", 20)
    texts = list(SAMPLES.values())
    x, lettered = features(texts)
    assert lettered.all()
    sets = [grams(t) for t in texts]
    wanted = [[len(a & b) / np.sqrt(len(a) * len(b)) for b in sets] for a in sets]
    assert np.abs(x @ x.T - np.array(wanted)).max() < 0.01


def test_pieces_of_long_texts_give_the_same_grams(monkeypatch):
    text = " ".join(SAMPLES.values())
    whole, _ = features([text])
    monkeypatch.setattr(language, "LETTERS_AT_ONCE", 10)
    assert (features([text])[0] == whole).mean() > 0.999


def test_learns_and_predicts_text_only(spark):
    rows = labelled(spark)
    model = train(rows.where(~held_out()), per_language=40)
    test = rows.where(held_out()).withColumnRenamed("lang", "truth")
    got = with_language(test.withColumn("lang_pred", F.lit("x")).withColumn("given", F.lit(1)), model)
    assert got.columns == ["doc_id", "text", "truth", "given", "lang_pred", "score"]
    out = got.collect()
    assert out and all(r.truth == r.lang_pred and 0 < r.score <= 1 for r in out)


def test_odd_documents(spark, odd):
    model = train(labelled(spark))
    got = with_language(odd, model).collect()
    assert len(got) == odd.count()
    for r in got:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in SAMPLES and 0 <= r.score <= 1


def test_nothing_learned_and_empty_tables(spark, odd, no_documents):
    model = train(no_documents)
    assert {r.lang_pred for r in with_language(odd, model).collect()} == {"und"}
    assert with_language(no_documents, train(labelled(spark))).collect() == []


def test_rows_without_label_or_text_teach_nothing(spark, odd):
    assert train(odd.where("lang IS NULL OR text IS NULL")).languages == []


def test_the_sample_is_bounded(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(language, "fit", lambda x, labels: taken.append(len(labels)) or fit(x, labels))
    train(labelled(spark, 200), per_language=10)
    assert 3 <= taken[0] <= 60


@pytest.mark.parametrize("lang", SAMPLES)
def test_one_language_only(spark, lang):
    model = train(labelled(spark).where(F.col("lang") == lang))
    assert model.predict([SAMPLES[lang], "", None])[0] == [lang, "und", "und"]
