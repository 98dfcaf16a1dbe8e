import numpy as np

from adlumen.llm import langid
from adlumen.llm.queries import QUERIES
from tests.llm import brute

TEXTS = [("en", "the cat sat on the mat and the dog"), ("en", "then they went to the other house"), ("de", "der hund und die katze sind im haus"),
         ("de", "dann gingen sie in das andere haus"), ("xx", "ααβ γδ ααβ")]


def test_held_out_accuracy(spark, small):
    truth = {r["doc_id"]: r["lang"] for r in brute.rows(small, "documents")}
    got = QUERIES["op4_language_models"](spark, small).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 200 and 20 < len(held) < 80
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_probabilities_of_a_context_add_up(spark):
    model = langid.train(spark.createDataFrame(TEXTS, "lang string, text string"))
    scorer = langid.Scorer(model)
    units = {ord(c) for _, t in TEXTS for c in t} | {32}
    for context in ("the", " th", "zzz", "αα "):
        grams = []
        for unit in sorted(units):
            value = 0
            for c in (*map(ord, context), unit):
                value = value << 16 | c
            grams.append(value)
        total = np.exp(scorer.logs(np.array(grams, dtype=np.uint64))).sum(axis=0)
        # one share of the uniform base is left to unseen characters
        assert (total <= 1.0001).all() and (total > 0.9).all()


def test_counts_by_hand(spark):
    got = {(r.lang, r.gram): r.n for r in langid.counted(spark.createDataFrame([("a", "Ab!b"), ("a", "ab")], "lang string, text string")).collect()}

    def pack(s):
        value = 0
        for c in s:
            value = value << 16 | ord(c)
        return value - (1 << 64) if value >> 63 else value

    assert got == {("a", pack("   a")): 2, ("a", pack("  ab")): 2, ("a", pack(" ab ")): 2, ("a", pack("ab b")): 1, ("a", pack("b b ")): 1}


def test_nulls_ties_long_and_empty(spark):
    rows = [(i, t, lang) for i, (lang, t) in enumerate(TEXTS * 4)] + [
        (100, None, "en"), (101, "", None), (102, "12 34 !", "de"), (103, "the cat " * 50_000, None), (103, "the cat " * 50_000, None), (None, "der hund", "de")]
    docs = spark.createDataFrame([(*r, 1, "g") for r in rows], "doc_id long, text string, lang string, score int, gram string")
    got = langid.identify(docs).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert [(by_id[i].lang_pred, by_id[i].score, by_id[i].rejected) for i in (100, 101, 102)] == [("und", 0.0, True)] * 3
    assert by_id[103].lang_pred == "en" and by_id[None].lang_pred == "de"
    assert langid.identify(docs.limit(0)).count() == 0
    nothing = langid.identify(docs.where("lang IS NULL")).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}


def test_every_labelled_row_counts_in_the_calibration(spark):
    words = {"en": ["the", "cat", "house", "other"], "de": ["der", "hund", "haus", "andere"]}
    rows = [(i, " ".join(words[lang][(i // k) % 4] for k in (1, 3, 7)) + (" zzqx" * (i % 40 == 0)), lang)
            for i in range(2_400) for lang in [("en", "de")[i % 2]]]
    learn = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = langid.train(learn.select("lang", "text"))
    got = langid.calibrate(learn, model)
    entropy, _ = langid.Scorer(model).entropies([t for _, t, _ in rows])
    truth = np.array([model["langs"].index(lang) for *_, lang in rows])
    for i in range(2):
        own = entropy[truth == i, i]
        assert abs(got["limits"][i] - own.mean() - langid.DEVIATIONS * own.std()) < 1e-9
    losses = [-np.log(np.maximum(langid.posterior(entropy, t)[np.arange(len(truth)), truth], 1e-9)).mean() for t in langid.TEMPERATURES]
    assert got["temperature"] == langid.TEMPERATURES[np.argmin(losses)]
