import random

import numpy as np
import pyarrow as pa
import pytest

from weftline.llm import langid
from weftline.llm.textcode import column_bytes

SYLLABLES = {"aa": ["the", "ing", "tion", "er"], "bb": ["eau", "é", "oi", "ment"], "cc": ["sch", "ü", "ich", "ung"]}


def make(lang, rng, n=60):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def table(spark, n=300):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(SYLLABLES))
        rows.append((i, make(lang, rng), lang if i % 11 else None, 0.5))
    rows += [(900, None, "aa", 0.1), (901, "", "bb", 0.1), (902, "12 34 …€ 😀", "cc", 0.1), (903, "Жук", None, 0.1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double"), rows


def fitted(languages, texts, labels):
    lists = [np.unique(langid.text_grams(*column_bytes(pa.array([t])))[0], return_counts=True) for t in texts]
    return langid.LanguageModel(languages).fit([g for g, _ in lists], [n.astype(float) for _, n in lists], np.array(labels))


def plain(model, text):
    """Language and score by loops over letters and grams, apart from the array code."""
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    letter = lambda c: 97 <= c <= 122 or c >= 128
    b = [32, 32, *(c if letter(c) else 32 for c in low), 32, 32, 32]
    total, n, known = np.zeros(langid.DIM), 0, 0
    for i, c in enumerate(b):
        if c == 32:
            continue
        for size, kind in ((b[i : i + 2], 1), (b[i - 1 : i + 2], 2), (b[i - 1 : i + 3], 3)):
            value = int.from_bytes(bytes(size), "big") + (kind << 40)
            bucket = (value * int(langid._MIX[kind]) % 2**64) >> (64 - (langid.BUCKETS.bit_length() - 1))
            total += model.embed[bucket]
            known += int(model.seen[bucket])
            n += 1
    if not n or not any(x.isalpha() for x in text):
        return "und", 0.0
    z = (total / n @ model.soft + model.bias) / model.heat
    p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    short = min(1.0, known / n / model.usual) if model.usual else 1.0
    return model.languages[int(p.argmax())], float(p.max() * short)


def test_equals_plain_scorer(spark):
    docs, rows = table(spark)
    model = langid.train(docs)
    for r, (_, text, *_) in zip(sorted(langid.classify(docs, model).collect(), key=lambda r: r.doc_id), rows):
        lang, score = plain(model, text)
        assert r.lang_pred == lang and abs(r.score - score) < 1e-3


@pytest.mark.parametrize("ident", [None, 0, 7])
def test_one_id(spark, ident):
    """Rows of one id, or without any, train as any others unless that id is held out."""
    rng = random.Random(3)
    rows = [(ident, make(x, rng, 20), x) for x in sorted(SYLLABLES) for _ in range(120)] + [(ident, "the ing tion", "aa")] * 2000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, rows=50)
    got = langid.classify(docs, model).collect()
    if docs.where(~langid.held_out("doc_id", 3, 1)).isEmpty():
        assert {r.lang_pred for r in got} == {"und"} and langid.accepted(docs).count() == len(rows)
    else:
        assert np.mean([langid_ == r.lang_pred for (*_, langid_), r in zip(rows, got)]) > 0.98


def test_sample_is_bounded(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(langid.LanguageModel, "fit", lambda self, grams, counts, labels: seen.append(np.bincount(labels).tolist()) or self)
    rng = random.Random(4)
    rows = [(i, make(x, rng, 5), x) for i, x in enumerate(sorted(SYLLABLES) * 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langid.train(docs, rows=40)
    langid.train(docs, rows=40, all_rows=30)
    assert seen == [[40] * 3, [10] * 3]


def test_long_texts_train_whole(spark):
    """The language stands in the last part only: the fit sees it."""
    rng = random.Random(5)
    rows = [(i, "zz " * 3000 + make(x, rng, 400), x) for i, x in enumerate(["aa", "bb"] * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.classify(docs, langid.train(docs)).collect()
    assert np.mean([r.lang_pred == x for r, (*_, x) in zip(sorted(got, key=lambda r: r.doc_id), rows)]) > 0.98


def test_unlabelled_tables_keep_their_rows(spark):
    docs = spark.createDataFrame([(1, "abc", None, 1.0, "x"), (2, None, None, 1.0, "x")], "doc_id long, text string, lang string, lang_score double, _lang string")
    assert langid.accepted(docs).count() == 2


def test_held_out_accuracy(spark):
    docs, rows = table(spark)
    model = langid.train(docs)
    got = {r.doc_id: r for r in langid.classify(docs, model).collect()}
    truth = {r[0]: r[2] for r in rows[:-4] if r[2]}
    assert np.mean([got[i].lang_pred == x for i, x in truth.items()]) > 0.98
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and got[900].score == 0
    assert got[903].lang_pred != "und" and got[903].score < model.reject_below + 1e-9
    assert all(0 <= r.score <= 1 for r in got.values())
    assert np.mean([got[i].score >= model.reject_below for i in truth]) > 0.98


def test_scores_do_not_depend_on_neighbours():
    rng = random.Random(2)
    texts = [make(x, rng, 30) for x in "aa bb cc aa".split()]
    model = fitted(["aa", "bb", "cc"], texts * 4, [0, 1, 2, 0] * 4)
    both = model.raw_scores(*column_bytes(pa.array(texts)))[0]
    for i, t in enumerate(texts):
        assert np.allclose(both[i], model.raw_scores(*column_bytes(pa.array([t])))[0][0])


def test_table_equals_mean_embedding():
    """The folded table gives what averaging embeddings and the softmax layer give."""
    model = fitted(["aa", "bb"], ["the ing the", "eau oi eau"] * 8, [0, 1] * 8)
    g, first = langid.text_grams(*column_bytes(pa.array(["the eau"])))
    want = model.embed[g].mean(0) @ model.soft + model.bias
    assert np.allclose(model.raw_scores(*column_bytes(pa.array(["the eau"])))[0][0], want, atol=1e-4)


@pytest.mark.parametrize("rows", [[], [(1, "abc", None)]])
def test_nothing_to_learn(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.classify(docs, langid.train(docs)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * len(rows)
