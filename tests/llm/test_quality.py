"""Quality trees (2), languages (6) and quality rules (8)."""

import random
import re
import zlib
from collections import Counter

import numpy as np
from llm_helpers import AWKWARD, WORD, by_id, documents, prose

from clickloom.llm import language, quality_rules, quality_trees
from clickloom.llm.statistics import FEATURES, features

LANGS = {"en": "the of and ing th er on an re he in ed nd ha", "de": "der die und ein sch keit ung ich ver ge be ö ü ä", "fr": "le la eau oi que ment tion é è ç ou un des"}


def tongue(lang, seed, n):
    pick, parts = random.Random(f"{lang}{seed}"), LANGS[lang].split()
    return " ".join("".join(pick.choice(parts) for _ in range(pick.randrange(1, 4))) for _ in range(n))


def junk(seed, n):
    return " ".join(w.upper() + "%%%" for w in tongue("en", seed, n).split())


def test_trees_learn_and_walk():
    pick = np.random.default_rng(1)
    x = pick.normal(size=(3000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.2)).astype(float)
    model = quality_trees.grow(x[:2000], y[:2000], trees=40)
    assert ((model.scores(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.97
    # the arrays say what a walk node by node says
    for row in x[:20]:
        total = model.base
        for feature, threshold, leaf in zip(model.feature, model.threshold, model.leaf, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            total += leaf[node - len(feature)]
        assert np.isclose(1 / (1 + np.exp(-total)), model.scores(row[None])[0])


def test_quality_scores(spark):
    texts = [junk(k, 30 + k) if k % 3 == 0 else tongue("en", k, 30 + k) for k in range(240)] + AWKWARD
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(0, 240, 2)] + [(999, 1, 0), (1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    out = by_id(quality_trees.score_documents(docs, labels))
    assert len(out) == len(texts)
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 3 == 1) for k, r in out.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out.values())
    assert np.mean([out[k]["predicted"] == (k % 3 > 0) for k in range(240)]) > 0.97


def test_quality_without_labels_or_documents(spark):
    docs = documents(spark, ["a", None])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in quality_trees.score_documents(docs, none).collect()} == {0.5}
    assert quality_trees.score_documents(docs.where("false"), none).collect() == []


def test_features_of_empty_texts():
    values = features(np.zeros(0, np.uint8), np.array([0, 0, 0]))
    assert values.shape == (2, len(FEATURES))
    assert np.isfinite(values).all()


def _base(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    count = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {j for i in range(len(words) - 2) if count[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated)


def test_quality_rules(spark):
    good = {k: tongue(lang, k, 120) for k, lang in enumerate(["en", "de", "fr"] * 40)}
    texts = [*good.values(), *AWKWARD, *(junk(k, 150) for k in range(5)), "the end. " * 100, "a b c\na b c\n" * 3]
    langs = ["en", "de", "fr"] * 40 + [None, "xx", "en"] * 4 + ["en"] * 5 + ["en", None]
    out = by_id(quality_rules.judge_documents(documents(spark, texts, langs)))
    for k, text in enumerate(texts):
        r = out[k]
        expected = _base(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == expected
        failed = expected[0] < 50 or 100 * expected[4] > 50 * expected[0]
        assert r["base_failed"] == failed
        assert not (failed and r["kept"])
        if k in good:
            assert r["kept"], (k, r)
    assert not any(out[132 + k]["kept"] for k in range(6))
    assert quality_rules.judge_documents(documents(spark, ["x"]).where("false")).collect() == []


def test_rules_of_a_rare_language(spark):
    texts = [tongue("en", k, 3000) for k in range(40)] + [tongue("fr", k, 50) for k in range(2)]
    out = by_id(quality_rules.judge_documents(documents(spark, texts, ["en"] * 40 + ["fr"] * 2)))
    assert len(out) == 42
    assert all(r["kept"] for r in out.values())
    assert all(out[k]["word_distance"] is not None for k in (40, 41))


def test_documents_without_a_language_make_no_reference(spark):
    good = [prose(k, 300, vocabulary=12) for k in range(40)]
    junk = [" ".join(f"{k}{j}#9{j * 7}" for j in range(300)) for k in range(12)]
    judged = {}
    for name in (None, ""):
        docs = documents(spark, [*good, *junk], langs=["en"] * 40 + [name] * 12)
        judged[name] = [r["kept"] for _, r in sorted(by_id(quality_rules.judge_documents(docs)).items())]
        langs = {r["lang"] for r in quality_rules.reference_counts(docs).collect()}
        assert langs == ({"en"} if name is None else {"en", ""})
    assert judged[None] == [True] * 40 + [False] * 12
    assert judged[""][:40] == [True] * 40
    alone = quality_rules.judge_documents(documents(spark, good[:3], langs=[None] * 3)).collect()
    assert [(r["kept"], r["word_distance"]) for r in alone] == [(not r["base_failed"], None) for r in alone]


def test_divergence():
    p, q = np.array([[1.0, 0.0], [0.5, 0.5], [0.25, 0.75]]), np.array([0.5, 0.5])
    m = (p + q) / 2
    terms = [[x * np.log2(x / y) if x else 0 for x, y in zip(a, b, strict=True)] for a, b in zip(p, m, strict=True)]
    other = [[x * np.log2(x / y) for x, y in zip(q, b, strict=True)] for b in m]
    assert np.allclose(quality_rules.divergence(p, q), np.sqrt((np.sum(terms, 1) + np.sum(other, 1)) / 2))


def test_languages(spark):
    names = ["en", "de", "fr"]
    texts = [tongue(names[k % 3], k, 40) for k in range(150)] + AWKWARD + [tongue("en", 7, 60) + " " + tongue("de", 8, 40), "12 34", "ÀÉ ñandú"]
    langs = [names[k % 3] for k in range(150)] + [None] * (len(texts) - 150)
    out = by_id(language.identify_documents(documents(spark, texts, langs)))
    assert len(out) == len(texts)
    for k, r in out.items():
        assert r["held_out"] == (zlib.crc32(str(k).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
        letters = any(c.isalpha() for c in texts[k] or "")
        assert (r["lang_pred"] == "und") == (not letters)
        assert r["lang_pred"] in [*names, "und"]
    assert np.mean([out[k]["lang_pred"] == langs[k] for k in range(150)]) > 0.98
    mixed = out[150 + len(AWKWARD)]
    assert sorted(mixed["languages"]) == ["de", "en"]
    assert mixed["lang_pred"] == "en"
    assert abs(mixed["score"] - 0.6) < 0.15


def test_rare_languages_and_four_in_one_text(spark):
    LANGS["ru"], LANGS["el"] = "по не ст но на ен то ра", "και το αι στ ου ρα με"
    try:
        names = ["en", "de", "fr", "ru"]
        texts = [tongue(names[k % 4], k, 3000) for k in range(40)] + [tongue("el", k, 20) for k in range(4)]
        texts.append(" ".join(tongue(lang, 99, 60) for lang in names))
        langs = [names[k % 4] for k in range(40)] + ["el"] * 4 + [None]
        out = by_id(language.identify_documents(documents(spark, texts, langs)))
    finally:
        del LANGS["ru"], LANGS["el"]
    assert all(out[k]["lang_pred"] == langs[k] for k in range(44))
    assert sorted(out[44]["languages"]) == sorted(names)


def test_languages_without_anything_learned(spark):
    docs = documents(spark, ["a b", None], [None, None])
    assert {(r["lang_pred"], r["score"]) for r in language.identify_documents(docs).collect()} == {("und", 0.0)}
    assert language.identify_documents(docs.where("false")).collect() == []


def test_word_trigrams():
    text = "Äb, c!"
    raw = np.frombuffer(text.encode(), np.uint8)
    buckets, first, owner = language.trigrams(raw, np.array([0, len(raw)]))
    assert (len(buckets), first.tolist(), owner.tolist()) == (3, [0, 2], [0, 0])
