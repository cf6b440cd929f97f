import numpy as np

from quarry.llm import langid as li
from quarry.llm import queries

SF = "/root/testdata/sf0.01"


def model():
    return li.Model(["en", "de"], {"the": 0, "der": 1}, np.array([[-1.0, -9.0], [-9.0, -1.0]]),
                    {"th": 0, "^sch": 1, "e": 2, "sch": 3, "^th": 4},
                    np.array([[-2.0, -5.0], [-9.0, -3.0], [-1.0, -1.5], [-7.0, -1.0], [-3.0, -8.0]]))


def test_backoff_takes_the_longest_known_length():
    m = model()
    assert m.vector("the").tolist() == [-1, -9]           # the word itself
    assert m.vector("thou").tolist() == [-3, -8]          # ^th, not th
    assert m.vector("schon").tolist() == [-9, -3]         # ^sch has four, sch three
    assert m.vector("bath").tolist() == [-2, -5]          # th
    assert m.vector("xe").tolist() == [-1, -1.5]          # e
    assert m.vector("xy").tolist() == [0, 0]


def test_scores_are_sums_over_words(monkeypatch):
    m = model()
    text = "The THE der schon! 12 the_thou"
    total = sum(m.vector(w) for w in ["the", "the", "der", "schon", "the", "thou"])
    for bound in (500_000, 2):  # also when the memory is emptied between texts
        monkeypatch.setattr(li, "_KNOWN_WORDS", bound)
        s = li.Scorer(m)
        for _ in range(2):
            lang, share = s.predict(text)
            assert lang == "en" and abs(share - 1 / (1 + np.exp(total[1] - total[0]))) < 1e-9
            assert s.predict("der schon")[0] == "de"
    assert s.predict("12 ...") == s.predict(None) == s.predict("") == ("und", 0.0)


def test_held_out_language(spark):
    got = queries.op4_language_id(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas()
    m = got.merge(docs, on="doc_id")
    assert len(got) == 1000 and got["score"].between(0, 1).all()
    held = m[m["held_out"] & m["lang"].notna()]
    assert len(held) > 200 and (held["lang"] == held["lang_pred"]).mean() >= 0.97


def test_edge_rows(spark, make_docs):
    docs = make_docs([None, "", "1 2 3", "und so weiter", "and so on", "and so on"],
                     ["en", "de", None, "de", "en", "en"]).selectExpr("*", "0 AS score")
    m = li.train(docs)
    rows = {r.doc_id: r.p for r in li.identify(docs, m, "p", "s").collect()}
    assert rows == {0: "und", 1: "und", 2: "und", 3: "de", 4: "en", 5: "en"}
    nothing = li.train(docs.limit(0))
    assert {r.p for r in li.identify(docs, nothing, "p", "s").collect()} == {"und"}
    assert li.identify(docs.limit(0), m, "p", "s").count() == 0


def test_letters_only():
    for text in ("2\u00bd", "\u00b2", "\u2167", "\u2460 \u00bc", "12 !", "_", "\u0661\u0662"):
        assert li.words_of(text) == []
        assert li.Scorer(model()).predict(text) == ("und", 0.0)
    assert li.words_of("x\u00b2y 3te \u00c4\u2460\u00d6") == ["x", "y", "te", "\u00e4", "\u00f6"]
    assert li.words_of("\u65e5\u672c\u4e00") == ["\u65e5\u672c\u4e00"]


def test_long_texts_in_pieces(monkeypatch):
    import resource
    m = model()
    text = "the der schon " * 2_000 + "thou" * 3_000
    whole = li.Scorer(m).predict(text)
    monkeypatch.setattr(li, "PIECE", 50)
    assert list(li.pieces("aa bb  cc", 1)) == ["aa", " bb", " ", " cc"]
    cut = li.Scorer(m).predict(text)
    assert cut[0] == whole[0] and abs(cut[1] - whole[1]) < 1e-9
    monkeypatch.undo()
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert li.Scorer(m).predict("der the " * 5_000_000)[0] in ("de", "en")  # ten million words
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 300_000


def brute_model(rows, langs):
    """Counts and log frequencies from the definition."""
    from collections import Counter
    words, grams = {}, {}
    for lang in langs:
        c = Counter(w for t, x in rows if x == lang for w in li.words_of(t))
        for w, k in c.items():
            words.setdefault(w, Counter())[lang] += k
            for n in range(1, 6):
                for g in li.grams_of(w, n):
                    grams.setdefault((n, g), Counter())[lang] += k
    out = {}
    for kind in range(6):
        held = {("w", w): c for w, c in words.items()} if kind == 0 else {
            g: c for g, c in grams.items() if g[0] == kind}
        for lang in langs:
            total = sum(c[lang] for c in held.values()) + li.SMOOTHING * len(held)
            for key, c in held.items():
                out.setdefault(key, []).append(np.log((c[lang] + li.SMOOTHING) / total))
    return out


def test_training_counts_and_both_forms(spark, make_docs):
    import random
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 7))) for _ in range(30)) for _ in range(40)]
    langs = [("en", "de", "fr")[i % 3] for i in range(40)]
    docs = make_docs(texts, langs)
    docs = docs.unionByName(docs)  # each once in the sample
    m = li.train(docs)
    assert m.languages == ["de", "en", "fr"]
    brute = brute_model(list(zip(texts, langs)), m.languages)
    assert len(brute) == len(m.words) + len(m.grams)
    for w, i in m.words.items():
        assert np.allclose(m.word_table[i], brute["w", w])
    for g, i in m.grams.items():
        assert np.allclose(m.gram_table[i], brute[len(g), g])
    asked = make_docs([*texts[:5], "abc zzz", "zzz", "yyy xa", None, "12", texts[0]]).selectExpr("*", "1 AS x")
    table = li.train(docs, model_bytes=0)
    assert isinstance(table, li.TableModel)
    both = [{(r.doc_id, r.lang, r.x): (r.p, round(r.s, 9)) for r in li.identify(asked, t, "p", "s").collect()}
            for t in (m, table)]
    assert both[0] == both[1] and len(both[0]) == 11


def test_hot_and_null_ids_are_sampled_evenly(spark):
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"word{'abcdefghij'[i % 10]} common {'x' * (i % 997)}", "en")
            for i in range(6_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    m = li.train(docs, sample_docs=600)
    met = sum(1 for w in m.words if set(w) == {"x"})
    assert 250 < met < 700  # of 996 lengths; neither all nor none of a hot id
