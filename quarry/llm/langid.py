"""Language identification: words first, then shorter and shorter n-grams.

A text's words are its runs of letters in lower case. A word of the model is
scored by its log frequency in each language. A word the model does not hold is
scored by its character n-grams (the word between ``^`` and ``$``) of the
greatest length, 5 down to 1, of which the model holds any: the mean of their
log frequencies. A text's score for a language is the sum over its words; the
largest wins, and its softmax share is the score.

Learning uses a documented, bounded sample, about ``sample_docs`` documents per
language by the hash of doc_id and text, each distinct pair once. All words and
n-grams of the sample are the model. Where they take at most ``MODEL_BYTES``, the
model is broadcast (``Model``); a larger one stays a table, and words, n-grams
and scores are joined to it (``TableModel``). Both give the same predictions.

Long texts are read in pieces of about ``PIECE`` characters, cut between words, and
long words in pieces of their n-grams, so memory doesn't grow with a text.

Defined cases: a text that is null or has no letter (digits and number signs
such as a raised 2 are none) is ``und`` with score 0, as is every text when nothing
was learned; ties go to the language that sorts first; rows without doc_id are
sampled by their texts; repeated documents are judged one by one; other columns
pass through."""

from __future__ import annotations

import re
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import bounded, free_name, materialise, slices, text_batches

SAMPLE_DOCS = 1_500
MODEL_BYTES = 256 << 20
MAX_GRAM = 5
SMOOTHING = 0.1
UNKNOWN = "und"
PIECE = 1 << 20
_KNOWN_WORDS = 600_000
_GROUP_WORDS = 100_000
_ITEM_BYTES = 150  # a word or n-gram in a worker, beside its characters
_WORD = re.compile(r"[^\W\d_]+")
_BREAK = re.compile(r"[\W\d_]")


def words_of(text: str) -> list[str]:
    found = _WORD.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    # numbers that aren't decimal digits end a word
    return [w for f in found for w in "".join(c if c.isalpha() else " " for c in f).split()]


def pieces(text: str | None, size: int | None = None):
    """``text`` in parts of about ``size`` characters that cut no word."""
    at, size = 0, size or PIECE
    while text and at < len(text):
        cut = _BREAK.search(text, at + size) if at + size < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def grams_of(word: str, n: int, first: int = 0, last: int | None = None) -> list[str]:
    """The n-grams of ``word`` that begin at places ``first`` to ``last``."""
    w = f"^{word}$"
    return [w[i:i + n] for i in range(first, min(len(w) - n + 1, last or len(w)))]


class Model:
    """Log frequencies per language: tables with a row per word and per n-gram,
    and the rows' numbers."""

    def __init__(self, languages: list[str], words: dict[str, int], word_table: np.ndarray,
                 grams: dict[str, int], gram_table: np.ndarray):
        self.languages = languages
        self.words, self.word_table = words, word_table
        self.grams, self.gram_table = grams, gram_table

    def vector(self, word: str) -> np.ndarray:
        return self.vectors([word])[0]

    def _held(self, word: str):
        """Rows of the longest known n-grams of ``word``, in parts."""
        for n in range(MAX_GRAM, 0, -1):
            any_held = False
            for at in range(0, len(word) + 2, PIECE):
                held = [g for g in map(self.grams.get, grams_of(word, n, at, at + PIECE)) if g is not None]
                if held:
                    any_held = True
                    yield held
            if any_held:
                return

    def vectors(self, words: list[str]) -> np.ndarray:
        """Log frequencies of each word; of words it doesn't hold the mean of
        their n-grams, of words without any known one 0."""
        out = np.zeros((len(words), len(self.languages)))
        known = [(i, self.words[w]) for i, w in enumerate(words) if w in self.words]
        if known:
            at, rows = zip(*known)
            out[list(at)] = self.word_table[list(rows)]
        flat, owner, sizes, get = [], [], [], self.grams.get

        def add():
            if flat:
                starts = np.cumsum(sizes) - sizes
                np.add.at(out, owner, np.add.reduceat(self.gram_table[flat], starts, axis=0))
            flat.clear(), owner.clear(), sizes.clear()

        counts = np.ones(len(words))
        for i, w in enumerate(words):
            if w in self.words:
                continue
            framed = f"^{w}$"
            if len(w) > PIECE:
                parts = list(self._held(w))
            else:
                for n in range(MAX_GRAM, 0, -1):
                    held = [g for k in range(len(framed) - n + 1) if (g := get(framed[k:k + n])) is not None]
                    if held:
                        break
                parts = [held] if held else []
            for held in parts:
                flat += held
                owner.append(i)
                sizes.append(len(held))
            counts[i] = sum(map(len, parts)) or 1
            if len(flat) > PIECE:
                add()
        add()
        return out / counts[:, None]


class Scorer:
    """Scores texts; remembers the vectors of words it has met (bounded)."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.table = np.zeros((1 << 16, len(self.model.languages)))

    def _learn(self, words: list[str]) -> None:
        new = [w for w in dict.fromkeys(words) if w not in self.place]
        if len(self.place) + len(new) > _KNOWN_WORDS:
            self.forget()
            new = list(dict.fromkeys(words))
        first, need = len(self.place), len(self.place) + len(new)
        if need > len(self.table):
            grown = np.zeros((max(need, 2 * len(self.table)), self.table.shape[1]))
            grown[:len(self.table)] = self.table
            self.table = grown
        self.table[first:need] = self.model.vectors(new)
        self.place.update(zip(new, range(first, need)))

    def _totals(self, counters: list[Counter]) -> np.ndarray:
        """Sums of the words' vectors of each of some texts, none of them empty."""
        words = list(chain.from_iterable(counters))
        try:
            at = list(map(self.place.__getitem__, words))
        except KeyError:
            self._learn(words)
            at = list(map(self.place.__getitem__, words))
        n = np.fromiter(chain.from_iterable(c.values() for c in counters), np.float64, len(words))
        sizes = [len(c) for c in counters]
        return np.add.reduceat(self.table[at] * n[:, None], np.cumsum(sizes) - sizes, axis=0)

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.predict_all([text])[0]

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score of each text; words of many texts are looked up at once."""
        total = np.zeros((len(texts), len(self.model.languages)))
        met, group, owner, size = np.zeros(len(texts), bool), [], [], 0
        for i, text in enumerate(texts if self.model.languages else ()):
            for piece in pieces(text):
                words = Counter(words_of(piece))
                if words:
                    group.append(words)
                    owner.append(i)
                    size += len(words)
                if size > _GROUP_WORDS:
                    np.add.at(total, owner, self._totals(group))
                    met[owner] = True
                    group, owner, size = [], [], 0
        if group:
            np.add.at(total, owner, self._totals(group))
            met[owner] = True
        out = [(UNKNOWN, 0.0)] * len(texts)
        best = total.argmax(axis=1) if total.size else np.zeros(len(texts), int)
        for i in np.flatnonzero(met).tolist():
            share = 1 / np.exp(total[i] - total[i, best[i]]).sum()
            out[i] = self.model.languages[best[i]], float(share)
        return out


def _counts(docs: DataFrame) -> DataFrame:
    """(lang, kind, item, n): words (kind 0) and n-grams of words (kind = n)."""
    def run(batches):
        for b in slices(batches):
            by_lang: dict[str, Counter] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for piece in pieces(text):
                    by_lang.setdefault(lang, Counter()).update(words_of(piece))
            for lang, c in by_lang.items():
                yield from _rows([(lang, 0, w, k) for w, k in c.items()])
                grams = Counter()
                for w, k in c.items():
                    for n in range(1, MAX_GRAM + 1):
                        for at in range(0, len(w) + 2, PIECE):
                            for g in grams_of(w, n, at, at + PIECE):
                                grams[(n, g)] += k
                yield from _rows([(lang, n, g, k) for (n, g), k in grams.items()])

    def _rows(out, most=50_000):
        for i in range(0, len(out), most):
            cols = list(zip(*out[i:i + most]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()),
                 pa.array(cols[2], pa.string()), pa.array(cols[3], pa.int64())],
                names=["lang", "kind", "item", "n"])

    return (text_batches(docs).mapInArrow(run, "lang string, kind int, item string, n long")
            .groupBy("lang", "kind", "item").agg(F.sum("n").alias("n")))


class TableModel:
    """A model too large to broadcast: tables ``languages`` (lang, i), ``parts``
    (kind, item, i, part: log frequency above that of an unmet item), ``base``
    (kind, bases by i: log frequencies of unmet items)."""

    def __init__(self, languages: list[str], parts: DataFrame, base: DataFrame):
        self.languages, self.parts, self.base = languages, parts, base


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, model_bytes: int = MODEL_BYTES) -> Model | TableModel:
    """A model from ``docs`` (doc_id, text, lang); pass only rows to learn from."""
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select(
        F.col("lang").cast("string").alias("lang"), F.xxhash64("doc_id", "text").alias("k"), "text")
    sizes = materialise(known.groupBy("lang").agg(F.count("*").alias("docs")), "language-sizes")
    share = F.pmod(F.xxhash64("k"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = (known.join(bounded(sizes), "lang").where(share * F.col("docs") < sample_docs)
            .dropDuplicates(["lang", "k"]).select("lang", "text"))
    counts = materialise(_counts(some), "language-counts")
    items = counts.groupBy("kind", "item").agg(F.lit(1).alias("one"))
    n_items, chars = items.agg(F.count("*"), F.sum(F.octet_length("item"))).first()
    languages = sorted(r.lang for r in sizes.select("lang").toLocalIterator())
    sums = (counts.groupBy("kind", "lang").agg(F.sum("n").alias("total"))
            .join(items.groupBy("kind").agg(F.count("*").alias("items")), "kind"))
    if n_items * (_ITEM_BYTES + 8 * len(languages)) + (chars or 0) > model_bytes:
        return _table_model(counts, sums, languages)
    place = {lang: i for i, lang in enumerate(languages)}
    base = {k: np.full(len(languages), np.nan) for k in range(MAX_GRAM + 1)}
    for kind, lang, total, n in sums.select("kind", "lang", "total", "items").collect():
        base[kind][place[lang]] = np.log(total + SMOOTHING * n)
        base[kind][np.isnan(base[kind])] = np.log(SMOOTHING * n)
    tables = []
    for wanted in (F.col("kind") == 0, F.col("kind") > 0):
        rows = counts.where(wanted).select("item", "lang", "n", "kind").toArrow()
        number: dict[str, int] = {}
        at = [number.setdefault(x, len(number)) for x in rows.column("item").to_pylist()]
        table = np.full((len(number), len(languages)), SMOOTHING)
        table[at, [place[x] for x in rows.column("lang").to_pylist()]] += rows.column("n").to_numpy()
        table = np.log(table)
        kind = np.zeros(len(number), int)
        kind[at] = rows.column("kind").to_numpy()
        for k in np.unique(kind):
            table[kind == k] -= base[k]
        tables += [number, table]
    return Model(languages, *tables)


def _table_model(counts: DataFrame, sums: DataFrame, languages: list[str]) -> TableModel:
    spark = counts.sparkSession
    number = bounded(materialise(spark.createDataFrame(
        list(enumerate(languages)), "i int, lang string"), "languages"))
    parts = counts.join(number, "lang").select(
        "kind", "item", "i", F.log((F.col("n") + SMOOTHING) / SMOOTHING).alias("part"))
    totals = sums.join(number, "lang").groupBy("kind").agg(
        F.max("items").alias("items"), F.map_from_entries(F.collect_list(F.struct("i", "total"))).alias("t"))
    every = F.sequence(F.lit(0), F.lit(len(languages) - 1))
    base = totals.select("kind", F.transform(every, lambda i: F.log(
        F.lit(SMOOTHING) / (F.coalesce(F.try_element_at("t", i), F.lit(0)) + SMOOTHING * F.col("items")))).alias("base"))
    return TableModel(languages, materialise(parts, "language-parts"), materialise(base, "language-bases"))


def _identify_by_join(docs: DataFrame, model: TableModel, lang: str, score: str) -> DataFrame:
    """``docs`` with prediction and score, by joins on words and n-grams."""
    h1, h2 = free_name(docs, "_h1"), free_name(docs, "_h2")

    def run(batches):
        for b in slices(batches):
            for text, x, y in zip(*(b.column(i).to_pylist() for i in range(3))):
                for piece in pieces(text):
                    c = Counter(words_of(piece))
                    yield pa.RecordBatch.from_pydict({"x": [x] * len(c), "y": [y] * len(c),
                                                      "word": list(c), "n": list(c.values())},
                                                     schema=pa.schema([("x", pa.int64()), ("y", pa.int64()),
                                                                       ("word", pa.string()), ("n", pa.int64())]))

    keyed = docs.withColumn(h1, F.xxhash64("text")).withColumn(h2, F.xxhash64(F.lit(1), "text"))
    texts = keyed.where("text IS NOT NULL").select("text", F.col(h1).alias("x"), F.col(h2).alias("y"))
    # copies of a text are read once
    words = text_batches(texts.dropDuplicates(["x", "y"])).mapInArrow(run, "x long, y long, word string, n long")
    words = materialise(words.groupBy("x", "y", "word").agg(F.sum("n").alias("n")), "language-words")
    vocabulary = words.select("word").distinct()
    whole = model.parts.where("kind = 0").select(F.col("item").alias("word")).distinct()
    framed = F.concat(F.lit("^"), F.col("word"), F.lit("$"))

    def of_length(n):
        starts = F.sequence(F.lit(1), F.greatest(F.length(framed) - n + 1, F.lit(1)))
        return F.transform(starts, lambda i: F.struct(
            F.lit(n).alias("kind"), framed.substr(i, F.lit(n)).alias("item")))

    grams = F.flatten(F.array(*map(of_length, range(1, MAX_GRAM + 1))))
    items = model.parts.select("kind", "item").distinct()
    held = (vocabulary.join(whole, "word", "left_anti").select("word", F.inline(grams))
            .where(F.length("item") == F.col("kind")).groupBy("word", "kind", "item").agg(F.count("*").alias("k"))
            .join(items, ["kind", "item"]))
    longest = held.groupBy("word").agg(F.max("kind").alias("kind"))
    held = held.join(longest, ["word", "kind"])
    size = held.groupBy("word").agg(F.sum("k").alias("of"))
    held = held.join(size, "word").select("word", "kind", "item", (F.col("k") / F.col("of")).alias("w"))
    used = materialise(held.unionByName(vocabulary.join(whole, "word", "left_semi").select(
        "word", F.lit(0).alias("kind"), F.col("word").alias("item"), F.lit(1.0).alias("w"))), "language-used")
    worth = used.join(model.parts, ["kind", "item"]).groupBy("word", "i").agg(
        F.sum(F.col("w") * F.col("part")).alias("part"))
    kinds = used.groupBy("word").agg(F.max("kind").alias("kind"))
    text = ["x", "y"]
    above = (words.join(worth, "word").groupBy(*text, "i").agg(F.sum(F.col("n") * F.col("part")).alias("s"))
             .groupBy(*text).agg(F.map_from_entries(F.collect_list(F.struct("i", "s"))).alias("above")))
    unmet = (words.join(kinds, "word", "left").groupBy(*text, "kind").agg(F.sum("n").alias("n"))
             .join(F.broadcast(model.base), "kind", "left")
             .groupBy(*text).agg(F.collect_list(F.struct("n", "base")).alias("unmet")))
    every = F.sequence(F.lit(0), F.lit(len(model.languages) - 1))
    total = F.transform(every, lambda i: F.coalesce(F.try_element_at("above", i), F.lit(0.0)) + F.aggregate(
        "unmet", F.lit(0.0), lambda acc, u: acc + F.coalesce(u["n"] * F.get(u["base"], i), F.lit(0.0))))
    found = unmet.join(above, text, "left").select(*text, total.alias("total"))
    best = F.array_max("total")
    names = F.array(*map(F.lit, model.languages))
    found = found.select(
        F.col("x").alias(h1), F.col("y").alias(h2),
        F.get(names, (F.array_position("total", best) - 1).cast("int")).alias(lang),
        (1 / F.aggregate("total", F.lit(0.0), lambda acc, t: acc + F.exp(t - best))).alias(score))
    found = bounded(materialise(found, "language-predictions"))
    return (keyed.join(found, [h1, h2], "left").drop(h1, h2)
            .fillna({lang: UNKNOWN, score: 0.0}))


def identify(docs: DataFrame, model: Model | TableModel, lang: str = "lang_pred", score: str = "score",
             keep_text: bool = True) -> DataFrame:
    """``docs`` with the predicted language of each whole text and its score."""
    if isinstance(model, TableModel):
        out = _identify_by_join(docs, model, lang, score)
        return out if keep_text else out.drop("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [f for f in docs.schema.fields if keep_text or f.name != "text"]

    def run(batches):
        scorer = Scorer(shared.value)
        for b in slices(batches):
            got = scorer.predict_all(b.column(b.schema.get_field_index("text")).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index(f.name)) for f in keep]
                + [pa.array([g[0] for g in got], pa.string()),
                   pa.array([g[1] for g in got], pa.float64())],
                names=[f.name for f in keep] + [lang, score])

    return text_batches(docs).mapInArrow(run, T.StructType(
        [*keep, T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())]))
