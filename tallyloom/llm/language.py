"""Languages of documents and of the segments of mixed ones.

Word-first backoff: a known word scores by its logarithmic frequency in each language; an unseen one by the letter
n-grams it is made of, longest known first. The model is fitted on a bounded sample of labelled documents (PER_LANGUAGE
for each label, taken by hash) and refitted on those of their sentences that it gives the language of their label, so
that wrong labels and mixed documents wash out. Sentences are then scored one by one over whole texts.
"""

from __future__ import annotations

import functools
import pickle
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The languages, with their codes of two and three letters and English names.
LANGUAGES = ("en", "hi", "ur", "es", "pt", "fr", "de", "id")
SPELLINGS = {
    "en": "en", "eng": "en", "english": "en",
    "hi": "hi", "hin": "hi", "hindi": "hi",
    "ur": "ur", "urd": "ur", "urdu": "ur",
    "es": "es", "spa": "es", "spanish": "es", "castilian": "es",
    "pt": "pt", "por": "pt", "portuguese": "pt",
    "fr": "fr", "fra": "fr", "fre": "fr", "french": "fr",
    "de": "de", "deu": "de", "ger": "de", "german": "de",
    "id": "id", "ind": "id", "indonesian": "id",
}

#: Documents per label that the model is fitted on, the characters of the longest of them, words and n-grams that it keeps
#: per language. With these bounds the training texts fit the driver.
PER_LANGUAGE = 300
LONGEST_TRAINING = 20_000
MAX_WORDS = 30_000
MAX_GRAMS = 30_000
NGRAM = 5
#: A segment is a sentence from so many words on, if at least this share of them is supported in its language, and counts
#: for the languages present from this confidence on. A known word is supported where it occurs, an unseen one by the share
#: of its places whose longest known n-gram has LONG_GRAM letters and occurs in the language.
LEAST_WORDS = 4
LEAST_SUPPORT = 0.3
LONG_GRAM = 4
LEAST_CONFIDENCE = 0.8
#: The score of words in a language without any labelled text.
ABSENT = -8.0

_LINK = regex.compile(r"(?:https?://|www\.)\S+|\S+@\S+\.\S+|[#@]\w+|<[^<>\s]{1,80}>", regex.I)
_QUOTED = regex.compile(r"“([^“”\n]*)”|«([^«»\n]*)»|„([^„“”\n]*)[“”]|\"([^\"\n]*)\"|‘([^‘’\n]*)’(?!\w)")
_END = re.compile("[.!?\u3002\u2026][\"\u201d\u00bb\u2019)\\]]*\\s+|[\u0964\u06d4\u061f][\"\u201d\u00bb\u2019)\\]]*\\s*|[\r\n\x0b\x0c\x85\u2028\u2029]+|\\s(?:[/|;*\u2014\u2013\u2022\u00b7]|--+)\\s")
_QUOTES = re.compile("[\"\u201c\u201d\u201e\u00ab\u2018]")
_LINKED = re.compile("[/@#<]|www\\.")
_EDGE = regex.compile(r"^[^\p{L}\p{M}\p{N}]+|[^\p{L}\p{M}\p{N}]+$")
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*(?:[’'\-]\p{L}[\p{L}\p{M}]*)*")


def label_code(c: Column) -> Column:
    """The language that a label denotes, null for missing, unknown and other ones.

    Letter case, blanks, region and script suffixes (en-IN, pt_BR) don't count; known are the spellings in SPELLINGS.
    """
    head = F.regexp_extract(F.lower(F.regexp_replace(c, r"^[\s ]+|[\s ]+$", "")), r"^([a-z]+)(?:[\s_\-.@(].*)?$", 1)
    pairs = [x for k, v in SPELLINGS.items() for x in (F.lit(k), F.lit(v))]
    return F.try_element_at(F.create_map(*pairs), head)


def _quotation(m: regex.Match) -> str:
    """A quoted sentence stays, as one of its own; quoted words go."""
    inner = next((x for x in m.groups() if x is not None), "")
    return f"\n{inner}\n" if len(inner.split()) > LEAST_WORDS else " "


def sentences(text: str) -> list[str]:
    """The pieces of a text between ends of sentences, line ends, separators and the borders of quoted sentences.

    Links, tags, addresses and quotations of up to LEAST_WORDS words are taken out.
    """
    if _LINKED.search(text):
        text = _LINK.sub(" ", text)
    if _QUOTES.search(text):
        text = _QUOTED.sub(_quotation, text)
    return [s for s in _END.split(text) if s and not s.isspace()]


@functools.lru_cache(maxsize=200_000)
def word(token: str) -> str:
    """The word of a token between blanks: lower case, without what surrounds it; '' for tokens with digits or without letters."""
    core = _EDGE.sub("", unicodedata.normalize("NFC", token).lower())
    return core if _WORD.fullmatch(core) else ""


def words(sentence: str) -> list[str]:
    return [w for t in sentence.split() if (w := word(t))]


class Model:
    """Scores of words in each language."""

    def __init__(self, counted: dict[str, Counter]) -> None:
        n = len(LANGUAGES)
        self.totals = np.array([sum(counted[x].values()) for x in LANGUAGES], float)
        self.words: dict[str, np.ndarray] = {}
        grams: list[dict[str, np.ndarray]] = [{} for _ in range(NGRAM + 1)]
        seen: dict[str, np.ndarray] = {}
        for i, x in enumerate(LANGUAGES):
            for w, c in counted[x].most_common(MAX_WORDS):
                seen.setdefault(w, np.zeros(n))[i] = c
        for w, c in seen.items():
            if c.sum() >= 2:
                self.words[w] = np.log((c + 0.1) / (self.totals + 0.1 * len(seen))).astype(np.float32)
        self.there = self.totals > 0
        self.rare = np.log(0.6 / (self.totals + 0.1 * max(len(seen), 1))).astype(np.float32)  # between none and one
        for w, c in seen.items():
            padded = f"^{w}$"
            for k in range(1, NGRAM + 1):
                for j in range(len(padded) - k + 1):
                    g = grams[k].setdefault(padded[j : j + k], np.zeros(n))
                    g += np.log1p(c)
        self.grams: list[dict[str, np.ndarray]] = [{}]
        self.absent: list[np.ndarray] = [np.zeros(n)]  # the score of an n-gram in a language without it
        for k in range(1, NGRAM + 1):
            total = sum(grams[k].values(), np.zeros(n)) + 1.0
            keep = sorted(grams[k].items(), key=lambda x: (-x[1].sum(), x[0]))[:MAX_GRAMS]
            self.grams.append({g: np.log((c + 0.2) / (total + 0.2 * len(keep))).astype(np.float32) for g, c in keep})
            self.absent.append(np.log(0.2 / (total + 0.2 * len(keep))).astype(np.float32) + 1e-3)

    def unseen(self, word: str) -> tuple[np.ndarray, np.ndarray]:
        """(scores, support): the mean over the longest known n-grams at each place of the word, weighed less than a known
        word, and the share of the places with a long one of the language."""
        padded = f"^{word}$"
        total, n, long_ = np.zeros(len(LANGUAGES), np.float32), 0, np.zeros(len(LANGUAGES), np.float32)
        places = max(len(padded) - LONG_GRAM + 1, 1)
        for at in range(len(padded)):
            for k in range(min(NGRAM, len(padded) - at), 0, -1):
                s = self.grams[k].get(padded[at : at + k])
                if s is not None:
                    total += s - s.mean()
                    n += 1
                    if k >= LONG_GRAM:
                        long_ += s > self.absent[k]
                    break
        return 0.5 * total / max(n, 1) ** 0.5, long_ / places


class Scorer(dict):
    """Places of tokens in the table of scores, filled as tokens turn up; place 0 is for tokens that are no words."""

    KEEP = 400_000

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.model = model
        self.clear()

    def clear(self) -> None:
        super().clear()
        n = len(LANGUAGES)
        self.table = np.zeros((4096, 2 * n + 1), np.float32)  # scores, support in the language, is a word
        self.used = 1

    def __missing__(self, token: str) -> int:
        w = word(token)
        if not w:
            self[token] = 0
            return 0
        at, n = self.used, len(LANGUAGES)
        if at >= len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        known = self.model.words.get(w)
        s, support = self.model.unseen(w) if known is None else (known - known[self.model.there].mean(), known > self.model.rare)
        self.table[at, :n] = np.where(self.model.there, np.clip(s, -8, 8), ABSENT)
        self.table[at, n : 2 * n] = support
        self.table[at, 2 * n] = 1
        self[token] = at
        self.used += 1
        return at

    def score(self, segments: list[str]) -> np.ndarray:
        """For each segment: the sums of scores by language, of support by language, and the number of words."""
        if self.used > self.KEEP:
            self.clear()
        flat: list[int] = []
        starts = np.zeros(len(segments), np.int64)
        for i, s in enumerate(segments):
            starts[i] = len(flat)
            flat += map(self.__getitem__, s.split())
            if len(flat) == starts[i]:
                flat.append(0)
        return np.add.reduceat(self.table[flat], starts, axis=0, dtype=np.float64) if segments else np.zeros((0, self.table.shape[1]))


def judge(scored: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(language, -1 for no sentence; confidence; words) of scored segments.

    The evidence of n words counts as that of their square root, as the words of a sentence depend on one another.
    """
    n = len(LANGUAGES)
    count = scored[:, 2 * n]
    x = scored[:, :n] / np.sqrt(np.maximum(count, 1))[:, None]
    e = np.exp(x - x.max(axis=1, keepdims=True))
    best = x.argmax(axis=1)
    sure = e.max(axis=1) / e.sum(axis=1)
    support = np.take_along_axis(scored[:, n : 2 * n], best[:, None], axis=1)[:, 0]
    return np.where((count >= LEAST_WORDS) & (support >= LEAST_SUPPORT * count), best, -1), sure, count


def fit(labelled: list[tuple[str, str]], rounds: int = 2) -> Model:
    """The model of (text, language) pairs."""
    pairs = [(lang, s, t) for text, lang in labelled for s in sentences(text) if len(t := words(s)) >= LEAST_WORDS]
    counted: dict[str, Counter] = {x: Counter() for x in LANGUAGES}
    for lang, _, t in pairs:
        counted[lang].update(t)
    model = Model(counted)
    for _ in range(rounds if pairs else 0):
        best, _, _ = judge(Scorer(model).score([s for _, s, _ in pairs]))
        counted = {x: Counter() for x in LANGUAGES}
        for (lang, _, t), b in zip(pairs, best, strict=True):
            if b >= 0 and LANGUAGES[b] == lang:
                counted[lang].update(t)
        model = Model(counted)
    return model


def training_sample(df: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "lang", per_language: int = PER_LANGUAGE, longest: int = LONGEST_TRAINING) -> list[tuple[str, str]]:
    """(text, language) of up to ``per_language`` documents for each label, those with the least hashes of their keys and
    texts among the texts of at most ``longest`` characters.

    The hashes are ranked first, without their texts; the texts of those chosen are then read in a second scan.
    """
    rows = df.select(F.xxhash64(F.col(key), F.col(text)).alias("h"), F.col(text).alias("t"), label_code(F.col(label)).alias("l")).where(F.col("l").isNotNull() & F.length("t").between(1, longest))
    first = F.row_number().over(Window.partitionBy("l").orderBy("h"))
    chosen = rows.select("l", "h").withColumn("_r", first).where(F.col("_r") <= per_language).select("l", "h").collect()  # bounded by labels x per_language
    if not chosen:
        return []
    texts = rows.where(F.col("h").isin(sorted({r.h for r in chosen}))).groupBy("l", "h").agg(F.first("t").alias("t"))
    asked = {(r.l, r.h) for r in chosen}
    return [(r.t, r.l) for r in sorted(texts.collect(), key=lambda r: (r.l, r.h)) if (r.l, r.h) in asked]


_OUT = "lang string, confidence double, langs array<string>, n_sentences int, segments array<struct<segment:int,lang:string,confidence:double,first_sentence:int,n_sentences:int,n_words:int>>"


@functools.lru_cache(maxsize=4)
def _scorer(pickled: bytes) -> Scorer:
    return Scorer(pickle.loads(pickled))


def _describe(best: np.ndarray, sure: np.ndarray, count: np.ndarray) -> tuple:
    """The row of a document from its segments."""
    own = np.flatnonzero(best >= 0)
    if not len(own):
        return None, None, [], 0, []
    parts: list[list] = []
    for i, j in enumerate(own):
        lang, c, n = LANGUAGES[best[j]], float(sure[j]), int(count[j])
        if parts and parts[-1][1] == lang:
            p = parts[-1]
            p[2] += c * n
            p[4] += 1
            p[5] += n
        else:
            parts.append([len(parts), lang, c * n, i, 1, n])
    volume: dict[str, float] = {}
    for _, lang, weight, *_ in parts:
        volume[lang] = volume.get(lang, 0.0) + weight
    total = sum(p[5] for p in parts)
    main = min(volume, key=lambda x: (-volume[x], x))
    present = sorted({LANGUAGES[best[j]] for j in own if sure[j] >= LEAST_CONFIDENCE}) or [main]
    return main, volume[main] / total, present, len(own), [(s, lang, w / n, at, m, n) for s, lang, w, at, m, n in parts]


def _portions(texts: list[str | None], most: int = 1_000_000) -> Iterator[list[str | None]]:
    """Whole texts in portions of about ``most`` characters, which bounds the arrays of a batch."""
    part: list[str | None] = []
    size = 0
    for t in texts:
        part.append(t)
        size += len(t or "")
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def identify(spark: SparkSession, df: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "lang", model: Model | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, segments).

    documents: (key, label, code, lang, confidence, langs, n_sentences): the label and the language it denotes, the main
    language by words with the share of its words times their confidence, and all languages with a whole sentence.
    Texts without a sentence, null and empty ones included, have null and no languages. segments: (key, segment, lang,
    confidence, first_sentence, n_sentences, n_words): stretches of sentences in one language, in order. Rows with null
    or repeated keys are kept, an empty table gives none, extra columns are ignored. Without ``model`` one is fitted on
    the labelled documents of ``df`` itself.
    """
    model = model or fit(training_sample(df, key=key, text=text, label=label))
    data = spark.sparkContext.broadcast(pickle.dumps(model))  # at most MAX_WORDS words a language, MAX_GRAMS n-grams a length
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = _scorer(data.value)
        for pdf in batches:
            rows: list[tuple] = []
            for texts in _portions(pdf["t"].tolist()):
                pieces = [sentences(t) if t else [] for t in texts]
                best, sure, count = judge(scorer.score([s for p in pieces for s in p]))
                ends = np.cumsum([0, *map(len, pieces)])
                rows += [_describe(best[a:b], sure[a:b], count[a:b]) for a, b in zip(ends, ends[1:])]
            out = pd.DataFrame(rows, columns=["lang", "confidence", "langs", "n_sentences", "segments"])
            out.insert(0, "l", pdf["l"].to_numpy())
            out.insert(0, "k", pdf["k"].to_numpy())
            yield out

    # the key travels as text: pandas would make floats of whole numbers beside nulls
    told = df.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t"), F.col(label).alias("l")).mapInPandas(run, f"k string, l string, {_OUT}").withColumn("k", F.col("k").cast(kind))
    documents = told.select(F.col("k").alias(key), F.col("l").alias("label"), label_code(F.col("l")).alias("code"), "lang", "confidence", "langs", "n_sentences")
    segments = told.select(F.col("k").alias(key), F.explode("segments").alias("s")).select(key, "s.*")
    return documents, segments


def label_cases(spark: SparkSession, df: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "lang", model: Model | None = None) -> DataFrame:
    """(key, lang): every language of each mixed document, and the language of each other one whose label is missing, unknown or another."""
    documents = identify(spark, df, key=key, text=text, label=label, model=model)[0]
    case = (F.size("langs") > 1) | ((F.size("langs") == 1) & ~F.coalesce(F.col("code") == F.get("langs", F.lit(0)), F.lit(False)))
    return documents.where(case).select(key, F.explode("langs").alias("lang"))
