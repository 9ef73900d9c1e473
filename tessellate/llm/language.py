"""Language identification by words first, character n-grams second.

A text's score for a language is the sum, over its words, of the word's log
frequency in that language. A word that the model doesn't know is scored by its
character n-grams instead, the longest of which any is known, from five letters
down to one. The model is fitted to at most `sample` rows of known language; its
tables have at most `vocabulary` words and `grams` n-grams, and are broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, modest_batches, staged

LONGEST = 5
#: Letters of a word whose n-grams are taken at a time.
PIECE = 64
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")


def held_out(key: str = "doc_id") -> Column:
    """Whether crc32 of a row's id as text is a multiple of 5."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


@dataclass
class LanguageModel:
    """Languages in order, and for each word and n-gram (which begins with a tab) its
    log frequencies in them."""

    languages: list[str]
    tables: dict[str, np.ndarray]


def _log_frequencies(counts: DataFrame, languages: list[str], term: str, most: int) -> dict[str, np.ndarray]:
    """Of counts (lang, term, n): the most frequent terms, with the logs of their
    shares in each language, half a count added."""
    wide = counts.groupBy(term).agg(F.sum("n").alias("n"), *[F.sum(F.when(F.col("lang") == x, F.col("n")).otherwise(0)).alias(f"l{k}") for k, x in enumerate(languages)])
    totals = np.array(counts.agg(*[F.sum(F.when(F.col("lang") == x, F.col("n")).otherwise(0)) for x in languages]).first(), float)
    top = wide.orderBy(F.desc("n"), term).limit(most)
    found = top.select(term, F.array(*[F.col(f"l{k}").cast("double") for k in range(len(languages))]).alias("c")).toPandas()
    if not len(found):
        return {}
    logs = np.log(np.vstack(found["c"]) + 0.5) - np.log(totals + 0.5 * len(found))
    return dict(zip(found[term], logs, strict=True))


def fit_language(docs: DataFrame, sample: int = 20_000, vocabulary: int = 100_000, grams: int = 200_000) -> LanguageModel:
    """Fits on docs (doc_id, text, lang): of the rows that are not held out and have
    a text and a language, the first `sample` by a hash of their id; of their words and
    n-grams, the `vocabulary` and `grams` most frequent ones are kept."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").where(~held_out()).where("doc_id IS NOT NULL AND lang IS NOT NULL")
    rows = bounded_sample(rows.where("text IS NOT NULL"), "doc_id", sample, rows.count())
    words = rows.select("lang", F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word")).where("word <> ''")
    counts = staged(words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")))
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    if not languages:
        return LanguageModel([], {})
    size = F.char_length("w")
    spans = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(LONGEST)), lambda k: F.when(k <= size, F.transform(F.sequence(F.lit(1), size - k + 1), lambda i: F.concat(F.lit("\t"), F.substring(F.col("w"), i, k)))).otherwise(F.array().cast("array<string>"))))
    # a word's ends count as letters; long words go in pieces that share what a gram needs
    ended = counts.select("lang", "n", F.concat(F.lit("<"), "word", F.lit(">")).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.char_length("w") - (LONGEST - 1), F.lit(1)), F.lit(PIECE - LONGEST + 1))
    cut = ended.select("lang", "n", F.explode(F.transform(starts, lambda i: F.substring(F.col("w"), i, F.lit(PIECE)))).alias("w"))
    pieces = cut.select("lang", "n", F.explode(spans).alias("gram"))
    gram_counts = staged(pieces.groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    tables = _log_frequencies(counts, languages, "word", vocabulary)
    tables |= _log_frequencies(gram_counts, languages, "gram", grams)
    return LanguageModel(languages, tables)


class _Words(dict):
    """The row of a word in a growing matrix of scores; forgets what it has worked
    out beyond the model when that gets too much."""

    def __init__(self, model: LanguageModel, most: int = 300_000):
        self.tables, self.width, self.most = model.tables, len(model.languages), most
        self.words = {w: v for w, v in model.tables.items() if w[0] != "\t"}
        self._reset()

    def _reset(self) -> None:
        self.clear()
        self.rows = np.zeros((len(self.words) + self.most, self.width))
        for k, (w, v) in enumerate(self.words.items()):
            dict.__setitem__(self, w, k)
            self.rows[k] = v

    def backed_off(self, word: str) -> np.ndarray:
        w = f"<{word}>"
        for n in range(min(LONGEST, len(w)), 0, -1):
            known = [v for i in range(len(w) - n + 1) if (v := self.tables.get("\t" + w[i : i + n])) is not None]
            if known:
                return np.mean(known, axis=0)
        return np.zeros(self.width)

    def __missing__(self, word: str) -> int:
        k = len(self)
        self.rows[k] = self.backed_off(word)
        self[word] = k
        return k

    def score(self, words: list[str]) -> np.ndarray:
        if len(self) + len(words) > len(self.rows):
            if len(words) > self.most:
                half = len(words) // 2
                return self.score(words[:half]) + self.score(words[half:])
            self._reset()
        return self.rows[[self[w] for w in words]].sum(axis=0)


def _predicting(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = LanguageModel(*model.value)
        table = _Words(m) if m.languages else None
        for b in batches:
            names, scores = [], []
            for text in b.column(2):
                words = _WORD.findall(text.as_py().lower()) if text.is_valid else []
                if table is None or not any(map(str.isalpha, words)) and not any(c.isalpha() for w in words for c in w):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                total = table.score(words)
                best = int(total.argmax())
                names.append(m.languages[best])
                scores.append(float(1 / np.exp(np.clip(total - total[best], -700, 0)).sum()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify_language(docs: DataFrame, sample: int = 20_000) -> DataFrame:
    """A row for each row of docs, by a model fitted to at most `sample` of them
    (see fit_language): doc_id, held_out (crc32 of its id as text is a
    multiple of 5), lang_pred and score, the posterior of lang_pred under equal
    priors.

    Null text, and text without a letter, is `und` with score 0; so is every row
    where no row could teach. A row without doc_id is predicted, is not held out and
    teaches nothing. Ties go to the language that sorts first. Repeated rows are each
    predicted; an empty table gives an empty result; other columns, whatever their
    names, are ignored."""
    modest_batches(docs.sparkSession)
    fitted = fit_language(docs, sample)
    model = docs.sparkSession.sparkContext.broadcast((fitted.languages, fitted.tables))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(_predicting(model), "doc_id long, held_out boolean, lang_pred string, score double")
