"""Toxicity scores by weak supervision.

Many voters look at a text: one for each word of a lexicon mined from labelled
training rows, one for each fixed list of insults, and some patterns. A generative
label model, fitted by expectation maximization over all training documents, labelled
or not, estimates how often each voter fires on toxic and on clean texts, and which
voter it depends on: within a class the voters form a tree, the one that explains most
of what they have in common, so that voters that repeat each other count once. Its
posteriors are the labels that a logistic regression learns, mostly those of documents
without a known label; that linear classifier gives the scores.

The label model passes over vote patterns and returns sums of a fixed number of
terms; the classifier is fitted to at most `sample` rows.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, modest_batches, staged, unstage

#: Plain insults of four languages, as any dictionary has them.
INSULTS = (
    ("idiot", "moron", "stupid", "scum", "trash", "loser", "worthless", "pathetic", "disgusting", "clown", "imbecile", "bastard"),
    ("idiotin", "dummkopf", "abschaum", "arschloch", "trottel", "vollidiot", "schwachkopf", "widerlich", "mistkerl", "nichtsnutz"),
    ("imbécile", "connard", "connasse", "salaud", "crétin", "abruti", "ordure", "dégueulasse", "salope", "minable"),
    ("idiota", "imbécil", "estúpido", "estúpida", "basura", "escoria", "asqueroso", "cabrón", "gilipollas", "payaso"),
)
#: Words by which a text addresses its reader, in the same languages.
ADDRESS = frozenset(("you", "your", "du", "dich", "dein", "toi", "ton", "tu", "tú", "eres"))
#: The evidence of a known label, in log odds: about one in fifty is wrong.
GOLD = 4.0
#: Places for mined terms: votes are bits of a long, which the fixed ones share.
MINED = 40
PATTERNS = ("two_hits", "five_hits", "dense", "shouting", "exclaiming", "addressed")
VOTERS = MINED + len(INSULTS) + len(PATTERNS)
FEATURES = VOTERS + 2


def trains(key: str = "doc_id") -> Column:
    """Whether a row may teach: crc32 of its id as text, modulo 3, is not 1."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 != 1, F.lit(False))


def _clean_labels(labels: DataFrame) -> DataFrame:
    """doc_id, toxic (0 or 1), one row each: the larger where rows differ."""
    return labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))


def mine_lexicon(rows: DataFrame, least: int = 5, odds: float = 2.0, terms: int = MINED) -> list[str]:
    """The words and stems, `terms` at most, that set toxic rows (text, toxic) apart. A
    stem, written with a star, is the first 3 to 8 letters of longer words. Support
    is counted in distinct texts, where texts that share their least word hash count
    once, so that copies of one document lend its words no support. Of the terms
    that begin with one another, the longest with the widest support is kept."""
    words = F.filter(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+")), lambda w: F.char_length(w) >= 3)
    seen = rows.select("toxic", words.alias("words")).where(F.size("words") > 0).withColumn("like", F.array_min(F.transform("words", lambda w: F.xxhash64(w))))
    n = {r["toxic"]: r["n"] for r in seen.groupBy("toxic").agg(F.countDistinct("like").alias("n")).collect()}
    if not n.get(1) or not n.get(0):
        return []
    each = seen.select("toxic", "like", F.explode("words").alias("word"))
    stems = F.transform(F.filter(F.sequence(F.lit(3), F.lit(8)), lambda k: k < F.char_length("word")), lambda k: F.concat(F.substring(F.col("word"), F.lit(1), k), F.lit("*")))
    per = each.select("toxic", "like", F.explode(F.array_append(stems, F.col("word"))).alias("term")).distinct()
    per = per.groupBy("term").agg(F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") == 0).alias("c"))
    ratio = F.log((F.col("t") + 0.5) / (n[1] + 1)) - F.log((F.col("c") + 0.5) / (n[0] + 1))
    # rows are a bounded sample, and so are the terms that reach the least support
    best = per.where(F.col("t") >= least).withColumn("odds", ratio).where(F.col("odds") >= odds)
    kept: list[str] = []
    for r in best.orderBy(F.desc("t"), F.desc(F.char_length("term")), F.col("term").endswith("*"), "term").toLocalIterator():
        if len(kept) == terms:
            break
        body = r["term"].rstrip("*")
        if not any(body.startswith(k.rstrip("*")) or k.startswith(body) for k in kept):
            kept.append(r["term"])
    return kept


def _voting(lexicon: list[str]):
    """A pandas UDF: text to the votes as bits, the hits, and the words."""

    @F.pandas_udf("bits long, hits long, words long")
    def vote(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        find = ahocorasick.Automaton()
        terms: dict[str, int] = {}
        for k, w in enumerate(lexicon):
            terms[w] = terms.get(w, 0) | 1 << k
        for k, group in enumerate(INSULTS):
            for w in group:
                terms[w] = terms.get(w, 0) | 1 << (MINED + k)
        for w, bits in terms.items():
            find.add_word(w.rstrip("*"), (bits, len(w.rstrip("*")), w.endswith("*")))
        find.make_automaton()
        first = MINED + len(INSULTS)

        def look(text: str | None) -> tuple[int, int, int]:
            if not text:
                return 0, 0, 0
            low = text.lower()
            bits = hits = 0
            kinds, addressed = set(), False
            for end, (own, size, stem) in find.iter(low):
                start = end - size + 1
                if (start and low[start - 1].isalpha()) or not stem and low[end + 1 : end + 2].isalpha():
                    continue
                bits |= own
                hits += 1
                kinds.add(own)
                if not addressed:
                    addressed = not ADDRESS.isdisjoint(low[max(0, start - 40) : end + 40].split())
            words = 1 + low.count(" ")
            # letters that lower-casing changes are capitals
            upper = 0 if low == text else sum(map(operator.ne, low, text)) if len(low) == len(text) else sum(map(str.isupper, text))
            fired = (len(kinds) >= 2, hits >= 5, hits * 50 >= words and hits > 0, upper * 2 > len(text), text.count("!") * 4 > words, addressed)
            for k, yes in enumerate(fired):
                bits |= yes << (first + k)
            return bits, hits, words

        for texts in batches:
            yield pd.DataFrame([look(t) for t in texts], columns=["bits", "hits", "words"])

    return vote


def _unpacked(bits: np.ndarray) -> np.ndarray:
    return ((bits[:, None] >> np.arange(VOTERS)) & 1).astype(float)


@dataclass
class LabelModel:
    """For each voter the voter it depends on (itself if on none), the log odds of its
    vote by its own and the other's, and its rates of firing on clean and toxic texts;
    and the prior log odds."""

    parents: np.ndarray
    tables: np.ndarray
    prior: float
    rates: np.ndarray

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        code = (2 * votes + votes[:, self.parents]).astype(np.int64)
        return self.prior + self.tables[np.arange(VOTERS), code].sum(axis=1)


def _sums(model: LabelModel):
    """Expected counts of a batch of vote patterns under the present model: by class,
    of patterns, of each voter, and of each pair of voters that fire together."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, VOTERS + 1, VOTERS + 1))
        for f in frames:
            x = _unpacked(f["bits"].to_numpy(np.int64))
            p = 1 / (1 + np.exp(-np.clip(model.log_odds(x) + f["gold"].to_numpy(float), -30, 30)))
            x1 = np.c_[np.ones(len(x)), x]
            for y, w in ((0, (1 - p) * f["n"]), (1, p * f["n"])):
                total[y] += x1.T @ (x1 * np.asarray(w)[:, None])
        flat = total.ravel()
        yield pd.DataFrame({"k": np.arange(len(flat)), "v": flat})

    return run


def _gather(patterns: DataFrame, model: LabelModel) -> np.ndarray:
    rows = patterns.mapInPandas(_sums(model), "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(2 * (VOTERS + 1) ** 2)
    for r in rows:
        out[r["k"]] = r["v"]
    return out.reshape(2, VOTERS + 1, VOTERS + 1)


def _pair_counts(sums: np.ndarray) -> np.ndarray:
    """[class, own vote, other vote, voter, other voter]"""
    n, one = sums[:, :1, :1], sums[:, 1:, :1]
    other, both = sums[:, :1, 1:], sums[:, 1:, 1:]
    return np.clip(np.stack([np.stack([n - one - other + both, other - both], 1), np.stack([one - both, both], 1)], 1), 0, None)


def dependence_tree(sums: np.ndarray, significant: float = 10.0) -> np.ndarray:
    """The voter that each depends on, itself if on none: the spanning forest of most
    mutual information within the classes, both of equal weight. A pair is left out
    if its statistic (twice the information in all texts, about chi squared with a
    degree of freedom for each class) isn't over `significant`."""
    counts = _pair_counts(sums) + 1e-9
    n = counts.sum(axis=(1, 2), keepdims=True)
    share = counts / n
    own, other = share.sum(axis=2, keepdims=True), share.sum(axis=1, keepdims=True)
    information = (share * np.log(share / (own * other))).sum(axis=(1, 2))
    weight = np.where((2 * information * n[:, 0, 0]).sum(axis=0) > significant, information.sum(axis=0), 0.0)
    np.fill_diagonal(weight, 0.0)
    parents = np.arange(VOTERS)
    best, via = weight[0].copy(), np.zeros(VOTERS, np.int64)
    out = np.ones(VOTERS, bool)
    out[0] = False
    while out.any():
        k = int(np.argmax(np.where(out, best, -1.0)))
        if best[k] > 0:
            parents[k] = via[k]
        out[k] = False
        closer = weight[k] > best
        best, via = np.where(closer, weight[k], best), np.where(closer, k, via)
    return parents


def _model(sums: np.ndarray, parents: np.ndarray) -> LabelModel:
    """Rates and tables from expected counts; a voter's rate given another's vote leans
    on its rate in the class with the weight of one text."""
    n = sums[:, 0, 0]
    rates = (sums[:, 1:, 0] + 0.05) / (n[:, None] + 1)
    own = np.stack([1 - rates, rates], axis=1)  # class, vote, voter
    counts = _pair_counts(sums)[..., np.arange(VOTERS), parents]  # class, vote, other vote, voter
    given = (counts + own[:, :, None]) / (counts.sum(axis=1, keepdims=True) + 1)
    given = np.where(parents == np.arange(VOTERS), own[:, :, None], given)
    tables = np.log(given[1] / given[0]).reshape(4, VOTERS).T
    return LabelModel(parents, tables, math.log((n[1] + 0.5) / (n[0] + 0.5)), rates)


def fit_label_model(patterns: DataFrame, rounds: int = 4) -> LabelModel:
    """Expectation maximization over patterns (bits, gold, n), each document in one of
    them. gold, the evidence of a known label in log odds or 0, starts it and keeps the
    class from drifting. Voters are taken as independent at first; halfway the tree is
    found, and the fit goes on with it."""
    alone = np.arange(VOTERS)
    model = LabelModel(alone, np.zeros((VOTERS, 4)), 0.0, np.zeros((2, VOTERS)))
    model = _model(_gather(patterns.where("gold <> 0"), model), alone)
    for _ in range(rounds):
        model = _model(_gather(patterns, model), alone)
    sums = _gather(patterns, model)
    parents = dependence_tree(sums)
    model = _model(sums, parents)
    for _ in range(rounds):
        model = _model(_gather(patterns, model), parents)
    return model


def _posteriors(model: LabelModel):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            odds = model.log_odds(_unpacked(f["bits"].to_numpy(np.int64))) + f["gold"].to_numpy(float)
            yield f.assign(p=1 / (1 + np.exp(-np.clip(odds, -30, 30))))

    return run


def _bit(k: int) -> Column:
    return F.getbit(F.col("bits"), F.lit(k)).cast("double")


def _extras(at: str = "") -> list[Column]:
    hits, words = F.col(at + "hits"), F.col(at + "words")
    return [F.log1p(hits.cast("double")), F.least(hits / F.greatest(words, F.lit(1)) * 20, F.lit(1.0))]


def _logit(weights: list[float], bias: float) -> Column:
    """A linear form over the votes and extras, as an expression of one fold."""
    w = F.array(*[F.lit(float(x)) for x in weights[:VOTERS]])
    total = F.aggregate(F.sequence(F.lit(0), F.lit(VOTERS - 1)), F.lit(float(bias)), lambda s, k: s + F.getbit(F.col("_votes.bits"), k).cast("double") * F.get(w, k))
    for c, x in zip(_extras("_votes."), weights[VOTERS:], strict=True):
        total = total + c * F.lit(float(x))
    return total


@dataclass
class ToxicityModel:
    lexicon: list[str]
    label_model: LabelModel | None
    weights: list[float]
    bias: float

    def score(self, docs: DataFrame, threshold: float = 0.7) -> DataFrame:
        """docs with score (0 to 1) and predicted (1 if score reaches threshold) as
        further columns, in place of any of these names."""
        modest_batches(docs.sparkSession)
        own = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("score", "predicted")]
        seen = docs.select(*own, _voting(self.lexicon)(F.col("text")).alias("_votes"))
        score = 1 / (1 + F.exp(-_logit(self.weights, self.bias)))
        return seen.select(*own, score.alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))

    def keep_clean(self, docs: DataFrame, threshold: float = 0.7) -> DataFrame:
        """The rows of docs that score below threshold, with docs' own columns."""
        row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
        scored = self.score(docs.select("text", row), threshold)
        return scored.where("predicted = 0").select("row.*")


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample: int = 20_000, terms: int = MINED) -> ToxicityModel:
    """Fits on docs (doc_id, text) and labels (doc_id, toxic); only rows for which
    trains() holds take part. At most `sample` labelled rows, the first by a hash of
    their id, are mined for the lexicon (`terms` of them, MINED at most) and tell the
    label model their label; it sees the votes of every training document, once each.
    At most `sample` training documents, labelled or not, teach the classifier its
    posteriors. With no labels of both kinds the fixed lists vote alone, by a bias and
    weights that are set."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    modest_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(trains())
    known = staged(bounded_sample(_clean_labels(labels).where(trains()), "doc_id", sample))
    rows = staged(docs.join(F.broadcast(known), "doc_id").select("text", "toxic"))  # at most sample labels
    lexicon = mine_lexicon(rows, terms=min(terms, MINED))
    vote = _voting(lexicon)
    both = rows.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    unstage(rows)
    if not both[0] or not both[1]:
        unstage(known)
        return ToxicityModel(lexicon, None, [0.0] * MINED + [4.0] * len(INSULTS) + [0.5] * len(PATTERNS) + [0.0, 0.0], -3.0)
    gold = F.coalesce(F.when(F.col("toxic") == 1, GOLD).when(F.col("toxic") == 0, -GOLD), F.lit(0.0)).alias("gold")
    told = lambda df: df.join(F.broadcast(known), "doc_id", "left").select(gold, vote("text").alias("v"))
    patterns = staged(told(docs).groupBy("v.bits", "gold").agg(F.count(F.lit(1)).alias("n")))
    model = fit_label_model(patterns)
    total = patterns.agg(F.sum("n")).first()[0]
    taught = told(bounded_sample(docs, "doc_id", sample, total)).select("gold", "v.bits", "v.hits", "v.words")
    soft = taught.mapInPandas(_posteriors(model), "gold double, bits long, hits long, words long, p double")
    votes = F.array(*[_bit(k) for k in range(VOTERS)], *_extras())
    classes = F.array(F.struct(F.lit(1.0).alias("label"), F.col("p").alias("weight")), F.struct(F.lit(0.0).alias("label"), (1 - F.col("p")).alias("weight")))
    train = staged(soft.select(votes.alias("votes"), F.explode(classes).alias("x")).select("votes", "x.label", "x.weight").where("weight > 1e-6").coalesce(8))
    fitted = LogisticRegression(weightCol="weight", regParam=1e-5, standardization=False, maxIter=100).fit(train.select(array_to_vector("votes").alias("features"), "label", "weight"))
    unstage(known, patterns, train)
    return ToxicityModel(lexicon, model, [float(x) for x in fitted.coefficients.toArray()], float(fitted.intercept))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample: int = 20_000) -> DataFrame:
    """A row for each row of docs: doc_id, held_out (it could not teach), score and
    predicted.

    Null or empty text has the score of a text without votes. A row without doc_id
    is scored and not held out, and teaches nothing. Repeated rows are each scored;
    labels of one document that differ count as toxic. An empty table gives an empty
    result. Other columns, whatever their names, are ignored."""
    model = fit_toxicity(docs, labels, sample)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return model.score(docs.select("doc_id", "text"), threshold).select("doc_id", held.alias("held_out"), "score", "predicted")
