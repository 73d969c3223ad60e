"""Operator 2: toxicity by a weighted lexicon matched with Aho-Corasick.

Texts are folded first: lower case, homoglyphs of Latin letters, and digits or
signs standing between letters (``l0ser``, ``id!ot``) become the letters they
imitate; everything that is no letter or digit becomes one space.

The lexicon is learned from labelled rows: words and word beginnings whose
document frequency is far higher among toxic documents, weighted by their
log odds.  Of a beginning and its extensions the longest that still covers
nearly the same documents is kept, and of all terms those that are the
heaviest in some toxic documents (copies of one text, counted once, would
otherwise bring in all its rare words).  Word pairs around a hit that are at home
in clean documents become exception phrases; hits inside them don't count.
A document's weight and its weight per word (the length normalisation) give
the score through a logistic curve fitted on the same rows.

``MAX_LABELLED`` rows (those of smallest id hash) are the documented bound of
the fit; every document is scored, over its whole text.

Edge cases: a null or empty text has no hits; without labelled rows of both
classes the lexicon is empty and every score is the share of toxic rows among
them (0 without rows).  A document labelled more than once counts with its
highest label.  Null ids are scored and never held out.  Repeated rows are
scored each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_LABELLED = 20_000
MAX_TERMS = 5_000
MIN_SHARE = 0.01  # of the toxic rows must hold a term
MIN_ODDS = 3.0
MIN_NEEDED = 0.002  # of the toxic rows must have a term as their heaviest
SAME_COVER = 0.9
PREFIXES = range(4, 9)
THRESHOLD = 0.7

# Letters that look like Latin ones, and signs used in their place.
HOMOGLYPHS = str.maketrans("авекмнорстухіјѕԁɡһοαερτυνκι", "abekmhopctyxijsdghoaeptuvki")
SIGNS = str.maketrans("01345789@$!|", "oieasotgasii")
_LOOKALIKE = re.compile("[" + "".join(map(chr, HOMOGLYPHS)) + "]")
_SIGN = re.compile(r"(?<=[^\W\d_])[013457@$!|]+(?=[^\W\d_])")
_REST = re.compile(r"[\W_]+")


def folded(text: str) -> str:
    """`` word word ... ``: a space before and after each folded word."""
    text = text.lower()
    if not text.isascii() and _LOOKALIKE.search(text):
        # only words that mix scripts: a wholly Cyrillic or Greek word is left as it is
        text = re.sub(r"[^\W\d_]+", lambda m: w.translate(HOMOGLYPHS) if re.search(r"[a-z]", w := m[0]) else w, text)
    text = _SIGN.sub(lambda m: m[0].translate(SIGNS), text)
    return " " + _REST.sub(" ", text).strip() + " "


@dataclass
class Model:
    terms: dict[str, float] = field(default_factory=dict)  # " word " or " beginning" -> weight
    exceptions: list[str] = field(default_factory=list)  # " word word "
    coefficients: tuple[float, float, float] = (0.0, 0.0, 0.0)
    prior: float = 0.0

    def automaton(self):
        a = ahocorasick.Automaton()
        for phrase in self.exceptions:
            a.add_word(phrase, (len(phrase), 0.0))
        for term, weight in self.terms.items():
            a.add_word(term, (len(term), weight))
        a.make_automaton()
        return a


def hits(automaton, text: str) -> list[tuple[int, int, float]]:
    """(start, end, weight) of every term in a folded text that lies in no exception phrase."""
    if not len(automaton):
        return []
    found, shields = [], []
    for end, (length, weight) in automaton.iter(text):
        (found if weight else shields).append((end + 1 - length, end + 1, weight))
    if not shields:
        return found
    return [h for h in found if not any(a <= h[0] and h[1] <= b for a, b, _ in shields)]


def features(automaton, text: str) -> tuple[int, float, float]:
    """(hits, log weight, log weight per thousand words) of a raw text."""
    text = folded(text)
    found = hits(automaton, text)
    if not found:
        return 0, 0.0, 0.0
    weight, words = sum(h[2] for h in found), text.count(" ") - 1
    return len(found), float(np.log1p(weight)), float(np.log1p(1000.0 * weight / (words + 10)))


def training_id(doc_id: str | Column = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) if isinstance(doc_id, str) else F.crc32(doc_id.cast("string").cast("binary"))


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: list[Counter] = [Counter(), Counter()]
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own: set[str] = set()
            for word in set(folded(text or "").split()):
                own.add(f" {word} ")
                own.update(f" {word[:k]}" for k in PREFIXES if len(word) >= k)
            counts[toxic].update(own)
        terms = list(counts[1])  # a term without toxic rows is never chosen
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([counts[1][t] for t in terms], pa.int64()),
                                          pa.array([counts[0][t] for t in terms], pa.int64())], names=["term", "toxic", "clean"])


def _log_odds(toxic: float, clean: float, n_toxic: int, n_clean: int) -> float:
    return float(np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1)))


def chosen_terms(counts: list[tuple[str, int, int]], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Of nested beginnings the longest with nearly the cover of the shortest that qualifies."""
    cover: dict[str, int] = {}
    weight: dict[str, float] = {}
    root: dict[str, str] = {}  # shortest qualifying beginning -> the term that stands for it
    for term, toxic, clean in sorted(counts, key=lambda c: (len(c[0].rstrip()), len(c[0]), c[0])):
        odds = _log_odds(toxic, clean, n_toxic, n_clean)
        if odds < MIN_ODDS:
            continue
        stem = term.rstrip()
        base = next((stem[:k] for k in range(2, len(stem) + 1) if stem[:k] in root), None)
        if base is None:
            root[stem], cover[stem], weight[term] = term, toxic, odds
        elif toxic >= SAME_COVER * cover[base] and term.startswith(root[base]):
            del weight[root[base]]
            root[base], weight[term] = term, odds
    return dict(sorted(weight.items(), key=lambda w: (-w[1], w[0]))[:MAX_TERMS])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Newton's method; the intercept isn't penalised."""
    x1 = np.column_stack([np.ones(len(x)), x])
    beta, penalty = np.zeros(x1.shape[1]), np.diag([1e-6] + [ridge] * x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip((x1 * beta).sum(1), -30, 30)))
        curvature = np.einsum("ni,n,nj->ij", x1, p * (1 - p), x1) + penalty
        step = np.linalg.solve(curvature, (x1 * (y - p)[:, None]).sum(0) - penalty @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def fit(docs: DataFrame, labels: DataFrame, held_out: int = 1, folds: int = 3) -> Model:
    """Learn lexicon, exceptions and curve from labelled rows outside fold ``held_out``."""
    own = labels.where((training_id() % folds != held_out) & F.col("toxic").isNotNull())
    own = own.groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.max("toxic").cast("int").alias("toxic"))
    # the bound: at most MAX_LABELLED ids reach the join with the texts
    own = own.orderBy(F.xxhash64("__id"), "__id").limit(MAX_LABELLED)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = texts.join(F.broadcast(own), F.col("doc_id") == F.col("__id")).select("text", "toxic").dropDuplicates(["text", "toxic"]).persist()
    try:
        totals = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
        n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
        prior = n_toxic / (n_toxic + n_clean) if n_toxic + n_clean else 0.0
        if not n_toxic or not n_clean:
            return Model(prior=prior)
        support = max(2, int(np.ceil(MIN_SHARE * n_toxic)))
        counts = rows.mapInArrow(_term_counts, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"))
        counts = counts.where(F.col("toxic") >= support)
        # clean counts of the few candidates only: each task counts them against the candidate list
        candidates = {r["term"]: r["toxic"] for r in counts.orderBy(F.col("toxic").desc(), "term").limit(20 * MAX_TERMS).collect()}
        clean = Counter({r["term"]: r["n"] for r in rows.where("toxic = 0").mapInArrow(_counter(set(candidates)), "term string, n long")
                         .groupBy("term").agg(F.sum("n").alias("n")).collect()})
        model = Model(chosen_terms([(t, n, clean[t]) for t, n in candidates.items()], n_toxic, n_clean), prior=prior)
        needed = rows.where("toxic = 1").mapInArrow(_heaviest(model), "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
        needed = {r["term"] for r in needed.where(F.col("n") >= max(1.0, MIN_NEEDED * n_toxic)).collect()}
        model.terms = {t: w for t, w in model.terms.items() if t in needed}
        pairs = rows.mapInArrow(_pairs(model), "pair string, toxic long, clean long").groupBy("pair").agg(
            F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where("clean >= 3").orderBy(F.col("clean").desc(), "pair").limit(MAX_TERMS)
        model.exceptions = [r["pair"] for r in pairs.collect() if _log_odds(r["toxic"], r["clean"], n_toxic, n_clean) < 0]
        x = np.array(rows.mapInArrow(_features(model), "a double, b double, y double").collect(), dtype=float).reshape(-1, 3)
        model.coefficients = tuple(float(b) for b in _logistic(x[:, :2], x[:, 2]))
        return model
    finally:
        rows.unpersist()


def _counter(wanted: set[str]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n: Counter = Counter()
            for text in batch.column(0).to_pylist():
                own: set[str] = set()
                for word in set(folded(text or "").split()):
                    own.add(f" {word} ")
                    own.update(f" {word[:k]}" for k in PREFIXES if len(word) >= k)
                n.update(own & wanted)
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["term", "n"])

    return count


def _heaviest(model: Model):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        for batch in batches:
            n: Counter = Counter()
            for text in batch.column(0).to_pylist():
                text = folded(text or "")
                found = hits(automaton, text)
                if found:
                    start, end, _ = max(found, key=lambda h: (h[2], h[1] - h[0], text[h[0] : h[1]]))
                    n[text[start:end]] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["term", "n"])

    return count


def _pairs(model: Model):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        for batch in batches:
            n: list[Counter] = [Counter(), Counter()]
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text, own = folded(text or ""), set()
                for start, _, _ in hits(automaton, text):
                    end = text.find(" ", start + 1)
                    before, after = text.rfind(" ", 0, start), text.find(" ", end + 1)
                    if before >= 0:
                        own.add(text[before : end + 1])
                    if after >= 0:
                        own.add(text[start : after + 1])
                n[toxic].update(own)
            pairs = list(n[0] | n[1])  # of either class: the clean rows of a pair may lie in other batches
            yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.string()), pa.array([n[1][p] for p in pairs], pa.int64()),
                                              pa.array([n[0][p] for p in pairs], pa.int64())], names=["pair", "toxic", "clean"])

    return count


def _features(model: Model):
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        for batch in batches:
            found = [features(automaton, t or "") for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.float64()),
                                              pa.array([float(y) for y in batch.column(1).to_pylist()], pa.float64())], names=["a", "b", "y"])

    return compute


def _scorer(model: Model):
    b0, b1, b2 = model.coefficients

    def score(texts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        for batch in texts:
            found = [features(automaton, t.as_py() or "") for t in batch.column("text")]
            value = [model.prior if not model.terms else 1 / (1 + np.exp(-(b0 + b1 * f[1] + b2 * f[2]))) for f in found]
            columns = [c for i, c in enumerate(batch.columns) if batch.schema.names[i] != "text"]
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(value, pa.float64()), pa.array([f[0] for f in found], pa.int64())],
                                             names=[*names, "score", "hits"])

    return score


def score_documents(docs: DataFrame, model: Model, held_out: int = 1, folds: int = 3) -> DataFrame:
    """doc_id, held_out, score, predicted, hits of every document."""
    fold = F.coalesce(training_id() % folds == held_out, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), fold.alias("held_out"), "text")
    scored = rows.mapInArrow(_scorer(model), "doc_id long, held_out boolean, score double, hits long")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "hits")


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents, all their columns, that the model doesn't reject."""
    columns = docs.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        b0, b1, b2 = model.coefficients
        at = columns.index("text")
        for batch in batches:
            ok = []
            for t in batch.column(at):
                _, a, b = features(automaton, t.as_py() or "")
                ok.append(not model.terms or 1 / (1 + np.exp(-(b0 + b1 * a + b2 * b))) < THRESHOLD)
            yield batch.filter(pa.array(ok, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
