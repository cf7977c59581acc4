"""Toxicity classifier, regularised by counterfactual swaps of identity terms.

Logistic regression on the presence of words. Besides the usual loss and an L2 term, the fit
penalises the squared change of a labelled sentence's score (as log-odds) when the identity
terms in it are swapped for others of their kind or left out. Terms that only co-occur with
toxic labels thus lose their weight, and neutral mentions of a group stay neutral.

The L2 term is weaker for words that tell more about the label (by the logarithm of the ratio of
their shares in toxic and other texts), so that rare telling words count. Its factor and the
threshold are chosen by cross-validation on the sample; the bias is moved so that the
threshold is a score of 0.5, which so is a decision's margin rather than a probability.

The model is fitted on a sample of at most ``sample`` labelled rows, those with the smallest
hash of their id. Spark counts their words; of those, the most telling come to the driver. Scoring runs over whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sportlake.llm.tables import stored

#: Labelled rows used at most, and words with a weight at most.
SAMPLE, FEATURES = 20_000, 4_000
#: Words in fewer sample texts carry no weight.
LEAST_TEXTS = 4
#: Factors of the L2 term to choose from, and parts of the sample held out in turn.
RIDGES, FOLDS = (8.0, 2.0, 0.5), 3
#: Terms that can stand for each other in a sentence, by kind.
IDENTITY = {
    "gender": "woman women man men girl girls boy boys female male nonbinary".split(),
    "orientation": "gay lesbian straight bisexual homosexual heterosexual queer".split(),
    "faith": "muslim muslims christian christians jew jews jewish hindu hindus buddhist atheist".split(),
    "origin": "black white asian latino african american european mexican arab immigrant".split(),
    "age": "old young elderly teenager teenagers".split(),
    "ability": "disabled deaf blind autistic".split(),
}
_KIND = {term: kind for kind, terms in IDENTITY.items() for term in terms}
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[.!?\n]+")


def words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


@dataclass
class Model:
    """Weights of words and the bias; a text's score is the logistic of their sum."""

    bias: float = 0.0
    weights: dict[str, float] = field(default_factory=dict)

    def score(self, text: str | None) -> float:
        found = words(text or "") & self.weights.keys()
        total = self.bias + sum(self.weights[w] for w in sorted(found))
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of labelled texts, and the sets of identity terms of their sentences."""
    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        mentions = []
        for text in texts:
            low = text.lower()
            own = [sorted(_KIND.keys() & words(s)) for s in _SENTENCE.split(low)] if _KIND.keys() & words(low) else []
            mentions.append(sorted({" ".join(x) for x in own if x}))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([sorted(words(t)) for t in texts], pa.list_(pa.string())),
                pa.array(mentions, pa.list_(pa.string())),
            ],
            names=["toxic", "words", "mentions"],
        )


def swaps(mention: str) -> Iterator[tuple[list[str], list[str]]]:
    """Identity terms of a sentence and what replaces them: nothing, then each other term."""
    terms = mention.split()
    yield terms, []
    for term in terms:
        for other in IDENTITY[_KIND[term]]:
            if other not in terms:
                yield [term], [other]


def train(
    texts: list[list[str]],
    labels: list[int],
    mentions: list[list[str]],
    fairness: float = 1.0,
    ridge: float = 2.0,
    steps: int = 400,
) -> Model:
    """Fits the weights by full-batch Adam steps; ``fairness`` weighs the swap penalty."""
    y = np.array(labels, float)
    if not len(y):
        return Model()
    names = sorted({w for found in texts for w in found})
    place = {w: i for i, w in enumerate(names)}
    owner = np.repeat(np.arange(len(texts)), [len(found) for found in texts])
    codes = np.array([place[w] for found in texts for w in found], np.int64)
    n = len(y)
    df = np.bincount(codes, minlength=len(names)).astype(float)
    pos = np.bincount(codes, y[owner], minlength=len(names))
    share = (y.sum() + 0.5) / (n + 1)
    gain = (pos - df * share) ** 2 / (df * share * (1 - share) + 1e-9)
    gain[df < LEAST_TEXTS] = -1
    chosen = [names[i] for i in np.argsort(-gain, kind="stable")[:FEATURES] if gain[i] > 0]
    chosen = sorted({*chosen, *_KIND})
    number = {w: i for i, w in enumerate(chosen)}
    remap = np.array([number.get(w, -1) for w in names] or [-1])
    keep = remap[codes] >= 0 if len(codes) else np.zeros(0, bool)
    row, col = owner[keep], remap[codes[keep]] if len(codes) else codes
    swapped: dict[tuple[tuple, tuple], int] = {}
    for found in mentions:
        for mention in found:
            for out, into in swaps(mention):
                key = tuple(sorted(number[w] for w in out)), tuple(number[w] for w in into)
                swapped[key] = swapped.get(key, 0) + 1
    pairs = list(swapped.items())
    change = np.zeros((len(pairs), len(chosen)), np.float32) if pairs else None
    for i, ((out, into), _) in enumerate(pairs):
        change[i, list(out)] -= 1
        change[i, list(into)] += 1
    counts = np.array([c for _, c in pairs], float)
    # A word's weight is w * scale; identity terms, which may be in no text, have at least 1.
    at = np.array([place.get(name, len(names)) for name in chosen], np.int64)
    df, pos = np.append(df, 0)[at], np.append(pos, 0)[at]
    scale = np.abs(np.log((pos + 0.5) / (y.sum() + 1) / ((df - pos + 0.5) / (n - y.sum() + 1))))
    scale[[number[name] for name in _KIND]] = np.maximum(scale[[number[name] for name in _KIND]], 1)
    w, bias = np.zeros(len(chosen)), float(np.log(share / (1 - share)))
    first, second = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for step in range(1, steps + 1):
        total = bias + np.bincount(row, (w * scale)[col], minlength=n)
        error = 1 / (1 + np.exp(-np.clip(total, -30, 30))) - y
        slope = np.bincount(col, error[row], minlength=len(chosen))
        if pairs:
            slope += fairness * 2 * (change.T @ (counts * (change @ (w * scale))))
        slope = slope * scale + ridge * w
        slope = np.append(slope, error.sum())
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        move = 0.1 * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
        w, bias = w - move[:-1], bias - move[-1]
    return Model(float(bias), {name: float(v) for name, v in zip(chosen, w * scale, strict=True) if v})


def _best_cut(odds: np.ndarray, y: np.ndarray) -> float:
    """Log-odds from which on texts count as toxic: the middle of the gap with the highest F1."""
    order = np.argsort(-odds, kind="stable")
    odds, hits = odds[order], np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    below = np.append(odds[1:], odds[-1] - 1)
    f1[below >= odds] = -1
    last = int(np.argmax(f1))
    return float((odds[last] + below[last]) / 2)


def selected(texts: list[list[str]], labels: list[int], mentions: list[list[str]], **options) -> Model:
    """``train`` with the ridge of least held-out loss; score 0.5 is the best held-out threshold.

    With fewer than two texts of either label for each fold, or a given ridge, ``train`` as it is.
    """
    y = np.array(labels, float)
    if "ridge" in options or min(y.sum(), len(y) - y.sum()) < 2 * FOLDS:
        return train(texts, labels, mentions, **options)
    part = np.empty(len(y), np.int64)
    for label in (0, 1):
        own = np.flatnonzero(y == label)
        part[own] = np.arange(len(own)) % FOLDS
    best = None
    for ridge in RIDGES:
        odds = np.empty(len(y))
        for fold in range(FOLDS):
            rest = np.flatnonzero(part != fold)
            pick = lambda values: [values[i] for i in rest]
            model = train(pick(texts), pick(labels), pick(mentions), **{"steps": 200, **options, "ridge": ridge})
            for i in np.flatnonzero(part == fold):
                odds[i] = model.bias + sum(model.weights.get(w, 0.0) for w in texts[i])
        loss = np.logaddexp(0, np.where(y == 1, -odds, odds)).sum()
        if best is None or loss < best[0]:
            best = loss, ridge, _best_cut(odds, y)
    model = train(texts, labels, mentions, **options, ridge=best[1])
    return Model(model.bias - best[2], model.weights)


def remainder(docs_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo a number; null ids have the remainder 0."""
    return F.coalesce(F.crc32(F.col(docs_id).cast("string")) % modulus, F.lit(0))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, **options) -> Model:
    """Model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic 0/1).

    Rows without id or label are left out. Only rows of ``labels`` and ``docs`` given here
    are learned from; hold rows out by leaving them out of ``labels``.
    """
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).where(
        "doc_id is not null and toxic in (0, 1)"
    )
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(sample)
    rows = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .join(F.broadcast(chosen), "doc_id")  # at most ``sample`` ids
        .select("toxic", "text")
        .mapInArrow(_featured, "toxic int, words array<string>, mentions array<string>")
        # Copies of a text count once.
        .withColumn("key", F.xxhash64("words"))
        .dropDuplicates(["key", "toxic"])
    )
    rows = stored(rows, "sample")
    known = _informative(rows)
    names = ["toxic", "words", "mentions"]

    def narrowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [[w for w in found if w in known] for found in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array(own, pa.list_(pa.string())), batch.column(2)]
            yield pa.RecordBatch.from_arrays([*columns, batch.column(3)], names=[*names, "key"])

    schema = "toxic int, words array<string>, mentions array<string>, key bigint"
    table = rows.select(*names, "key").mapInArrow(narrowed, schema).toArrow()
    table = table.sort_by([("key", "ascending"), ("toxic", "ascending")])
    return selected(
        table["words"].to_pylist(), table["toxic"].to_pylist(), table["mentions"].to_pylist(), **options
    )


def _informative(rows: DataFrame) -> set[str]:
    """The ``FEATURES`` words that tell most about the label, and all identity terms."""
    total = rows.agg(F.count("*").alias("n"), F.sum("toxic").alias("y")).first()
    share = ((total["y"] or 0) + 0.5) / (total["n"] + 1)
    counts = rows.select("toxic", F.explode("words").alias("word")).groupBy("word")
    counts = counts.agg(F.count("*").alias("df"), F.sum("toxic").alias("pos")).where(F.col("df") >= LEAST_TEXTS)
    gain = (F.col("pos") - F.col("df") * share) ** 2 / F.col("df")
    best = counts.orderBy(gain.desc(), "word").limit(FEATURES).collect()
    return {r["word"] for r in best} | _KIND.keys()


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (doc_id, text) as ``doc_id, score``, a row for each row.

    The score is the model's for the whole text; null and empty texts get that of no word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [model.score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values, pa.float64())], names=["doc_id", "score"]
            )

    narrow = docs.select(F.col("doc_id").cast("long"), "text")
    return narrow.mapInArrow(run, "doc_id bigint, score double")


def clean(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text scores below the threshold, all columns as they are."""

    @F.pandas_udf("double")
    def score(texts):
        return texts.map(model.score)

    return docs.where(score(F.col("text")) < threshold)
