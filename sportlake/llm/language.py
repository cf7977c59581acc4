"""Language identification by a convolutional network over bytes, trained in numpy.

Bytes (A-Z as a-z) are embedded, filters of several widths slide over a window of
``WINDOW`` bytes, each filter keeps its maximum, and a softmax over the languages follows.
Training works with the filters as matrices. For prediction, embedding and filters fold
into tables by pairs of bytes, which give the same numbers by a few lookups a byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sportlake.llm.words import _LOWER, text_bytes

WINDOW, EMBED, FILTERS, WIDTHS = 128, 8, 16, (2, 3, 4, 5)
#: Different labelled texts of each language, at most, and windows from each.
SAMPLE, PER_TEXT = 1_200, 4
_PAD = 32


@dataclass
class Network:
    languages: list[str]
    embed: np.ndarray
    filters: list[np.ndarray]
    offsets: list[np.ndarray]
    out: np.ndarray
    out_offset: np.ndarray

    def tables(self) -> list[list[tuple[int, bool, np.ndarray]]]:
        """For each width, lookups (place, by pair of bytes, table) whose sum is the filter."""
        result = []
        for width, weights in zip(WIDTHS, self.filters, strict=True):
            single = [self.embed @ weights[j * EMBED : (j + 1) * EMBED] for j in range(width)]
            own = []
            for j in range(0, width - 1, 2):
                pair = single[j][None, :, :] + single[j + 1][:, None, :]
                own.append((j, True, pair.reshape(65536, FILTERS).astype(np.float32)))
            if width % 2:
                own.append((width - 1, False, single[-1].astype(np.float32)))
            result.append(own)
        return result

    def probabilities(self, windows: np.ndarray, tables=None) -> np.ndarray:
        """Probabilities of the languages for rows of ``WINDOW`` bytes."""
        tables = tables or self.tables()
        found = np.empty((len(windows), len(self.languages)), np.float32)
        for low in range(0, len(windows), 2048):
            part = np.ascontiguousarray(windows[low : low + 2048].T)
            pairs = part[:-1].astype(np.int64) | part[1:].astype(np.int64) << 8
            tops = []
            for width, own, offset in zip(WIDTHS, tables, self.offsets, strict=True):
                top = None
                for t in range(WINDOW - width + 1):
                    value = None
                    for j, by_pair, table in own:
                        got = table[(pairs if by_pair else part)[t + j]]
                        value = got if value is None else np.add(value, got, out=value)
                    top = value if top is None else np.maximum(top, value, out=top)
                tops.append(np.maximum(top + offset, 0))
            logits = np.concatenate(tops, axis=1) @ self.out + self.out_offset
            logits = np.exp(logits - logits.max(axis=1, keepdims=True))
            found[low : low + 2048] = logits / logits.sum(axis=1, keepdims=True)
        return found


def cut_windows(data: np.ndarray) -> np.ndarray:
    """All of a text's bytes in rows of ``WINDOW``, the last one filled with blanks."""
    rows = max(1, -(-len(data) // WINDOW))
    padded = np.full(rows * WINDOW, _PAD, np.uint8)
    padded[: len(data)] = _LOWER[data]
    return padded.reshape(rows, WINDOW)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = 3) -> Network:
    """Adam on the cross-entropy over batches of 64 windows, with a fixed seed."""
    draw = np.random.Generator(np.random.PCG64(11))
    scale = lambda *shape: (draw.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    params = [scale(256, EMBED) * 8]
    params += [scale(w * EMBED, FILTERS) for w in WIDTHS]
    params += [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
    params += [scale(FILTERS * len(WIDTHS), len(languages)), np.zeros(len(languages), np.float32)]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    k, step = len(WIDTHS), 0
    for _ in range(epochs):
        order = draw.permutation(len(windows))
        for low in range(0, len(order), 64):
            chosen = order[low : low + 64]
            x, y = windows[chosen], labels[chosen]
            n = len(x)
            embedded = params[0][x]
            tops, where, views = [], [], []
            for i, width in enumerate(WIDTHS):
                m = WINDOW - width + 1
                view = np.concatenate([embedded[:, j : j + m] for j in range(width)], axis=2)
                value = view @ params[1 + i] + params[1 + k + i]
                at = value.argmax(axis=1)
                tops.append(np.take_along_axis(value, at[:, None], 1)[:, 0])
                where.append(at)
                views.append(view)
            joined = np.concatenate(tops, axis=1)
            hidden = np.maximum(joined, 0)
            logits = hidden @ params[-2] + params[-1]
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(n), y] -= 1
            p /= n
            slopes = [np.zeros_like(q) for q in params]
            slopes[-2], slopes[-1] = hidden.T @ p, p.sum(axis=0)
            back = (p @ params[-2].T) * (joined > 0)
            for i, width in enumerate(WIDTHS):
                own = back[:, i * FILTERS : (i + 1) * FILTERS]
                seen = np.take_along_axis(views[i], where[i][:, :, None], 1)
                slopes[1 + i] = np.einsum("nfe,nf->ef", seen, own)
                slopes[1 + k + i] = own.sum(axis=0)
                into = np.einsum("nf,ef->nfe", own, params[1 + i]).reshape(n, FILTERS, width, EMBED)
                for j in range(width):
                    bytes_ = np.take_along_axis(x, where[i] + j, 1)
                    np.add.at(slopes[0], bytes_, into[:, :, j])
            step += 1
            for q, s, a, b in zip(params, slopes, first, second, strict=True):
                a += 0.1 * (s - a)
                b += 0.001 * (s * s - b)
                q -= 0.004 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return Network(
        languages, params[0], params[1 : 1 + k], params[1 + k : 1 + 2 * k], params[-2], params[-1]
    )


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``PER_TEXT`` windows of each labelled text, evenly spaced over all of it."""
    for batch in batches:
        data, cuts = text_bytes(batch.column(1))
        langs, keys, rows = [], [], []
        for i, (lang, key) in enumerate(
            zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)
        ):
            windows = cut_windows(data[cuts[i] : cuts[i + 1]])
            places = np.unique(np.linspace(0, len(windows) - 1, PER_TEXT).astype(int))
            langs += [lang] * len(places)
            keys += [key] * len(places)
            rows += [w.tobytes() for w in windows[places]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(keys, pa.int64()), pa.array(rows, pa.binary())],
            names=["lang", "key", "window"],
        )


def fit(docs: DataFrame, sample: int = SAMPLE) -> Network | None:
    """Network from ``docs`` (text, lang), learned from up to ``sample`` texts of each language.

    Texts are taken in the order of a hash, copies of one text count once, and every language is learned. Rows
    without language or letter are left out. None if there is nothing to learn from. What the
    driver gets grows with the number of languages only: ``sample * PER_TEXT`` windows for each.
    """
    known = docs.select(F.col("lang").cast("string"), "text", F.xxhash64("text", "lang").alias("key"))
    known = known.where("lang is not null and text is not null").where(F.col("text").rlike(r"\p{L}"))
    order = W.partitionBy("lang").orderBy(F.pmod("key", F.lit(1 << 30)), "key")
    chosen = known.select("lang", "key").distinct().withColumn("place", F.row_number().over(order))
    chosen = chosen.where(F.col("place") <= sample).drop("place")
    rows = known.join(chosen, ["lang", "key"]).groupBy("lang", "key").agg(F.min("text").alias("text"))
    rows = rows.select("lang", "text", "key").mapInArrow(_sampled, "lang string, key bigint, window binary")
    table = rows.toArrow().sort_by([("key", "ascending"), ("window", "ascending")])
    if not len(table):
        return None
    languages = sorted(set(table["lang"].to_pylist()))
    number = {x: i for i, x in enumerate(languages)}
    windows = np.frombuffer(b"".join(table["window"].to_pylist()), np.uint8).reshape(-1, WINDOW)
    labels = np.array([number[x] for x in table["lang"].to_pylist()])
    return train(windows, labels, languages)


def identified(docs: DataFrame, network: Network | None) -> DataFrame:
    """``docs`` (doc_id, text) as ``doc_id, lang_pred, score``, a row for each row.

    Every window of the whole text is classified; the language with the largest mean
    probability, weighed by the windows' bytes, wins, the first in order of name on ties, and that mean
    is the score. Null texts
    and texts without a letter, or without a network, are ``und`` with score 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = network.tables() if network else None
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                yield _identify(part, network, tables)

    narrow = docs.select(F.col("doc_id").cast("long"), "text")
    return narrow.mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def _identify(batch: pa.RecordBatch, network: Network | None, tables) -> pa.RecordBatch:
    languages, scores = ["und"] * batch.num_rows, [0.0] * batch.num_rows
    texts = batch.column(1).to_pylist()
    wanted = [i for i, t in enumerate(texts) if network and t and any(map(str.isalpha, t))]
    if wanted:
        data, cuts = text_bytes(batch.column(1))
        parts = [cut_windows(data[cuts[i] : cuts[i + 1]]) for i in wanted]
        p = network.probabilities(np.concatenate(parts), tables)
        weight = np.full(len(p), WINDOW, np.float64)
        ends = np.cumsum([len(x) for x in parts])
        for i, end in zip(wanted, ends, strict=True):
            weight[end - 1] = (cuts[i + 1] - cuts[i] - 1) % WINDOW + 1
        sums = np.add.reduceat(p * weight[:, None], np.r_[0, ends[:-1]], axis=0)
        sums /= np.add.reduceat(weight, np.r_[0, ends[:-1]])[:, None]
        for i, own in zip(wanted, sums, strict=True):
            best = int(own.argmax())
            languages[i], scores[i] = network.languages[best], float(min(1.0, own[best]))
    return pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
        names=["doc_id", "lang_pred", "score"],
    )
