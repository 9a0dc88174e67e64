"""Language identification by a bidirectional gated recurrent network over bytes.

Texts are read as UTF-8 in segments of ``SEGMENT`` bytes. One network reads a
segment forwards, one backwards; together they label every byte with a
distribution over languages. A document's probabilities are the mean over its
letters. Trained here, in numpy, by backpropagation through time on a bounded
sample.

The gates are piecewise linear and the candidate is x / (1 + |x|): the same
network at a fraction of the time of exponentials.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEGMENT = 128
BATCH = 2048
UNKNOWN = "und"
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


class Direction:
    """One gated recurrent network; rows of the weights are reset, update and candidate."""

    def __init__(self, units: int, rng: np.random.Generator):
        self.units = units
        self.table = (rng.normal(size=(3 * units, 256)) * 0.3).astype(np.float32)
        self.back = (rng.normal(size=(3 * units, units)) * 0.5 / units ** 0.5).astype(np.float32)

    def run(self, bytes_: np.ndarray, keep: list | None = None) -> Iterator[np.ndarray]:
        """States (units, rows) after each row of ``bytes_`` (steps, rows)."""
        u = self.units
        h = np.zeros((u, bytes_.shape[1]), np.float32)
        for x in bytes_:
            given, past = self.table.take(x, axis=1), self.back @ h
            gates = given[:2 * u]
            gates += past[:2 * u]
            gates *= 0.25
            gates += 0.5
            np.clip(gates, 0, 1, out=gates)
            c = past[2 * u:] * gates[:u]
            c += given[2 * u:]
            n = c / (1 + np.abs(c))
            if keep is not None:
                keep.append((x, h, gates, past[2 * u:], n))
            h = n + gates[u:] * (h - n)
            yield h

    def learn(self, kept: list, errors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of (table, back), going back through the kept steps; ``errors`` (steps, units, rows) by state."""
        u = self.units
        grad_back, inputs = np.zeros_like(self.back), []
        flow = np.zeros_like(errors[0])
        for (_, h, gates, past, n), error in zip(reversed(kept), errors[::-1], strict=True):
            flow = flow + error
            r, z = gates[:u], gates[u:]
            d_c = flow * (1 - z) * (1 - np.abs(n)) ** 2
            d_gates = np.concatenate([d_c * past, flow * (h - n)]) * (0.25 * ((gates > 0) & (gates < 1)))
            d_past = np.concatenate([d_gates, d_c * r])
            grad_back += d_past @ h.T
            flow = flow * z + self.back.T @ d_past
            inputs.append(np.concatenate([d_gates, d_c]))
        x = np.concatenate([k[0] for k in reversed(kept)])
        d = np.concatenate(inputs, axis=1)
        table = np.stack([np.bincount(x, row, 256) for row in d]).astype(np.float32)
        return table, grad_back


class Network:
    """Both directions and the layer that turns their states into labels."""

    def __init__(self, langs: list[str], units: int = 6, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.langs, self.units = langs, units
        self.ahead, self.behind = Direction(units, rng), Direction(units, rng)
        self.out = (rng.normal(size=(len(langs), 2 * units)) * 0.3).astype(np.float32)
        self.bias = np.zeros((len(langs), 1), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.ahead.table, self.ahead.back, self.behind.table, self.behind.back, self.out, self.bias]

    def label(self, bytes_: np.ndarray) -> np.ndarray:
        """Probabilities (steps, languages, rows) of every byte of ``bytes_`` (steps, rows)."""
        u = self.units
        scores = np.empty((len(bytes_), len(self.langs), bytes_.shape[1]), np.float32)
        for t, h in enumerate(self.ahead.run(bytes_)):
            scores[t] = self.out[:, :u] @ h
        for t, h in enumerate(self.behind.run(bytes_[::-1])):
            scores[-1 - t] += self.out[:, u:] @ h
        scores += self.bias
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        return scores

    def gradients(self, bytes_: np.ndarray, lang: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross entropy over positions; ``weight`` (steps, rows) is 0 beyond a text's end."""
        u, kept = self.units, ([], [])
        ahead = np.stack(list(self.ahead.run(bytes_, kept[0])))
        behind = np.stack(list(self.behind.run(bytes_[::-1], kept[1])))[::-1]
        states = np.concatenate([ahead, behind], axis=1)
        scores = self.out @ states + self.bias
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        d = scores / scores.sum(axis=1, keepdims=True)
        d[:, lang, np.arange(len(lang))] -= 1
        d *= (weight / max(1.0, weight.sum()))[:, None, :]
        errors = self.out.T @ d
        grad_out = (d @ states.transpose(0, 2, 1)).sum(axis=0)
        first = self.ahead.learn(kept[0], errors[:, :u])
        second = self.behind.learn(kept[1], np.ascontiguousarray(errors[::-1, u:]))
        return [*first, *second, grad_out, d.sum(axis=(0, 2))[:, None]]


def segments(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes (steps, rows), length of each row, text of each row): whole texts, cut."""
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = -(-sizes // SEGMENT)
    owner = np.repeat(np.arange(len(texts)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = np.repeat(np.cumsum(sizes) - sizes, counts) + nth * SEGMENT
    lengths = np.minimum(SEGMENT, sizes[owner] - nth * SEGMENT)
    whole = np.frombuffer(b"".join(texts) + bytes(SEGMENT), np.uint8)
    at = start[:, None] + np.arange(SEGMENT)
    rows = np.where(np.arange(SEGMENT) < lengths[:, None], whole[at], 0)
    return np.ascontiguousarray(rows.T), lengths, owner


def train(texts: list[bytes], langs: list[str], units: int = 6, steps: int = 320, rows: int = 256, seed: int = 7) -> Network:
    """A network fitted to segments by Adam; the same input gives the same network."""
    net = Network(sorted(set(langs)), units, seed)
    bytes_, lengths, owner = segments(texts)
    lang = np.array([net.langs.index(x) for x in langs])[owner]
    weight = (np.arange(SEGMENT)[:, None] < lengths).astype(np.float32)
    rng, order = np.random.default_rng(seed), np.zeros(0, np.int64)
    mean, square = ([np.zeros_like(p) for p in net.parameters()] for _ in range(2))
    for step in range(1, steps + 1):
        if not len(order):
            order = rng.permutation(len(owner))
        some, order = order[:rows], order[rows:]
        rate = 0.03 * (1 - step / (steps + 1)) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
        grads = net.gradients(np.ascontiguousarray(bytes_[:, some]), lang[some], weight[:, some])
        for p, g, m, s in zip(net.parameters(), grads, mean, square, strict=True):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            p -= rate * m / (np.sqrt(s) + 1e-8)
    return net


def fit(labelled: DataFrame, per_lang: int = 1200, cuts: int = 4, **settings) -> Network | None:
    """A network from (text, lang): at most about ``per_lang`` texts of a language, ``cuts`` segments of each.

    Texts are chosen, and cut, by a digest of their content, so any order and
    partitioning of the rows gives the same network. Null languages and texts
    without letters are left out; without any row there is no network.
    """
    rows = labelled.select("text", F.col("lang").cast("string").alias("lang")).where("lang is not null and text rlike '\\\\p{L}'")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per language
    if not counts:
        return None
    pairs = [F.lit(x) for k, n in counts.items() for x in (k, int((1 << 20) * min(1.0, per_lang / n)))]
    some = rows.withColumn("h", F.xxhash64("text")).where(F.pmod("h", F.lit(1 << 20)) < F.element_at(F.create_map(*pairs), F.col("lang")))
    free = F.greatest(F.length("text") - SEGMENT, F.lit(0)) + 1
    cut = some.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(cuts - 1)))).select(
        "lang", F.substring("text", (F.pmod(F.xxhash64("h", "i"), free) + 1).cast("int"), F.lit(SEGMENT)).alias("part"))
    found = sorted((r["lang"], r["part"]) for r in cut.distinct().collect())  # bounded by per_lang and cuts
    return train([p.encode()[:SEGMENT] for _, p in found], [x for x, _ in found], **settings)


def label_texts(net: Network, texts: list[str]) -> list[tuple[str, float]]:
    """(language, probability) of each text, pooled over the letters of the whole text."""
    data = [t.encode() for t in texts]
    bytes_, lengths, owner = segments(data)
    pooled = np.zeros((len(texts), len(net.langs)))
    letters = np.zeros(len(texts))
    for at in range(0, len(owner), BATCH):
        some = slice(at, at + BATCH)
        part = np.ascontiguousarray(bytes_[:, some])
        counted = LETTER[part] & (np.arange(SEGMENT)[:, None] < lengths[some])
        sums = (net.label(part) * counted[:, None, :]).sum(axis=0)
        for k, row in enumerate(sums):
            pooled[:, k] += np.bincount(owner[some], row, len(texts))
        letters += np.bincount(owner[some], counted.sum(axis=0), len(texts))
    out = []
    for text, p, n in zip(texts, pooled, letters, strict=True):
        if not n or not any(map(str.isalpha, text)):
            out.append((UNKNOWN, 0.0))
        else:
            best = int(p.argmax())
            out.append((net.langs[best], round(min(1.0, float(p[best] / n)), 6)))
    return out


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """``docs`` with lang_pred and score (double, 0 to 1), from the text alone.

    ``und`` with score 0 where the text is null, has no letter, or there is no
    network. Ties go to the first language by name; repeated rows are labelled
    alike. Columns of the same names are replaced.
    """
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    docs = docs.select(*keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b["text"].to_pylist()]
            found: list[tuple[str, float]] = []
            at = 0
            while at < len(texts):  # a few MB of text at a time
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) <= 1 << 21):
                    size += len(texts[end])
                    end += 1
                found += label_texts(net, texts[at:end]) if net else [(UNKNOWN, 0.0)] * (end - at)
                at = end
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([x for x, _ in found]), pa.array([s for _, s in found], pa.float64())],
                                             [*b.schema.names, "lang_pred", "score"])

    schema = f"{docs.schema.simpleString()[7:-1]},lang_pred:string,score:double"
    return docs.mapInArrow(run, schema)
