"""Language identification by error-correcting output codes over byte n-grams.

Each language has a codeword; each of its bits splits the languages in two,
and one binary n-gram classifier (log odds of the n-grams of either side)
predicts it. A text's margins are decoded to the codeword of least weighted
loss, where a bit weighs as much as it separates the languages; texts with two
close codewords are flagged as ambiguous.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"


@dataclass(frozen=True)
class LangConfig:
    """``sample_docs``: labelled documents a language that the classifiers are fitted on, about; chosen by a hash.

    ``margin``: a text is ambiguous when its two best losses, for margins of
    typical texts near one, differ by less.
    """

    orders: tuple[int, ...] = (2, 3, 4)
    bits: int = 13
    sample_docs: int = 5_000
    smoothing: float = 0.5
    steepness: float = 4.0
    margin: float = 0.5
    seed: int = 11


_FOLD = np.array([b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)], np.uint8)
_PRIMES = np.array([2654435761, 2246822519, 3266489917, 668265263], np.uint32)


def ngram_counts(text: str, cfg: LangConfig) -> np.ndarray:
    """Counts of hashed byte n-grams of the whole text; runs of non-letters are one space."""

    data = _FOLD[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]
    blank = data == 32
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1]
    x = np.concatenate([[32], data[keep], [32]]).astype(np.uint32)
    out = np.zeros(1 << cfg.bits, np.int64)
    for order in cfg.orders:
        n = len(x) - order + 1
        if n > 0:
            h = np.full(n, order, np.uint32)
            for j in range(order):
                h = (h ^ x[j : j + n]) * _PRIMES[j % 4]
                h ^= h >> np.uint32(15)
            out += np.bincount(h >> np.uint32(32 - cfg.bits), minlength=len(out))
    return out


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def codewords(languages: int, seed: int = 0) -> np.ndarray:
    """+1 / -1 by language and bit: all splits for up to five languages, else well-spread random ones."""

    if languages < 2:
        return np.ones((languages, 0))
    if languages <= 5:
        splits = [(1, *s) for s in itertools.product((1, -1), repeat=languages - 1) if -1 in s]
        return np.array(splits, float).T
    rng = np.random.default_rng(seed)
    best, far = None, -1
    for _ in range(50):
        m = rng.choice([-1.0, 1.0], (languages, math.ceil(10 * math.log2(languages))))
        m = m[:, np.abs(m.sum(axis=0)) < languages]
        apart = (m.shape[1] - m @ m.T) / 2 + np.eye(languages) * m.shape[1]
        if apart.min() > far:
            best, far = m, apart.min()
    return best


@dataclass(frozen=True)
class LangModel:
    """Fitted classifiers: ``weights`` by n-gram and bit, scaled to margins near one; ``trust`` by bit."""

    cfg: LangConfig
    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray
    trust: np.ndarray

    def predict_text(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, ambiguous); without a letter, or when nothing was learned, (und, 0, True)."""

        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        counts = ngram_counts(text, self.cfg)
        seen = np.flatnonzero(counts)
        margins = counts[seen] @ self.weights[seen] / counts.sum()
        loss = np.logaddexp(0, -self.cfg.steepness * self.code * margins) @ self.trust
        order = np.argsort(loss, kind="stable")
        share = np.exp(loss[order[0]] - loss)
        gap = loss[order[1]] - loss[order[0]]
        return self.languages[order[0]], float(1 / share.sum()), bool(gap < self.cfg.margin)

    def predict(self, text: Column | str) -> Column:
        """Struct (lang, score, ambiguous) of a text column; the whole text counts."""

        kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())])

        @F.arrow_udf("struct<lang:string,score:double,ambiguous:boolean>")
        def predicted(texts: pa.Array) -> pa.Array:
            rows = [self.predict_text(t.as_py()) for t in texts]
            return pa.array([dict(zip(("lang", "score", "ambiguous"), r, strict=True)) for r in rows], kind)

        return predicted(text)


def _fit(profiles: dict[str, np.ndarray], cfg: LangConfig) -> LangModel:
    """Binary log-odds classifiers of every bit, from the n-gram frequencies of each language."""

    languages = tuple(sorted(profiles))
    code = codewords(len(languages), cfg.seed)
    if len(languages) < 2:
        return LangModel(cfg, languages, code, np.zeros((1 << cfg.bits, 0), np.float32), np.ones(0))
    freq = np.stack([profiles[x] for x in languages]) + cfg.smoothing
    freq /= freq.sum(axis=1, keepdims=True)
    weights = np.empty((freq.shape[1], code.shape[1]))
    for j in range(code.shape[1]):
        weights[:, j] = np.log(freq[code[:, j] > 0].mean(axis=0)) - np.log(freq[code[:, j] < 0].mean(axis=0))
    typical = code * (freq @ weights)  # expected margin towards the right side, by language and bit
    scale = np.maximum(np.abs(typical).mean(axis=0), 1e-9)
    trust = np.clip(typical.min(axis=0) / scale, 0.05, 1.0)
    return LangModel(cfg, languages, code, (weights / scale).astype(np.float32), trust)


def train(labelled: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id",
          cfg: LangConfig | None = None) -> LangModel:
    """Fit on about ``sample_docs`` rows a language, chosen by a hash of ``key``; equal texts count once.

    Rows with a null label or a text without letters teach nothing; no row at
    all gives a model that answers ``und``. Each document's n-grams count as
    at most a thousand, so that long texts don't outweigh the others.
    """

    cfg = cfg or LangConfig()
    rows = labelled.select(F.col(label).alias("lang"), F.col(text).alias("text"), F.col(key).alias("key"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return _fit({}, cfg)
    limit = F.create_map(*itertools.chain.from_iterable(
        (F.lit(lang), F.lit(cfg.sample_docs / n)) for lang, n in sizes.items()))
    draw = F.pmod(F.xxhash64("key", F.lit(cfg.seed)), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where(draw < limit[F.col("lang")]).dropDuplicates(["lang", "text"]).select("lang", "text")

    def profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if has_letter(t := t.as_py()):
                    c = ngram_counts(t, cfg)
                    total = sums.setdefault(lang, np.zeros(len(c)))
                    total += c * min(1.0, 1000 / c.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array(sums, pa.string()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
            names=["lang", "profile"])

    def added(group):
        total = np.sum([np.frombuffer(p) for p in group["profile"]], axis=0)
        return group.head(1).assign(profile=[total.tobytes()])

    schema = "lang string, profile binary"
    summed = sample.mapInArrow(profiles, schema).groupBy("lang").applyInPandas(added, schema).collect()
    return _fit({r["lang"]: np.frombuffer(r["profile"]).copy() for r in summed}, cfg)


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: crc32 of the id as text, modulo 4, is 2."""

    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
             cfg: LangConfig | None = None) -> DataFrame:
    """``row`` (all columns of the document), held_out, lang_pred, score, ambiguous; one row per row of ``docs``.

    Learns from the labelled documents that aren't held out and predicts all
    from their text alone. A null doc_id counts as not held out.
    """

    model = train(docs.where(~held_out(F.col(doc_id))), text, lang, doc_id, cfg)
    found = docs.select(F.struct("*").alias("row"), held_out(F.col(doc_id)).alias("held_out"),
                        model.predict(F.col(text)).alias("p"))
    return found.select("row", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"),
                        F.col("p.ambiguous").alias("ambiguous"))


def keep_identified(docs: DataFrame, cfg: LangConfig | None = None) -> DataFrame:
    """The documents, with all their columns, whose language is neither unknown nor ambiguous."""

    return identify(docs, cfg=cfg).where((F.col("lang_pred") != UNKNOWN) & ~F.col("ambiguous")).select("row.*")
