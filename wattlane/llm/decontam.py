"""Benchmark decontamination: one Aho-Corasick automaton over all windows of the benchmark's items.

Texts and items are normalised alike: ASCII lower case, words of ASCII letters,
digits and non-ASCII characters. The automaton's symbols are word numbers, so
a text is scanned once, word by word, and an item costs ten nodes a word. Hits
are mapped back to offsets in the original text.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlane.llm.common import stage

_KEEP = b"abcdefghijklmnopqrstuvwxyz0123456789"
#: byte by byte: A-Z to a-z, every other ASCII character that isn't of a word to a space
NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or b in _KEEP else 32 for b in range(256)
)


@dataclass(frozen=True)
class DecontamConfig:
    """One automaton holds items of up to ``automaton_chars`` characters; a larger benchmark takes further scans."""

    window: int = 10
    automaton_chars: int = 2_000_000


def normalised(text: str | None) -> bytes:
    """UTF-8 of the text with separators as spaces; every byte stays at its place."""

    return (text or "").encode("utf-8", "surrogatepass").translate(NORMAL)


@dataclass(frozen=True)
class Matcher:
    """``numbers``: number of every benchmark word; ``automaton``: from windows to (length, items)."""

    numbers: dict[bytes, int]
    automaton: ahocorasick.Automaton | None

    def hits(self, words: list[bytes]) -> tuple[np.ndarray, set[str | None]]:
        """Which words lie in an occurrence of a window, and the items whose windows occur."""

        hit, items = np.zeros(len(words), bool), set()
        if self.automaton is not None and words:
            number = self.numbers.get
            for end, (length, names) in self.automaton.iter(tuple(number(w, 0) for w in words)):
                hit[end - length + 1 : end + 1] = True
                items.update(names)
        return hit, items


@functools.lru_cache(maxsize=2)
def build_matcher(items: tuple[tuple[str | None, str | None], ...], window: int) -> Matcher:
    """``items``: (name, text). An item of fewer words than the window is one window; one without words has none."""

    numbers: dict[bytes, int] = {}
    names: dict[tuple[int, ...], set] = {}
    for name, text in items:
        words = [numbers.setdefault(w, len(numbers) + 1) for w in normalised(text).split()]
        width = min(window, len(words))
        for i in range(len(words) - width + 1 if words else 0):
            names.setdefault(tuple(words[i : i + width]), set()).add(name)
    if not names:
        return Matcher(numbers, None)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for key, who in names.items():
        automaton.add_word(key, (len(key), tuple(who)))
    automaton.make_automaton()
    return Matcher(numbers, automaton)


def _ranges(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def _offsets(norm: bytes, ranges: list[tuple[int, int]]) -> list[dict]:
    """Code point offsets (end exclusive) of ranges of words."""

    data = np.frombuffer(norm, np.uint8)
    inside = np.concatenate([[False], data != 32, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    points = np.cumsum((data & 0xC0) != 0x80)  # code points up to and with a byte
    return [{"start": int(points[edges[2 * a]] - 1), "end": int(points[edges[2 * b - 1] - 1])} for a, b in ranges]


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_SCAN = pa.struct([("n_words", pa.int64()), ("words", _SPAN), ("spans", _SPAN), ("items", pa.list_(pa.string()))])
_SCAN_DDL = ("struct<n_words:bigint,words:array<struct<start:bigint,end:bigint>>,"
             "spans:array<struct<start:bigint,end:bigint>>,items:array<string>>")


def _scan_udf(items: tuple[tuple[str | None, str | None], ...], window: int):
    @F.arrow_udf(_SCAN_DDL)
    def scan(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = build_matcher(items, window)
        for batch in texts:
            out = []
            for t in batch:
                norm = normalised(t.as_py())
                words = norm.split()
                hit, found = matcher.hits(words)
                ranges = _ranges(hit) if found else []
                out.append({"n_words": len(words), "words": [{"start": a, "end": b} for a, b in ranges],
                            "spans": _offsets(norm, ranges) if ranges else [], "items": list(found)})
            yield pa.array(out, _SCAN)

    return scan


@F.arrow_udf(T.LongType())
def _covered(ranges: pa.Array) -> pa.Array:
    """Words in the union of the ranges that several scans found."""

    out = []
    for spans in ranges:
        total = end = 0
        for s in sorted((x["start"], x["end"]) for x in spans.as_py()):
            total += max(0, s[1] - max(end, s[0]))
            end = max(end, s[1])
        out.append(total)
    return pa.array(out, pa.int64())


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", cfg: DecontamConfig | None = None) -> DataFrame:
    """``row`` (all columns of the document), n_words, n_hit, items, spans, contaminated; one row per document.

    ``items``: ids of the items that occur, as text, sorted, without null ids;
    ``spans``: hit passages in code points of the original text, end exclusive.
    Null and wordless texts have no words; an empty benchmark hits nothing;
    repeated items count once, repeated documents each. A benchmark beyond
    the size of one automaton is cut into shards that are scanned in turn,
    with the state staged in between.
    """

    cfg = cfg or DecontamConfig()
    items = benchmark.select(F.col(item_id).cast("string").alias("name"), F.col(item_text).alias("text")).distinct()
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    shards = max(1, math.ceil(chars / cfg.automaton_chars))
    state = docs.select(F.struct("*").alias("row"), F.col(text).alias("whole"))
    found: list[str] = []
    for k in range(shards):
        shard = items.where(F.pmod(F.xxhash64("name", "text"), F.lit(shards)) == k) if shards > 1 else items
        listed = tuple(sorted(((r["name"], r["text"]) for r in shard.collect()), key=repr))
        state = state.withColumn(f"scan{k}", _scan_udf(listed, cfg.window)("whole"))
        if shards > 1:
            state = stage(state, f"scan{k}")
        found.append(f"scan{k}")
    if shards == 1:
        n_hit = F.aggregate("scan0.words", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    else:
        n_hit = _covered(F.concat(*[F.col(f"{s}.words") for s in found]))
    names = F.array_sort(F.array_distinct(F.array_compact(F.concat(*[F.col(f"{s}.items") for s in found]))))
    spans = F.concat(*[F.col(f"{s}.spans") for s in found])
    return state.select("row", F.col("scan0.n_words").alias("n_words"), n_hit.alias("n_hit"), names.alias("items"),
                        F.array_sort(spans).alias("spans")).withColumn("contaminated", F.col("n_hit") > 0)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, cfg: DecontamConfig | None = None) -> DataFrame:
    """The documents, with all their columns, in which no window of the benchmark occurs."""

    return contamination(docs, benchmark, cfg=cfg).where(~F.col("contaminated")).select("row.*")
