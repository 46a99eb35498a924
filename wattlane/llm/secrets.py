"""Secrets in texts: pattern spans, and strings whose sliding-window entropy is high for their character class.

Only DataFrame functions. A pattern's matches come with ``regexp_extract_all``;
the lengths of the pieces that ``split`` leaves between them give the offsets.
The entropy of a window is carried along: when a character enters and another
leaves, only their two counts and terms change.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: kinds in the order of the result; the first three are the base kinds
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "entropy")

# Java patterns. Each takes whole runs, so that no shorter match is tried inside a run that fails.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]++"""
ASSIGN_VALUE = r"""^[A-Za-z_]++["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]++)$"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"


@dataclass(frozen=True)
class CharClass:
    """A candidate is a string of ``chars`` alone, a window long or more, that matches every pattern of ``needs``."""

    name: str
    chars: str
    needs: tuple[str, ...]
    threshold: float


@dataclass(frozen=True)
class SecretConfig:
    """Thresholds are bits per character over ``window`` characters (at most log2 of the window, 4.32 for 20)."""

    window: int = 20
    classes: tuple[CharClass, ...] = (
        CharClass("hex", "[0-9A-Fa-f]", ("[0-9]", "[A-Fa-f]"), 3.0),
        # digits in two places, as words with a number have them in one
        CharClass("lower", "[a-z0-9]", ("[0-9][a-z]+[0-9]",), 3.5),
        CharClass("upper", "[A-Z0-9]", ("[0-9][A-Z]+[0-9]",), 3.4),
        CharClass("alnum", "[A-Za-z0-9]", ("[0-9]", "[A-Z]", "[a-z]"), 3.7),
        CharClass("base64", "[A-Za-z0-9+/=_-]", ("[0-9]", "[A-Z]", "[a-z]", "[+/=_-]"), 3.8),
    )
    #: separators: what lies between them is judged where the whole run is no secret
    separators: str = "[+/=_-]"
    #: a candidate of less than two windows that contains one of these (lower case) is no secret; in a longer one, windows with them don't count
    allow: tuple[str, ...] = (
        "example", "sample", "placeholder", "changeme", "dummy", "xxxx", "your-", "your_",
        "0123456789", "1234567890", "abcdefgh",
    )
    #: nor is one that matches one of these as a whole: identifiers, version and date stamps
    allow_patterns: tuple[str, ...] = (
        r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}",
        r"[A-Za-z]+([-_/][A-Za-z]+)+[0-9]{0,4}",
        r"[0-9TZ:_-]+",
    )


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often and wherever ``use`` names it."""

    return F.get(F.transform(F.array(value), use), F.lit(0))


def _placed(pairs: Column) -> Column:
    """Array of (start, m) from an array of (gap before, m).

    The offsets are running sums in two levels, in blocks of about the root of
    the array's size: an array that grows by one element a step is copied each time.
    """

    def summed(block: Column) -> Column:
        nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,m:string>>").alias("found"))

        def step(acc: Column, pair: Column) -> Column:
            at = acc["at"] + F.length(pair["gap"])
            return F.struct((at + F.length(pair["m"])).alias("at"),
                            F.concat(acc["found"], F.array(F.struct(at.alias("start"), pair["m"].alias("m")))).alias("found"))

        return F.aggregate(block, nothing, step)

    def joined(pairs: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(pairs).cast("double"))).cast("int")
        firsts = F.sequence(F.lit(1), F.size(pairs), width)
        blocks = F.transform(firsts, lambda i: summed(F.slice(pairs, i, width)))
        nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<start:int,m:string>>>").alias("found"))

        def step(acc: Column, block: Column) -> Column:
            moved = F.transform(block["found"], lambda x: F.struct((x["start"] + acc["at"]).alias("start"), x["m"].alias("m")))
            return F.struct((acc["at"] + block["at"]).alias("at"), F.concat(acc["found"], F.array(moved)).alias("found"))

        return F.flatten(F.aggregate(blocks, nothing, step, lambda acc: acc["found"]))

    return _bound(pairs, joined)


def _located(text: Column, pattern: str) -> Column:
    """Array of (start, m) of all matches of a pattern without empty matches, leftmost and not overlapping."""

    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(F.slice(gaps, 1, F.size(matches)), matches,
                       lambda g, m: F.struct(g.alias("gap"), m.alias("m")))
    return F.when(F.rlike(text, F.lit(pattern)), _placed(pairs)).otherwise(
        F.array().cast("array<struct<start:int,m:string>>"))


def window_entropy(chars: Column, window: int) -> Column:
    """Highest Shannon entropy, in bits per character, of any ``window`` neighbouring characters of an array.

    A shorter array is one window of its own; an empty one has 0. The time a
    character takes depends on the alphabet alone, not on the length.
    """

    return _bound(chars, lambda bound: _window_entropy(bound, window))


def _window_entropy(chars: Column, window: int) -> Column:
    width = F.least(F.size(chars), F.lit(window))
    bits = window.bit_length()  # a count fits in so many bits; several share a long
    per = 60 // bits

    def place(at: Column) -> Column:
        """Which long a character is counted in, by how many bits its count is shifted, and its one."""

        shift = (at % per * bits).cast("int")
        return F.struct(F.floor(at / per).alias("lane"), shift.alias("shift"),
                        F.call_function("shiftleft", F.lit(1).cast("long"), shift).alias("one"))

    def term(n: Column) -> Column:
        return F.when(n > 1, n * F.log2(n.cast("double"))).otherwise(0.0)

    def carried(places: Column, lanes: Column) -> Column:
        start = F.struct(F.lit(0).alias("i"), lanes.alias("n"), F.lit(0.0).alias("s"), F.lit(0.0).alias("best"))

        def step(acc: Column, come: Column) -> Column:
            gone = F.get(places, acc["i"] - F.lit(window))  # null while the first window fills

            def count(x: Column) -> Column:
                return F.call_function("shiftright", F.get(acc["n"], x["lane"]), x["shift"]).bitwiseAND(F.lit((1 << bits) - 1))

            same = F.coalesce((gone["lane"] == come["lane"]) & (gone["shift"] == come["shift"]), F.lit(False))
            n_in, n_out = count(come), F.coalesce(count(gone), F.lit(0))
            moved = F.transform(acc["n"], lambda v, k: v + F.when(k == come["lane"], come["one"]).otherwise(0)
                                - F.when(F.coalesce(k == gone["lane"], F.lit(False)), gone["one"]).otherwise(0))
            change = F.when(same, 0.0).otherwise(term(n_in + 1) - term(n_in) + term(n_out - 1) - term(n_out))
            total = acc["s"] + change
            entropy = F.log2(width.cast("double")) - total / width
            full = acc["i"] + 1 >= width
            return F.struct((acc["i"] + 1).alias("i"), moved.alias("n"), total.alias("s"),
                            F.when(full, F.greatest(acc["best"], entropy)).otherwise(acc["best"]).alias("best"))

        return F.aggregate(places, start, step, lambda acc: acc["best"])

    def over(distinct: Column) -> Column:
        lanes = F.array_repeat(F.lit(0).cast("long"), F.ceil(F.size(distinct) / per).cast("int"))
        places = F.transform(chars, lambda c: place(F.array_position(distinct, c) - 1))
        return _bound(places, lambda p: _bound(lanes, lambda n: carried(p, n)))

    return F.when(F.size(chars) > 0, _bound(F.array_distinct(chars), over)).otherwise(0.0)


def _has_word(m: Column, cfg: SecretConfig) -> Column:
    low = F.lower(m)
    out = F.lit(False)
    for word in cfg.allow:
        out = out | F.contains(low, F.lit(word))
    return out


def _allowed(m: Column, cfg: SecretConfig) -> Column:
    out = (F.length(m) < 2 * cfg.window) & _has_word(m, cfg)
    for pattern in cfg.allow_patterns:
        out = out | F.rlike(m, F.lit(f"^({pattern})$"))
    return out


def _high(m: Column, cfg: SecretConfig) -> Column:
    """Whether a string's entropy is above the threshold of the first class that holds all of it."""

    threshold = F.lit(None).cast("double")
    for c in reversed(cfg.classes):
        fits = F.rlike(m, F.lit(f"^{c.chars}+$"))
        for need in c.needs:
            fits = fits & F.rlike(m, F.lit(need))
        threshold = F.when(fits, F.lit(c.threshold)).otherwise(threshold)
    return F.coalesce(threshold.isNotNull() & (window_entropy(F.split(m, ""), cfg.window) >= threshold), F.lit(False))


def _entropy_spans(text: Column, cfg: SecretConfig) -> Column:
    """Spans of high entropy: a whole run of the widest class or, where that has none, its pieces between separators.

    A long candidate with allowed words is judged by its parts between them.
    """

    widest = cfg.classes[-1].chars
    # only runs that hold a digit are candidates of any class: the cheap look-ahead skips plain words
    runs = _located(text, rf"(?<!{widest})(?=[A-Za-z+/=_-]*+[0-9]){widest}{{{cfg.window},}}+")
    words = "(?i:" + "|".join(f"\\Q{w}\\E" for w in cfg.allow) + ")"

    def secret(m: Column) -> Column:
        parts = F.when(_has_word(m, cfg), F.split(m, words)).otherwise(F.array(m)) if cfg.allow else F.array(m)
        long = F.filter(parts, lambda p: F.length(p) >= cfg.window)
        return ~_allowed(m, cfg) & F.exists(long, lambda p: _high(p, cfg))

    def judged(run: Column) -> Column:
        m = run["m"]
        start = F.struct(run["start"].alias("at"), F.array().cast("array<struct<start:int,m:string>>").alias("found"))

        def step(acc: Column, piece: Column) -> Column:
            here = F.array(F.struct(acc["at"].alias("start"), piece.alias("m")))
            fits = (F.length(piece) >= cfg.window) & ~F.rlike(piece, F.lit(f"^{cfg.separators}+$"))
            return F.struct((acc["at"] + F.length(piece)).alias("at"),
                            F.when(fits & secret(piece), F.concat(acc["found"], here)).otherwise(acc["found"]).alias("found"))

        # cut before and after each row of separators
        pieces = F.split(m, f"(?<={cfg.separators})(?!{cfg.separators})|(?<!{cfg.separators})(?={cfg.separators})")
        return F.when(secret(m), F.array(run)).when(
            F.rlike(m, F.lit(cfg.separators)) & ~_allowed(m, cfg),
            F.aggregate(pieces, start, step, lambda acc: acc["found"])).otherwise(start["found"])

    return F.flatten(F.transform(runs, judged))


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 cfg: SecretConfig | None = None) -> DataFrame:
    """doc_id and ``found``: array of (start, rank, end, kind) in order of start, then kind as in KINDS.

    Code points, end exclusive; null and empty texts have none. An entropy
    span inside a base span is left out. Rows that repeat stay repeated;
    other columns of ``docs`` are not read.
    """

    cfg = cfg or SecretConfig()
    whole = F.coalesce(F.col("text"), F.lit(""))

    def spans(found: Column, kind: str) -> Column:
        return F.transform(found, lambda x: F.struct(
            x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
            (x["start"] + F.length(x["m"])).alias("end"), F.lit(kind).alias("kind")))

    assign = F.filter(_located(whole, ASSIGN), lambda x: F.length(F.regexp_extract(x["m"], ASSIGN_VALUE, 1)) >= 6)
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).select(
        "doc_id",
        F.concat(spans(assign, "assign"), spans(_located(whole, ACCESS), "access"),
                 spans(_located(whole, HEX), "hex")).alias("base"),
        spans(_entropy_spans(whole, cfg), "entropy").alias("added"),
    )
    return docs.select("doc_id", _bound(F.array_sort(F.concat("base", "added")), _outside_base).alias("found"))


def _outside_base(spans: Column) -> Column:
    """Sorted spans without the entropy spans that lie inside a base span.

    A base span that holds another stands before it, so it is enough to know how
    far the base spans before reach; as in ``_placed``, block by block.
    """

    base = len(BASE_KINDS)
    width = F.ceil(F.sqrt(F.size(spans).cast("double"))).cast("int")
    blocks = F.transform(F.sequence(F.lit(1), F.size(spans), width), lambda i: F.slice(spans, i, width))

    def reach(acc: Column, x: Column) -> Column:
        return F.when(x["rank"] < base, F.greatest(acc, x["end"])).otherwise(acc)

    def swept(blocks: Column) -> Column:
        tops = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), reach))
        first = F.struct(F.lit(0).alias("top"), F.array().cast("array<int>").alias("tops"))
        before = F.aggregate(tops, first, lambda acc, t: F.struct(
            F.greatest(acc["top"], t).alias("top"), F.concat(acc["tops"], F.array(acc["top"])).alias("tops")), lambda acc: acc["tops"])

        def kept(block: Column, top: Column) -> Column:
            none = F.struct(top.alias("top"), F.slice(block, 1, 0).alias("found"))
            return F.aggregate(block, none, lambda acc, x: F.struct(
                reach(acc["top"], x).alias("top"),
                F.when((x["rank"] < base) | (x["end"] > acc["top"]), F.concat(acc["found"], F.array(x))).otherwise(
                    acc["found"]).alias("found")), lambda acc: acc["found"])

        return F.flatten(F.zip_with(blocks, before, kept))

    return F.when(F.size(spans) > 0, _bound(blocks, swept)).otherwise(spans)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  cfg: SecretConfig | None = None) -> DataFrame:
    """One row per document: counts of the base kinds, digest of the base spans, all spans.

    Repeated rows give repeated rows; an empty table gives an empty result;
    other columns of ``docs`` are not read.
    """

    found = find_secrets(docs, doc_id, text, cfg)
    base = F.filter("found", lambda s: s["rank"] < len(BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in BASE_KINDS], F.sha2(_joined(base), 256).alias("base_sha256"),
                        _joined(F.col("found")).alias("spans"))
