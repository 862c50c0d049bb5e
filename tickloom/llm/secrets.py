"""Secret scans as column expressions: three signature kinds, and Shannon entropy over sliding windows.

Strings of 20 or more token characters that hold letters and digits are candidates. For each, a window of 20
characters slides along; the sum of c log c over its character counts changes only by the counts of the character
that enters and the one that leaves, so each step costs two counts. A candidate whose greatest window entropy reaches
the threshold of its character class is a span of kind `entropy`, unless it is an identifier or a path of plain words
as a whole. Windows that hold an example's word, a run or ten characters of an alphabet don't count; others of the same
string do. Of a string that overlaps signature spans, each part outside them is a candidate by itself.

Long texts cost in proportion: candidates are cut into short pieces that overlap by a window less one character before
windows slide, and whatever runs along an array does so in blocks (`along`), since growing an array copies it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The signatures, in the order in which kinds rank.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
#: Characters of a candidate in which windows slide at once.
PIECE = 128
#: Bits that the greatest window entropy of a class must reach: of hexadecimal strings, one letter case, and all others.
LEAST_BITS = {r"^[0-9a-fA-F]+$": 2.9, r"^([0-9a-z_=-]+|[0-9A-Z_=-]+)$": 3.55, r"": 3.75}
#: Runs of a class within a string of a wider one: bits, and how often a letter must follow a digit.
RUNS = {r"[0-9a-fA-F]{20,}": (2.9, 2), r"[0-9a-z_=-]{20,}": (3.55, 3), r"[0-9A-Z_=-]{20,}": (3.55, 3)}
#: Strings that are no secrets as a whole: identifiers of 8-4-4-4-12, paths of plain words.
IDENTIFIER = r"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
ALLOWED = (
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"^/?(?:[A-Za-z]{2,15}[0-9]{0,4}[/_=-]+)++[A-Za-z]{0,15}[0-9]{0,4}$",
)
#: What a window that counts doesn't hold: examples and placeholders, ten characters of an alphabet in a row, runs.
ALPHABETS = ("abcdefghijklmnopqrstuvwxyz", "01234567890123456789", "qwertyuiopasdfghjklzxcvbnm")
_TENS = sorted({a[k : k + 10] for a in ALPHABETS for k in range(len(a) - 9)})
UNCOUNTED = rf"(?i:example|sample|placeholder|changeme|redacted|your[_-]|{'|'.join(_TENS)})|(.)\1{{5,}}"

SPAN = "struct<start:int,rank:int,kind:string,end:int>"
#: Spans that overlap, with the end of the run before; and a candidate with its text.
RUN = "struct<before:int,start:int,end:int>"
HELD = "struct<start:int,rank:int,kind:string,end:int,value:string>"
MASK = "[SECRET]"


def _none(kind: str = SPAN) -> Column:
    return F.array().cast(f"array<{kind}>")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once even where lambdas refer to it again and again."""
    return F.element_at(F.transform(F.array(value), use), 1)


def along(items: Column, begin: Column, step: Callable[[Column, Column], tuple[Column, Column]], out: str, finish: Callable[[Column], Column] | None = None) -> Column:
    """What `step` emits along an array: step(state, x) gives the next state and an array of `out`; then finish(state).

    Blocks of about the square root of the array's size run by themselves from the state before, so that what is emitted
    is copied some square root of n times, not n times.
    """
    made = lambda state, emitted: F.struct(state.alias("state"), emitted.alias("out"))

    def over(own: Column) -> Column:
        n, block, items = own["n"], own["block"], own["items"]

        def within(states: Column, at: Column) -> Column:
            def one(s: Column, x: Column) -> Column:
                state, emitted = step(s["state"], x)
                return made(state, F.concat(s["out"], emitted))

            return F.concat(states, F.array(F.aggregate(F.slice(items, at + 1, block), made(F.element_at(states, -1)["state"], _none(out)), one)))

        starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, block)).otherwise(F.array().cast("array<int>"))
        all_of = lambda states: F.flatten(F.transform(states, lambda x: x["out"]))
        ended = lambda states: F.concat(all_of(states), finish(F.element_at(states, -1)["state"])) if finish else all_of(states)
        return let(F.aggregate(starts, F.array(made(begin, _none(out))), within), ended)

    sized = lambda x: F.struct(x.alias("items"), F.size(x).alias("n"), F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(x))).cast("int")).alias("block"))
    return let(items, lambda x: let(sized(x), over))


def spans_of(text: Column, pattern: str, kind: str, keep=None, held: bool = False) -> Column:
    """Leftmost non-overlapping matches with their places in characters; `keep` tests a match, given it and group 2.

    Split gives what lies between the matches, so running lengths of both give each match's place. held: with the text.
    """
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if kind == "assign" else found
    parts = F.arrays_zip(F.slice(between, F.lit(1), F.size(found)).alias("between"), found.alias("found"), values.alias("value"))
    out = HELD if held else SPAN

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        start = at + F.length(x["between"])
        end = start + F.length(x["found"])
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"), *([x["found"].alias("value")] if held else []))
        return end, F.when(keep(x["found"], x["value"]), F.array(span)).otherwise(_none(out)) if keep else F.array(span)

    return F.when(text.rlike(pattern), along(parts, F.lit(0), step, out)).otherwise(_none(out))


def pieces(text: Column, window: int = WINDOW, size: int = PIECE) -> Column:
    """The text in pieces of `size` characters that overlap by window - 1, so each window lies in one of them."""
    pattern = F.lit(rf"(?s).{{1,{size - window + 1}}}(?=(.{{0,{window - 1}}}))")
    return F.zip_with(F.regexp_extract_all(text, pattern, F.lit(0)), F.regexp_extract_all(text, pattern, F.lit(1)), lambda a, b: F.concat(a, b))


def greatest_entropy(text: Column, window: int = WINDOW, uncounted: str | None = None) -> Column:
    """The greatest Shannon entropy, in bits a character, of any `window` characters in a row; 0 for shorter texts.

    Windows in which the expression `uncounted` is found don't count.
    """
    return F.coalesce(F.array_max(F.transform(pieces(text, window), lambda x: _entropy(x, window, uncounted))), F.lit(0.0))


def _entropy(text: Column, window: int, uncounted: str | None) -> Column:
    """greatest_entropy of one piece: its characters are looked up from its start."""
    term = lambda n: F.when(n > 1, n * F.log2(n)).otherwise(0.0)

    def step(state: Column, at: Column) -> Column:
        """`at`: the place of the character that enters, from 1."""
        held = F.substring(text, F.greatest(at - window, F.lit(1)), F.least(at - 1, F.lit(window)))
        full = at > window
        count = lambda part, char: F.length(part) - F.length(F.replace(part, char, F.lit("")))
        first, new = F.substring(held, F.lit(1), F.lit(1)), F.substring(text, at, F.lit(1))
        leaving = count(held, first)
        after = F.when(full, state["sum"] - term(leaving) + term(leaving - 1)).otherwise(state["sum"])
        kept = F.when(full, F.substring(held, F.lit(2), F.lit(window))).otherwise(held)
        there = count(kept, new)
        total = after - term(there) + term(there + 1)
        bits = F.when(at >= window, F.log2(F.lit(float(window))) - total / window).otherwise(0.0)
        best = F.greatest(state["best"], bits)
        if uncounted:
            best = F.when((bits > state["best"]) & ~F.concat(kept, new).rlike(uncounted), bits).otherwise(state["best"])
        return F.struct(total.alias("sum"), best.alias("best"))

    begin = F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))
    steps = F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, begin, step, lambda s: s["best"])


def secretive(candidate: Column) -> Column:
    """Whether a string of digits and letters has a window that counts of its class's entropy, and it isn't allowed.

    A string of a wide class may hold a run of a narrower one, as a hexadecimal key behind a prefix: windows of such a run
    in which digits and letters alternate are of the run's class.
    """
    least = F.lit(None).cast("double")
    for pattern, bits in reversed(LEAST_BITS.items()):
        least = F.when(candidate.rlike(pattern), F.lit(bits)).otherwise(least) if pattern else F.lit(bits)
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | candidate.rlike(pattern)
    reached = lambda own, uncounted: F.exists(pieces(own["value"]), lambda p: _entropy(p, WINDOW, uncounted) >= own["least"])
    judged = lambda value, bits: let(F.struct(value.alias("value"), bits.alias("least")), lambda own: F.when(own["value"].rlike(UNCOUNTED), reached(own, UNCOUNTED)).otherwise(reached(own, None)))
    enough = judged(candidate, least)

    def has(pattern: str, bits: float, changes: int) -> Column:
        runs = F.regexp_extract_all(candidate, F.lit(pattern), F.lit(0))
        return F.exists(runs, lambda x: (F.regexp_count(x, F.lit("[0-9][A-Za-z]")) >= changes) & ~x.rlike(IDENTIFIER) & judged(x, F.lit(bits)))

    for pattern, (bits, changes) in RUNS.items():
        enough = enough | has(pattern, bits, changes)
    return candidate.rlike("[0-9]") & candidate.rlike("[A-Za-z]") & ~allowed & enough


def outside(candidates: Column, spans: Column) -> Column:
    """The parts of candidates that no span covers, of WINDOW characters at least, each with its text.

    One sweep by start: a span cuts the candidate that is open, a candidate ends the one before.
    """
    events = F.array_sort(F.concat(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["kind"].alias("kind"), x["end"].alias("end"), F.lit(None).cast("string").alias("value"))), candidates))
    entropy = F.lit(KINDS.index("entropy"))

    def part(state: Column, end: Column) -> Column:
        own = F.struct(state["at"].alias("start"), entropy.alias("rank"), F.lit("entropy").alias("kind"), end.alias("end"), F.substring(state["value"], state["at"] - state["start"] + 1, end - state["at"]).alias("value"))
        return F.when(end - state["at"] >= WINDOW, F.array(own)).otherwise(_none(HELD))

    def step(state: Column, x: Column) -> tuple[Column, Column]:
        fresh = x["rank"] == entropy
        covered = F.when(fresh, state["covered"]).otherwise(F.greatest(state["covered"], x["end"]))
        at = F.when(fresh, F.greatest(x["start"], state["covered"])).otherwise(F.greatest(state["at"], x["end"]))
        keep = lambda name: F.when(fresh, x[name]).otherwise(state[name]).alias(name)
        after = F.struct(at.alias("at"), covered.alias("covered"), keep("start"), keep("end"), keep("value"))
        return after, part(state, F.when(fresh, state["end"]).otherwise(F.least(state["end"], x["start"])))

    begin = F.struct(*(F.lit(0).alias(n) for n in ("at", "covered", "start", "end")), F.lit("").alias("value"))
    return F.when(F.size(candidates) > 0, along(events, begin, step, HELD, lambda last: part(last, last["end"]))).otherwise(_none(HELD))


def secret_spans(docs: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """Adds `out`: all spans of the text by start, then kind; start and end count characters, the end excluded.

    A null text counts as empty and has no span. Every column and row stays, repeated rows too; a column of the name
    `out` is replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    base = F.array_sort(F.concat(spans_of(whole, ASSIGN, "assign", lambda found, value: F.length(value) >= ASSIGN_LEAST), spans_of(whole, ACCESS, "access"), spans_of(whole, HEX, "hex")))
    named = _free(docs, "base_spans"), _free(docs, "entropy_spans")
    found = docs.withColumn(named[0], base).withColumn(named[1], spans_of(whole, CANDIDATE, "entropy", held=True))
    parts = F.filter(outside(F.col(named[1]), F.col(named[0])), lambda x: secretive(x["value"]))
    plain = F.transform(parts, lambda x: F.struct(*(x[n].alias(n) for n in ("start", "rank", "kind", "end"))))
    return found.withColumn(named[1], plain).withColumn(out, F.array_sort(F.concat(*named))).drop(*(n for n in named if n != out))


def _free(docs: DataFrame, name: str) -> str:
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 of the signature spans and all spans as a string."""
    found = secret_spans(docs.select(F.col("doc_id").cast("long"), "text"))
    written = lambda spans: F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda x: x["kind"] != "entropy")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def masked(text: Column, spans: Column) -> Column:
    """The text with each span, or run of spans that overlap, replaced by MASK; `spans` are sorted by start."""
    def step(state: Column, x: Column) -> tuple[Column, Column]:
        """state: where the run before the open one ends, and the open run; a gap closes it."""
        apart = x["start"] >= state["end"]
        closed = F.when(apart & (state["end"] > state["start"]), F.array(state)).otherwise(_none(RUN))
        fresh = F.struct(F.when(state["end"] > state["start"], state["end"]).otherwise(state["before"]).alias("before"), x["start"].alias("start"), x["end"].alias("end"))
        return F.when(apart, fresh).otherwise(F.struct(state["before"].alias("before"), state["start"].alias("start"), F.greatest(state["end"], x["end"]).alias("end"))), closed

    def joined(some: Column) -> Column:
        """A block's part of the text is cut out once, and its runs from that part."""
        first, end = F.element_at(some, 1)["before"], F.element_at(some, -1)["end"]
        cut = lambda p: F.transform(p["some"], lambda x: F.substring(p["text"], x["before"] - p["first"] + 1, x["start"] - x["before"]))
        return let(F.struct(some.alias("some"), F.substring(text, first + 1, end - first).alias("text"), first.alias("first")), lambda p: F.array_join(F.concat(cut(p), F.array(F.lit(""))), MASK))

    def whole(runs: Column) -> Column:
        block = F.ceil(F.sqrt(F.size(runs))).cast("int")
        parts = F.transform(F.sequence(F.lit(0), F.size(runs) - 1, block), lambda at: let(F.slice(runs, at + 1, block), joined))
        return F.concat(F.array_join(parts, ""), F.substring(text, F.element_at(runs, -1)["end"] + 1, F.length(text)))

    runs = along(spans, F.struct(*(F.lit(0).alias(n) for n in ("before", "start", "end"))), step, RUN, lambda last: F.array(last))
    return F.when(F.size(spans) > 0, let(runs, whole)).otherwise(text)
