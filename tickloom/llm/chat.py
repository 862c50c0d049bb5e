"""Conversations as training text in one template, with a loss mask, in Spark expressions only.

A run of an assistant's turns is `<s>text[TURN]text</s>`, a run of another role's `[INST]role[SAYS]text[TURN]text[/INST]`.
Texts and roles can't imitate a marker: in them every backslash is doubled and every marker gets one after its first
character, which `unescaped` takes back. A marker holds `[` or `<` only at its start and `]` or `>` only at its end,
so none arises where a text meets a marker.

Turns are collected by conversation and span of 64 turn numbers, sorted and merged there, and the spans of a
conversation are joined by length and role at their ends; so a long conversation is formatted in many tasks.

Defined results: null texts and roles count as empty. Turns go by number, nulls first, and equal numbers by role and text;
repeated rows stay. Rows without conv_id form one conversation. An empty table gives none. A conversation's text is
one value of at most 2 GB, and turns that share a number, or have none, meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The template's markers.
ASK, SAYS, ASKED, ANSWER, ANSWERED, NEXT = "[INST]", "[SAYS]", "[/INST]", "<s>", "</s>", "[TURN]"
MARKERS = (ASK, SAYS, ASKED, ANSWER, ANSWERED, NEXT)
SPAN = 64


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for m in MARKERS:
        text = F.replace(text, F.lit(m), F.lit(f"{m[0]}\\{m[1:]}"))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _opening(role: Column) -> Column:
    return F.when(role == "assistant", F.lit(ANSWER)).otherwise(F.concat(F.lit(ASK), role, F.lit(SAYS)))


def _closing(role: Column) -> Column:
    return F.when(role == "assistant", F.lit(ANSWERED)).otherwise(F.lit(ASKED))


def _lead(before: Column, role: Column) -> Column:
    """What stands between a turn and the one before it."""
    return F.when(before.isNull(), _opening(role)).when(before == role, F.lit(NEXT)).otherwise(F.concat(_closing(before), _opening(role)))


RUNS = "array<struct<role: string, texts: array<string>>>"
MASK = "struct<at: bigint, spans: array<struct<start: bigint, end: bigint>>>"


def _merged(turns: Column) -> Column:
    """RUNS of sorted turns: adjacent turns of one role are one run."""

    def add(runs: Column, t: Column) -> Column:
        last, texts = F.try_element_at(runs, F.lit(-1)), F.array(escaped(t["text"]))
        role = escaped(t["role"])
        longer = F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(F.struct(role.alias("role"), F.concat(last["texts"], texts).alias("texts"))))
        return F.when((F.size(runs) > 0) & (last["role"] == role), longer).otherwise(F.concat(runs, F.array(F.struct(role.alias("role"), texts.alias("texts")))))

    return F.aggregate(turns, F.array().cast(RUNS), add)


def _mask(runs: Column) -> Column:
    """MASK: the code points of the runs without the first one's lead, and where among them an assistant speaks."""

    def add(mask: Column, run: Column, k: Column) -> Column:
        lead = F.when(k == 0, 0).otherwise(F.length(_lead(runs[k - 1]["role"], run["role"])))

        def one(done: Column, text: Column) -> Column:
            start = done["at"] + F.when(done["first"], lead).otherwise(len(NEXT))
            end = start + F.length(text)
            spans = F.when(run["role"] == "assistant", F.concat(done["spans"], F.array(F.struct(start.alias("start"), end.alias("end"))))).otherwise(done["spans"])
            return F.struct(end.alias("at"), spans.alias("spans"), F.lit(False).alias("first"))

        begun = F.struct(mask["at"].alias("at"), mask["spans"].alias("spans"), F.lit(True).alias("first"))
        return F.aggregate(run["texts"], begun, one, lambda x: F.struct(x["at"].alias("at"), x["spans"].alias("spans")))

    numbered = F.transform(runs, lambda run, k: F.struct(run.alias("run"), k.alias("k")))
    return F.aggregate(numbered, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start: bigint, end: bigint>>").alias("spans")).cast(MASK), lambda mask, x: add(mask, x["run"], x["k"]).cast(MASK))


def format_conversations(turns: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(id, n_turns, formatted, loss_spans): loss_spans are the [start, end) code points of each assistant text, in order."""
    none = F.lit("")
    rows = turns.select(F.col(id).alias("id"), F.floor(F.col(turn) / SPAN).alias("span"), F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), none).alias("role"), F.coalesce(F.col(text), none).alias("text")).alias("x"))
    spans = rows.groupBy("id", "span").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("x")).alias("turns")).select("id", "span", "n", _merged(F.col("turns")).alias("runs"))
    body = F.array_join(F.transform("runs", lambda r, k: F.concat(F.when(k == 0, "").otherwise(_lead(F.col("runs")[k - 1]["role"], r["role"])), F.array_join(r["texts"], NEXT))), "")
    spans = spans.select("id", "span", "n", F.col("runs")[0]["role"].alias("first"), F.element_at("runs", -1)["role"].alias("last"), body.alias("body"), _mask(F.col("runs")).alias("mask"))
    w = Window.partitionBy("id").orderBy(F.asc_nulls_first("span"))
    led = spans.withColumn("lead", _lead(F.lag("last").over(w), F.col("first")))
    size = F.length("lead") + F.col("mask.at")
    led = led.withColumn("at", F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("mask.at"))
    moved = F.transform("mask.spans", lambda s: F.struct((s["start"] + F.col("at")).alias("start"), (s["end"] + F.col("at")).alias("end")))
    piece = F.struct("at", F.concat("lead", "body").alias("piece"), moved.alias("spans"), "last")
    whole = led.select("id", "n", piece.alias("p")).groupBy("id").agg(F.sum("n").alias("n_turns"), F.sort_array(F.collect_list("p")).alias("p"))
    joined = F.concat(F.array_join(F.transform("p", lambda p: p["piece"]), ""), _closing(F.element_at("p", -1)["last"]))
    return whole.select(F.col("id").alias(id), "n_turns", joined.alias("formatted"), F.flatten(F.transform("p", lambda p: p["spans"])).alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array<struct<role, text>>."""
    runs = F.split(formatted, r"(?=\[INST\]|<s>)")

    def one(run: Column) -> Column:
        own = F.startswith(run, F.lit(ANSWER))
        named = F.substring_index(run, SAYS, 1)
        role = F.when(own, F.lit("assistant")).otherwise(unescaped(F.substring(named, len(ASK) + 1, 1 << 30)))
        head = F.when(own, len(ANSWER)).otherwise(F.length(named) + len(SAYS))
        tail = F.when(own, len(ANSWERED)).otherwise(len(ASKED))
        texts = F.split(F.substring(run, head + 1, F.length(run) - head - tail), r"\[TURN\]")
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(runs, one))


def read_loss(formatted: Column) -> Column:
    """The texts under the loss mask, as the markers set it."""
    answers = F.regexp_extract_all(formatted, F.lit(r"(?s)<s>(.*?)</s>"), 1)
    return F.flatten(F.transform(answers, lambda a: F.transform(F.split(a, r"\[TURN\]"), unescaped)))


def digest(formatted: DataFrame, id: str = "conv_id") -> DataFrame:
    """Counts and hashes of what is read back from formatted conversations."""
    read = formatted.select(id, read_turns(F.col("formatted")).alias("turns"), F.array_join(read_loss(F.col("formatted")), "").alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(id, F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
