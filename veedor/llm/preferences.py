"""Preference formatting: one prompt and two masked completions from a pair of conversations.

The prompt is the longest common prefix of the turns of the chosen and the rejected conversation
(role and text equal), rendered and encoded once. What is left of each is its completion. The loss
mask of a completion is 1 on what assistants say, with the end mark of the turn, and 0 on headers and
on turns of others.

A conversation is a row for each turn; turns go by number, then role, then text, and rows repeated in
full count once. Null conversation ids are ignored, null roles and texts are empty. A pair with just
one side, or without turns, gives no row. If one conversation is a prefix of the other, or they are
equal, the shorter one's completion is empty and ``usable`` is false. A conversation is put together
in one task, as it becomes one row; nothing larger is. Other columns are ignored. Empty tables give
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches
from .encoding import Encoder


@dataclass(frozen=True)
class ChatTemplate:
    header: str = "<{}>\n"  # before a turn, with its role
    footer: str = "\n<end>\n"  # after a turn
    assistant: str = "assistant"


def conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(id, turns): the turns of each conversation as an array of (role, text)."""
    empty = F.lit("")
    turn = F.struct(F.col(f"`{turn_col}`").alias("turn"), F.coalesce(F.col(f"`{role_col}`"), empty).alias("role"), F.coalesce(F.col(f"`{text_col}`"), empty).alias("text"))
    each = turns.select(F.col(f"`{id_col}`").alias("id"), turn.alias("t")).filter("id is not null").groupBy("id").agg(F.array_sort(F.collect_set("t")).alias("t"))
    return each.select("id", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))


def common_turns(a: Column, b: Column) -> Column:
    """How many turns two arrays have in common at their beginning."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(differs > 0, differs - 1).otherwise(F.size(a)).cast("int")


def _rendered(turns: Column, template: ChatTemplate) -> Column:
    head, tail = template.header.split("{}")
    return F.transform(
        turns,
        lambda t: F.struct(F.concat(F.lit(head), t["role"], F.lit(tail)).alias("head"), F.concat(t["text"], F.lit(template.footer)).alias("body"), (t["role"] == template.assistant).alias("loss")),
    )


def _joined(parts: Column) -> Column:
    return F.array_join(F.transform(parts, lambda p: F.concat(p["head"], p["body"])), "")


def _loss_chars(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0), lambda n, p: n + F.when(p["loss"], F.length(p["body"])).otherwise(0)).cast("long")


def _mask(parts: Column) -> Column:
    """The loss mask over a completion's characters, as runs: ``0*11 1*14`` is 11 characters without and 14 with loss."""
    return F.array_join(F.transform(parts, lambda p: F.concat(F.lit("0*"), F.length(p["head"]), F.lit(" "), p["loss"].cast("int"), F.lit("*"), F.length(p["body"]))), " ")


def format_preferences(pairs: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """pairs: id, chosen and rejected, arrays of (role, text). Adds the rendered sides.

    id, n_common_turns, prompt, chosen, rejected (texts), chosen_parts, rejected_parts (header, body
    and loss flag of each turn), chosen_mask, rejected_mask (runs of characters), chosen_loss,
    rejected_loss (characters under the mask), usable.
    """
    both = pairs.filter("size(chosen) > 0 and size(rejected) > 0").withColumn("n_common_turns", common_turns(F.col("chosen"), F.col("rejected")))
    rest = lambda side: _rendered(F.slice(side, F.col("n_common_turns") + 1, F.size(side)), template)
    both = both.select("id", "n_common_turns", _joined(_rendered(F.slice("chosen", F.lit(1), F.col("n_common_turns")), template)).alias("prompt"), rest("chosen").alias("chosen_parts"), rest("rejected").alias("rejected_parts"))
    return both.select(
        "*",
        _joined(F.col("chosen_parts")).alias("chosen"),
        _joined(F.col("rejected_parts")).alias("rejected"),
        _mask(F.col("chosen_parts")).alias("chosen_mask"),
        _mask(F.col("rejected_parts")).alias("rejected_mask"),
        _loss_chars(F.col("chosen_parts")).alias("chosen_loss"),
        _loss_chars(F.col("rejected_parts")).alias("rejected_loss"),
        ((F.size("chosen_parts") > 0) & (F.size("rejected_parts") > 0)).alias("usable"),
    )


def encode_preferences(formatted: DataFrame, tokenizer: str) -> DataFrame:
    """Adds prompt_ids, and ids and mask of each completion, to what ``format_preferences`` gives."""
    small_batches(formatted.sparkSession)
    kept = ["id", "n_common_turns", "usable"]
    kinds = dict(formatted.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, plain_specials=True)
        ids_of = lambda texts: [memoryview(x).cast("B") for x in encoder.encode([t.encode("utf-8", "replace") for t in texts])]
        import numpy as np

        array = lambda data: np.frombuffer(data, encoder.dtype).astype(np.int32)
        for batch in batches:
            cols = [batch.column(i) for i in range(len(kept))]
            cols.append(pa.array([array(x) for x in ids_of(batch.column("prompt").to_pylist())], pa.list_(pa.int32())))
            for side in ("chosen_parts", "rejected_parts"):
                ids, masks = [], []
                for parts in batch.column(side).to_pylist():
                    coded = [array(x) for x in ids_of([s for p in parts for s in (p["head"], p["body"])])]
                    flags = [f for p in parts for f in (0, int(bool(p["loss"])))]
                    ids.append(np.concatenate(coded) if coded else np.zeros(0, np.int32))
                    masks.append(np.repeat(flags, [len(x) for x in coded]).astype(np.int8) if coded else np.zeros(0, np.int8))
                cols += [pa.array(ids, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.int8()))]
            yield pa.RecordBatch.from_arrays(cols, [*kept, "prompt_ids", "chosen_ids", "chosen_mask", "rejected_ids", "rejected_mask"])

    schema = ", ".join(f"{k} {kinds[k]}" for k in kept) + ", prompt_ids array<int>, chosen_ids array<int>, chosen_mask array<tinyint>, rejected_ids array<int>, rejected_mask array<tinyint>"
    return formatted.select(*kept, "prompt", "chosen_parts", "rejected_parts").mapInArrow(run, schema)


def reply_pairs(turns: DataFrame, assistant: str = "assistant", **cols) -> DataFrame:
    """Pairs from single conversations: (id, chosen, rejected).

    chosen is the conversation up to its last assistant turn. In rejected one reply, which a hash of
    the id picks among all assistant turns but an opening one, says what the turn before it says; the
    turns after it are the same. So pairs part at any depth, and not at all where the reply is an echo
    already. Conversations without a reply to some turn give no pair.
    """
    talks = conversations(turns, **cols)
    replies = F.filter(F.transform("turns", lambda t, i: F.when((t["role"] == assistant) & (i > 0), i)), lambda i: i.isNotNull())
    talks = talks.withColumn("replies", replies).filter("size(replies) > 0")
    digest = F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 8), 16, 10).cast("long")
    talks = talks.withColumn("k", F.get("replies", F.pmod(digest, F.size("replies")).cast("int"))).withColumn("last", F.element_at("replies", -1))
    echo = F.struct(F.lit(assistant).alias("role"), F.get("turns", F.col("k") - 1)["text"].alias("text"))
    chosen = F.slice("turns", F.lit(1), F.col("last") + 1)
    return talks.select("id", chosen.alias("chosen"), F.transform(chosen, lambda t, i: F.when(i == F.col("k"), echo).otherwise(t)).alias("rejected"))
