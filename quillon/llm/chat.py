r"""Chat formatting with a grammar round trip.

A conversation is rendered turn by turn as ``### role: text </turn>`` lines.  A deterministic parser
reads the rendering back; where it recovers other turns than the source, control strings inside
the texts are escaped with a backslash and the turn is rendered and read again, until both agree.

    turn := "### " role ": " text " </turn>\n"
    text := characters, where every control string ("### " or "</turn>") has a backslash before it,
            one more than in the source
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches

#: Turns of the conversation that is added to every input of the query.
EXTRA = (-7, r"\### Assistant: </turn> ok")

OPEN, CLOSE = "### ", "</turn>"
CONTROL = re.compile(r"### |</turn>")
ESCAPED = re.compile(r"\\(### |</turn>)")
BARE = re.compile(r"(?<!\\)(?:### |</turn>)")
ROLE_ESCAPE = re.compile(r"[^A-Za-z0-9_-]")
TURN = re.compile(r"### ([A-Za-z0-9_%-]*): (.*?) (?<!\\)</turn>\n", re.S)


def escape(text: str) -> str:
    """One more backslash before every control string, whatever backslashes are there already."""
    return CONTROL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def role_name(role: str) -> str:
    """Role for a turn's head: other characters than letters, digits, _ and - as %hex%."""
    return ROLE_ESCAPE.sub(lambda m: f"%{ord(m[0]):x}%", role)


def role_read(name: str) -> str:
    return re.sub(r"%([0-9a-f]+)%", lambda m: chr(int(m[1], 16)), name)


def render(role: str, body: str) -> str:
    return f"{OPEN}{role_name(role)}: {body} {CLOSE}\n"


def parse(rendered: str) -> list[tuple[str, str]] | None:
    """(role, body) of each turn; None if the text is not a sequence of turns."""
    turns, at = [], 0
    while at < len(rendered):
        m = TURN.match(rendered, at)
        if not m:
            return None
        body = m[2]
        if BARE.search(body):  # within a turn
            return None
        turns.append((role_read(m[1]), unescape(body)))
        at = m.end()
    return turns


def format_turn(role: str, text: str) -> str:
    """Rendering of one turn that the parser reads back as exactly this turn."""
    for body in (text, escape(text)):
        done = render(role, body)
        if parse(done) == [(role, text)]:
            return done
    raise ValueError(f"turn can't be rendered: {text[:80]!r}")


def format_turns(rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", trained: str = "assistant") -> DataFrame:
    """(conv, turn, role, formatted, mask_start, mask_end), one row per turn.

    ``formatted`` is the turn's rendering, checked by the round trip; the mask spans the text of
    ``trained`` turns within it (code points; both null for other roles).  Joined in order of turn
    they are the conversation.  Null roles and texts are empty; other columns are left aside.  Rows
    are formatted one by one: repeated rows and null ids or turns stay as they are, an empty table gives
    no rows, and a text of any length takes time in proportion to its length.
    """
    small_batches(rows.sparkSession)
    kind = {c: rows.schema[c].dataType.simpleString() for c in (conv_col, turn_col)}
    rows = rows.select(F.col(conv_col).alias("_conv"), F.col(turn_col).alias("_turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("_role"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            roles = b.column("_role").to_pylist()
            done = [format_turn(r, t) for r, t in zip(roles, b.column("_text").to_pylist())]
            lo = [len(OPEN) + len(role_name(r)) + 2 if r == trained else None for r in roles]
            hi = [len(d) - len(CLOSE) - 2 if s is not None else None for d, s in zip(done, lo)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array(done, pa.string()), pa.array(lo, pa.int64()), pa.array(hi, pa.int64())],
                ["_conv", "_turn", "_role", "formatted", "mask_start", "mask_end"],
            )

    out = rows.mapInArrow(run, f"_conv {kind[conv_col]}, _turn {kind[turn_col]}, _role string, formatted string, mask_start long, mask_end long")
    return out.withColumnsRenamed({"_conv": conv_col, "_turn": turn_col, "_role": role_col})


class _Digest:
    """What one conversation's renderings say, read turn by turn so that none is held whole."""

    def __init__(self) -> None:
        self.turns, self.all, self.loss, self.n, self.loss_chars, self.chars = 0, hashlib.sha256(), hashlib.sha256(), 0, 0, 0

    def add(self, formatted: str, lo, hi) -> None:
        for role, text in parse(formatted):
            self.n += 1
            self.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        if lo is not None and not pd.isna(lo):
            text = unescape(formatted[int(lo) : int(hi)])
            self.loss_chars += len(text)
            self.loss.update(text.encode("utf-8", "surrogatepass"))
        self.chars += len(formatted)


def digest_conversations(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role") -> DataFrame:
    """One row per conversation, read back from ``format_turns``' output.

    Rows are sorted by conversation and turn within partitions and streamed: a conversation of any
    length needs the memory of one batch.  Turns with one number go by role and rendering, null ones
    first; repeated rows count as often as they occur; rows with a null id are one conversation with
    that id; an empty table gives no rows.
    """
    kind = turns.schema[conv_col].dataType.simpleString()
    turns = turns.select(F.col(conv_col).cast("string").alias("_conv"), F.col(turn_col).alias("_turn"), F.col(role_col).alias("_role"), "formatted", "mask_start", "mask_end")
    turns = turns.repartition("_conv").sortWithinPartitions("_conv", "_turn", "_role", "formatted")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, digest, done = None, None, []
        for b in batches:
            for conv, formatted, lo, hi in zip(b["_conv"], b["formatted"], b["mask_start"], b["mask_end"]):
                if digest is None or conv != now:
                    if digest is not None:
                        done.append((now, digest))
                    now, digest = conv, _Digest()
                digest.add(formatted, lo, hi)
            if done:
                yield frame(done)
                done = []
        if digest is not None:
            yield frame([(now, digest)])

    def frame(done: list) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "_conv": pd.Series([c for c, _ in done], dtype=object),
                "n_turns": [d.n for _, d in done],
                "turns_sha256": [d.all.hexdigest() for _, d in done],
                "loss_chars": [d.loss_chars for _, d in done],
                "loss_sha256": [d.loss.hexdigest() for _, d in done],
                "formatted_chars": [d.chars for _, d in done],
            }
        )

    out = turns.mapInPandas(run, "_conv string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return out.withColumn("_conv", F.col("_conv").cast(kind)).withColumnRenamed("_conv", conv_col)


def with_extra(spark: SparkSession, rows: DataFrame) -> DataFrame:
    conv, text = EXTRA
    extra = spark.range(2).select(
        F.lit(conv).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text")
    )
    return rows.select("conv_id", "turn", "role", "text").unionByName(extra)


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one with control strings in its texts, formatted and read back."""
    rows = with_extra(spark, spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return digest_conversations(format_turns(rows))
