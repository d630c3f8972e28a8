"""Token counts by offset-mapped attribution.

A document is encoded once, as a whole.  Every token has a span of characters; sections are spans of
characters too, and an interval join of the two gives each section its tokens.  A token that crosses
a boundary goes where the rule says: ``start`` (the section of its first character), ``most`` (the
section with most of its characters, the first of equals) or ``share`` (each section its part).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, tidy
from .tokens import RANKS, encoder, token_bytes

RULES = ("start", "most", "share")


def token_spans(text: str, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first character, end) of each token.  Tokens within one character both span it."""
    end = np.cumsum(sizes[ids])
    start = end - sizes[ids]
    raw = text.encode()
    if len(raw) == len(text):
        return start, end
    char = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80) - 1
    return char[start], char[end - 1] + 1


def line_starts(text: str) -> np.ndarray:
    """Start of each line; a line has its line feed.  An empty text is one line."""
    cps = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    at = np.flatnonzero(cps == 10) + 1
    return np.concatenate([[0], at[at < len(cps)]]).astype(np.int64)


def attribute(start: np.ndarray, end: np.ndarray, bounds: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each section; section i is bounds[i] to bounds[i + 1], in order and without gaps."""
    n = len(bounds) - 1
    first = np.searchsorted(bounds, start, side="right") - 1
    if rule == "start":
        return np.bincount(first, minlength=n).astype(float)
    last = np.searchsorted(bounds, end, side="left") - 1
    inside = first == last
    out = np.bincount(first[inside], minlength=n).astype(float)
    for t in np.flatnonzero(~inside):  # tokens that cross a boundary: few
        cuts = np.concatenate([[start[t]], bounds[first[t] + 1 : last[t] + 1], [end[t]]])
        part = np.diff(cuts)
        if rule == "most":
            out[first[t] + int(part.argmax())] += 1
        else:
            out[first[t] : last[t] + 1] += part / (end[t] - start[t])
    return out


def count_tokens(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sections_col: str | None = None, rule: str = "start", ranks: str = RANKS, special: bool = False
) -> DataFrame:
    """(id, section, start, end, n_tokens) for every section of every row.

    Sections begin at the offsets in ``sections_col`` (an array of longs; what is before the first
    one is section 0 as well) or, without it, at each line.  Counts of a row's sections add up to the
    tokens of its whole text, in which ``<|endoftext|>`` is one token if ``special``.  Null and empty texts have one
    empty section with no tokens; repeated rows each have their sections; other columns aren't looked at; an empty
    table gives no rows; texts of any length are encoded whole.
    """
    small_batches(docs.sparkSession)
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    cols = [F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text")]
    rows = docs.select(*cols, *([F.col(sections_col).cast("array<bigint>").alias("_at")] if sections_col else []))
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, sizes = encoder(ranks, special), token_bytes(ranks)
        for b in batches:
            given = b.column(2).to_pylist() if sections_col else None
            row, columns = [], [[], [], [], []]
            for i, text in enumerate(b.column("_text").to_pylist()):
                if given is None:
                    starts = line_starts(text)
                else:
                    starts = np.array(sorted({0, *(x for x in given[i] or () if x is not None and 0 < x < len(text))}), np.int64)
                bounds = np.append(starts, len(text))
                ids = np.array(encode(text), np.int64)
                n = attribute(*token_spans(text, ids, sizes), bounds, rule) if len(ids) else np.zeros(len(starts))
                row.append(len(starts))
                for c, x in zip(columns, (np.arange(len(starts)), bounds[:-1], bounds[1:], n)):
                    c.append(x)
            if row:
                ids = b.column(0).take(pa.array(np.repeat(np.arange(len(row)), row)))
                section, start, end, n = (np.concatenate(c) for c in columns)
                yield pa.RecordBatch.from_arrays([ids, pa.array(section, pa.int32()), pa.array(start), pa.array(end), pa.array(n)], ["_id", "section", "start", "end", "n_tokens"])

    out = rows.mapInArrow(tidy(run), f"_id {kind}, section int, start long, end long, n_tokens double")
    return out.withColumn("n_tokens", F.col("n_tokens").cast("long") if rule != "share" else F.col("n_tokens")).withColumnRenamed("_id", id_col)


def op9_token_counts(spark, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document; a token counts where it starts."""
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), special=True)
