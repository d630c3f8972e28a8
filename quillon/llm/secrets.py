"""Secret scans with multipart credential linking.

Strong patterns (an assignment to a secret-like name, an access key id, a long hex string) count
by themselves.  Weak parts (a login name, a short or unnamed secret, an endpoint) count only where
complementary parts stand near them in the same scope: parts are intervals of a text, scopes are
its paragraphs, and an interval join within scopes finds what co-occurs.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import save, tidy

#: Code points between parts that belong together.
REACH = 400

# The strong patterns.
ASSIGN = re.compile(
    r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_LONG = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "login", "weak", "endpoint")
# The weak patterns and the role of each kind.
LOGIN = re.compile(r"(?ai)(?<![A-Za-z0-9])(?:user(?:name|_?id)?|login|account|client_?id|access_?key(?:_?id)?)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9_.@-]{3,}")
WEAK = re.compile(r"(?ai)(?<![A-Za-z0-9])(?:pwd|pass|credential|signature|private_?key|auth)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{4,}")
# Runs of these characters with a digit, a capital and a small letter.
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{24,}")
ENDPOINT = re.compile(r"(?ai)\b(?:https?|ftp|s3|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s\"'<>]+|(?<![A-Za-z0-9])(?:host|endpoint|server)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9.-]{4,}(?::[0-9]+)?")
DIGIT, SMALL, CAPITAL = (re.compile(p) for p in ("[0-9]", "[a-z]", "[A-Z]"))
ROLE = {"assign": "secret", "hex": "secret", "weak": "secret", "access": "id", "login": "id", "endpoint": "endpoint"}

PART = "struct<kind:string,start:long,end:long,scope:long>"
SCANNED = f"text_key string, n_assign long, n_access long, n_hex long, base string, parts array<{PART}>"


def text_key(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, order of the kind, kind, end) of the strong findings, by start and then kind."""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8] if ":" in text or "=" in text else []
    found += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    # runs of hex digits of 32 and more are the runs that the plain pattern finds and keeps
    found += [(m.start(), 2, "hex", m.end()) for m in HEX_LONG.finditer(text)]
    return sorted(found)


def weak_spans(text: str) -> list[tuple[int, int, str, int]]:
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 3, "login", m.end()) for m in LOGIN.finditer(text)]
        found += [(m.start(), 4, "weak", m.end()) for m in WEAK.finditer(text)]
        found += [(m.start(), 5, "endpoint", m.end()) for m in ENDPOINT.finditer(text)]
    found += [(m.start(), 4, "weak", m.end()) for m in OPAQUE.finditer(text) if mixed(m[0])]
    return sorted(found)


def mixed(run: str) -> bool:
    return all(p.search(run) for p in (DIGIT, SMALL, CAPITAL))


def outside(spans: list[tuple[int, int, str, int]], taken: list[tuple[int, int, str, int]]) -> list[tuple[int, int, str, int]]:
    """``spans`` that don't overlap any of ``taken`` (sorted by start)."""
    starts, ends = [], []
    for start, _, _, end in taken:  # joined where they overlap
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return [x for x in spans if not (k := bisect_left(starts, x[3])) or ends[k - 1] <= x[0]]


def scan_text(text: str) -> tuple:
    """One text's strong findings, and all of its parts with their paragraph's start."""
    strong = base_spans(text)
    weak = outside(weak_spans(text), strong)
    parts = []
    if weak:  # strong parts alone have nothing to link
        scope, after = 0, text.find("\n\n")
        for start, _, kind, end in sorted(strong + weak):
            while 0 <= after <= start - 2:
                scope, after = after + 1, text.find("\n\n", after + 1)
            parts.append({"kind": kind, "start": start, "end": end, "scope": scope})
    n = [sum(x[2] == k for x in strong) for k in KINDS[:3]]
    return (*n, ",".join(f"{k}:{s}:{e}" for s, _, k, e in strong), parts)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_key, n_assign, n_access, n_hex, base, parts) of every row; text_key names the text."""
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    kind = rows.schema[id_col].dataType.simpleString()

    parts = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("scope", pa.int64())]))
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), parts]
    names = ["text_key", "n_assign", "n_access", "n_hex", "base", "parts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(text_key(t), *scan_text(t)) for t in b.column("_text").to_pylist()]
            columns = [pa.array(x, k) for x, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], ["_id", *names])

    return rows.mapInArrow(tidy(run), f"_id {kind}, {SCANNED}").withColumnRenamed("_id", id_col)


def link(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """(text_key, kind, start, end) of the weak parts that complementary parts support.

    ``parts`` has (text_key, kind, start, end, scope).  Within a scope, intervals are joined to the
    intervals that begin within ``reach`` of them by a range frame, so a scope with many parts
    yields one row per part, not one per pair.  A weak secret needs an id near it, a login a secret,
    and an endpoint both.
    """
    role = F.create_map(*[F.lit(x) for kv in ROLE.items() for x in kv])[F.col("kind")]
    near = W.partitionBy("text_key", "scope").orderBy("start").rangeBetween(-reach, reach)
    near = {r: F.max(F.when(F.col("role") == r, 1).otherwise(0)).over(near) == 1 for r in ("id", "secret")}
    parts = parts.withColumn("role", role).withColumn("id_near", near["id"]).withColumn("secret_near", near["secret"])
    ok = (
        F.when(F.col("kind") == "weak", F.col("id_near"))
        .when(F.col("kind") == "login", F.col("secret_near"))
        .when(F.col("kind") == "endpoint", F.col("id_near") & F.col("secret_near"))
    )
    return parts.filter(ok).select("text_key", "kind", "start", "end")


def find_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """(id, text_key, n_assign, n_access, n_hex, base, linked) for every row of ``docs``.

    ``base`` has the strong spans as kind:start:end, ``linked`` (an array, null for none) the weak
    ones that complementary parts support.  Null and empty texts have no spans; repeated rows each
    get their row, also where ids are null or repeated; other columns are not looked at; an empty table
    gives no rows.  A text that many rows share is linked once, and a text of any length is scanned
    whole, in time in proportion to its length.  Paragraphs end at two line feeds in a row; where lines end in
    carriage return and line feed the text is one paragraph, and ``reach`` alone bounds what is linked.
    """
    rows = save(scan(docs, id_col, text_col), "secrets")
    parts = rows.filter(F.size("parts") > 0).groupBy("text_key").agg(F.first("parts").alias("parts"))
    linked = link(parts.select("text_key", F.inline("parts")), reach)
    linked = linked.groupBy("text_key").agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias("linked"))
    linked = save(linked, "secret-links").withColumnRenamed("text_key", "_key")
    return rows.drop("parts").join(linked, F.col("text_key") == F.col("_key"), "left").drop("_key")


def redact(docs: DataFrame, found: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of ``found`` (from ``find_secrets`` on the same texts) replaced by
    ``[SECRET]``.  All other rows and columns stay as they are.

    Findings are joined by the text's digest, one row per text that has any, so repeated rows,
    repeated ids and null ids are handled alike; null texts stay null; an empty table stays empty.
    """
    has = found.filter((F.col("base") != "") | F.col("linked").isNotNull())
    has = has.groupBy(F.col("text_key").alias("_key")).agg(F.first("base").alias("_base"), F.first("linked").alias("_linked"))
    has = save(has, "secret-spans")

    @F.pandas_udf("string")
    def key(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: text_key(t or ""))

    @F.pandas_udf("string")
    def cut(texts: pd.Series, base: pd.Series, linked: pd.Series) -> pd.Series:
        def one(t, b, more):
            spans = [tuple(map(int, x.split(":")[1:])) for x in b.split(",") if x] + [(x["start"], x["end"]) for x in (more if more is not None else ())]
            out, at = [], 0
            for s, e in sorted(spans):
                if s >= at:
                    out += [t[at:s], "[SECRET]"]
                at = max(at, e)
            return "".join([*out, t[at:]])

        return pd.Series([None if t is None else one(t, b, m) for t, b, m in zip(texts, base, linked)], dtype=object)

    names = docs.columns
    hit = docs.withColumn("_text_key", key(F.col(text_col))).join(has, F.col("_text_key") == F.col("_key"), "left")
    # texts without findings don't go to Python again
    new = F.coalesce(cut(F.when(F.col("_key").isNotNull(), F.col(text_col)), F.col("_base"), F.col("_linked")), F.col(text_col))
    return hit.withColumn(text_col, new).select(*names)


def op3_secrets(spark, sf_dir: str) -> DataFrame:
    """Secrets in every document: counts, digest of the strong spans, and all spans."""
    found = find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    strong = F.transform(
        F.filter(F.split("base", ","), lambda x: x != ""),
        lambda x: F.struct(
            F.split(x, ":")[1].cast("long").alias("start"),
            F.split(x, ":")[2].cast("long").alias("end"),
            F.split(x, ":")[0].alias("kind"),
        ),
    )
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    every = F.array_sort(
        F.transform(F.concat(strong, F.col("linked")), lambda x: F.struct(x["start"].alias("start"), rank[x["kind"]].alias("rank"), x["end"].alias("end"), x["kind"].alias("kind")))
    )
    text = F.array_join(F.transform(every, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), F.when(F.col("linked").isNull(), F.col("base")).otherwise(text).alias("spans")
    )
