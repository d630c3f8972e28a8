"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  A trigram's vector binds the vectors of its letters,
each rotated by its place, by multiplication; a text's vector is the bundle (sum) of its trigrams'
vectors, and a language's prototype is the bundle of its texts, each at the same length.  A text gets
the language whose prototype has the largest cosine with it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, tidy

#: Components of the vectors.
DIM = 512
#: Letters are told apart by classes: 0 parts words, a-z have their own, others share the rest.
CLASSES = 1024
SEED = 20_240_501
#: Expected number of training texts for each language (a hash of the id picks them).
TRAIN_PER_LANG = 3000
#: Components of a training text's vector are rounded to this many parts of its length, so that sums
#: of them don't depend on the order of rows.
PARTS = 100_000
#: Part of a language's training texts that have a trigram, from which on it is familiar.
FAMILIAR = 0.001
#: Share of unfamiliar trigrams that is allowed in any case and at most, and the allowance in standard
#: deviations for texts with few trigrams.
LEAST_SHARE, MOST_SHARE, DEVIATIONS = 0.15, 0.5, 3.0
#: Distinct trigrams from which on a held-out text tells its share of unfamiliar ones, and the quantile taken.
LONG, QUANTILE = 64, 0.999


@lru_cache(maxsize=1)
def letter_classes() -> np.ndarray:
    """Class of each code point; 0 for what is no letter."""
    out = np.zeros(0x110000, np.uint16)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = ord(c.lower()[0])
            out[cp] = low - 96 if 97 <= low <= 122 else 27 + low * 2654435761 % 2**32 % (CLASSES - 27)
    return out


@lru_cache(maxsize=1)
def letter_vectors() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors of the classes at the first, second and third place of a trigram."""
    v = np.random.default_rng(SEED).integers(0, 2, (CLASSES, DIM), dtype=np.int8) * 2 - 1
    return np.roll(v, 2, axis=1), np.roll(v, 1, axis=1), v


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Codes and numbers of a text's trigrams; None if it has no letter.

    Runs of other characters count as one space, and the text begins and ends with one.
    """
    cps = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    c = letter_classes()[cps]
    c = np.concatenate([[0], c, [0]])
    c = c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])].astype(np.int64)
    if len(c) < 3:
        return None
    return np.unique((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], return_counts=True)


def bundle(codes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sum of the vectors of all trigrams of a text."""
    first, second, third = letter_vectors()
    out = np.zeros(DIM)
    for i in range(0, len(codes), 4096):  # bounded memory for texts with very many trigrams
        x = codes[i : i + 4096]
        v = first[x // CLASSES**2] * second[x // CLASSES % CLASSES] * third[x % CLASSES]
        out += n[i : i + 4096].astype(np.float32) @ v.astype(np.float32)
    return out


def pick(docs: DataFrame, text_col: str, lang_col: str, id_col: str, per_lang: int) -> tuple[DataFrame, dict[str, int]]:
    """(_text, _lang) of about ``per_lang`` labelled rows of each language, picked by a hash of the id,
    and the languages' rows."""
    rows = docs.select(F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang"), F.col(id_col).alias("_id")).filter(F.col("_text").isNotNull() & F.col("_lang").isNotNull())
    # the driver has a row per language anyway; no text is shuffled to find its language's share
    n = {r["_lang"]: r["n"] for r in rows.groupBy("_lang").agg(F.count("*").alias("n")).collect()}
    limits = F.create_map(*[F.lit(x) for lang, k in n.items() for x in (lang, min(1.0, per_lang / k) * (1 << 20))]) if n else None
    picked = rows.filter(F.pmod(F.xxhash64("_id", F.lit(SEED)), F.lit(1 << 20)) < limits[F.col("_lang")]) if n else rows.limit(0)
    return picked.select("_text", "_lang"), n


def learn(docs: DataFrame, text_col: str, lang_col: str, id_col: str, per_lang: int = TRAIN_PER_LANG) -> tuple[list[str], np.ndarray]:
    """Languages and their prototypes from the labelled rows ``docs``.

    About ``per_lang`` texts of each language are used, picked by a hash of the id; languages with
    fewer use all.  Sums are made per task and language first; the driver gets one row of ``DIM``
    numbers per language.
    """
    small_batches(docs.sparkSession)
    picked, _ = pick(docs, text_col, lang_col, id_col, per_lang)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for text, lang in zip(b.column("_text").to_pylist(), b.column("_lang").to_pylist()):
                found = trigrams(text)
                if found and (size := np.linalg.norm(v := bundle(*found))):
                    sums[lang] = sums.get(lang, 0) + np.rint(v * (PARTS / size)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))], ["lang", "sums"])

    parts = picked.mapInArrow(tidy(run), "lang string, sums array<long>")
    per = parts.select("lang", F.posexplode("sums")).groupBy("lang", "pos").agg(F.sum("col").alias("n"))
    found = per.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("pos", "n"))).alias("v")).orderBy("lang").collect()
    vectors = np.array([[x["n"] for x in r["v"]] for r in found], float).reshape(-1, DIM)
    return [r["lang"] for r in found], vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def known(codes: np.ndarray, familiar: np.ndarray) -> int:
    """How many of the codes are in ``familiar``, which is ascending."""
    if not len(familiar):
        return 0
    return int((familiar[np.minimum(np.searchsorted(familiar, codes), len(familiar) - 1)] == codes).sum())


def unfamiliar_most(n: float, share: float) -> float:
    """How many of ``n`` distinct trigrams may be unfamiliar: the expected share, and what chance adds to it."""
    return share * n + DEVIATIONS * (share * (1 - share) * n) ** 0.5


def learn_familiar(docs: DataFrame, text_col: str, lang_col: str, id_col: str, per_lang: int = TRAIN_PER_LANG) -> tuple[np.ndarray, float]:
    """Codes of the trigrams that are familiar in any language, and the share of others that texts may have.

    Familiar trigrams come from labelled rows that aren't held out, the share from those that are:
    their ``QUANTILE`` between ``LEAST_SHARE`` and ``MOST_SHARE``, and ``MOST_SHARE`` if none is long
    enough.  The driver gets the familiar trigrams, a part of the ``CLASSES ** 3`` possible ones.
    """
    small_batches(docs.sparkSession)
    held = held_out(F.col(id_col))
    picked, n = pick(docs.filter(~held), text_col, lang_col, id_col, per_lang)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: dict[str, Counter] = {}
        for b in batches:
            for text, lang in zip(b.column("_text").to_pylist(), b.column("_lang").to_pylist()):
                if found := trigrams(text):
                    texts.setdefault(lang, Counter()).update(found[0].tolist())
        for lang, n in texts.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(list(n), pa.int64()), pa.array(list(n.values()), pa.int64())], ["lang", "code", "texts"])

    texts = picked.mapInArrow(tidy(count), "lang string, code long, texts long").groupBy("lang", "code").agg(F.sum("texts").alias("texts"))
    least = F.create_map(*[F.lit(x) for lang, k in n.items() for x in (lang, FAMILIAR * min(k, per_lang))]) if n else None
    rows = texts.filter(F.col("texts") >= least[F.col("lang")]).select("code").distinct().collect() if n else []
    familiar = np.array(sorted(r["code"] for r in rows), np.int64)

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [x[0] for t in b.column("_text").to_pylist() if (x := trigrams(t)) and len(x[0]) >= LONG]
            yield pa.RecordBatch.from_arrays([pa.array([1 - known(c, familiar) / len(c) for c in found], pa.float64())], ["share"])

    kept, _ = pick(docs.filter(held), text_col, lang_col, id_col, per_lang)
    share = kept.mapInArrow(tidy(shares), "share double").agg(F.percentile("share", F.lit(QUANTILE))).first()[0]
    return familiar, MOST_SHARE if share is None else min(MOST_SHARE, max(LEAST_SHARE, share))


def predict(
    docs: DataFrame, langs: list[str], prototypes: np.ndarray, text_col: str = "text", with_text: bool = True, familiar: tuple[np.ndarray, float] | None = None
) -> DataFrame:
    """``docs`` (without the text, if not ``with_text``) with ``lang_pred`` and ``score``; columns of these names are replaced.

    With ``familiar`` (see ``learn_familiar``) ``in_language`` says whether few enough of the text's
    distinct trigrams are unfamiliar to be a text of the learned languages, be it of several.

    The score is the cosine with the prototype, 0 where it is negative.  Null texts and texts
    without a letter get ``und`` and 0, as does every text if no language was learned; texts of any length are read whole.
    """
    small_batches(docs.sparkSession)
    keep = docs.drop("lang_pred", "score", *(["in_language"] if familiar else []))
    at = keep.columns.index(text_col)
    carried = [i for i in range(len(keep.columns)) if with_text or i != at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            best, scores, inside = [], [], []
            for text in b.column(at).to_pylist():
                found = trigrams(text) if text is not None and langs else None
                if found is None:
                    best.append("und")
                    scores.append(0.0)
                    inside.append(False)
                    continue
                v = bundle(*found)
                cos = prototypes @ v / max(float(np.linalg.norm(v)), 1e-12)
                k = int(cos.argmax())
                best.append(langs[k])
                scores.append(min(1.0, max(0.0, float(cos[k]))))
                if familiar:
                    n = len(found[0])
                    inside.append(n - known(found[0], familiar[0]) <= unfamiliar_most(n, familiar[1]))
            columns = [*[b.column(i) for i in carried], pa.array(best, pa.string()), pa.array(scores, pa.float64()), *([pa.array(inside, pa.bool_())] if familiar else [])]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    schema = T.StructType([*[keep.schema.fields[i] for i in carried], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), *([T.StructField("in_language", T.BooleanType())] if familiar else [])])
    return keep.mapInArrow(tidy(run), schema)


def held_out(key: Column) -> Column:
    """Whether a row is kept from learning: crc32 of the id as text leaves 1 when divided by 3."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def identify(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = TRAIN_PER_LANG, judged: bool = False) -> DataFrame:
    """``docs`` with ``held_out``, ``lang_pred`` and ``score``, learned from its own labelled rows; with ``in_language`` if ``judged``.

    Only rows that aren't held out are learned from; held-out ones set the bound of ``in_language``.
    Repeated rows are predicted alike; an empty table gives no rows; further columns are kept.
    """
    langs, prototypes = learn(docs.filter(~held_out(F.col(id_col))), text_col, lang_col, id_col, per_lang)
    familiar = learn_familiar(docs, text_col, lang_col, id_col, per_lang) if judged else None
    return predict(docs.withColumn("held_out", held_out(F.col(id_col))), langs, prototypes, text_col, familiar=familiar)


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that aren't held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    langs, prototypes = learn(docs.filter(~held_out(F.col("doc_id"))), "text", "lang", "doc_id")
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return predict(rows, langs, prototypes, with_text=False).select("doc_id", "held_out", "lang_pred", "score")
