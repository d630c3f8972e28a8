"""Target resolution, registry lookup and routing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalar import box_valid, normal_name
from ..functions.session import saved


def lookup_receptors(targets: DataFrame, registry: DataFrame, *, key: str = "target_id", name: str = "target_name") -> DataFrame:
    """Targets with their registry entry: by exact key, else by normalised name (of key or entry).

    ``registry`` has (reg_key, reg_name, available, box_center, box_size).  Of several entries with
    one name the first key wins.
    """
    fields = ["available", "box_center", "box_size"]
    entry = F.struct("reg_key", *fields)
    exact = registry.groupBy(F.col("reg_key").alias("_k")).agg(F.min_by(entry, "reg_key").alias("_exact"))
    names = registry.select(F.explode(F.array_distinct(F.array(normal_name(F.col("reg_key")), normal_name(F.col("reg_name"))))).alias("_nm"), "reg_key", entry.alias("_e")).filter("_nm <> ''")
    named = names.groupBy("_nm").agg(F.min_by("_e", "reg_key").alias("_named"))
    out = targets.join(exact, F.col(key).cast("string") == F.col("_k"), "left").withColumn("_n", normal_name(F.col(name))).join(named, F.col("_n") == F.col("_nm"), "left")
    return out.withColumn("receptor", F.coalesce("_exact", "_named")).drop("_k", "_exact", "_n", "_nm", "_named")


def route(targets: DataFrame, *, mode: str = "auto") -> DataFrame:
    """``branch`` and ``reason`` from receptor evidence only; labels are never read.

    ``cascade`` without a valid receptor raises an error when the rows are computed.
    """
    e = F.col("receptor")
    problem = (
        F.when(e.isNull(), "not_registered").when(~F.coalesce(e["available"], F.lit(False)), "file_missing").when(~box_valid(e["box_center"], e["box_size"]), "invalid_box")
    )
    if mode == "library":
        return targets.withColumn("branch", F.lit("library")).withColumn("reason", F.lit("forced"))
    if mode == "cascade":
        bad = F.raise_error(F.concat(F.lit("no valid receptor: "), problem)).cast("string")
        return targets.withColumn("branch", F.when(problem.isNull(), "cascade").otherwise(bad)).withColumn("reason", F.lit("forced"))
    if mode != "auto":
        raise ValueError("mode must be auto, cascade or library")
    return targets.withColumn("branch", F.when(problem.isNull(), "cascade").otherwise("library")).withColumn("reason", F.coalesce(problem, F.lit("receptor")))


def resolve(queries: DataFrame, texts: DataFrame, names: DataFrame) -> DataFrame:
    """(query_id, text, method): exact id, then name within a text, then within a name, then a token.

    ``queries`` has (query_id, name, code); ``texts`` (text, n, first) and ``names`` (code, name, text,
    first), one row per distinct text or name.  Containment is joined on grams (see ``containing``) of distinct
    names, however many queries ask for one or entries have one, and queries take the answer of their code or
    name.  The better method is kept per query.  All three tables are used several times and saved first.
    """
    queries, texts, names = saved(queries, "queries"), saved(texts, "texts"), saved(names, "names")
    answer = lambda p, n, f: F.struct(F.lit(p).alias("_p"), n.cast("long").alias("_n"), f.cast("long").alias("_f"), F.col("text"))
    exact = names.filter("code is not null").groupBy("code").agg(F.min_by("text", "first").alias("text")).select("code", answer(1, F.lit(0), F.lit(0)).alias("_exact"))
    entries = names.groupBy("name").agg(F.min(F.struct("first", "text")).alias("_e")).select("name", "_e.text", "_e.first")
    asked = queries.select("name").filter("name <> ''").distinct().withColumn("_ln", F.lower("name"))
    some = asked.select("_ln").distinct()
    inside = containing(some, "_ln", texts, "text").groupBy("_ln").agg(F.min_by(F.struct("text", "n", "first"), F.struct(-F.col("n"), "first")).alias("_t")).select("_ln", "_t.*")
    by_text = asked.join(inside, "_ln").select("name", answer(2, -F.col("n"), F.col("first")).alias("_b"))
    inside = containing(some, "_ln", entries, "name").groupBy("_ln").agg(F.min(F.struct("first", "text")).alias("_t")).select("_ln", "_t.*")
    by_name = asked.join(inside, "_ln").select("name", answer(3, F.lit(0), F.col("first")).alias("_b"))
    tokens = asked.select("name", F.posexplode(F.regexp_extract_all("name", F.lit(r"[A-Z][A-Z0-9]{2,}"), F.lit(0))).alias("_at", "_tok"))
    inside = containing(tokens, "_tok", entries, "name").groupBy("_tok").agg(F.min(F.struct("first", "text")).alias("_t")).select("_tok", "_t.*")
    by_token = tokens.join(inside, "_tok").select("name", answer(4, F.col("_at"), F.col("first")).alias("_b"))
    named = by_text.unionByName(by_name).unionByName(by_token).groupBy("name").agg(F.min("_b").alias("_named"))
    found = queries.join(exact, "code", "left").join(named, "name", "left")
    best = F.when(F.col("query_id").isNotNull(), F.min(F.coalesce("_exact", "_named")).over(W.partitionBy("query_id")))
    method = F.coalesce(*[F.when(F.col("_b._p") == i + 1, F.lit(m)) for i, m in enumerate(("exact_id", "text_contains", "name_contains", "token"))])
    return found.select("query_id", best.alias("_b")).select("query_id", F.col("_b.text").alias("text"), F.coalesce(method, F.lit("none")).alias("method"))


def first_mapped(rows: DataFrame, accessions: str, mapping: DataFrame, *, id_col: str) -> DataFrame:
    """(id, accession, mapped): of accessions split at commas, semicolons and blanks, the first in the map."""
    long = rows.select(id_col, F.posexplode(F.split(F.trim(F.col(accessions)), r"[,;\s]+")).alias("_at", "accession")).filter("accession <> ''")
    hit = long.join(mapping, "accession").groupBy(id_col).agg(F.min_by(F.struct("accession", "mapped"), "_at").alias("_m"))
    return rows.select(id_col).join(hit, id_col, "left").select(id_col, "_m.accession", "_m.mapped")


def with_sequence(targets: DataFrame, accessions: DataFrame, sequences: DataFrame, *, target: str = "target_id", longer_than: int = 10) -> DataFrame:
    """(target, accession, sequence): targets whose accession has a sequence of more than so many letters."""
    long = sequences.select("accession", "sequence").filter(F.length("sequence") > longer_than)
    return targets.select(target).join(accessions.select(target, "accession"), target).join(long, "accession").select(target, "accession", "sequence")


def grams_of(text, most: int = 3):
    """Distinct substrings of 1 to ``most`` letters."""
    one = lambda n: F.transform(F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - (n - 1))).otherwise(F.array().cast("array<int>")), lambda i: F.substring(text, i, F.lit(n)))
    return F.array_distinct(F.concat(*[one(n) for n in range(1, most + 1)]))


def containing(names: DataFrame, name: str, texts: DataFrame, text: str) -> DataFrame:
    """Rows of ``names`` and ``texts`` where the text has the name in it, whatever its case.

    Both are joined on a gram: a text lists all of its grams of up to three letters, a name its one that
    fewest texts have.  Empty names are in no text.  The lists of grams are many times larger than their files, from
    which Spark guesses their size, so they are joined by merging, never sent to the driver.
    """
    listed = texts.withColumn("_text", F.lower(text)).withColumn("_gram", F.explode(grams_of(F.lower(text))))
    per = listed.groupBy("_gram").agg(F.count("*").alias("_texts"))
    some = names.select(name).distinct().withColumn("_name", F.lower(name)).filter("_name <> ''")
    size = F.least(F.lit(3), F.length("_name"))
    own = some.select(name, "_name", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("_name") - size + 1), lambda i: F.substring(F.col("_name"), i, size)))).alias("_gram"))
    rarest = own.hint("merge").join(per, "_gram").groupBy(name, "_name").agg(F.min_by("_gram", F.struct("_texts", "_gram")).alias("_gram"), F.count("*").alias("_found"))
    return rarest.hint("merge").join(listed, "_gram").filter(F.contains("_text", F.col("_name"))).drop("_gram", "_text", "_name", "_found")


def evidence_triples(associations: DataFrame, left: DataFrame, right: DataFrame, keys: Sequence[str], score: str) -> DataFrame:
    """Associations with both ends described, labelled by score; the middle of the scale is dropped."""
    from ..functions.scalar import threshold_label

    return associations.join(left, keys[0]).join(right, keys[1]).withColumn("label", threshold_label(F.col(score))).filter("label is not null")


def rank_first(df: DataFrame, by: Sequence[str], order: Sequence) -> DataFrame:
    return df.withColumn("_rn", F.row_number().over(W.partitionBy(*by).orderBy(*order))).filter("_rn = 1").drop("_rn")
