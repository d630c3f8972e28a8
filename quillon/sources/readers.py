"""Sources with their contracts: rows that break one go to a quarantine frame or fail the read."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import label
from ..functions.session import new_path, saved


def candidates(spark: SparkSession, path: str, *, strict: bool = True, columns: Sequence[str] = ("id", "smiles")) -> tuple[DataFrame, DataFrame]:
    """(rows, problems) of a candidate CSV: columns there, cells not blank, ids unique.

    Cells are trimmed; further columns are left aside.  ``problems`` has (id, problem); in strict mode
    any problem is an error.
    """
    raw = spark.read.option("header", True).csv(path)
    missing = [c for c in columns if c not in raw.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    rows = saved(raw.select(*[F.trim(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in columns]), "candidates")  # the text is read once
    blank = rows.filter(" or ".join(f"{c} = ''" for c in columns)).select("id", F.lit("blank").alias("problem"))
    twice = rows.filter("id <> ''").groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id", F.lit("duplicate").alias("problem"))
    problems = blank.unionByName(twice)
    if strict:
        found = problems.limit(10).collect()
        if found:
            raise ValueError("; ".join(f"{r['problem']} id {r['id']!r}" for r in found))
        return rows, problems
    return rows.join(problems.select("id").distinct(), "id", "left_anti"), problems


def bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``df`` as a table in the shared folder, dealt into buckets of ``key`` and sorted within them.

    Joins and groups on ``key`` read it as it lies: it is not shuffled again, however often it is used.  The
    session's catalog knows it by a name of its own.
    """
    path = new_path(df.sparkSession, "bucketed")
    name = f"bucketed_{path.rpartition('-')[2]}"
    df.write.bucketBy(buckets, key).sortBy(key).option("path", path).option("compression", "zstd").saveAsTable(name)
    return df.sparkSession.table(name)


def in_file_order(df: DataFrame, name: str) -> DataFrame:
    """Rows of a file source with their place from 0 on: by path, then by place in the file.

    Rows are numbered within the splits that tasks read; splits begin where the ones before end.
    """
    path, start = F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start")
    rows = df.select("*", path, start, F.monotonically_increasing_id().alias("_serial"))
    per = rows.groupBy("_path", "_start").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.partitionBy(F.lit(0)).orderBy("_path", "_start").rowsBetween(W.unboundedPreceding, -1))  # a row per split
    per = per.select("_path", "_start", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.col("_before") + F.row_number().over(W.partitionBy("_path", "_start").orderBy("_serial")) - 1
    return rows.join(per, ["_path", "_start"]).withColumn(name, place).drop("_path", "_start", "_serial", "_before")


def candidate_summary(df: DataFrame, *, most: int = 100_000, declared: int | None = None) -> DataFrame:
    """One row: number of rows, blanks, the first limit that is broken (NULL if none; it begins with the
    failing field), and three rows as ``id=smiles``."""
    agg = df.agg(F.count("*").alias("n_rows"), F.count_if(F.trim("id") == "").alias("blank_ids"), F.count_if(F.trim("smiles") == "").alias("blank_structures"))
    error = F.when(F.col("n_rows") == 0, "rows:empty").when(F.col("n_rows") > most, "rows:too_many")
    if declared is not None:
        error = error.when(F.col("n_rows") != declared, "expectedCandidateCount:mismatch")
    out = agg.withColumn("error", error.when(F.col("blank_ids") > 0, "id:blank").when(F.col("blank_structures") > 0, "smiles:blank"))
    some = df.orderBy("id", "smiles").limit(3).agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "id", "smiles"))), ";").alias("sample"))
    return out.crossJoin(F.broadcast(some))  # one row each


def labelled_pairs(spark: SparkSession, sources: dict[str, str]) -> DataFrame:
    """(source, row, source_smiles, target_text, label) of several CSV files; only valid rows, with their place."""
    out = None
    for name, path in sources.items():
        df = in_file_order(spark.read.option("header", True).csv(path), "row").select(F.lit(name).alias("source"), "row", F.trim("source_smiles").alias("source_smiles"), F.trim("target_text").alias("target_text"), label(F.col("label")).alias("label"))
        out = df if out is None else out.unionByName(df)
    return out.filter("label is not null and source_smiles <> '' and target_text <> ''")


def keyed_lines(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """TSV with # comments: the first line of each key (the first column) wins."""
    text = in_file_order(spark.read.text(path), "_no")
    text = text.filter(~F.col("value").startswith("#") & (F.trim("value") != ""))
    parts = F.split("value", "\t")
    cells = text.select("_no", *[F.nullif(F.trim(F.coalesce(F.get(parts, F.lit(i)), F.lit(""))), F.lit("")).alias(c) for i, c in enumerate(columns)])
    key = columns[0]
    return cells.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*columns[1:]), "_no").alias("_v")).select(key, "_v.*")


def numbered_lines(spark: SparkSession, path: str, column: str) -> DataFrame:
    """(library_index, column): lines that aren't blank with their place in the file."""
    rows = in_file_order(spark.read.text(path), "library_index")
    return rows.select("library_index", F.trim("value").alias(column)).filter(F.col(column) != "")


def library(spark: SparkSession, path: str, column: str, *, least: int = 1) -> DataFrame:
    """Distinct lines with the place where each came first; at least ``least`` of them."""
    out = numbered_lines(spark, path, column).groupBy(column).agg(F.min("library_index").alias("library_index"))
    n = out.count()
    if n < least:
        raise ValueError(f"library has {n} entries, expected at least {least}")
    return out


def tsv_column(spark: SparkSession, path: str, column: int | str, *, exclude: DataFrame | None = None) -> DataFrame:
    """Distinct values of one TSV column (by place or by name), without those in ``exclude``."""
    named = isinstance(column, str)
    df = spark.read.option("header", named).option("sep", "\t").csv(path)
    out = df.select(F.col(column if named else df.columns[column]).alias("value")).filter("value is not null").distinct()
    if path.endswith(".gz"):
        out = out.repartition("value")
    return out if exclude is None else out.join(exclude.toDF("value"), "value", "left_anti")


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """(accession, sequence): the accession stands in brackets or is the header's first word."""
    rec = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("value")).filter("value <> ''")
    head = F.substring_index("value", "\n", 1)
    body = F.regexp_replace(F.substring(F.col("value"), F.length(head) + 1, F.length("value")), r"\s+", "")
    bracket = F.regexp_extract(head, r"\[([^\]]+)\]", 1)
    acc = F.coalesce(F.nullif(bracket, F.lit("")), F.regexp_extract(head, r"^(\S+)", 1))
    return rec.select(acc.alias("accession"), body.alias("sequence"))


REGISTRY = T.StructType(
    [T.StructField("target_name", T.StringType()), T.StructField("pdbqt", T.StringType()), T.StructField("box_center", T.ArrayType(T.DoubleType())), T.StructField("box_size", T.ArrayType(T.DoubleType()))]
)


def registry(spark: SparkSession, path: str) -> DataFrame:
    """(reg_key, reg_name, pdbqt, box_center, box_size) of a JSON map; a missing file is empty."""
    schema = T.StructType([T.StructField("entries", T.MapType(T.StringType(), REGISTRY))])
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    there = p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
    df = spark.read.schema(schema).option("multiLine", True).json(path) if there else spark.createDataFrame([], schema)
    return df.select(F.explode("entries").alias("reg_key", "e")).select("reg_key", F.col("e.target_name").alias("reg_name"), "e.pdbqt", "e.box_center", "e.box_size")


def partitioned_scores(spark: SparkSession, path: str) -> DataFrame:
    """Scores by target: the id comes from the folder's name."""
    return spark.read.parquet(path)


def cache(spark: SparkSession, path: str, key: str) -> DataFrame:
    """All shards of a cache; an empty cache or a repeated key is an error."""
    df = spark.read.parquet(path)
    n, distinct = df.agg(F.count("*"), F.countDistinct(key)).first()
    if not n or n != distinct:
        raise ValueError("the cache is empty" if not n else f"{n - distinct} repeated keys in the cache")
    return df


def evidence(spark: SparkSession, folder: str, *, alternatives: dict[str, Sequence[str]]) -> dict[str, DataFrame]:
    """Tables of a folder with each wanted column under its first alternative name that exists."""

    def pick(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(next(n for n in names if n in df.columns)).alias(c) for c, names in alternatives.items() if any(n in df.columns for n in names)])

    return {name: pick(spark.read.parquet(f"{folder}/{name}.parquet")) for name in ("association", "drug", "target")}


def reference_list(spark: SparkSession, path: str, default: Sequence[tuple[str, str]], *, least: int = 21) -> DataFrame:
    """(name, smiles) from lines ``smiles,name``; # lines are skipped, and a short list is replaced."""
    parts = F.split("value", ",")
    rows = spark.read.text(path).filter(~F.col("value").startswith("#") & (F.trim("value") != ""))
    rows = rows.select(F.coalesce(F.trim(F.get(parts, F.lit(1))), F.trim(F.get(parts, F.lit(0)))).alias("name"), F.trim(F.get(parts, F.lit(0))).alias("smiles"))
    if rows.limit(least).count() < least:
        return spark.createDataFrame(list(default), "name string, smiles string")
    return rows


def base_scores(spark: SparkSession, path: str, expected: DataFrame, *, required: Sequence[str]) -> DataFrame:
    """Scores of an earlier run: columns there, ids unique, and the same (id, smiles) as the input."""
    from ..operators.audit import identity

    df = spark.read.option("header", True).csv(path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    df = saved(df, "base-scores")  # the text is read once
    if df.groupBy("id").count().filter("count > 1").limit(1).count():
        raise ValueError("duplicate ids")
    bad = identity(expected, df, "id", "smiles").limit(10).collect()
    if bad:
        raise ValueError("; ".join(f"{r['problem']} id {r['id']!r}" for r in bad))
    return df


def file_digests(spark: SparkSession, path: str, *, pattern: str = "*") -> DataFrame:
    """(path, digest, length) of files, read by Spark's tasks.

    Files that the tasks can open are read piece by piece, so memory is the same for files of any size.  On other stores
    Spark reads them, one whole file (of 2 GB at most) after the other.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    if any(not f.startswith("file:") for f in files.inputFiles()):
        return files.select("path", F.sha2("content", 256).alias("digest"), "length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digests = []
            for name in b.column("path").to_pylist():
                with open("/" + name.removeprefix("file:").lstrip("/"), "rb") as f:
                    digests.append(hashlib.file_digest(f, "sha256").hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("path"), pa.array(digests, pa.string()), b.column("length")], ["path", "digest", "length"])

    return files.select("path", "length").mapInArrow(run, "path string, digest string, length long")


def missing_as_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    from ..functions.scalar import finite

    return df.withColumns({c: finite(F.col(c)) for c in columns})


def with_defaults(df: DataFrame, defaults: dict[str, Column | float]) -> DataFrame:
    """Failed layers get their default, and ``n_imputed`` counts them per row."""
    count = sum((F.col(c).isNull().cast("int") for c in defaults), F.lit(0))
    return df.withColumn("n_imputed", count).withColumns({c: F.coalesce(F.col(c), v if isinstance(v, Column) else F.lit(v)) for c, v in defaults.items()})
