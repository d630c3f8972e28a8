"""Sources and sinks: every query writes a table in the shared folder and reads it back by its contract."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import rounded
from ..functions.session import new_path, saved
from ..operators import audit, ranges, ranking, stats
from ..sources import readers, writers
from .q_fusion import DOCK, FIVE, FIVE_AGG, LONG, METRICS, attached
from .q_fusion import ORACLES as FUSION
from .q_rank import METRICS_SQL, metrics
from .views import PS, pair_scores, r, table

QUERIES, ORACLES = {}, {}
BOOTSTRAP_SQL = FUSION["bootstrap_median_ci"]
FIVE_SQL = f"WITH {LONG} SELECT metric, {FIVE} FROM (SELECT metric, {FIVE_AGG} FROM lg GROUP BY metric)"


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def parts(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("k"), "p_name", "p_type", "p_brand", "p_size")


def candidate_csv(spark, sf):
    """Candidates with blank structures and repeated ids."""
    p = parts(spark, sf)
    name = F.concat(F.lit("m"), "k").alias("id")
    rows = p.select(name, F.when(F.col("k") % 50 == 3, " ").otherwise(F.col("p_type")).alias("smiles"), F.col("p_brand").alias("note"))
    path = new_path(spark, "candidates")
    writers.csv(rows.unionByName(p.filter("k % 70 = 5").select(name, F.lit("again").alias("smiles"), F.lit("").alias("note"))), path)
    return readers.candidates(spark, path, strict=False)


@query("src_candidates", "SELECT 'm' || p_partkey AS id, p_type AS smiles FROM part WHERE p_partkey % 50 <> 3 AND p_partkey % 70 <> 5")
def src_candidates(spark, sf):
    return candidate_csv(spark, sf)[0]


@query("src_candidate_problems", "SELECT 'm' || p_partkey AS id, 'blank' AS problem FROM part WHERE p_partkey % 50 = 3 UNION ALL SELECT 'm' || p_partkey, 'duplicate' FROM part WHERE p_partkey % 70 = 5")
def src_candidate_problems(spark, sf):
    return candidate_csv(spark, sf)[1]


@query(
    "src_labelled_pairs",
    """WITH p AS (SELECT *, CASE WHEN p_partkey % 2 = 0 THEN 'even' ELSE 'odd' END AS source FROM part), n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY p_partkey) - 1 AS row FROM p)
SELECT source, row, p_name AS source_smiles, p_brand AS target_text, CASE p_partkey % 5 WHEN 0 THEN 1 ELSE 0 END AS label FROM n WHERE p_partkey % 5 IN (0, 1)""",
)
def src_labelled_pairs(spark, sf):
    """Two CSV files with labels 1, 0.0, text, none and 7; valid rows keep their place."""
    label = F.element_at(F.array(*[F.lit(x) for x in ("1", "0.0", "x", "", "7")]), (F.col("k") % 5 + 1).cast("int"))
    paths = {}
    for name, where in (("even", "k % 2 = 0"), ("odd", "k % 2 = 1")):
        paths[name] = new_path(spark, name)
        writers.csv(parts(spark, sf).filter(where).orderBy("k").select(F.col("p_name").alias("source_smiles"), F.col("p_brand").alias("target_text"), label.alias("label")), paths[name])
    return readers.labelled_pairs(spark, paths)


def text_file(spark, rows, name):
    path = new_path(spark, name)
    rows.write.text(path)
    return path


@query("src_keyed_lines", "SELECT p_brand AS brand, arg_min(p_type, p_partkey) AS type, CAST(min(p_partkey) AS VARCHAR) AS first FROM part WHERE p_partkey % 7 <> 0 GROUP BY 1")
def src_keyed_lines(spark, sf):
    """Lines with comments between them; the first line of a key wins."""
    line = F.when(F.col("k") % 7 == 0, F.concat(F.lit("# "), "p_brand", F.lit("\tcomment\t0"))).otherwise(F.concat_ws("\t", "p_brand", "p_type", F.col("k").cast("string")))
    path = text_file(spark, parts(spark, sf).orderBy("k").select(line.alias("value")), "lines")
    return readers.keyed_lines(spark, path, ["brand", "type", "first"])


@query("src_library", "SELECT p_type AS structure, min(n) AS library_index FROM (SELECT p_type, p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS n FROM part) WHERE p_partkey % 10 <> 0 GROUP BY 1")
def src_library(spark, sf):
    """A line library with blank lines: distinct lines with the place where each came first."""
    path = text_file(spark, parts(spark, sf).orderBy("k").select(F.when(F.col("k") % 10 == 0, "  ").otherwise(F.col("p_type")).alias("value")), "library")
    return readers.library(spark, path, "structure", least=3)


@query("src_tsv_column", "SELECT DISTINCT p_name AS value FROM part WHERE p_name NOT IN (SELECT p_name FROM part WHERE p_partkey % 3 = 0)")
def src_tsv_column(spark, sf):
    """The second column of a compressed TSV, without what the library has."""
    p, path = parts(spark, sf), new_path(spark, "tsv")
    p.select("k", "p_name").write.option("sep", "\t").option("compression", "gzip").csv(path)
    return readers.tsv_column(spark, path, 1, exclude=p.filter("k % 3 = 0").select("p_name"))


@query("src_tsv_named", "SELECT DISTINCT p_brand AS value FROM part")
def src_tsv_named(spark, sf):
    path = new_path(spark, "tsv")
    parts(spark, sf).select("k", "p_brand").write.option("header", True).option("sep", "\t").csv(path)
    return readers.tsv_column(spark, path, "p_brand")


@query("src_fasta", "SELECT CASE WHEN p_partkey % 2 = 0 THEN 'P' || p_partkey ELSE 'Q' || p_partkey END AS accession, upper(replace(p_name, ' ', '')) AS sequence FROM part")
def src_fasta(spark, sf):
    """Records of several lines, with the accession in brackets or first in the header."""
    k, letters = F.col("k"), F.upper(F.replace("p_name", F.lit(" "), F.lit("")))
    head = F.when(k % 2 == 0, F.concat(F.lit(">sp|x [P"), k, F.lit("] name"))).otherwise(F.concat(F.lit(">Q"), k, F.lit(" other")))
    body = F.concat(F.substring(letters, 1, 5), F.lit("\n"), F.substring(letters, F.lit(6), F.length(letters)))
    return readers.fasta(spark, text_file(spark, parts(spark, sf).select(F.concat(head, F.lit("\n"), body).alias("value")), "fasta"))


@query("src_registry", "SELECT 'N' || n_nationkey AS reg_key, n_name AS reg_name, n_nationkey || '.pdbqt' AS pdbqt, 1.5::DOUBLE * n_nationkey + 3 AS box FROM nation")
def src_registry(spark, sf):
    """A JSON map of targets, one entry each."""
    k = F.col("n_nationkey")
    box = F.array((k * 1.5).cast("double"), F.lit(1.0), F.lit(2.0))
    entry = F.struct(F.concat(F.lit("N"), k), F.struct(F.col("n_name").alias("target_name"), F.concat(k.cast("string"), F.lit(".pdbqt")).alias("pdbqt"), box.alias("box_center"), F.array(*[F.lit(20.0)] * 3).alias("box_size")))
    whole = table(spark, sf, "nation").agg(F.map_from_entries(F.collect_list(entry)).alias("entries"))  # a registry is one small file
    found = readers.registry(spark, text_file(spark, whole.select(F.to_json(F.struct("entries")).alias("value")), "registry"))
    return found.select("reg_key", "reg_name", "pdbqt", F.aggregate("box_center", F.lit(0.0), lambda s, x: s + x).alias("box"))


@query("src_partitioned", f"WITH {PS} SELECT CAST(target_id % 20 AS INTEGER) AS target_id, count(*) AS n, CAST(sum(CASE WHEN target_id % 20 = 3 THEN 0 ELSE candidate_index END) AS BIGINT) AS places FROM ps GROUP BY 1")
def src_partitioned(spark, sf):
    """One folder per target; a second write replaces one of them only."""
    rows = pair_scores(spark, sf).select((F.col("target_id") % 20).alias("target_id"), "candidate_index", "final_score")
    path = new_path(spark, "scores")
    writers.scores_by_target(rows, path)
    writers.scores_by_target(rows.filter("target_id = 3").withColumn("candidate_index", F.lit(0).cast("long")), path)
    return readers.partitioned_scores(spark, path).groupBy("target_id").agg(F.count("*").alias("n"), F.sum("candidate_index").alias("places"))


@query("src_cache", "SELECT p_partkey AS k, p_size FROM part")
def src_cache(spark, sf):
    """A compressed table whose keys are there and unique."""
    path = new_path(spark, "cache")
    writers.table(parts(spark, sf).select("k", "p_size"), path)
    return readers.cache(spark, path, "k")


@query("src_evidence", "SELECT 'association' AS name, count(*) AS n, count(DISTINCT l_partkey) AS drugs, count(DISTINCT l_suppkey) AS targets FROM lineitem UNION ALL SELECT 'drug', count(*), count(DISTINCT p_partkey), 0 FROM part UNION ALL SELECT 'target', count(*), 0, count(DISTINCT s_suppkey) FROM supplier")
def src_evidence(spark, sf):
    """Three tables whose columns have other names than wanted."""
    folder = new_path(spark, "evidence")
    for name, df in (("association", table(spark, sf, "lineitem").select(F.col("l_partkey").alias("drugId"), F.col("l_suppkey").alias("target_id"))), ("drug", table(spark, sf, "part").select(F.col("p_partkey").alias("id"))), ("target", table(spark, sf, "supplier").select(F.col("s_suppkey").alias("targetId")))):
        writers.table(df, f"{folder}/{name}.parquet")
    found = readers.evidence(spark, folder, alternatives={"drug": ("drug_id", "drugId", "id"), "target": ("target_id", "targetId")})
    one = lambda name, df: df.agg(F.count("*").alias("n"), *[(F.countDistinct(c) if c in df.columns else F.lit(0).cast("long")).alias(f"{c}s") for c in ("drug", "target")]).withColumn("name", F.lit(name))
    out = [one(name, df) for name, df in found.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("src_reference_list", "SELECT p_name AS name, 'S' || p_partkey AS smiles FROM part WHERE p_partkey % 4 = 1 UNION ALL SELECT 'S' || p_partkey, 'S' || p_partkey FROM part WHERE p_partkey % 4 > 1")
def src_reference_list(spark, sf):
    """Lines ``structure,name`` with comments; some have no name."""
    k = F.col("k")
    line = F.when(k % 4 == 0, F.concat(F.lit("# "), k)).when(k % 4 == 1, F.concat(F.lit("S"), k, F.lit(", "), "p_name")).otherwise(F.concat(F.lit("S"), k))
    return readers.reference_list(spark, text_file(spark, parts(spark, sf).select(line.alias("value")), "references"), [("default", "C")])


@query("src_base_scores", "SELECT CAST(p_partkey AS VARCHAR) AS id, p_type AS smiles, CAST(p_size AS DOUBLE) / 100 AS final_score FROM part")
def src_base_scores(spark, sf):
    """Scores of an earlier run for the very same candidates."""
    rows = parts(spark, sf).select(F.col("k").cast("string").alias("id"), F.col("p_type").alias("smiles"), (F.col("p_size") / 100).alias("final_score"))
    path = new_path(spark, "base")
    writers.csv(rows, path)
    return readers.base_scores(spark, path, rows.select("id", "smiles"), required=["id", "smiles", "final_score"]).select("id", "smiles", F.col("final_score").cast("double").alias("final_score"))


@query(
    "snk_reranked",
    f"WITH {DOCK} SELECT CAST(target_id AS VARCHAR) AS target_id, CAST(candidate_index AS VARCHAR) AS candidate_index, CAST(rk AS VARCHAR) AS dock_rank FROM (SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY ligand_efficiency, candidate_index) AS rk FROM at0 WHERE ligand_efficiency IS NOT NULL)",
)
def snk_reranked(spark, sf):
    """Rows of the second stage as CSV, in the order of their rank."""
    path = new_path(spark, "reranked")
    writers.reranked(ranking.re_rank(attached(spark, sf), "ligand_efficiency").select("target_id", "candidate_index", "dock_rank"), path)
    return spark.read.option("header", True).csv(path)


JSON_SQL = "'{\"auc\":' || CAST(CAST(round_even(auc_l2_labeled * 1000000, 0) AS BIGINT) AS VARCHAR) || ',\"target_id\":' || target_id || '}'"


@query("snk_summary", f"WITH m AS ({METRICS_SQL}) SELECT target_id, sha256({JSON_SQL}) AS digest, target_id % 13 <> 3 AS same FROM m WHERE auc_l2_labeled IS NOT NULL")
def snk_summary(spark, sf):
    """Stored summaries, some of them changed, compared with what a new computation gives, text by text."""
    m = metrics(spark, sf).filter("auc_l2_labeled is not null").select("target_id", F.rint(F.col("auc_l2_labeled") * 1000000).cast("long").alias("auc"))
    path = new_path(spark, "summary")
    writers.summary(m.withColumn("auc", F.when(F.col("target_id") % 13 == 3, F.col("auc") + 1).otherwise(F.col("auc"))), path)
    stored = spark.read.schema("json string, digest string").json(path).select(F.get_json_object("json", "$.target_id").cast("long").alias("_t"), F.col("digest").alias("_stored"), F.col("json").alias("_json"))
    now = m.select("target_id", F.to_json(F.struct("auc", "target_id")).alias("_now"))
    both = now.join(stored, F.col("target_id") == F.col("_t"))
    return both.select("target_id", F.sha2("_now", 256).alias("digest"), ((F.col("_now") == F.col("_json")) & (F.sha2("_now", 256) == F.col("_stored"))).alias("same"))


@query("snk_events", "SELECT event_type, count(*) * 2 AS n, CAST(sum(event_id) * 2 AS BIGINT) AS ids FROM events GROUP BY 1")
def snk_events(spark, sf):
    """An event log that two runs append to."""
    rows, path = table(spark, sf, "events").select("event_id", "event_type"), new_path(spark, "log")
    writers.append_events(rows, path)
    writers.append_events(rows, path)
    return spark.read.schema(rows.schema).json(path).groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("snk_top_hits", f"WITH {PS} SELECT target_id, string_agg(rk || ':' || part_key || ':' || CAST(CAST(round_even(final_score * 10000, 0) AS BIGINT) AS VARCHAR), ';' ORDER BY rk) AS hits FROM (SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY final_score DESC, candidate_index) AS rk FROM ps) WHERE rk <= 20 GROUP BY 1")
def snk_top_hits(spark, sf):
    path = new_path(spark, "hits")
    writers.top_hits(pair_scores(spark, sf), path, key="part_key")
    schema = "target_id long, hits array<struct<rank:int,key:long,score:double>>"
    text = F.transform("hits", lambda x: F.concat_ws(":", x["rank"].cast("string"), x["key"].cast("string"), F.rint(x["score"] * 10000).cast("long").cast("string")))
    return spark.read.schema(schema).json(path).select("target_id", F.array_join(text, ";").alias("hits"))


@query("snk_top_hits_first", f"WITH {PS} SELECT target_id, string_agg(rk || ':' || part_key, ';' ORDER BY rk) AS hits FROM (SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY final_score DESC, candidate_index) AS rk FROM ps) WHERE rk <= 5 AND target_id IN (SELECT DISTINCT target_id FROM ps ORDER BY target_id LIMIT 40) GROUP BY 1")
def snk_top_hits_first(spark, sf):
    """Hits of the first targets by id, where an export has a bound of its own."""
    path = new_path(spark, "hits")
    writers.top_hits(pair_scores(spark, sf), path, key="part_key", n=5, targets=40)
    found = spark.read.schema("target_id long, hits array<struct<rank:int,key:long,score:double>>").json(path)
    return found.select("target_id", F.array_join(F.transform("hits", lambda x: F.concat_ws(":", x["rank"].cast("string"), x["key"].cast("string"))), ";").alias("hits"))


@query("snk_reranked_order", f"WITH {DOCK} SELECT count(*) AS n, CAST(0 AS BIGINT) AS descents FROM at0 WHERE ligand_efficiency IS NOT NULL")
def snk_reranked_order(spark, sf):
    """Rows of the second stage as they stand in their files: how often a rank is below the one before it."""
    path = new_path(spark, "reranked")
    writers.reranked(ranking.re_rank(attached(spark, sf), "ligand_efficiency").select("target_id", "candidate_index", "dock_rank"), path)
    rows = readers.in_file_order(spark.read.option("header", True).schema("target_id long, candidate_index long, dock_rank int").csv(path), "place")
    before = rows.select((F.col("place") + 1).alias("place"), F.col("dock_rank").alias("_before"))
    return rows.join(before, "place", "left").agg(F.count("*").alias("n"), F.count_if(F.col("dock_rank") < F.col("_before")).alias("descents"))


@query(
    "snk_report_full",
    f"""WITH f AS ({FIVE_SQL}), b AS ({BOOTSTRAP_SQL}), w AS (SELECT * FROM f JOIN b USING (metric)), s AS (WITH {DOCK} SELECT docking_status, count(*) AS n FROM at0 GROUP BY 1)
SELECT 'metric:' || metric AS section, x.key AS metric, x.value AS value FROM w, unnest([{', '.join(f"{{'key': '{c}', 'value': {c}::DOUBLE}}" for c in ('n', 'mean', 'q1', 'median', 'q3', 'low', 'high'))}]) t(x)
UNION ALL SELECT 'status', docking_status, CAST(n AS DOUBLE) FROM s""",
)
def snk_report_full(spark, sf):
    """All metrics with number, mean, quartiles and the interval of the median, and status counts, as one CSV table."""
    rows = saved(stats.long_metrics(metrics(spark, sf), METRICS), "metrics")
    whole = stats.five_numbers(rows).join(stats.bootstrap_median(rows), "metric")
    path = new_path(spark, "report")
    writers.csv(writers.report(whole, attached(spark, sf).groupBy("docking_status").agg(F.count("*").alias("n"))), path)
    return spark.read.option("header", True).schema("section string, metric string, value double").csv(path)


@query(
    "snk_report",
    f"""WITH m AS ({METRICS_SQL}), s AS (WITH {DOCK} SELECT docking_status, count(*) AS n FROM at0 GROUP BY 1)
SELECT 'metric:auc' AS section, 'n' AS metric, CAST(count(auc_l2_labeled) AS DOUBLE) AS value FROM m UNION ALL SELECT 'metric:auc', 'median', {r('median(auc_l2_labeled)', 6)} FROM m
UNION ALL SELECT 'status', docking_status, CAST(n AS DOUBLE) FROM s""",
)
def snk_report(spark, sf):
    """Summary rows and status counts as one long table, written as CSV."""
    auc = saved(metrics(spark, sf).select("auc_l2_labeled"), "auc")
    middle = ranges.quantiles(auc, "auc_l2_labeled", [], {"median": 0.5}).select(rounded(F.col("median"), 6).alias("median"))
    m = auc.agg(F.count("auc_l2_labeled").alias("n")).join(F.broadcast(middle), F.lit(True), "left").withColumn("metric", F.lit("auc"))
    path = new_path(spark, "report")
    writers.csv(writers.report(m, attached(spark, sf).groupBy("docking_status").agg(F.count("*").alias("n"))), path)
    return spark.read.option("header", True).schema("section string, metric string, value double").csv(path)


@query("file_manifest", "SELECT * FROM (VALUES ('nation.parquet', 'mismatch'), ('region.parquet', 'unexpected'), ('supplier.parquet', 'malformed'), ('gone.parquet', 'missing')) v(path, problem)")
def file_manifest(spark, sf):
    """Tables of the input against a manifest that lacks one, has one too many, and wrong digests.  A table is a file or a
    folder of files, whose digests are digested once more."""
    files = readers.file_digests(spark, sf, pattern="*.parquet").select(F.regexp_extract("path", r"/([^/]+\.parquet)(/[^/]+)*$", 1).alias("path"), "digest")
    files = saved(files, "digests").groupBy("path").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("digest")), ","), 256).alias("digest"))
    wrong = F.when(F.col("path") == "nation.parquet", F.reverse("digest")).when(F.col("path") == "supplier.parquet", "none").otherwise(F.col("digest"))
    gone = spark.createDataFrame([("gone.parquet", "0" * 64)], "path string, digest string")
    return audit.compare_files(files.filter("path <> 'region.parquet'").withColumn("digest", wrong).unionByName(gone), files)
