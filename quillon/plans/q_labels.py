"""Label reconciliation, splits, pools and samples over labelled pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar
from ..functions.session import saved
from ..operators import labels, routing
from .views import table

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


POSITION = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]


def pairs(spark, sf):
    """Labelled pairs: (supplier, part), label from the return flag, in row order."""
    li = table(spark, sf, "lineitem")
    text = F.when(F.col("l_returnflag") == "R", "1").when(F.col("l_returnflag") == "A", "0.0").otherwise("n/a")
    return li.select(F.col("l_suppkey").alias("target_id"), F.col("l_partkey").alias("key"), scalar.label(text).alias("label"), F.col("l_linestatus").alias("status"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(POSITION)])


ORDER = ["o0", "o1", "o2", "o3"]
PAIRS = """
pr AS (SELECT l_suppkey AS target_id, l_partkey AS key, CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END AS label, l_linestatus AS status,
              l_orderkey AS o0, l_linenumber AS o1, l_partkey AS o2, l_extendedprice AS o3 FROM lineitem),
ok AS (SELECT * FROM pr WHERE label IS NOT NULL),
cl AS (SELECT target_id, key, label, status, o0, o1, o2, o3 FROM (
         SELECT *, row_number() OVER (PARTITION BY target_id, key ORDER BY o0, o1, o2, o3) AS rn, min(label) OVER (PARTITION BY target_id, key) AS lo, max(label) OVER (PARTITION BY target_id, key) AS hi FROM ok)
       WHERE lo = hi AND rn = 1),
st AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY sha256('42|' || target_id || '|' || key), target_id, key) <= round_even(count(*) OVER (PARTITION BY label) * 0.2::DOUBLE, 0) THEN 'heldout' ELSE 'fit' END AS split FROM cl)"""


def clean(spark, sf):
    return labels.clean_pairs(pairs(spark, sf), ["target_id", "key"], ORDER)


def split(spark, sf):
    return labels.stratified_split(clean(spark, sf), ["target_id", "key"])


@query("label_clean", f"WITH {PAIRS} SELECT target_id, key, label, o0 AS order_key FROM cl")
def label_clean(spark, sf):
    return clean(spark, sf).select("target_id", "key", "label", F.col("o0").alias("order_key"))


@query("label_sources", f"WITH {PAIRS} SELECT status AS source, target_id, count(*) AS n_rows, count(DISTINCT key) AS n_keys FROM ok GROUP BY ALL")
def label_sources(spark, sf):
    """Two sources appended with a tag, counted by target."""
    rows = pairs(spark, sf).filter("label is not null").drop("source")
    both = labels.union_sources({s: rows.filter(F.col("status") == s) for s in ("O", "F")})
    return both.groupBy("source", "target_id").agg(F.count("*").alias("n_rows"), F.countDistinct("key").alias("n_keys"))


@query("split_fit_heldout", f"WITH {PAIRS} SELECT target_id, key, label, split FROM st")
def split_fit_heldout(spark, sf):
    return split(spark, sf).select("target_id", "key", "label", "split")


@query(
    "split_key_disjoint",
    f"WITH {PAIRS} SELECT target_id, key, label, CASE WHEN CAST('0x' || substr(sha256('42|' || key), 1, 7) AS BIGINT) / 268435456.0::DOUBLE < 0.2 THEN 'heldout' ELSE 'fit' END AS split FROM cl",
)
def split_key_disjoint(spark, sf):
    return labels.key_split(clean(spark, sf), "key").select("target_id", "key", "label", "split")


@query(
    "eligible_pairs",
    f"""WITH {PAIRS}, fit AS (SELECT DISTINCT target_id, key FROM ok WHERE status = 'F')
SELECT target_id, key, label FROM (
  SELECT *, row_number() OVER (PARTITION BY target_id, key ORDER BY o0, o1, o2, o3) AS rn, min(label) OVER (PARTITION BY target_id, key) AS lo, max(label) OVER (PARTITION BY target_id, key) AS hi
  FROM ok WHERE status = 'O' AND (target_id, key) NOT IN (SELECT (target_id, key) FROM fit))
WHERE lo = hi AND rn = 1""",
)
def eligible_pairs(spark, sf):
    rows = pairs(spark, sf).filter("label is not null")
    return labels.eligible(rows.filter("status = 'O'"), rows.filter("status = 'F'"), ["target_id", "key"], ORDER).select("target_id", "key", "label")


TARGETS = """
tc AS (SELECT target_id, count(DISTINCT key) FILTER (label = 1) AS n_positive, count(DISTINCT key) FILTER (label = 0) AS n_negative FROM st WHERE split = 'heldout' GROUP BY 1 HAVING count(*) FILTER (label = 1) > 0),
ts AS (SELECT *, CASE WHEN n_positive >= 5 AND n_negative >= 5 THEN 'strict_labeled' ELSE 'limited_positive' END AS tier FROM tc),
ft AS (SELECT *, 0 AS p FROM ts UNION ALL SELECT c_custkey + 1000000, 0, 0, 'unlabeled_fallback', -c_custkey FROM customer),
sel AS (SELECT *, row_number() OVER (ORDER BY CASE tier WHEN 'strict_labeled' THEN 0 WHEN 'limited_positive' THEN 1 ELSE 2 END, n_positive DESC, n_negative DESC, p, target_id) - 1 AS target_index FROM ft)"""


def targets(spark, sf):
    counts = labels.target_counts(split(spark, sf).filter("split = 'heldout'"))
    fallback = table(spark, sf, "customer").select((F.col("c_custkey") + 1000000).alias("target_id"), (-F.col("c_custkey")).alias("position"))
    texts = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("target_id"), F.col("s_name").alias("text"))
    return labels.select_targets(counts, fallback, 150, texts=texts)


@query("target_select", f"WITH {PAIRS}, {TARGETS} SELECT target_id, tier, n_positive, n_negative, target_index, coalesce(s_name, CAST(target_id AS VARCHAR)) AS text FROM sel LEFT JOIN supplier ON s_suppkey = target_id WHERE target_index < 150")
def target_select(spark, sf):
    return targets(spark, sf)


@query("tier_counts", f"WITH {PAIRS}, {TARGETS} SELECT tier, count(*) AS n_targets, sum(n_positive)::BIGINT AS n_positive FROM sel WHERE target_index < 150 GROUP BY tier")
def tier_counts(spark, sf):
    return targets(spark, sf).groupBy("tier").agg(F.count("*").alias("n_targets"), F.sum("n_positive").alias("n_positive"))


SEQ = """
ac AS (SELECT s_suppkey AS target_id, 'A' || s_suppkey AS accession FROM supplier WHERE s_suppkey % 9 <> 2),
sq AS (SELECT 'A' || p_partkey AS accession, upper(replace(CASE WHEN p_partkey % 4 = 1 THEN substr(p_name, 1, 8) ELSE p_name || p_type END, ' ', '')) AS sequence FROM part WHERE p_partkey % 7 <> 3)"""


def sequences(spark, sf):
    k = F.col("s_suppkey")
    accessions = table(spark, sf, "supplier").filter("s_suppkey % 9 <> 2").select(k.alias("target_id"), F.concat(F.lit("A"), k).alias("accession"))
    text = F.when(F.col("p_partkey") % 4 == 1, F.substring("p_name", 1, 8)).otherwise(F.concat("p_name", "p_type"))
    rows = table(spark, sf, "part").filter("p_partkey % 7 <> 3").select(F.concat(F.lit("A"), "p_partkey").alias("accession"), F.upper(F.replace(text, F.lit(" "), F.lit(""))).alias("sequence"))
    return routing.with_sequence(table(spark, sf, "supplier").select(k.alias("target_id")), accessions, rows)


@query("target_sequences", f"WITH {SEQ} SELECT target_id, accession, sequence FROM ac JOIN sq USING (accession) WHERE length(sequence) > 10")
def target_sequences(spark, sf):
    """Targets whose accession has a sequence that is long enough."""
    return sequences(spark, sf)


@query(
    "target_fill",
    f"""WITH {PAIRS}, {SEQ}, c AS (SELECT target_id, count(DISTINCT key) FILTER (label = 1) AS n FROM cl GROUP BY 1), g AS (SELECT target_id FROM c WHERE n >= 5 AND target_id IN (SELECT target_id FROM ac JOIN sq USING (accession) WHERE length(sequence) > 10)),
x AS (SELECT target_id, true AS labelled, '' AS h FROM g UNION ALL SELECT t, false, sha256('42|' || t) FROM (SELECT s_suppkey AS t FROM supplier UNION ALL SELECT c_custkey + 1000000 FROM customer) WHERE t NOT IN (SELECT target_id FROM g))
SELECT target_id, labelled, place FROM (SELECT *, row_number() OVER (ORDER BY labelled DESC, h, target_id) - 1 AS place FROM x) WHERE place < 120""",
)
def target_fill(spark, sf):
    """Labelled targets with a sequence first, the others in hash order."""
    every = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("target_id")).unionByName(table(spark, sf, "customer").select((F.col("c_custkey") + 1000000).alias("target_id")))
    return labels.fill_targets(labels.target_counts(clean(spark, sf)), sequences(spark, sf), every, 120)


POOL = 400
POOLS = f"""
hl AS (SELECT target_id, key, label FROM st WHERE split = 'heldout'),
nl AS (SELECT count(DISTINCT p_partkey) AS n FROM part),
lb AS (SELECT key, row_number() OVER (ORDER BY pl, key) - 1 AS no FROM (SELECT DISTINCT p_partkey AS key, CAST('0x' || substr(sha256('42|' || p_partkey), 1, 6) AS BIGINT) AS pl FROM part)),
tk AS (SELECT DISTINCT target_id, key FROM st),
sp AS (SELECT target_id, count(*) AS have, CAST('0x' || substr(sha256('42|' || target_id), 1, 6) AS BIGINT) % (SELECT n FROM nl) AS start FROM hl GROUP BY target_id),
fr AS (SELECT sp.target_id, lb.key, have, row_number() OVER (PARTITION BY sp.target_id ORDER BY (lb.no - start + 2 * n) % n) AS rn
       FROM sp CROSS JOIN lb CROSS JOIN nl WHERE (sp.target_id, lb.key) NOT IN (SELECT (target_id, key) FROM tk)),
po AS (SELECT target_id, key, label FROM hl UNION ALL SELECT target_id, key, NULL FROM fr WHERE rn <= {POOL} - have)"""


def split_once(spark, sf):
    """The split as a saved table, for queries that use it several times."""
    return saved(split(spark, sf).select("target_id", "key", "label", "split"), "split")


def pools(spark, sf, rows=None):
    rows = split_once(spark, sf) if rows is None else rows
    library = table(spark, sf, "part").select(F.col("p_partkey").alias("key"))
    return labels.candidate_pools(rows.filter("split = 'heldout'"), library, rows.filter("split = 'fit'"), POOL)


@query(
    "target_pools",
    f"""WITH {PAIRS}, {POOLS}
SELECT target_id, key, CAST(label AS INTEGER) AS label, CASE label WHEN 1 THEN 'heldout_positive' WHEN 0 THEN 'heldout_negative' ELSE 'unlabeled_background' END AS label_role,
       CAST(row_number() OVER (PARTITION BY target_id ORDER BY sha256('42-pool|' || target_id || '|' || key), key) - 1 AS INTEGER) AS candidate_index FROM po""",
)
def target_pools(spark, sf):
    return pools(spark, sf)


@query(
    "label_library_hits",
    f"""WITH {PAIRS}, lib AS (SELECT DISTINCT p_partkey AS key FROM part WHERE p_partkey % 3 <> 0)
SELECT target_id, count(*) AS n_labels, count(lib.key) AS n_in_library, count(*) - count(lib.key) AS n_absent, count(lib.key) FILTER (label = 1) AS positives_in_library
FROM cl LEFT JOIN lib USING (key) GROUP BY target_id""",
)
def label_library_hits(spark, sf):
    """Labels found in a library, by target."""
    library = table(spark, sf, "part").filter("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("key"), F.lit(True).alias("here")).distinct()
    rows = clean(spark, sf).join(library, "key", "left")
    here = F.col("here").isNotNull()
    return rows.groupBy("target_id").agg(F.count("*").alias("n_labels"), F.count_if(here).alias("n_in_library"), F.count_if(~here).alias("n_absent"), F.count_if(here & (F.col("label") == 1)).alias("positives_in_library"))


@query(
    "negatives_per_positive",
    f"""WITH {PAIRS}, np AS (SELECT target_id, count(*) FILTER (label = 1) AS n FROM cl GROUP BY 1)
SELECT target_id, key, CAST(place AS INTEGER) AS place FROM (SELECT cl.target_id, key, n, row_number() OVER (PARTITION BY cl.target_id ORDER BY sha256('42|' || cl.target_id || '|' || key), key) AS place FROM cl JOIN np USING (target_id) WHERE label = 0)
WHERE place <= 2 * n""",
)
def negatives_per_positive(spark, sf):
    """Up to two negatives for each positive of a target, in hash order."""
    rows = clean(spark, sf)
    need = rows.groupBy("target_id").agg(F.count_if(F.col("label") == 1).alias("n"))
    return labels.sample_per(rows.filter("label = 0").join(need, "target_id"), 2 * F.col("n"), ["target_id"], ["key"]).select("target_id", "key", "place")


@query(
    "ranking_pairs",
    f"""WITH {PAIRS},
ps AS (SELECT target_id, key, row_number() OVER (PARTITION BY target_id ORDER BY sha256('epoch1|' || target_id || '|' || key), key) AS place FROM cl WHERE label = 1),
ng AS (SELECT target_id, key AS negative, row_number() OVER (PARTITION BY target_id ORDER BY sha256('epoch1n|' || target_id || '|' || key), key) - 1 AS no, count(*) OVER (PARTITION BY target_id) AS n FROM cl WHERE label = 0)
SELECT target_id, key AS positive, negative FROM ps JOIN ng USING (target_id) WHERE place <= 20 AND no = (place - 1) % n""",
)
def ranking_pairs(spark, sf):
    """One negative for each sampled positive; the epoch is part of the seed."""
    rows = clean(spark, sf)
    pos = labels.sample_per(rows.filter("label = 1"), 20, ["target_id"], ["key"], "epoch1").select("target_id", F.col("key").alias("positive"), "place")
    neg = labels.sample_per(rows.filter("label = 0"), 1 << 30, ["target_id"], ["key"], "epoch1n").select("target_id", F.col("key").alias("negative"), (F.col("place") - 1).alias("no"))
    n = neg.groupBy("target_id").agg(F.count("*").alias("n"))
    pos = pos.join(n, "target_id").withColumn("no", ((F.col("place") - 1) % F.col("n")).cast("int"))
    return pos.join(neg, ["target_id", "no"]).select("target_id", "positive", "negative")


@query(
    "decoy_pool",
    f"""WITH {PAIRS} SELECT p_partkey AS key FROM part WHERE p_partkey NOT IN (SELECT key FROM cl WHERE label = 1 AND target_id % 2 = 0) ORDER BY sha256('42|' || p_partkey), key LIMIT 500""",
)
def decoy_pool(spark, sf):
    """Five hundred decoys that no active of the panel is in, the same for all targets."""
    active = clean(spark, sf).filter("label = 1 and target_id % 2 = 0").select("key").distinct()
    return labels.sample(table(spark, sf, "part").select(F.col("p_partkey").alias("key")).join(active, "key", "left_anti"), 500, ["key"])


@query(
    "balanced_set",
    f"""WITH {PAIRS} SELECT target_id, key, 1 AS label FROM cl WHERE label = 1
UNION ALL SELECT target_id, key, 0 FROM (SELECT target_id, key, row_number() OVER (PARTITION BY target_id ORDER BY sha256('7|' || target_id || '|' || key), key) AS place FROM cl WHERE label = 0) WHERE place <= 100""",
)
def balanced_set(spark, sf):
    rows = clean(spark, sf)
    others = labels.sample_per(rows.filter("label = 0"), 100, ["target_id"], ["key"], 7)
    return rows.filter("label = 1").select("target_id", "key", "label").union(others.select("target_id", "key", "label"))


@query("reservoir", "SELECT o_orderkey, o_custkey FROM orders ORDER BY sha256('11|' || o_orderkey), o_orderkey LIMIT 1000")
def reservoir(spark, sf):
    """A fixed-size sample of a large table."""
    return labels.sample(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), 1000, ["o_orderkey"], 11)


@query("ordered_distinct", "SELECT md5(text) AS text_key, min(doc_id) AS first_doc FROM documents WHERE text IS NOT NULL GROUP BY 1")
def ordered_distinct(spark, sf):
    docs = table(spark, sf, "documents").select(F.md5("text").alias("text_key"), F.col("doc_id").alias("first_doc"))
    return labels.ordered_distinct(docs, "text_key", "first_doc")


@query(
    "last_wins",
    "SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1",
)
def last_wins(spark, sf):
    """The newest row of each key replaces the older ones."""
    return labels.last_wins(table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_orderstatus")


@query(
    "pending_work",
    "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')",
)
def pending_work(spark, sf):
    """Keys without a finished row: what a resumed run still has to do."""
    done = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return table(spark, sf, "customer").select("c_custkey").join(done, "c_custkey", "left_anti")


@query(
    "library_union",
    "SELECT key, min(source) AS source FROM (SELECT lower(p_type) AS key, '1-part' AS source FROM part UNION ALL SELECT lower(p_name), '2-name' FROM part UNION ALL SELECT lower(c_mktsegment), '3-segment' FROM customer) GROUP BY key",
)
def library_union(spark, sf):
    """Three libraries in order of preference, without repeats."""
    part, customer = table(spark, sf, "part"), table(spark, sf, "customer")
    both = labels.union_sources({"1-part": part.select(F.lower("p_type").alias("key")), "2-name": part.select(F.lower("p_name").alias("key")), "3-segment": customer.select(F.lower("c_mktsegment").alias("key"))})
    return both.groupBy("key").agg(F.min("source").alias("source"))


@query("label_map", f"WITH {PAIRS} SELECT target_id, coalesce(array_to_string(list_sort(list(DISTINCT key) FILTER (label = 1)), ','), '') AS pos, coalesce(array_to_string(list_sort(list(DISTINCT key) FILTER (label = 0)), ','), '') AS neg FROM cl GROUP BY target_id")
def label_map(spark, sf):
    text = lambda c: F.array_join(F.transform(F.col(c), lambda x: x.cast("string")), ",").alias(c)
    return labels.label_map(clean(spark, sf)).select("target_id", text("pos"), text("neg"))


@query(
    "qualified_panel",
    f"WITH {PAIRS} SELECT target_id, count(*) FILTER (label = 1) AS n_positive, count(*) FILTER (label = 0) AS n_negative FROM cl GROUP BY target_id HAVING count(*) FILTER (label = 1) >= 10 AND count(*) FILTER (label = 0) >= 10",
)
def qualified_panel(spark, sf):
    m = labels.label_map(clean(spark, sf)).select("target_id", F.size("pos").cast("long").alias("n_positive"), F.size("neg").cast("long").alias("n_negative"))
    return m.filter("n_positive >= 10 and n_negative >= 10")


@query(
    "text_mode",
    "SELECT source, lang, n FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, f) AS rn FROM (SELECT source, lang, count(*) AS n, min(doc_id) AS f FROM documents GROUP BY ALL)) WHERE rn = 1",
)
def text_mode(spark, sf):
    return labels.most_frequent(table(spark, sf, "documents").select("source", "lang", "doc_id"), ["source"], "lang", "doc_id")


@query("text_support", "SELECT lang, source, count(*) AS support FROM documents GROUP BY ALL")
def text_support(spark, sf):
    return table(spark, sf, "documents").groupBy("lang", "source").agg(F.count("*").alias("support"))
