"""Object inventories over documents, labels, pages and lineitems."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.functions import paths, sizes
from opsframe.operators import inventory, objects, ordered
from opsframe.plans import tables as t
from opsframe.plans.registry import query
from opsframe.sinks import run_lines
from opsframe.sinks import text as sink
from opsframe.sinks.metric_files import append_metric_files
from opsframe.sources import manifests, tree
from opsframe.storage import scratch_path

QUOTA = 100_000
CHUNK = 1000
SEED = "fixed-seed"
BUCKET_URL = "https://s3-us-west-2.amazonaws.com/samples"

OBJECTS = "objects AS (SELECT doc_id, source || '/' || doc_id || '.tar.gz' AS key, n_chars AS size FROM documents)"
SAMPLE = OBJECTS + f""", sample AS (
  SELECT * FROM (
    SELECT *, coalesce(sum(size) OVER (ORDER BY md5('{SEED}' || key) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           AS before FROM objects)
  WHERE before <= {QUOTA})
"""


@query(f"WITH {OBJECTS} SELECT key, size FROM objects WHERE starts_with(key, 'src1')")
def object_listing(spark, sf_dir):
    return objects.object_listing(t.objects(spark, sf_dir), "src1")


@query(f"WITH {OBJECTS} SELECT count(*) AS n FROM objects WHERE starts_with(key, 'src1')")
def object_count(spark, sf_dir):
    return objects.object_count(t.objects(spark, sf_dir), "src1")


@query("SELECT page_id, url FROM pages WHERE url LIKE '%.html' OR url LIKE '%/'")
def suffix_filter(spark, sf_dir):
    return objects.suffix_filter(t.urls(spark, sf_dir), "url", ".html", "/")


@query("""
SELECT user_id AS archive, 'views/' || event_type || event_id AS member FROM events
WHERE event_type NOT IN ('view', 'click')
""")
def drop_marked(spark, sf_dir):
    # Each event is a member of its user's archive, in a folder whose name holds a mark.
    member = F.concat(F.lit("views/"), "event_type", F.col("event_id").cast("string"))
    members = t.table(spark, sf_dir, "events").select(F.col("user_id").alias("archive"), member.alias("member"))
    return objects.drop_marked(members, ["view", "click"])


LANES = "names AS (SELECT source || '_L00' || doc_id AS name FROM documents)"


def lane_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat("source", F.lit("_L00"), F.col("doc_id").cast("string"))
    return t.table(spark, sf_dir, "documents").select(name.alias("name"))


@query(f"""
WITH {LANES} SELECT i.id, n.name FROM (SELECT DISTINCT split_part(name, '_L00', 1) AS id FROM names) i
JOIN names n ON starts_with(n.name, i.id)
""")
def prefix_bundle(spark, sf_dir):
    names = lane_names(spark, sf_dir)
    return objects.prefix_bundle(objects.bundle_ids(names), names)


@query(f"WITH {LANES} SELECT split_part(name, '_L00', 1) AS id, name FROM names")
def exact_bundle(spark, sf_dir):
    return objects.exact_bundle(lane_names(spark, sf_dir))


def domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a ``--files`` domain, and those in English also as its ``--jobs`` partner."""
    documents = t.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "lang")
    endings = F.when(F.col("lang") == "en", F.array(F.lit("--files"), F.lit("--jobs"))).otherwise(F.array(F.lit("--files")))
    return documents.select("id", F.explode(endings).alias("ending")).select(F.concat("id", "ending").alias("name"))


def buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.labelled_objects(spark, sf_dir).select(F.concat("key", F.lit("--files")).alias("name"))


ORPHANS = "SELECT DISTINCT doc_id || '--files' AS name, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"


@query(f"SELECT name FROM ({ORPHANS})")
def orphan_names(spark, sf_dir):
    return objects.orphan_names(domains(spark, sf_dir), buckets(spark, sf_dir))


@query("""
SELECT doc_id || '--files' AS name FROM documents EXCEPT SELECT doc_id || '--files' AS name FROM labels
""")
def set_difference(spark, sf_dir):
    files = objects.suffix_filter(domains(spark, sf_dir), "name", objects.FILES_SUFFIX)
    return objects.set_difference(files, buckets(spark, sf_dir))


@query(f"""
SELECT name AS orphan, name FROM ({ORPHANS})
UNION ALL SELECT name AS orphan, replace(name, '--files', '--jobs') AS name FROM ({ORPHANS}) WHERE lang = 'en'
""")
def orphan_pairs(spark, sf_dir):
    return objects.orphan_pairs(domains(spark, sf_dir), buckets(spark, sf_dir))


@query("SELECT doc_id, doc_id || '--jobs' AS partner FROM documents")
def suffix_swap(spark, sf_dir):
    name = F.concat(F.col("doc_id").cast("string"), F.lit(objects.FILES_SUFFIX))
    partner = paths.suffix_swap(name, objects.FILES_SUFFIX, objects.JOBS_SUFFIX)
    return t.table(spark, sf_dir, "documents").select("doc_id", partner.alias("partner"))


UUIDS = f"""
hashed AS (SELECT doc_id::VARCHAR AS stem, md5('{SEED}' || doc_id || '.fastq.gz') AS h FROM documents),
pairs AS (
  SELECT 'project' AS project, stem,
         substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-4' || substr(h, 14, 3) || '-' ||
         translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h, 18, 3) || '-' ||
         substr(h, 21, 12) AS uuid
  FROM hashed)
"""


def pairs_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = t.table(spark, sf_dir, "documents").select(F.concat(F.col("doc_id").cast("string"), F.lit(".fastq.gz")).alias("name"))
    return objects.name_pairs(files, "project", SEED)


@query(f"WITH {UUIDS} SELECT * FROM pairs")
def uuid_map(spark, sf_dir):
    return pairs_of_documents(spark, sf_dir)


@query(f"WITH {UUIDS} SELECT uuid || '.fastq.gz' AS name, stem || '.fastq.gz' AS new_name FROM pairs")
def rename_join(spark, sf_dir):
    pairs = pairs_of_documents(spark, sf_dir)
    files = pairs.select(F.concat("uuid", F.lit(".fastq.gz")).alias("name"))
    return objects.rename_join(files, pairs)


@query(f"WITH {UUIDS} SELECT project || chr(9) || stem || chr(9) || uuid AS line FROM pairs")
def name_pair_sink(spark, sf_dir):
    path = scratch_path(spark, "name-pairs")
    sink.write_name_pairs(pairs_of_documents(spark, sf_dir), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query(f"WITH {UUIDS} SELECT * FROM pairs")
def name_pair_scan(spark, sf_dir):
    path = scratch_path(spark, "name-pairs")
    sink.write_name_pairs(pairs_of_documents(spark, sf_dir), path)
    return manifests.read_name_pairs(spark, path)


@query("""
SELECT doc_id::VARCHAR AS key, n_chars AS size FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
""")
def skip_existing(spark, sf_dir):
    listed = t.objects(spark, sf_dir).select(F.col("doc_id").cast("string").alias("key"), "size")
    return objects.skip_existing(listed, t.labelled_objects(spark, sf_dir))


@query(r"""
WITH parts AS (SELECT regexp_extract(url, '^(.*)/[^/]*$', 1) AS dir, regexp_extract(url, '([^/]*)$', 1) AS child, url FROM pages)
SELECT DISTINCT dir FROM parts WHERE contains(url, 'example')
AND dir IN (SELECT dir FROM parts WHERE contains(child, 'html'))
""")
def tested_dirs(spark, sf_dir):
    changed = t.urls(spark, sf_dir).select(F.col("url").alias("path"))
    children = changed.select(paths.dirname(F.col("path")).alias("dir"), paths.basename(F.col("path")).alias("child"))
    return objects.tested_dirs(changed, children, within="example", mark="html")


@query("SELECT page_id, regexp_extract(url, '^(.*)/[^/]*$', 1) AS dir FROM pages")
def dirname(spark, sf_dir):
    return t.urls(spark, sf_dir).select("page_id", paths.dirname(F.col("url")).alias("dir"))


PLAN = f"""
plan AS (
  SELECT key, i AS part, (i - 1) * {CHUNK} AS "offset", least({CHUNK}, size - (i - 1) * {CHUNK}) AS bytes
  FROM (SELECT key, size, unnest(generate_series(1, (size + {CHUNK} - 1) // {CHUNK})) AS i FROM objects WHERE size > 0))
"""


@query(f'WITH {OBJECTS}, {PLAN} SELECT key, part, "offset", bytes FROM plan')
def chunk_plan(spark, sf_dir):
    return objects.chunk_plan(t.objects(spark, sf_dir), CHUNK)


# Line numbers are the planned parts; lines that were returned are lost, and those sent late carry a number two higher,
# so that some are received twice and some are not in the plan.
PARTS = """
sent AS (
  SELECT l_orderkey AS key, l_linenumber AS planned_part,
         CASE l_returnflag WHEN 'N' THEN l_linenumber WHEN 'A' THEN l_linenumber + 2 END AS part FROM lineitem),
planned AS (SELECT key, max(planned_part) AS planned FROM sent GROUP BY key),
arrived AS (SELECT DISTINCT key, part FROM sent JOIN planned USING (key) WHERE part BETWEEN 1 AND planned)
"""


def sent_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    part = F.when(F.col("l_returnflag") == "N", F.col("l_linenumber")).when(
        F.col("l_returnflag") == "A", F.col("l_linenumber") + 2
    )
    lines = t.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), "l_linenumber", part.alias("part"))
    plan = lines.groupBy("key").agg(F.max("l_linenumber").alias("planned"))
    return plan, lines.select("key", "part")


@query(f"""
WITH {PARTS}
SELECT key, planned, count(part) AS received, count(part) = planned AS complete
FROM planned LEFT JOIN arrived USING (key) GROUP BY key, planned
""")
def chunk_verify(spark, sf_dir):
    return objects.chunk_verify(*sent_parts(spark, sf_dir))


@query(f"""
WITH {PARTS}
SELECT key, part FROM (SELECT key, unnest(generate_series(1, planned::BIGINT)) AS part FROM planned)
WHERE (key, part) NOT IN (SELECT key, part FROM arrived)
""")
def chunk_missing(spark, sf_dir):
    return objects.missing_parts(*sent_parts(spark, sf_dir))


@query("""
SELECT l_orderkey AS key FROM lineitem GROUP BY l_orderkey HAVING count(*) >= 3 AND bool_and(l_returnflag = 'R')
""")
def failure_list(spark, sf_dir):
    attempts = t.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("key"), (F.col("l_returnflag") != "R").alias("ok")
    )
    return objects.failure_list(attempts)


RUNS = """
marked AS (
  SELECT *, CASE WHEN lag(event_type) OVER w IS DISTINCT FROM event_type THEN 1 ELSE 0 END AS start
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
runs AS (
  SELECT *, sum(start) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM marked)
"""


def runs_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = t.table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    return objects.collate_runs(events, ["ts", "event_id"], "event_type", within=["user_id"])


@query(f"""
WITH {RUNS} SELECT user_id, event_id, event_type,
  row_number() OVER (PARTITION BY user_id, run ORDER BY ts, event_id) - 1 AS run_place
FROM runs
""")
def collate_runs(spark, sf_dir):
    return runs_of_events(spark, sf_dir).select("user_id", "event_id", "event_type", "run_place")


def _written_lines(spark: SparkSession, runs: DataFrame, id_column: str, url: str) -> DataFrame:
    path = scratch_path(spark, "run-lines")
    run_lines.write_run_lines(runs, path, id_column, url)
    return run_lines.read_run_lines(spark, path)


@query(f"""
WITH {RUNS} SELECT dense_rank() OVER (ORDER BY user_id, run) - 1 AS line,
  row_number() OVER (PARTITION BY user_id, run ORDER BY ts, event_id) - 1 AS place,
  event_type AS id, event_id::VARCHAR AS url
FROM runs
""")
def collect_urls(spark, sf_dir):
    # The text read back: a line is spread over as many rows and parts as it has URLs.
    return _written_lines(spark, runs_of_events(spark, sf_dir), "event_type", "event_id")


@query("""
WITH named AS (
  SELECT url, split_part(regexp_extract(url, '([^/]*)$', 1), '.html', 1) AS id FROM pages),
marked AS (
  SELECT *, CASE WHEN lag(id) OVER w IS DISTINCT FROM id THEN 1 ELSE 0 END AS start FROM named WINDOW w AS (ORDER BY url)),
runs AS (SELECT *, sum(start) OVER (ORDER BY url ROWS UNBOUNDED PRECEDING) AS run FROM marked)
SELECT dense_rank() OVER (ORDER BY run) - 1 AS line, row_number() OVER (PARTITION BY run ORDER BY url) - 1 AS place, id, url
FROM runs WHERE id <> ''
""")
def nonempty_guard(spark, sf_dir):
    # One walk over all URLs in order; URLs that end with a slash have no id and break a run.
    named = t.urls(spark, sf_dir).select("url", paths.stem_before(F.col("url"), ".html").alias("id"))
    return _written_lines(spark, objects.collate_runs(named, ["url"], "id"), "id", "url")


@query(f"WITH {SAMPLE} SELECT key, size FROM sample")
def quota_sample(spark, sf_dir):
    return ordered.quota_sample(objects.object_listing(t.objects(spark, sf_dir)), "key", "size", QUOTA, SEED)


@query(f"""
WITH {SAMPLE} SELECT split_part(regexp_extract(key, '([^/]*)$', 1), '.', 1) || ',{BUCKET_URL}/' ||
  regexp_extract(key, '([^/]*)$', 1) AS line
FROM sample
""")
def config_csv(spark, sf_dir):
    listed = objects.object_listing(t.objects(spark, sf_dir))
    path = scratch_path(spark, "config")
    sink.write_lines(objects.config_lines(ordered.quota_sample(listed, "key", "size", QUOTA, SEED), BUCKET_URL), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query(f"""
WITH {OBJECTS} SELECT split_part(regexp_extract(key, '([^/]*)$', 1), '.', 1) || ',{BUCKET_URL}/' ||
  regexp_extract(key, '([^/]*)$', 1) AS line
FROM objects
""")
def cost_plan_project(spark, sf_dir):
    return objects.config_lines(t.objects(spark, sf_dir), BUCKET_URL)


@query(f"""
WITH {OBJECTS} SELECT key, size, row_number() OVER (ORDER BY md5('{SEED}' || key)) AS position FROM objects
""")
def shuffle_order(spark, sf_dir):
    return ordered.shuffle_order(objects.object_listing(t.objects(spark, sf_dir)), "key", SEED)


@query("SELECT doc_id, ceil(n_chars * 1048576.0::DOUBLE / 1073741824.0::DOUBLE)::BIGINT || '.0G' AS disk FROM documents")
def disk_request(spark, sf_dir):
    return t.objects(spark, sf_dir).select("doc_id", sizes.disk_request(F.col("size") * 1048576).alias("disk"))


@query("SELECT doc_id, round(n_chars * 1048576 / 1099511627776.0::DOUBLE, 9) AS tb FROM documents")
def size_tb(spark, sf_dir):
    return t.objects(spark, sf_dir).select("doc_id", F.round(sizes.size_tb(F.col("size") * 1048576), 9).alias("tb"))


@query("SELECT doc_id, lang, source FROM documents WHERE lang = 'en'")
def optional_filter(spark, sf_dir):
    documents = t.table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return inventory.optional_filter(documents, lang="en", source=None)


INSTANCES = """
machines AS (
  SELECT s_suppkey AS reservation, s_name, CASE WHEN s_acctbal > 0 THEN 'running' ELSE 'stopped' END AS state,
         CASE WHEN s_nationkey >= 5 THEN '10.0.0.' || s_nationkey END AS ip, 'zone' || s_nationkey AS placement
  FROM supplier),
instances AS (
  SELECT reservation, s_name || '-worker' AS id, state, ip, placement FROM machines
  UNION ALL SELECT reservation, s_name || '-leader', 'running', NULL, placement FROM machines WHERE ip IS NOT NULL)
"""


def instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as reservations of one worker, and a leader where the worker has an address."""
    nation = F.col("s_nationkey").cast("string")
    address = F.when(F.col("s_nationkey") >= 5, F.concat(F.lit("10.0.0."), nation))

    def instance(role: str, state: Column, ip: Column) -> Column:
        name = F.concat("s_name", F.lit(f"-{role}"))
        return F.struct(name.alias("id"), state.alias("state"), ip.alias("ip"), F.concat(F.lit("zone"), nation).alias("placement"))

    worker = instance("worker", F.when(F.col("s_acctbal") > 0, "running").otherwise("stopped"), address)
    leader = instance("leader", F.lit("running"), F.lit(None).cast("string"))
    nested = F.when(address.isNull(), F.array(worker)).otherwise(F.array(worker, leader))
    reservations = t.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("reservation"), nested.alias("instances"))
    return inventory.inventory_flatten(reservations)


@query(f"WITH {INSTANCES} SELECT * FROM instances")
def inventory_flatten(spark, sf_dir):
    return instances(spark, sf_dir)


@query(f"WITH {INSTANCES} SELECT id, placement FROM instances WHERE ip IS NOT NULL AND state = 'running' AND id LIKE '%-worker'")
def tag_filter(spark, sf_dir):
    role = F.regexp_extract("id", "([a-z]+)$", 1)
    cluster = F.when(F.col("ip").isNotNull(), F.concat_ws("-", F.lit("addressed"), "state"))
    tags = F.create_map(F.lit("cluster_name"), cluster, F.lit("Name"), role)
    tagged = instances(spark, sf_dir).withColumn("tags", tags)
    return inventory.tag_filter(tagged, cluster_name="addressed-running", Name="worker", owner=None).select("id", "placement")


@query(f"WITH {INSTANCES} SELECT id FROM instances WHERE state = 'running'")
def running_ids(spark, sf_dir):
    return inventory.running_ids(instances(spark, sf_dir))


@query(f"WITH {INSTANCES} SELECT ip FROM instances WHERE ip IS NOT NULL")
def not_null_filter(spark, sf_dir):
    return inventory.not_null_filter(instances(spark, sf_dir), "ip")


@query("""
SELECT c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_name, s_nationkey, s_acctbal, NULL FROM supplier
""")
def outer_union(spark, sf_dir):
    customers = t.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = t.table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal")
    )
    return inventory.outer_union(customers, suppliers)


@query("SELECT DISTINCT user_id::VARCHAR AS id FROM events")
def id_list_sink(spark, sf_dir):
    path = scratch_path(spark, "ids")
    sink.write_ids(t.points(spark, sf_dir), path)
    return spark.read.text(path).withColumnRenamed("value", "id")


@query("""
SELECT event_type AS metric, sum(length(user_id::VARCHAR) + length(value::VARCHAR) + 29)::BIGINT AS bytes
FROM events GROUP BY event_type
""")
def file_discovery(spark, sf_dir):
    # The metric files below a run's folder among whatever else lies there; a line has two tabs, a break and 26 of time.
    path = scratch_path(spark, "run")
    append_metric_files(t.points(spark, sf_dir), f"{path}/metrics")
    sink.write_ids(t.points(spark, sf_dir), f"{path}/ids")
    found = tree.walk_files(spark, path, "*.tsv")
    metric = F.substring_index(paths.basename(F.col("key")), ".", 1)
    return found.groupBy(metric.alias("metric")).agg(F.sum("size").alias("bytes"))


@query("""
SELECT 'source=' || source || '/lang=' || lang AS folder, 1::BIGINT AS n_files, sum(length(doc_id::VARCHAR) + 1)::BIGINT AS bytes
FROM documents GROUP BY source, lang
""")
def tree_listing(spark, sf_dir):
    path = scratch_path(spark, "tree")
    named = t.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("line"), "source", "lang")
    named.repartition("source", "lang").write.partitionBy("source", "lang").text(path)
    return tree.folder_totals(tree.walk_files(spark, path, "*.txt"))
