"""Queries over passages, the registry's cache, spot checks, and tables that are written and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parallax.operators import backlog, cache, metrics, nearby, report, sampling
from parallax.plans import registry as records_plan
from parallax.plans import sql
from parallax.plans.catalogue import _merged, registered, six
from parallax.plans.registry import RATED, RECORDS, SCAN, WITH_TRUTH
from parallax.plans.sql import ratio, tokens
from parallax.sources import adapters, files
from parallax.storage import shared_folder
from parallax.streaming import scan


def _lines(spark: SparkSession, sf_dir: str, table: str, key: str, place: str) -> DataFrame:
    rows = adapters.table(spark, sf_dir, table).select(key, F.posexplode(F.split("text", "\n")).alias("pos", "title"))
    return rows.select(key, (F.col("pos") + 1).alias(place), "title")


def _strict_lines(table: str, key: str, place: str) -> str:
    """Lines in strict form with sorted words, and how often each letter of a to z and each space stands in them."""
    plain = "replace(translate(line, '“”„‘’‚–—', '\"\"\"''''''--'), '…', '...')"
    bare = f"regexp_replace({plain}, '^\\s*(?:(?:chapter|kapitel|chapitre|capítulo)\\s+)?\\d+(?:\\.\\d+)*\\s*[.:]?\\s+', '', 'i')"
    words = tokens(f"lower(trim(regexp_replace({bare}, '\\s*\\([^()]*\\)\\.?\\s*$', '')))")
    letters = "list_transform(string_split('abcdefghijklmnopqrstuvwxyz ', ''), lambda c: length(x) - length(replace(x, c, '')))"
    return f"""(SELECT *, length(x) AS n, {letters} AS letters FROM (SELECT {key}, {place}, {words} AS x FROM (SELECT {key}, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS {place} FROM {table}) WHERE length(trim(line)) >= 3) WHERE x <> '')"""


@registered(f"""WITH a AS MATERIALIZED {_strict_lines('benchmark', 'item_id', 'item_line')}, b AS MATERIALIZED {_strict_lines('documents', 'doc_id', 'doc_line')},
texts AS MATERIALIZED (SELECT DISTINCT a.x AS xa, b.x AS xb FROM (SELECT DISTINCT x, n, letters FROM a) a JOIN (SELECT DISTINCT x, n, letters FROM b) b ON 20 * abs(a.n - b.n) <= a.n + b.n
  WHERE 20 * list_sum(list_transform(list_zip(a.letters, b.letters), lambda p: abs(p[1] - p[2]))) <= a.n + b.n),
scored AS MATERIALIZED (SELECT xa, xb, {ratio('xa', 'xb')} AS score FROM texts)
SELECT item_id, CAST(item_line AS INTEGER) AS item_line, doc_id, CAST(doc_line AS INTEGER) AS doc_line, round(score, 6) AS score FROM scored JOIN a ON a.x = xa JOIN b ON b.x = xb WHERE score >= 95""")
def passage_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of passages that stand near-identically in documents."""
    items, docs = _lines(spark, sf_dir, "benchmark", "item_id", "item_line"), _lines(spark, sf_dir, "documents", "doc_id", "doc_line")
    return nearby.near_identical(items, docs).select("item_id", "item_line", "doc_id", "doc_line", six("score"))


@registered("""WITH items AS (SELECT l_orderkey AS key, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_linestatus, l_shipdate) AS ordinal, l_partkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'A'),
listed AS (SELECT key, count(*) AS n, min_by('10.1/' || l_partkey, ordinal) FILTER (l_partkey % 11 = 0) AS doi FROM items GROUP BY key),
days AS (SELECT o_orderkey AS key, CASE WHEN o_custkey % 2 = 0 AND o_custkey % 10 <> 4 THEN '2026-01-01' WHEN o_custkey % 10 <> 7 THEN '2026-01-02' END AS day FROM orders)
SELECT key::VARCHAR AS isbn, CASE WHEN day IS NULL THEN 'failed' WHEN n IS NULL THEN 'empty' ELSE 'found' END AS status, CASE WHEN day IS NOT NULL THEN doi END AS doi, CASE WHEN day IS NOT NULL THEN coalesce(n, 0) END AS n_items, day FROM days LEFT JOIN listed USING (key)""")
def registry_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two passes over the registry by way of the cache, the second one twice; in each some requests fail. The first
    asks for half of the documents, the second for all; what the first has found or found missing isn't asked again."""
    orders = adapters.table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("isbn"), "o_custkey")
    items = adapters.registry_items(spark, sf_dir).select(F.col("key").cast("string").alias("isbn"), "ordinal", "type", "DOI")
    folder = shared_folder(spark, "registry-cache")

    def fetch(failing: int, day: str):
        return lambda asked: cache.answers(asked, items, orders.where(F.col("o_custkey") % 10 == failing), day)

    cache.read_through(orders.where("o_custkey % 2 = 0"), folder, 1, fetch(4, "2026-01-01"))
    cache.read_through(orders, folder, 2, fetch(7, "2026-01-02"))
    out = cache.read_through(orders, folder, 2, fetch(7, "2026-01-02"))
    return out.select("isbn", "status", "doi", "n_items", F.date_format("fetched_at", "yyyy-MM-dd").alias("day"))


CHECKED = "checked AS (SELECT o_orderkey AS key, CASE WHEN o_orderstatus = 'F' OR o_custkey % 7 = 1 THEN true WHEN o_custkey % 7 <> 0 THEN false END AS verified FROM orders WHERE o_orderstatus IN ('F', 'O'))"
DRAWN = f"{CHECKED}, drawn AS (SELECT key FROM checked WHERE verified = false ORDER BY md5('20260815:' || key), key LIMIT 200)"


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    verified = F.when((F.col("o_orderstatus") == "F") | (F.col("o_custkey") % 7 == 1), True).when(F.col("o_custkey") % 7 != 0, False)
    return adapters.table(spark, sf_dir, "orders").where("o_orderstatus in ('F', 'O')").select(F.col("o_orderkey").alias("key"), verified.alias("verified"))


@registered(f"WITH {DRAWN} SELECT key FROM drawn")
def spot_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A uniform sample of the documents whose truth nobody has verified."""
    return sampling.uniform(_checked(spark, sf_dir).where("verified = false").select("key"), 200, "key")


@registered(f"WITH {DRAWN} SELECT count(*) AS sampled, count_if(key % 3 <> 0) AS accepted, round(count_if(key % 3 <> 0) / count(*), 6) AS precision FROM drawn")
def spot_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate's precision by a sample, of which two thirds or so are accepted."""
    accepted = adapters.table(spark, sf_dir, "orders").where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("key"))
    return sampling.spot_check(_checked(spark, sf_dir), 200, accepted).select("sampled", F.col("accepted"), six("precision"))


@registered("""SELECT o_orderkey AS key, o_custkey % 11 <> 5 AS readable, o_custkey % 11 <> 5 AND o_orderstatus = 'O' AND o_orderkey % 3 <> 0 AND o_custkey % 4 = 1 AS stale FROM orders WHERE o_orderstatus IN ('F', 'O')""")
def stale_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truth written as text and read again: entries without a flag, with false and with true, none at all, and lines
    that break off."""
    orders = adapters.table(spark, sf_dir, "orders").where("o_orderstatus in ('F', 'O')")
    k = F.col("o_custkey")
    entry = lambda title, skip: F.struct(F.lit(title).alias("title"), skip.cast("boolean").alias("skip"))
    entries = F.when(F.col("o_orderkey") % 3 == 0, F.array().cast("array<struct<title:string,skip:boolean>>")).otherwise(F.array(entry("One", F.lit(False)), entry("Two", F.when(k % 4 != 1, k % 4 == 2))))
    source = F.when(F.col("o_orderstatus") == "O", "bulk_gate").otherwise("agent_arbitration")
    text = F.to_json(F.struct(entries.alias("entries"), F.lit(False).alias("verified"), source.alias("source")))
    folder = shared_folder(spark, "truth-lines")
    orders.select(F.concat_ws("\t", F.col("o_orderkey").cast("string"), F.when(k % 11 == 5, F.substring(text, 1, 25)).otherwise(text))).write.text(folder)
    return files.truth_lines(spark, folder).select(F.col("key").cast("long").alias("key"), "readable", "stale")


@registered(f"WITH {sql.READINGS} SELECT key, reader, count(*) AS n_entries, count_if(skip) AS n_skip, CASE WHEN key % 5 = 2 THEN 2 ELSE 1 END AS written FROM readings WHERE NOT (key % 5 = 3 AND reader = 'N') GROUP BY key, reader")
def readings_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings stored by reader in two batches, the second, with new readings of some documents, twice; those without
    entries aren't stored."""
    entry = F.struct("ordinal", "title", "page", "skip")
    nested = adapters.readings(spark, sf_dir).groupBy("key", "reader").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    empty = (F.col("key") % 5 == 3) & (F.col("reader") == "N")
    nested = nested.withColumns({"entries": F.when(empty, F.slice("entries", 1, 0)).otherwise(F.col("entries")), "written": F.lit(1)}).select("key", "entries", "written", "reader")
    folder = shared_folder(spark, "readings")
    backlog.write_batch(nested, folder, 1, "reader")
    for _ in range(2):
        backlog.write_batch(nested.where("key % 5 = 2").withColumn("written", F.lit(2)), folder, 2, "reader")
    held = backlog.newest(spark, folder, nested.schema, ["key", "reader"])
    return held.select("key", "reader", F.size("entries").cast("long").alias("n_entries"), F.size(F.filter("entries", lambda e: e["skip"])).cast("long").alias("n_skip"), "written")


@registered(f"WITH {SCAN} SELECT * FROM scanned")
def incremental_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scan of a dump that comes in two deliveries, each scanned by a run of its own."""
    rows = records_plan._records(spark, sf_dir)
    half = rows.agg(F.max("position")).first()[0] or 0
    folder = shared_folder(spark, "scan")
    held = adapters.table(spark, sf_dir, "orders").select(F.concat(F.lit("T"), "o_orderkey").alias("key"))
    for part in (rows.where(F.col("position") <= half // 2), rows.where(F.col("position") > half // 2)):
        part.write.mode("append").json(f"{folder}/dump")
        scan.watch(spark, f"{folder}/dump", folder, held).awaitTermination()
    return scan.scanned(spark, folder).select("position", "key", "skipped")


@registered("SELECT conv_id, string_agg('--- Page ' || n || ' ---' || chr(10) || text, chr(10) || chr(10) ORDER BY n) AS block FROM (SELECT conv_id, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) AS n FROM conversations) GROUP BY conv_id")
def page_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of a conversation as the pages of a document, put into one block."""
    return report.page_blocks(adapters.table(spark, sf_dir, "conversations"), "conv_id", "turn", "text")


PERCENT = "round_even(100 * {0}, 0)::INTEGER || '%' AS {0}"


@registered(sql.query(*WITH_TRUTH, select=f"SELECT key, CASE WHEN key % 4 = 0 OR key % 9 = 0 THEN key::VARCHAR ELSE o_orderpriority END AS name, CASE WHEN key % 4 <> 0 AND key % 5 <> 0 THEN 'http://x.org/' || key END AS toc_download_url, {', '.join(PERCENT.format(c) for c in ('precision', 'recall', 'f1'))}, tp, fp, fn FROM (SELECT {RATED} FROM evaluated) JOIN orders ON o_orderkey = key"))
def report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The truth's scores against the registry as a report shows them; some documents have no title, or aren't listed."""
    k = F.col("o_orderkey")
    manifest = adapters.table(spark, sf_dir, "orders").where(k % 4 != 0).select(k.alias("key"), F.when(k % 9 == 0, "").otherwise(F.col("o_orderpriority")).alias("title"), F.when(k % 5 != 0, F.concat(F.lit("http://x.org/"), k)).alias("toc_download_url"))
    scored = records_plan.evaluate_corpus(spark, sf_dir)
    return report.book_rows(scored, manifest)


@registered(f"WITH {RECORDS} SELECT c_custkey, min_by(title, position) AS title, min(position) AS position FROM customer LEFT JOIN records ON key = CASE WHEN c_custkey % 2 = 0 THEN '978' || (c_custkey % 60) ELSE 'T' || c_custkey END GROUP BY c_custkey")
def records_of_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of a manifest's keys, nothing where there is none."""
    k = F.col("c_custkey")
    keys = adapters.table(spark, sf_dir, "customer").select("c_custkey", F.when(k % 2 == 0, F.concat(F.lit("978"), k % 60)).otherwise(F.concat(F.lit("T"), k)).alias("key"))
    return report.records_of(keys, records_plan._projected(spark, sf_dir).select("key", "title", "position")).select("c_custkey", "record.title", "record.position")


@registered("WITH todo AS (SELECT o_orderkey AS key, o_custkey FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderkey LIMIT 50) SELECT key FROM todo WHERE o_custkey % 3 <> 0")
def first_todo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first fifty documents without truth, of which some have no file."""
    orders = adapters.table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "key")
    return backlog.first_todo(orders.where("o_orderstatus = 'P'"), "key", 50, orders.where("o_custkey % 3 <> 0"))


@registered(f"WITH {sql.READINGS} SELECT key, reader, ordinal, '    p.' || CASE WHEN length(coalesce(page, '?')) < 4 THEN lpad(coalesce(page, '?'), 4, ' ') ELSE page END || '  ' || title AS line, CASE WHEN skip THEN 'text (OCR''d)' ELSE 'vision' END || ': lab/' || reader AS label FROM readings")
def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries as the arbitration report lists them, each with the label of its reading."""
    kind = F.when(F.col("skip"), "text").otherwise("vision")
    model = records_plan.records.model_from_file_part(F.concat(F.lit("lab__"), "reader"))
    return adapters.readings(spark, sf_dir).select("key", "reader", "ordinal", report.entry_line(F.col("page"), F.col("title")).alias("line"), report.kind_label(kind, model).alias("label"))


@registered(sql.query(*sql.CLOSE_PARTS, select="""SELECT key, CAST(place AS INTEGER) AS place, title, page, skip FROM (
  SELECT key, row_number() OVER (PARTITION BY key ORDER BY page IS NULL, coalesce(page_val, 0), coalesce(page, ''), side, ordinal) AS place, title, page, skip FROM (
    SELECT e.*, CASE WHEN m.i IS NOT NULL THEN 0 ELSE 1 END AS side FROM best b JOIN entries e ON e.key = b.key AND e.reader = b.side_a LEFT JOIN matched m ON m.key = b.key AND m.side_a = b.side_a AND m.side_b = b.side_b AND m.i = e.ordinal
    UNION ALL SELECT e.*, 2 FROM best b JOIN entries e ON e.key = b.key AND e.reader = b.side_b LEFT JOIN matched m ON m.key = b.key AND m.side_a = b.side_a AND m.side_b = b.side_b AND m.j = e.ordinal WHERE m.key IS NULL))"""))
def truth_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate's truth, stored as nested rows and read back entry by entry."""
    stored = backlog.truth_entry(_merged(spark, sf_dir).withColumnRenamed("position", "ordinal"))
    folder = shared_folder(spark, "truth")
    backlog.write_batch(stored, folder, 1, "source")
    held = backlog.newest(spark, folder, stored.select("key", "verified", "entries", "source").schema, ["key"])
    return held.select("key", F.posexplode("entries").alias("pos", "e")).select("key", (F.col("pos") + 1).alias("place"), "e.title", F.col("e.printed_page_number").alias("page"), "e.skip")


@registered(f"WITH {SCAN} SELECT r.key, filename, title, language, doi, toc_download_url, license, license_source, lobid_url FROM records r JOIN scanned s USING (position) WHERE skipped IS NULL")
def manifest_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest that the taken records of two deliveries are appended to, each with its full entry."""
    rows = records_plan._projected(spark, sf_dir)
    half = (rows.agg(F.max("position")).first()[0] or 0) // 2
    held = adapters.table(spark, sf_dir, "orders").select(F.concat(F.lit("T"), "o_orderkey").alias("key"))
    names = ["key", "filename", "title", "language", "doi", "toc_download_url", "license", "license_source", "lobid_url"]
    manifest = rows.select(*names).limit(0)
    for part in (rows.where(F.col("position") <= half), rows.where(F.col("position") > half)):
        taken = backlog.scan_reasons(part, held.union(manifest.select("key"))).where("skipped is null")
        manifest = backlog.inserted(manifest, part.join(taken.select("position"), "position", "left_semi").select(*names), ["key"])
    return manifest


@registered(sql.query(*WITH_TRUTH, select="SELECT round(coalesce(avg(precision), 0), 6) AS precision, round(coalesce(avg(recall), 0), 6) AS recall, round(coalesce(avg(f1), 0), 6) AS f1, round(avg(f1), 6) AS mean_f1, count(*) AS n_books FROM evaluated"))
def overall_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The means of all documents that truth and registry cover."""
    return metrics.overall(records_plan._evaluated(spark, sf_dir, "A")).select(six("precision"), six("recall"), six("f1"), six("mean_f1"), "n_books")
