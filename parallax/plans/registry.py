"""Queries over registry items, bibliographic records, raw answers and what is still to be done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parallax.functions import records, text
from parallax.operators import backlog, metrics, registry
from parallax.plans import sql
from parallax.plans.catalogue import ALL, CLOSE, GOLD, _gold, _plain_part, _rated, _rejected, registered, six
from parallax.sources import adapters

ITEMS = """items AS (SELECT l_orderkey AS key, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_linestatus, l_shipdate) AS ordinal, l_partkey, l_suppkey, l_linenumber, p_name
  FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'A'),
reg AS (SELECT key, ordinal, CASE WHEN l_suppkey % 7 = 0 AND l_suppkey % 9 = 0 THEN l_linenumber || p_name ELSE p_name END || CASE WHEN l_partkey % 5 = 0 THEN ' in short' ELSE '' END AS title,
  CASE WHEN l_suppkey % 9 <> 0 THEN l_linenumber::VARCHAR END AS page, l_linenumber FROM items WHERE l_partkey % 11 <> 0 AND l_partkey % 13 <> 0),
covered AS (SELECT key FROM reg GROUP BY key HAVING count(page) >= 3)"""


def _chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.chapters(adapters.registry_items(spark, sf_dir))


@registered(f"WITH {ITEMS} SELECT key, ordinal, title, 'Ann N' || l_linenumber AS authors, page FROM reg")
def registry_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw items as entries: chapters with titles, without glued pages, with authors that have a family name."""
    return _chapters(spark, sf_dir).select("key", "ordinal", "title", F.array_join("authors", "; ").alias("authors"), "page")


@registered(f"WITH {ITEMS} SELECT key, min_by(CASE WHEN l_partkey % 11 = 0 THEN '10.1/' || l_partkey END, ordinal) FILTER (l_partkey % 11 = 0) AS doi FROM items GROUP BY key")
def registry_book_doi(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = adapters.registry_items(spark, sf_dir).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("ordinal", "type", "DOI"))).alias("items"))
    return listed.select("key", text.book_doi(F.col("items")).alias("doi"))


@registered("SELECT l_orderkey AS key, l_linenumber, l_partkey, l_suppkey, p_name AS title FROM lineitem JOIN part ON l_partkey = p_partkey")
def glued_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles with their page put in front come back as they were."""
    line = adapters.table(spark, sf_dir, "lineitem").join(adapters.table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    page = F.col("l_linenumber").cast("string")
    glued = F.when(F.col("l_suppkey") % 2 == 0, F.concat(page, F.lit(" "), "p_name")).otherwise(F.col("p_name"))
    return line.select(F.col("l_orderkey").alias("key"), "l_linenumber", "l_partkey", "l_suppkey", text.without_glued_page(glued, page).alias("title"))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as bibliographic records, with gaps of every kind."""
    k = F.col("p_partkey")
    some = lambda n, value, kind: F.when(k % n != 0, value).otherwise(F.lit(None).cast(kind))
    entry = lambda label, url: F.struct(F.lit(label).alias("label"), url.alias("id"))
    codes = F.array(*map(F.lit, ("ger", "eng", "fra", "nld", "pol", "")))
    code = F.element_at(codes, (k % 6 + 1).cast("int"))
    return adapters.table(spark, sf_dir, "part").select(
        k.alias("position"),
        F.concat(F.lit("http://x.org/r/T"), k, F.when(k % 2 == 0, "#!").otherwise("")).alias("id"),
        F.when(k % 7 == 0, F.array(F.lit("Book"))).otherwise(F.array(F.lit("Book"), F.lit("EditedVolume"))).alias("type"),
        some(17, F.col("p_name"), "string").alias("title"),
        F.when(k % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("978"), k % 50))).alias("isbn"),
        some(4, F.concat(F.lit("10.2/"), k), "string").alias("doi"),
        F.when(k % 10 == 0, F.array().cast("array<struct<id:string,label:string>>")).otherwise(F.array(F.struct(F.concat(F.lit("http://id.org/lang/"), code).alias("id"), F.lit("x").alias("label")))).alias("language"),
        F.when(k % 8 == 0, F.array().cast("array<struct<label:string,id:string>>")).otherwise(F.array(entry("a", F.concat(F.lit("/toc/"), k)), entry("b", F.when(k % 9 != 0, F.concat(F.lit("HTTPS://x.org/toc/"), k))))).alias("tableOfContents"),
    )


RECORDS = """records AS (SELECT p_partkey AS position, p_partkey % 7 <> 0 AND p_partkey % 8 <> 0 AS fits, CASE WHEN p_partkey % 3 = 0 THEN 'T' || p_partkey ELSE '978' || (p_partkey % 50) END AS key,
  CASE WHEN p_partkey % 17 <> 0 THEN p_name ELSE '' END AS title, CASE WHEN p_partkey % 10 <> 0 THEN ['de', 'en', 'fr', 'nl', 'pol', NULL][p_partkey % 6 + 1] END AS language,
  CASE WHEN p_partkey % 4 <> 0 THEN '10.2/' || p_partkey END AS doi, CASE WHEN p_partkey % 8 <> 0 AND p_partkey % 9 <> 0 THEN 'HTTPS://x.org/toc/' || p_partkey END AS toc_download_url,
  'http://x.org/r/T' || p_partkey || '?format=json' AS lobid_url, CASE WHEN p_partkey % 3 = 0 THEN 'T' || p_partkey ELSE '978' || (p_partkey % 50) END || '.pdf' AS filename, 'CC0-1.0' AS license, 'library' AS license_source FROM part)"""


def _projected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.manifest_entries(_records(spark, sf_dir), "CC0-1.0", "library", "position")


@registered(f"WITH {RECORDS} SELECT * FROM records")
def manifest_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as manifest entries, with whether they belong in one."""
    return _projected(spark, sf_dir)


SCAN = f"""{RECORDS}, firsts AS (SELECT min(position) AS position FROM records WHERE fits GROUP BY key),
scanned AS (SELECT r.position, r.key, CASE WHEN NOT fits THEN 'no matching type/toc' WHEN key IN (SELECT 'T' || o_orderkey FROM orders) OR key IN (SELECT key FROM records q WHERE q.fits AND q.toc_download_url IS NOT NULL AND q.position < r.position) THEN 'already acquired' WHEN toc_download_url IS NULL THEN 'no toc url' END AS skipped FROM records r)"""


def _scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why a record of the dump is skipped, in the dump's order; the first of a key that has an address is taken."""
    held = adapters.table(spark, sf_dir, "orders").select(F.concat(F.lit("T"), "o_orderkey").alias("key"))
    return backlog.scan_reasons(_projected(spark, sf_dir), held)


@registered(f"WITH {SCAN} SELECT * FROM scanned")
def manifest_dedupe_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scanned(spark, sf_dir)


@registered(f"WITH {SCAN} SELECT position, key FROM scanned WHERE skipped IS NULL ORDER BY position LIMIT 100")
def acquired_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scan's first hundred new documents, which is where it stops."""
    return _scanned(spark, sf_dir).where("skipped is null").orderBy("position").limit(100).select("position", "key")


@registered(f"WITH {RECORDS} SELECT c.c_custkey, min(r.position) AS position FROM customer c LEFT JOIN records r ON r.key = '978' || (c.c_custkey % 60) GROUP BY 1")
def record_by_isbn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each number asked for, the first record that has it."""
    first = _records(spark, sf_dir).select("position", F.explode("isbn").alias("isbn")).groupBy("isbn").agg(F.min("position").alias("position"))
    asked = adapters.table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("978"), F.col("c_custkey") % 60).alias("isbn"))
    return asked.join(first, "isbn", "left").select("c_custkey", "position")


ANSWER = "l_suppkey % 10"


@registered("""SELECT l_orderkey AS key, pos AS place, title, authors, page, skip FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_returnflag, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate ORDER BY raw) - 1 AS pos FROM (
    SELECT l.*, unnest([{'raw': 0, 'title': p_name, 'authors': CASE WHEN l_suppkey % 3 = 0 THEN '' ELSE 'A. B' END, 'page': CASE l_suppkey % 4 WHEN 0 THEN l_linenumber::VARCHAR WHEN 1 THEN 'R' || l_linenumber END, 'skip': l_suppkey % 6 IN (1, 3, 4)}, {'raw': 1, 'title': 'Last', 'authors': '', 'page': NULL, 'skip': false}], recursive := true)
    FROM lineitem l JOIN part ON l_partkey = p_partkey WHERE l_suppkey % 10 <> 9))""")
def code_fence_json_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw answers, some fenced, some without an array, parsed into entries; what isn't an entry is left out."""
    line = adapters.table(spark, sf_dir, "lineitem").join(adapters.table(spark, sf_dir, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    s = F.col("l_suppkey")
    authors = F.when(s % 3 == 0, F.lit('"A. B"')).otherwise(F.lit('[" A. B ", " "]'))
    page = F.when(s % 4 == 0, F.format_string("%d.0", "l_linenumber")).when(s % 4 == 1, F.format_string('" R%d "', "l_linenumber")).when(s % 4 == 2, "-1").otherwise("true")
    skip = F.element_at(F.array(*map(F.lit, ("false", '"false"', "0", "1", "true", "null"))), (s % 6 + 1).cast("int"))
    items = F.format_string('[{"title": " %s ", "authors": %s, "printed_page_number": %s, "skip": %s}, 7, "x", {"title": "ab"}, {"title": "Last"}]', "p_name", authors, page, skip)
    answer = F.when(s % 10 == 9, F.lit("no list here")).when(s % 2 == 0, F.concat(F.lit("```json\n"), items, F.lit("\n```"))).otherwise(F.concat(F.lit("Here it is: "), items, F.lit(" done")))
    parsed = line.select(F.col("l_orderkey").alias("key"), F.posexplode(records.answer_entries(answer)).alias("place", "e"))
    return parsed.select("key", "place", "e.title", F.array_join("e.authors", "; ").alias("authors"), "e.page", "e.skip")


def _registry(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(registry entries of the covered documents, these documents)."""
    entries = _chapters(spark, sf_dir)
    books = registry.covered(entries)
    full = adapters.with_pages(entries.withColumns({"reader": F.lit("registry"), "skip": F.lit(False)}))
    return full.join(books, "key", "left_semi"), books


def _evaluation(source: str) -> tuple[str, ...]:
    """Parts of a query that hold a reading of covered documents against the registry."""
    sort = "row_number() OVER (PARTITION BY key, reader ORDER BY page IS NULL, coalesce(page_val, 0), coalesce(page, ''), ordinal)"
    return (
        sql.READINGS,
        sql.TRUTH,
        ITEMS,
        f"books AS ({source})",
        "given AS (SELECT r.key, 'given' AS reader, ordinal, title, page FROM readings r JOIN books ON books.key = r.key AND books.reader = r.reader WHERE NOT skip)",
        "both_sides AS (SELECT * FROM given UNION ALL SELECT key, 'registry', ordinal, title, page FROM reg WHERE key IN (SELECT key FROM books))",
        sql.entries("both_sides"),
        f"left_side AS (SELECT * REPLACE ({sort} AS ordinal), true AS fixed FROM entries WHERE reader = 'given'), right_side AS (SELECT * REPLACE ({sort} AS ordinal) FROM entries WHERE reader = 'registry')",
        sql.ALIGNED,
        """counted AS (SELECT key, coalesce(tp, 0) AS tp, coalesce(n_b, 0) - coalesce(tp, 0) AS fp, coalesce(n_a, 0) - coalesce(tp, 0) AS fn FROM books LEFT JOIN (SELECT key, count(*) AS n_a FROM left_side GROUP BY 1) USING (key) LEFT JOIN (SELECT key, count(*) AS n_b FROM right_side GROUP BY 1) USING (key) LEFT JOIN (SELECT key, count(*) AS tp FROM matched GROUP BY 1) USING (key)),
shares AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall FROM counted),
evaluated AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM shares)""",
    )


WITH_TRUTH = _evaluation("SELECT key, 'A' AS reader FROM covered WHERE key IN (SELECT key FROM truth)")
WITH_N = _evaluation("SELECT key, 'N' AS reader FROM covered WHERE key IN (SELECT key FROM readings WHERE reader = 'N')")
RATED = "key, tp, fp, fn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1"
MEANS = "round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall, round(avg(f1), 6) AS f1, count(*) AS n_books"


def _evaluated(spark: SparkSession, sf_dir: str, reader: str) -> DataFrame:
    entries, books = _registry(spark, sf_dir)
    given = adapters.readings(spark, sf_dir).where(F.col("reader") == reader)
    known = adapters.truth(spark, sf_dir) if reader == "A" else given
    return registry.evaluate(books.join(known, "key", "left_semi"), given, entries)


@registered(sql.query(*WITH_TRUTH, select=f"SELECT {RATED} FROM evaluated"))
def evaluate_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The truth of every document that the registry covers, held against it."""
    return _evaluated(spark, sf_dir, "A").select("key", "tp", "fp", "fn", six("precision"), six("recall"), six("f1"))


@registered(f"WITH {ITEMS}, {sql.TRUTH} SELECT key FROM truth WHERE key NOT IN (SELECT key FROM covered)")
def evaluate_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with truth that the registry doesn't cover."""
    return adapters.truth(spark, sf_dir).select("key").join(_registry(spark, sf_dir)[1], "key", "left_anti")


@registered(sql.query(*WITH_N, select=f"SELECT {RATED} FROM evaluated"))
def evaluate_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model's readings of the covered documents, held against the registry."""
    return _evaluated(spark, sf_dir, "N").select("key", "tp", "fp", "fn", six("precision"), six("recall"), six("f1"))


@registered(f"WITH {ITEMS} SELECT key FROM covered WHERE key NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'N')")
def model_without_reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Covered documents that the model hasn't read."""
    read = adapters.table(spark, sf_dir, "lineitem").where("l_returnflag = 'N'").select(F.col("l_orderkey").alias("key"))
    return _registry(spark, sf_dir)[1].join(read, "key", "left_anti")


@registered(f"WITH {ITEMS} SELECT l_returnflag AS model, count(DISTINCT l_orderkey) AS n_books FROM lineitem WHERE l_orderkey IN (SELECT key FROM covered) GROUP BY 1 UNION SELECT 'wanted', 0")
def models_for_covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The models that have read covered documents, with those that are asked for by name."""
    read = adapters.readings(spark, sf_dir).join(_registry(spark, sf_dir)[1], "key", "left_semi").groupBy(F.col("reader").alias("model")).agg(F.count_distinct("key").alias("n_books"))
    asked = read.groupBy().agg(F.lit("wanted").alias("model"), F.lit(0).cast("long").alias("n_books"))
    return read.unionByName(asked).groupBy("model").agg(F.max("n_books").alias("n_books"))


def _means(evaluated: DataFrame, label: str) -> DataFrame:
    return metrics.macro(evaluated.withColumn("source", F.lit(label)), "source").select("source", six("precision"), six("recall"), six("f1"), "n_books")


@registered("WITH " + _plain_part(WITH_TRUTH, "a") + "SELECT * FROM evaluated),\n" + _plain_part(WITH_N, "n") + f"SELECT * FROM evaluated)\nSELECT 'truth' AS source, {MEANS} FROM a HAVING count(*) > 0 UNION ALL SELECT 'N', {MEANS} FROM n HAVING count(*) > 0")
def overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row of means for each source that has results."""
    return _means(_evaluated(spark, sf_dir, "A"), "truth").unionByName(_means(_evaluated(spark, sf_dir, "N"), "N"))


@registered(sql.query(*WITH_TRUTH, select="SELECT round(avg(f1), 6) AS mean_f1, (coalesce(avg(f1), -1) < 0.5)::INTEGER AS exit_code FROM evaluated"))
def min_f1_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1 where the mean F1 is unknown or under the bound."""
    return _evaluated(spark, sf_dir, "A").agg(F.round(F.avg("f1"), 6).alias("mean_f1"), F.when(F.coalesce(F.avg("f1"), F.lit(-1.0)) < 0.5, 1).otherwise(0).alias("exit_code"))


@registered("WITH " + _plain_part(GOLD, "acc") + """SELECT model, f1 FROM accuracy), models AS (SELECT DISTINCT l_returnflag AS model FROM lineitem)
SELECT model, round(f1, 6) AS f1, row_number() OVER (ORDER BY coalesce(f1, -1) DESC, model) AS place FROM models LEFT JOIN acc USING (model)""")
def accuracy_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models by F1 against the arbitrated truth; A, which is never held against it, comes last."""
    models = adapters.table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("model"))
    return metrics.accuracy_table(models, metrics.macro(_gold(spark, sf_dir), "model")).select("model", six("f1"), "place")


@registered(sql.query(*ALL, select="SELECT side_a AS model_a, side_b AS model_b, round(avg(rate), 6) AS mean_agreement, count(*) AS n_books FROM rates WHERE side_a = 'A' GROUP BY ALL"))
def unscored_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of readers of which one, A, has no F1."""
    agreement = metrics.pairwise(_rated(adapters.readings(spark, sf_dir))[2])
    return metrics.unscored(agreement, metrics.macro(_gold(spark, sf_dir), "model")).select("model_a", "model_b", six("mean_agreement"), "n_books")


BOOKS = "books AS (SELECT o_orderkey AS key, CASE o_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE '10.1/' || o_orderkey END AS doi FROM orders)"


def _books(spark: SparkSession, sf_dir: str) -> DataFrame:
    doi = F.when(F.col("o_custkey") % 3 == 1, "").when(F.col("o_custkey") % 3 == 2, F.concat(F.lit("10.1/"), "o_orderkey"))
    return adapters.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), doi.alias("doi"))


@registered(f"WITH {BOOKS}, {sql.TRUTH} SELECT key FROM books WHERE coalesce(doi, '') = '' AND key IN (SELECT key FROM truth)")
def needs_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backlog.needs_backfill(_books(spark, sf_dir), adapters.truth(spark, sf_dir))


DOIS = "dois AS (SELECT key, min_by('10.1/' || l_partkey, ordinal) FILTER (l_partkey % 11 = 0) AS doi FROM items GROUP BY key)"


@registered(f"""WITH {BOOKS}, {sql.TRUTH}, {ITEMS}, {DOIS}, todo AS (SELECT key FROM books WHERE coalesce(doi, '') = '' AND key IN (SELECT key FROM truth))
SELECT count(*) AS checked, count(doi) AS dois, count_if(key IN (SELECT key FROM reg)) AS chapter_lists, count_if(key IN (SELECT key FROM covered)) AS entries_written FROM todo LEFT JOIN dois USING (key)""")
def backfill_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a pass over the documents without a DOI finds in the registry."""
    todo = needs_backfill(spark, sf_dir)
    mark = lambda d, name: d.select("key").distinct().withColumn(name, F.lit(True))
    entries = _chapters(spark, sf_dir)
    found = todo.join(registry_book_doi(spark, sf_dir), "key", "left").join(mark(entries, "listed"), "key", "left").join(mark(registry.covered(entries), "covered"), "key", "left")
    return found.agg(F.count("*").alias("checked"), F.count("doi").alias("dois"), F.count("listed").alias("chapter_lists"), F.count("covered").alias("entries_written"))


@registered(f"WITH {BOOKS}, {ITEMS}, {DOIS} SELECT key, coalesce(d.doi, b.doi) AS doi FROM books b LEFT JOIN dois d USING (key)")
def doi_write_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest with the registry's DOIs where there are any."""
    return backlog.updated(_books(spark, sf_dir), registry_book_doi(spark, sf_dir), "key", "doi")


@registered("SELECT o_orderkey AS key, model FROM orders, (SELECT unnest(['lab/one', 'lab/two']) AS model) WHERE NOT (model = 'lab/one' AND o_custkey % 20 = 0)")
def active_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = adapters.table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "key")
    skipped = orders.where("o_custkey % 20 = 0").select("key", F.lit("lab/one").alias("model"))
    return backlog.active(["lab/one", "lab/two"], orders, skipped)


@registered("SELECT o_orderkey AS key, model, 'vision' AS kind FROM orders, (SELECT unnest(['A', 'N']) AS model) WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = model AND l_linestatus = 'F')")
def missing_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings that the cache hasn't in the kind that is asked for; a cached one of another kind doesn't count."""
    kind = F.when(F.col("l_linestatus") == "F", "vision").otherwise("text")
    cached = adapters.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_returnflag").alias("model"), kind.alias("kind"))
    wanted = backlog.active(["A", "N"], _books(spark, sf_dir), cached.select("key", "model").limit(0)).withColumn("kind", F.lit("vision"))
    return backlog.missing(wanted, cached)


@registered("WITH held AS (SELECT o_orderkey AS key, 'no contents' AS reason FROM orders WHERE o_orderpriority = '5-LOW' AND o_totalprice > 300000) SELECT * FROM held UNION ALL SELECT o_orderkey, 'blurred' FROM orders WHERE o_custkey % 10 = 0 AND o_orderkey NOT IN (SELECT key FROM held)")
def reject_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New rejections; a document that is rejected already keeps its reason."""
    orders = adapters.table(spark, sf_dir, "orders")
    new = orders.where("o_custkey % 10 = 0").select(F.col("o_orderkey").alias("key"), F.lit("blurred").alias("reason"))
    return backlog.inserted(_rejected(spark, sf_dir).withColumn("reason", F.lit("no contents")), new, ["key"])


@registered("SELECT o_orderkey AS key, 'lab__one' AS model FROM orders WHERE o_custkey % 20 = 0 AND o_orderstatus <> 'P'")
def skip_list_remove(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The skip list without pairs that are taken off it; models as they stand in file names."""
    orders = adapters.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), records.file_part(records.model_of(F.lit("--port 1 --model lab/one"))).alias("model"), "o_orderstatus", "o_custkey")
    return backlog.removed(orders.where("o_custkey % 20 = 0").select("key", "model"), orders.where("o_orderstatus = 'P'").select("key", "model"), ["key", "model"])


@registered(sql.query(*CLOSE, select="""SELECT b.key, 'bulk_gate' AS source, false AS verified, n_a + n_b - matched AS n_entries, n_skip FROM best b JOIN (
  SELECT key, count_if(skip) AS n_skip FROM (
    SELECT e.key, e.skip FROM entries e JOIN best USING (key) WHERE e.reader = 'A'
    UNION ALL SELECT e.key, e.skip FROM entries e JOIN best USING (key) LEFT JOIN matched m ON m.key = e.key AND m.j = e.ordinal WHERE e.reader = 'B' AND m.key IS NULL) GROUP BY key) USING (key)"""))
def truth_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the gate writes: one nested row for each document that passes."""
    from parallax.plans.catalogue import _merged

    stored = backlog.truth_entry(_merged(spark, sf_dir).withColumnRenamed("position", "ordinal"))
    return stored.select("key", "source", "verified", F.size("entries").cast("long").alias("n_entries"), F.size(F.filter("entries", lambda e: e["skip"])).cast("long").alias("n_skip"))


@registered(sql.query(*ALL, sql.TRUTH, select="""SELECT key, n AS readers, CASE WHEN n = 1 THEN 'single' WHEN n = 2 THEN 'diff' ELSE 'listing' END AS shape, CASE WHEN n = 2 THEN matched END AS matched, CASE WHEN n = 2 THEN n_a - matched END AS only_a, CASE WHEN n = 2 THEN n_b - matched END AS only_b
FROM (SELECT key, count(*) AS n FROM sizes GROUP BY 1) LEFT JOIN (SELECT * FROM rates QUALIFY count(*) OVER (PARTITION BY key) = 1) USING (key) WHERE key NOT IN (SELECT key FROM truth)"""))
def arbitration_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For documents without truth: one reading alone, the difference of two, or a listing of more."""
    entries = adapters.readings(spark, sf_dir).join(adapters.truth(spark, sf_dir), "key", "left_anti")
    readers = entries.groupBy("key").agg(F.count_distinct("reader").alias("readers"))
    rates = _rated(entries)[2].select("key", "n_a", "n_b", "matched")
    both = readers.join(rates.join(readers.where("readers = 2").select("key"), "key", "left_semi"), "key", "left")
    shape = F.when(F.col("readers") == 1, "single").when(F.col("readers") == 2, "diff").otherwise("listing")
    return both.select("key", "readers", shape.alias("shape"), "matched", (F.col("n_a") - F.col("matched")).alias("only_a"), (F.col("n_b") - F.col("matched")).alias("only_b"))


@registered("""SELECT event_id, CASE WHEN user_id % 5 = 0 THEN CASE event_id % 4 WHEN 0 THEN 'day' WHEN 1 THEN 'hour' WHEN 2 THEN 'minute' END END AS rate_window,
  CASE WHEN event_id % 6 = 5 THEN NULL WHEN user_id % 5 = 0 THEN CASE WHEN event_id % 4 = 0 THEN NULL WHEN user_id % 2 = 0 THEN 7.5 ELSE 20.0 * (event_id % 6 + 1) END ELSE 2.0 * pow(2, event_id % 6) END::DOUBLE AS delay FROM events""")
def retry_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each failed call's rate limit, and how long to wait before the next attempt."""
    e, u = F.col("event_id"), F.col("user_id")
    left = lambda name, gone: F.struct(F.lit(f"X-RateLimit-Remaining-{name}").alias("key"), F.when(gone, " 0 ").otherwise("12").alias("value"))
    after = F.struct(F.lit("retry-after").alias("key"), F.when(u % 2 == 0, "7.5").otherwise("soon").alias("value"))
    headers = F.when(u % 5 == 0, F.map_from_entries(F.array(left("Minute", e % 4 != 3), left("Hour", e % 4 < 2), left("Day", e % 4 == 0), after)))
    events = adapters.table(spark, sf_dir, "events")
    return events.select("event_id", records.binding_window(headers).alias("rate_window"), records.retry_delay((e % 6).cast("int"), u % 5 == 0, headers).alias("delay"))
