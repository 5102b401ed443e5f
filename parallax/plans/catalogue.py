"""The named queries over the given tables, with their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parallax.functions import pages, similarity, text
from parallax.operators import align, catalog, gate, layout, metrics, sampling
from parallax.plans import sql
from parallax.sources import adapters
from parallax.storage import saved

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def registered(oracle: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE_SQL[f.__name__] = oracle
        return f

    return add


def six(c: str) -> Column:
    return F.round(c, 6).alias(c)


PLAIN = (sql.READINGS, sql.entries())
ALL = (*PLAIN, sql.SIDES, sql.ALIGNED, sql.RATES)
CLOSE = sql.CLOSE_PARTS
REAL = (*PLAIN, sql.TRUTH, sql.GOLD.replace("WHERE reader = 'A'", "WHERE reader = 'A' AND NOT skip"), sql.ALIGNED, sql.GOLD_SCORES)
GOLD = (*PLAIN, sql.TRUTH, sql.GOLD, sql.ALIGNED, sql.GOLD_SCORES)


def _rated(entries: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    pairs = align.readers(entries)
    found = align.candidates(entries, entries, ordered=True)
    matched = saved(align.align(found), "matched")
    return pairs, matched, align.rates(entries, matched, pairs)


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = adapters.perturbed(spark, sf_dir)
    pairs, matched, rates = _rated(entries)
    return gate.merge(entries, gate.best_pair(gate.passed(rates)), align.diff(entries, matched, pairs))


def _gold(spark: SparkSession, sf_dir: str, skipped: bool = True) -> DataFrame:
    """Each reader's counts against reader A of the arbitrated orders; both sides are ordered by page first. skipped:
    entries to skip count as truth, too."""
    entries = adapters.readings(spark, sf_dir)
    if not skipped:
        entries = entries.where("reader <> 'A' or not skip")
    order = W.partitionBy("key", "reader").orderBy(F.col("page").isNull(), F.coalesce("page_val", F.lit(0)), F.coalesce("page", F.lit("")), "ordinal")
    entries = entries.withColumn("ordinal", F.row_number().over(order))
    truth = adapters.truth(spark, sf_dir).where("source = 'agent_arbitration'")
    gold, others = entries.where("reader = 'A'").join(truth, "key", "left_semi"), entries.where("reader <> 'A'")
    matched = align.align(align.candidates(gold, others)).groupBy("key", F.col("side_b").alias("reader")).agg(F.count("*").alias("tp"))
    counted = others.groupBy("key", "reader").agg(F.count("*").alias("n_b")).join(gold.groupBy("key").agg(F.count("*").alias("n_a")), "key").join(matched, ["key", "reader"], "left")
    tp = F.coalesce("tp", F.lit(0))
    return metrics.scores(counted.select("key", F.col("reader").alias("model"), tp.alias("tp"), (F.col("n_b") - tp).alias("fp"), (F.col("n_a") - tp).alias("fn")))


@registered(sql.query(*PLAIN, select="SELECT key, reader, ordinal, page, page_val, CASE WHEN page IS NOT NULL THEN 'n:' || page_val END AS page_key, page IS NOT NULL AND try_cast(page AS INTEGER) IS NULL AS printed_roman FROM entries"))
def page_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    roman = F.coalesce(pages.printed_roman(F.col("page")), F.lit(False))
    return adapters.readings(spark, sf_dir).select("key", "reader", "ordinal", "page", "page_val", "page_key", roman.alias("printed_roman"))


@registered(sql.query(*PLAIN, select="SELECT key, reader, ordinal, row_number() OVER (PARTITION BY key, reader ORDER BY page IS NULL, coalesce(page_val, 0), coalesce(page, ''), ordinal) AS place FROM entries"))
def page_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = W.partitionBy("key", "reader").orderBy(*pages.page_order(F.col("page")), "ordinal")
    return adapters.readings(spark, sf_dir).select("key", "reader", "ordinal", F.row_number().over(order).alias("place"))


@registered("""SELECT p_partkey, p_name AS title FROM part""")
def title_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles with a number, an author and curly quotes put on come back as they were."""
    part = adapters.table(spark, sf_dir, "part")
    author = F.concat(F.lit("A. "), F.col("p_brand"))
    dressed = F.concat((F.col("p_partkey") % 30 + 1).cast("string"), F.lit(". "), F.when(F.col("p_partkey") % 2 == 0, F.concat(author, F.lit(": "), "p_name")).otherwise(F.concat("p_name", F.lit(" - "), author)), F.lit(" (S. 3)."))
    return part.select("p_partkey", text.normalize_title(F.when(F.col("p_partkey") % 2 == 0, dressed).otherwise(F.regexp_replace(dressed, r" \(S\. 3\)\.$", "")), F.array(author)).alias("title"))


ISBN = "CASE p_partkey % 4 WHEN 0 THEN '978-3-' || lpad(p_partkey::VARCHAR, 8, '0') || '-1' WHEN 1 THEN 'x; 3-' || lpad(p_partkey::VARCHAR, 8, '0') || '-x' WHEN 2 THEN '3' || lpad(p_partkey::VARCHAR, 9, '0') || ' 979' || lpad(p_partkey::VARCHAR, 10, '0') ELSE 'none' END"


@registered("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '9783' || lpad(p_partkey::VARCHAR, 8, '0') || '1' WHEN 1 THEN '3' || lpad(p_partkey::VARCHAR, 8, '0') || 'X' WHEN 2 THEN '979' || lpad(p_partkey::VARCHAR, 10, '0') END AS isbn FROM part""")
def isbn_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.expr(ISBN.replace("::VARCHAR", "").replace("lpad(p_partkey", "lpad(cast(p_partkey as string)"))
    return adapters.table(spark, sf_dir, "part").select("p_partkey", text.normalize_isbn(raw).alias("isbn"))


@registered("""SELECT l_orderkey AS key, count(*) AS n_chapters, min(l_linenumber)::BIGINT AS first_page FROM lineitem WHERE l_suppkey % 5 <> 4 GROUP BY 1 HAVING count(*) >= 3""")
def evaluation_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry chapters from their page ranges; a document needs three whose first page is known."""
    line = adapters.table(spark, sf_dir, "lineitem")
    span = F.when(F.col("l_suppkey") % 5 == 4, F.lit("")).otherwise(F.concat(F.lit(" "), "l_linenumber", F.lit(" - "), F.col("l_linenumber") + 9))
    known = line.select(F.col("l_orderkey").alias("key"), text.first_page(span).alias("page")).where("page is not null")
    return known.groupBy("key").agg(F.count("*").alias("n_chapters"), F.min(F.col("page").cast("long")).alias("first_page")).where("n_chapters >= 3")


STRATA = "strata AS (SELECT o_orderkey AS key, (year(o_orderdate) // 10)::VARCHAR || '0s' AS decade, o_orderpriority AS language FROM orders)"


def _strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.array(F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("startDate"), F.lit(None).cast("string").alias("dateStatement")))
    return adapters.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), text.decade(event).alias("decade"), F.col("o_orderpriority").alias("language"))


@registered(f"WITH {STRATA}, c AS (SELECT decade, language, count(*) AS n FROM strata GROUP BY ALL) SELECT decade, language, n, least(n, round_even(75 * n / (SELECT sum(n) FROM c), 0)::BIGINT) AS share FROM c")
def stratified_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.allocation(_strata(spark, sf_dir), 75, ["decade", "language"])


@registered(None)
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.stratified(_strata(spark, sf_dir), 75, ["decade", "language"], "key")


NAMES = "names AS (SELECT DISTINCT p_name AS t FROM part), met AS (SELECT a.t AS ta, b.t AS tb, a.t AS sa, b.t AS sb FROM names a JOIN names b ON left(a.t, 1) = left(b.t, 1))"


@registered(f"WITH {NAMES}, {sql.scored('met')} SELECT ta AS a, tb AS b, round({sql.ratio('ta', 'tb')}, 6) AS ratio, round(sort_ratio, 6) AS token_sort, round(partial, 6) AS partial, round(score, 6) AS score, strict >= 95 AS near FROM scores")
def title_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All scores of part names that share their first letter."""
    names = adapters.table(spark, sf_dir, "part").select(F.col("p_name").alias("a"), F.substring("p_name", 1, 1).alias("k")).distinct()
    met = names.join(names.withColumnRenamed("a", "b"), "k")
    a, b = F.col("a"), F.col("b")
    scored = met.select("a", "b", similarity.ratio_of(a, b).alias("ratio"), similarity.token_sort_ratio(a, b).alias("token_sort"), similarity.partial_ratio_of(F.lower(a), F.lower(b)).alias("partial"), similarity.title_score(a, b).alias("score"))
    return scored.select("a", "b", six("ratio"), six("token_sort"), six("partial"), six("score"), (F.col("token_sort") >= similarity.NEAR).alias("near"))


@registered(sql.query(*PLAIN, sql.SIDES, sql.ALIGNED, select="SELECT * FROM matched"))
def align_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rated(adapters.readings(spark, sf_dir))[1]


@registered(sql.query(sql.READINGS, sql.WRAPPED, sql.entries("wrapped"), sql.VARIANTS, sql.scored("met"), select="""SELECT key, i, j, round(CASE WHEN page_at = '-' THEN strict ELSE score END, 6) AS score, strict >= 95 AS near
FROM (SELECT key, i, j, page_at, max(score) AS score, max(strict) AS strict FROM met JOIN scores USING (ta, tb, sa, sb) GROUP BY ALL) WHERE CASE WHEN page_at = '-' THEN strict >= 95 ELSE score >= 70 END"""))
def variant_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries that may match when the variants of titles count, too."""
    entries = adapters.wrapped(spark, sf_dir)
    return align.candidates(entries, entries, ordered=True).select("key", "i", "j", six("score"), "near")


@registered(sql.query(*ALL, select="""SELECT key, side_a, side_b, 'matched' AS kind, i, j FROM matched
UNION ALL SELECT p.key, p.side_a, p.side_b, 'only_a', e.ordinal, NULL FROM pairs p JOIN entries e ON e.key = p.key AND e.reader = p.side_a WHERE NOT EXISTS (SELECT 1 FROM matched m WHERE m.key = p.key AND m.side_a = p.side_a AND m.side_b = p.side_b AND m.i = e.ordinal)
UNION ALL SELECT p.key, p.side_a, p.side_b, 'only_b', NULL, e.ordinal FROM pairs p JOIN entries e ON e.key = p.key AND e.reader = p.side_b WHERE NOT EXISTS (SELECT 1 FROM matched m WHERE m.key = p.key AND m.side_a = p.side_a AND m.side_b = p.side_b AND m.j = e.ordinal)"""))
def diff_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = adapters.readings(spark, sf_dir)
    pairs, matched, _ = _rated(entries)
    return align.diff(entries, matched, pairs)


@registered(sql.query(*ALL, select="SELECT side_a AS model_a, side_b AS model_b, round(avg(rate), 6) AS mean_agreement, count(*) AS n_books FROM rates GROUP BY ALL"))
def pairwise_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.pairwise(_rated(adapters.readings(spark, sf_dir))[2]).select("model_a", "model_b", six("mean_agreement"), "n_books")


@registered(sql.query(*ALL, select="SELECT side_a AS model, side_b AS other, round(avg(rate), 6) AS agreement FROM rates GROUP BY ALL UNION ALL SELECT side_b, side_a, round(avg(rate), 6) FROM rates GROUP BY ALL"))
def agreement_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The symmetric matrix of agreement, a row for each cell off the diagonal."""
    found = pairwise_agreement(spark, sf_dir)
    swap = F.explode(F.array(F.struct(F.col("model_a").alias("model"), F.col("model_b").alias("other")), F.struct(F.col("model_b").alias("model"), F.col("model_a").alias("other")))).alias("c")
    return found.select(swap, F.col("mean_agreement").alias("agreement")).select("c.model", "c.other", "agreement")


@registered(sql.query(*CLOSE, select="SELECT key, side_a, side_b, n_a, n_b, matched, near, round(rate, 6) AS rate, passed FROM gated"))
def gate_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    gated = gate.passed(_rated(adapters.perturbed(spark, sf_dir))[2])
    return gated.select("key", "side_a", "side_b", "n_a", "n_b", "matched", "near", six("rate"), "passed")


@registered(sql.query(*ALL, sql.GATE, select="SELECT reason, count(*) AS n_books FROM (SELECT e.key, CASE WHEN e.n = 0 THEN 'no_entries' WHEN e.n < 2 THEN 'single_reading_only' WHEN b.key IS NOT NULL THEN 'ok' ELSE 'below_threshold' END AS reason FROM (SELECT o_orderkey AS key, count(DISTINCT reader) AS n FROM orders LEFT JOIN entries ON key = o_orderkey GROUP BY 1) e LEFT JOIN best b ON b.key = e.key) GROUP BY 1"))
def gate_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = adapters.readings(spark, sf_dir)
    best = gate.best_pair(gate.passed(_rated(entries)[2]))
    books = adapters.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"))
    return gate.outcomes(entries, best, books).groupBy("reason").agg(F.count("*").alias("n_books"))


@registered(sql.query(*ALL, sql.GATE, select="SELECT key, side_a, side_b, round(rate, 6) AS rate FROM best"))
def gate_best_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.best_pair(gate.passed(_rated(adapters.readings(spark, sf_dir))[2])).select("key", "side_a", "side_b", six("rate"))


@registered(sql.query(*CLOSE, select="""SELECT key, row_number() OVER (PARTITION BY key ORDER BY page IS NULL, coalesce(page_val, 0), coalesce(page, ''), side, ordinal) AS position, title, CASE WHEN reader = 'B' OR ordinal % 2 = 0 THEN reader || ' author ' || ordinal WHEN side = 0 THEN 'B author ' || j ELSE '' END AS authors, page, skip FROM (
  SELECT e.*, CASE WHEN m.i IS NOT NULL THEN 0 ELSE 1 END AS side, m.j FROM best b JOIN entries e ON e.key = b.key AND e.reader = b.side_a LEFT JOIN matched m ON m.key = b.key AND m.side_a = b.side_a AND m.side_b = b.side_b AND m.i = e.ordinal
  UNION ALL SELECT e.*, 2, NULL FROM best b JOIN entries e ON e.key = b.key AND e.reader = b.side_b WHERE NOT EXISTS (SELECT 1 FROM matched m WHERE m.key = b.key AND m.side_a = b.side_a AND m.side_b = b.side_b AND m.j = e.ordinal))"""))
def gate_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir).withColumn("authors", F.array_join("authors", "; "))


@registered(sql.query(*REAL, select="SELECT key, model, tp, fp, fn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM evaluated"))
def evaluate_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each reader's entries against the truth's real ones."""
    return _gold(spark, sf_dir, skipped=False).select("key", "model", "tp", "fp", "fn", six("precision"), six("recall"), six("f1"))


@registered(sql.query(*GOLD, select="SELECT model, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, n_books FROM accuracy"))
def gold_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.macro(_gold(spark, sf_dir), "model").select("model", six("precision"), six("recall"), six("f1"), "n_books")


def _ranking(alias: str) -> str:
    return f"""SELECT {alias} FROM (SELECT *, CASE WHEN e >= 1 THEN 0 ELSE (o - e) / (1 - e) END AS k FROM (SELECT *, f1_a * f1_b + (1 - f1_a) * (1 - f1_b) AS e FROM (
  SELECT side_a, side_b, o, n, coalesce(a.f1, 1) AS f1_a, b.f1 AS f1_b FROM agreement LEFT JOIN acc a ON a.model = side_a JOIN acc b ON b.model = side_b)))"""


def _plain_part(parts: tuple[str, ...], suffix: str) -> str:
    """Common table expressions put into one, so that two alignments can stand in one query."""
    return f"{suffix} AS (WITH RECURSIVE " + ",\n".join(parts) + "\n"


@registered(
    "WITH "
    + _plain_part(ALL, "agreement")
    + "SELECT side_a, side_b, avg(rate) AS o, count(*) AS n FROM rates GROUP BY ALL),\n"
    + _plain_part(GOLD, "acc")
    + "SELECT model, f1 FROM accuracy)\n"
    + _ranking("side_a AS model_a, side_b AS model_b, round(f1_a, 6) AS f1_a, round(f1_b, 6) AS f1_b, round(o, 6) AS observed_agreement, round(e, 6) AS expected_agreement, round(k, 6) AS kappa, round(least(f1_a, f1_b) - greatest(0, k), 6) AS score, n AS n_books")
)
def rank_candidate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: reader pairs by accuracy less the agreement beyond chance; A, being the truth, has F1 1."""
    agreement = metrics.pairwise(_rated(adapters.readings(spark, sf_dir))[2])
    accuracy = metrics.macro(_gold(spark, sf_dir), "model").select("model", "f1")
    accuracy = accuracy.unionByName(accuracy.groupBy().agg(F.lit("A").alias("model"), F.lit(1.0).alias("f1")))
    ranked = metrics.rank_pairs(agreement, accuracy)
    return ranked.select("model_a", "model_b", *map(six, ("f1_a", "f1_b", "observed_agreement", "expected_agreement", "kappa", "score")), "n_books")


@registered(sql.query(*PLAIN, select="SELECT reader, count(DISTINCT key) AS n_books FROM entries GROUP BY 1 HAVING count(DISTINCT key) >= 50"))
def reader_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.reader_counts(adapters.readings(spark, sf_dir), 50)


@registered("SELECT CASE o_orderstatus WHEN 'F' THEN 'agent_arbitration' WHEN 'O' THEN 'bulk_gate' ELSE 'unknown' END AS source, count(*) AS n_books FROM orders GROUP BY 1")
def source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = adapters.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"))
    return catalog.source_counts(orders.join(adapters.truth(spark, sf_dir), "key", "left"))


def _rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.table(spark, sf_dir, "orders").where("o_orderpriority = '5-LOW' and o_totalprice > 300000").select(F.col("o_orderkey").alias("key"))


REJECTED = "rejected AS (SELECT o_orderkey AS key FROM orders WHERE o_orderpriority = '5-LOW' AND o_totalprice > 300000)"


@registered(f"WITH {sql.TRUTH}, {REJECTED} SELECT DISTINCT l_orderkey AS key FROM lineitem WHERE l_orderkey NOT IN (SELECT key FROM truth) AND l_orderkey NOT IN (SELECT key FROM rejected)")
def needs_arbitration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.needs_arbitration(adapters.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key")), adapters.truth(spark, sf_dir), _rejected(spark, sf_dir))


@registered(f"WITH {sql.TRUTH}, {REJECTED} SELECT o_orderkey AS key FROM orders o WHERE o_custkey % 20 <> 0 AND o_orderkey NOT IN (SELECT key FROM rejected) AND o_orderkey NOT IN (SELECT t.key FROM truth t JOIN orders u ON u.o_orderkey = t.key WHERE NOT (t.source = 'bulk_gate' AND u.o_totalprice < 50000))")
def needs_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheap gated orders count as stale; a twentieth of the customers is held out."""
    orders = adapters.table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "key")
    truth = adapters.truth(spark, sf_dir).join(orders.select("key", "o_totalprice"), "key").withColumn("stale", (F.col("source") == "bulk_gate") & (F.col("o_totalprice") < 50000))
    return catalog.needs_decision(orders, truth, orders.where("o_custkey % 20 = 0").select("key"), _rejected(spark, sf_dir))


@registered(f"""WITH {sql.TRUTH}, {REJECTED}, books AS (SELECT DISTINCT o.o_orderkey AS key, t.source, o.o_orderkey IN (SELECT l_orderkey FROM lineitem) AS has_reading, o.o_orderkey IN (SELECT key FROM rejected) AS is_out, o.o_custkey % 20 = 0 AS is_held FROM orders o LEFT JOIN truth t ON t.key = o.o_orderkey)
SELECT unnest(['books', 'truth', 'gated', 'arbitrated', 'read', 'awaiting arbitration', 'rejected', 'held out']) AS metric,
  unnest([count(*), count(source), count_if(source = 'bulk_gate'), count_if(source = 'agent_arbitration'), count_if(has_reading), count_if(has_reading AND source IS NULL AND NOT is_out), count_if(is_out), count_if(is_held)])::BIGINT AS n_books FROM books""")
def coverage_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = adapters.table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "key")
    read = adapters.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"))
    return catalog.status(orders, read, adapters.truth(spark, sf_dir), _rejected(spark, sf_dir), orders.where("o_custkey % 20 = 0"))


@registered("SELECT o_custkey AS key, min(o_orderkey) AS first_position FROM orders GROUP BY 1")
def requested_keys_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys as requested, in their first places."""
    return adapters.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.min("o_orderkey").alias("first_position"))


@registered("""WITH RECURSIVE w AS (SELECT user_id AS page, value AS vpos, (second(ts) + event_id / 1e6)::DOUBLE AS hpos, event_type AS content, row_number() OVER (PARTITION BY user_id ORDER BY value, second(ts) + event_id / 1e6) AS k FROM events),
f AS (SELECT page, k, vpos AS anchor, 1 AS row, hpos, vpos, content FROM w WHERE k = 1
  UNION ALL SELECT w.page, w.k, CASE WHEN w.vpos - f.anchor > 8 THEN w.vpos ELSE f.anchor END, CASE WHEN w.vpos - f.anchor > 8 THEN f.row + 1 ELSE f.row END, w.hpos, w.vpos, w.content FROM f JOIN w ON w.page = f.page AND w.k = f.k + 1)
SELECT page, row, string_agg(content, ' ' ORDER BY hpos, vpos) AS content FROM f GROUP BY ALL""")
def row_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = adapters.table(spark, sf_dir, "events")
    hpos = (F.second("ts") + F.col("event_id") / 1e6).cast("double")
    return layout.row_clusters(events.select(F.col("user_id").alias("page"), F.col("value").alias("vpos"), hpos.alias("hpos"), F.col("event_type").alias("content")))


from parallax.plans import desk, registry  # noqa: E402,F401  add their queries to the catalogue
