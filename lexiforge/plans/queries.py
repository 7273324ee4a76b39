"""The engine's queries over the driver's tables, each with its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexiforge.functions import html as H
from lexiforge.functions import text as X
from lexiforge.operators import books, canary, chunk, freq, ledger, publish, search, validate, vocab

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# A word list of our own for the driver's languages.
STOPS = {"en": "the of and to in is that for with on as are this be at by or an it was", "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als", "fr": "de la le et les des en un du une que est pour qui dans par plus au sur la", "es": "de la que el en y a los se del las un por con no una su para es al"}


def stopwords(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, w) for k, v in STOPS.items() for w in sorted(set(v.split()))], "language string, word string")


_STOPS_SQL = ", ".join(f"('{k}', '{w}')" for k, v in STOPS.items() for w in sorted(set(v.split())))
_TOKENS_SQL = r"""
t AS (SELECT lang, doc_id, unnest(list_transform(list_filter(string_split_regex(coalesce(text, ''), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> ''), lambda x: lower(x))) AS key,
             generate_subscripts(list_filter(string_split_regex(coalesce(text, ''), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> ''), 1) - 1 AS i FROM documents),
f AS (SELECT lang AS language, key, count(*) AS count, count(DISTINCT doc_id) AS doc_count, min((doc_id, i)) AS first_ord FROM t GROUP BY ALL),
r AS (SELECT language, row_number() OVER (PARTITION BY language ORDER BY count DESC, first_ord)::INTEGER AS rank, key, count, doc_count FROM f)"""
_CAND_SQL = f"""{_TOKENS_SQL},
s(language, key) AS (VALUES {_STOPS_SQL}),
c AS (SELECT * FROM r ANTI JOIN s USING (language, key) WHERE length(key) >= 2 AND (count >= 30 OR doc_count >= 3)
      QUALIFY row_number() OVER (PARTITION BY language ORDER BY rank) <= 20000)"""


def _freq(spark, sf_dir):
    return freq.document_freq(read(spark, sf_dir, "documents"))


def _candidates(spark, sf_dir):
    return freq.candidates(_freq(spark, sf_dir), stopwords(spark))


@query(f"WITH {_TOKENS_SQL} SELECT * FROM r")
def token_freq(spark, sf_dir):
    return _freq(spark, sf_dir)


@query(f"WITH {_CAND_SQL} SELECT * FROM c")
def candidate_filter(spark, sf_dir):
    return _candidates(spark, sf_dir)


@query(f"WITH {_CAND_SQL} SELECT language, count(*) AS types, coalesce((SELECT count(*) FROM c WHERE c.language = r.language), 0) AS candidates FROM r GROUP BY language")
def freq_summary(spark, sf_dir):
    f = _freq(spark, sf_dir)
    return freq.summary(f, freq.candidates(f, stopwords(spark)))


@query(f"WITH {_TOKENS_SQL} SELECT language, key, doc_count FROM r WHERE doc_count >= 2")
def doc_freq(spark, sf_dir):
    return _freq(spark, sf_dir).filter("doc_count >= 2").select("language", "key", "doc_count")


@query(f"WITH {_TOKENS_SQL} SELECT language, rank, key FROM r WHERE rank <= 1500 AND NOT contains(key, '-')")
def vocab_top(spark, sf_dir):
    return _freq(spark, sf_dir).filter(F.col("rank") <= 1500).filter(~vocab.lemma_artifact(F.col("key"))).select("language", "rank", "key")


@query("""WITH c AS (SELECT user_id, event_type, count(*) AS n, min(event_id) AS first FROM events GROUP BY ALL)
SELECT user_id, coalesce(arg_max(event_type, (n, -first)) FILTER (WHERE event_type <> ''), '') AS modal FROM c GROUP BY user_id""")
def modal_pos(spark, sf_dir):
    return freq.modal_value(read(spark, sf_dir, "events"), ["user_id"], "event_type", "event_id")


@query(f"""WITH {_CAND_SQL}, p AS (SELECT language, key, row_number() OVER (PARTITION BY language ORDER BY rank) - 1 AS place FROM c)
SELECT language, (place // 20 * 20)::BIGINT AS start, array_to_string(list(key ORDER BY place), ' ') AS words, count(*) AS n FROM p GROUP BY language, place // 20""")
def batching(spark, sf_dir):
    b = vocab.batches(_candidates(spark, sf_dir))
    return b.select("language", "start", F.array_join("words", " ").alias("words"), F.size("words").cast("long").alias("n"))


@query(f"""WITH {_CAND_SQL} SELECT language, ceil(count(*) / 20)::BIGINT AS total,
 (SELECT count(*) FROM events WHERE event_type = 'click' AND user_id % 4 = CASE language WHEN 'en' THEN 0 WHEN 'de' THEN 1 WHEN 'fr' THEN 2 ELSE 3 END) AS done,
 (SELECT count(*) FROM events WHERE event_type = 'click' AND user_id % 4 = CASE language WHEN 'en' THEN 0 WHEN 'de' THEN 1 WHEN 'fr' THEN 2 ELSE 3 END) >= ceil(count(*) / 20) AS complete FROM c GROUP BY language""")
def batch_completeness(spark, sf_dir):
    lang = F.element_at(F.array(*map(F.lit, ("en", "de", "fr", "es"))), (F.col("user_id") % 4 + 1).cast("int"))
    tasks = read(spark, sf_dir, "events").select(F.lit("s6").alias("stage"), F.when(F.col("event_type") == "click", "done").otherwise("queued").alias("status"), F.lit("batch").alias("executor"), F.concat(lang, F.lit("#"), "event_id").alias("item_key"))
    return vocab.completeness(tasks, _candidates(spark, sf_dir), "s6", "batch")


@query(f"""WITH {_CAND_SQL}, g AS (SELECT lang AS language, lower(regexp_extract(text, '[\\p{{L}}\\p{{M}}\\p{{N}}]+')) AS word, text AS gloss_zh, doc_id FROM documents)
SELECT language, key AS word, arg_min(gloss_zh, doc_id) AS gloss_zh, min(rank) AS rank FROM c JOIN g ON g.language = c.language AND g.word = c.key GROUP BY ALL""".replace("SELECT language, key AS word", "SELECT c.language, key AS word"))
def gloss_join(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    first = F.lower(F.regexp_extract("text", r"[\p{L}\p{M}\p{N}]+", 0))
    gloss = docs.select(F.col("lang").alias("language"), first.alias("word"), F.col("text").alias("gloss_zh"), F.lit("").alias("pos"), F.lit("").alias("hanja"), F.col("doc_id").alias("file"), F.lit(0).alias("item"))
    return vocab.first_gloss(gloss).join(_candidates(spark, sf_dir).withColumnRenamed("key", "word"), ["language", "word"]).select("language", "word", "gloss_zh", "rank")


@query(f"""WITH {_CAND_SQL}, g AS (SELECT lang AS language, lower(regexp_extract(text, '[\\p{{L}}\\p{{M}}\\p{{N}}]+')) AS word, arg_min(text, doc_id) AS gloss_zh FROM documents GROUP BY ALL)
SELECT c.language || '-voc-' || printf('%05d', rank) AS id, c.language, word, '' AS reading, '' AS pos, gloss_zh, '' AS gloss_detail_zh, 'draft' AS status FROM c JOIN g ON g.language = c.language AND g.word = c.key WHERE rank <= 1500""")
def ingest_vocab(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    first = F.lower(F.regexp_extract("text", r"[\p{L}\p{M}\p{N}]+", 0))
    gloss = docs.select(F.col("lang").alias("language"), first.alias("word"), F.col("text").alias("gloss_zh"), F.lit("").alias("pos"), F.lit("").alias("hanja"), F.col("doc_id").alias("file"), F.lit(0).alias("item"))
    return vocab.entries(_candidates(spark, sf_dir).withColumn("reading", F.lit("")), gloss).drop("frequency")


@query("""WITH o AS (SELECT sha256(text) AS sha256, arg_min(lang, doc_id) AS language, min(doc_id) AS first, max(doc_id) AS last FROM documents GROUP BY 1)
SELECT 'book-' || language || '-' || printf('%03d', row_number() OVER (PARTITION BY language ORDER BY first)) AS book_id, language, 'title ' || first AS title_orig, 'corpus/' || last AS epub_path, sha256, true AS is_new FROM o""")
def register_books(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    files = docs.select("lang", F.concat(F.lit("corpus/"), "doc_id").alias("path"), F.sha2("text", 256).alias("sha256"), F.concat(F.lit("title "), "doc_id").alias("title"), F.col("doc_id").alias("ord"))
    none = spark.createDataFrame([], "book_id string, title_orig string, language string, epub_path string, sha256 string")
    return books.register(files, none)


@query("SELECT source AS book_id, count(*) AS chapter_count, sum(n_chars)::BIGINT AS total_chars, bool_or(contains(text, '|')) AS has_ruby FROM documents GROUP BY source")
def book_rollup(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return books.rollup(docs.select(F.col("source").alias("book_id"), F.col("n_chars").alias("char_count"), F.contains("text", F.lit("|")).alias("has_ruby")))


@query("SELECT source AS book_id, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id)::INTEGER AS chapter_idx FROM documents WHERE n_chars >= 80")
def chapter_index(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select(F.col("source").alias("book_id"), "doc_id", F.col("doc_id").alias("spine_pos"), F.col("n_chars").alias("char_count"))
    return books.dense_chapters(docs, 80).select("book_id", "doc_id", "chapter_idx")


@query("SELECT doc_id, coalesce(quality, -1) AS status FROM documents LEFT JOIN labels USING (doc_id)")
def upsert_books(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", F.lit(-1).alias("status"))
    return books.upsert(docs, read(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("status")), "doc_id")


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id")
def ledger_register(spark, sf_dir):
    return books.latest(read(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type"), "user_id", ["ts", "event_id"]).drop("ts")


@query("SELECT doc_id AS book_id, lang AS language FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS DISTINCT FROM 1")
def select_pending_books(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    rows = rows.select(F.col("doc_id").alias("book_id"), F.col("lang").alias("language"), F.when(F.col("quality") == 1, "unpacked").alias("status"))
    return books.pending(rows).select("book_id", "language")


@query("SELECT doc_id AS book_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def select_untokenized(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("book_id"), F.lit("unpacked").alias("status"))
    return books.untokenized(docs, read(spark, sf_dir, "labels").select(F.col("doc_id").alias("book_id"))).select("book_id")


@query("SELECT CASE quality WHEN 1 THEN 'unpacked' WHEN 0 THEN 'registered' ELSE '?' END AS status, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def status_histogram(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    return books.status_histogram(rows.select(F.when(F.col("quality") == 1, "unpacked").when(F.col("quality") == 0, "registered").alias("status")))


@query("SELECT event_type AS stage, CASE WHEN event_id % 3 = 0 THEN 'done' ELSE 'queued' END AS status, count(*) AS n, coalesce(sum(json_extract(props, '$.k')::BIGINT), 0)::BIGINT AS prompt_tokens, coalesce(sum(user_id), 0)::BIGINT AS completion_tokens FROM events GROUP BY 1, 2")
def ledger_report(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return ledger.report(e.select(F.col("event_type").alias("stage"), F.when(F.col("event_id") % 3 == 0, "done").otherwise("queued").alias("status"), F.get_json_object("props", "$.k").cast("long").alias("prompt_tokens"), F.col("user_id").alias("completion_tokens")))


def _task_events(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    task = F.concat("user_id", F.lit("-"), F.col("event_id") % 30)
    n = F.row_number().over(W.partitionBy("user_id", F.col("event_id") % 30).orderBy("event_id"))
    kind = F.when(n == 1, "enqueue").otherwise(F.element_at(F.array(*map(F.lit, ("claim", "complete", "fail"))), (F.col("event_id") % 3 + 1).cast("int")))
    none = F.lit(None).cast("string")
    return e.select(F.col("event_id").alias("seq"), task.alias("id"), kind.alias("event"), F.col("event_id").alias("ts"), F.lit("s4").alias("stage"), none.alias("book_id"), F.col("event_type").alias("item_key"), F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("executor"), F.lit(3).alias("max_attempts"), F.get_json_object("props", "$.k").cast("long").alias("prompt_tokens"), F.lit(1).cast("long").alias("completion_tokens"), none.alias("output_path"), F.lit("x").alias("error"))


_STATE_SQL = """WITH n AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_id % 30 ORDER BY event_id) AS n FROM events),
k AS (SELECT *, CASE WHEN n = 1 THEN 'enqueue' ELSE ['claim', 'complete', 'fail'][event_id % 3 + 1] END AS event FROM n),
s AS (SELECT user_id || '-' || event_id % 30 AS id, arg_max(event, event_id) AS last, count(*) FILTER (WHERE event = 'claim') AS attempts, min(event_id) AS enqueue_ts,
 max(event_id) FILTER (WHERE event = 'claim') AS start_ts, max(event_id) FILTER (WHERE event IN ('complete', 'fail')) AS end_ts,
 arg_max(json_extract(props, '$.k')::BIGINT, event_id) FILTER (WHERE event = 'complete') AS prompt_tokens,
 arg_max(event_type, event_id) FILTER (WHERE event = 'complete' AND event_id % 2 = 0) AS executor FROM k GROUP BY user_id, event_id % 30),
l AS (SELECT id, CASE last WHEN 'enqueue' THEN 'queued' WHEN 'claim' THEN 'running' WHEN 'complete' THEN 'done' ELSE 'failed' END AS status, attempts, enqueue_ts, start_ts, end_ts, prompt_tokens, executor FROM s)"""


@query(f"{_STATE_SQL} SELECT * FROM l")
def ledger_state(spark, sf_dir):
    return ledger.state(_task_events(spark, sf_dir)).select("id", "status", "attempts", "enqueue_ts", "start_ts", "end_ts", "prompt_tokens", "executor")


@query(f"{_STATE_SQL} SELECT id, CASE WHEN status = 'running' AND start_ts < (SELECT max(event_id) FROM events) + 900 - 1800 THEN 'queued' ELSE status END AS status, attempts FROM l WHERE status = 'queued' OR (status = 'running' AND start_ts < (SELECT max(event_id) FROM events) + 900 - 1800) OR (status = 'failed' AND attempts < 3)")
def ledger_pending(spark, sf_dir):
    # now: so long after the log's end that some of its last claims are stale
    now = read(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] + 900
    return ledger.pending(ledger.state(_task_events(spark, sf_dir)), "s4", now).select("id", "status", "attempts")


@query(f"{_STATE_SQL} SELECT event_id FROM events WHERE user_id || '-' || event_id % 30 NOT IN (SELECT id FROM l WHERE status = 'done')")
def resume_not_done(spark, sf_dir):
    work = read(spark, sf_dir, "events").select("event_id", F.concat("user_id", F.lit("-"), F.col("event_id") % 30).alias("task_id"))
    return ledger.not_done(work, ledger.state(_task_events(spark, sf_dir))).select("event_id")


@query("SELECT doc_id, substr(sha256('6' || chr(31) || doc_id || chr(31) || text || chr(31)), 1, 16) AS hash FROM documents")
def content_hash(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", X.content_hash(F.lit("6"), F.col("doc_id"), F.col("text")).alias("hash"))


_UWS = r"[\s\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{0085}\x0B]"


@query(rf"SELECT doc_id, sha256(regexp_replace(regexp_replace(text, '{_UWS}+', ' ', 'g'), '^ | $', '', 'g')) AS normal FROM documents")
def norm_ws(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.sha2(X.norm_ws(F.col("text")), 256).alias("normal"))


@query(rf"SELECT doc_id, sha256(regexp_replace(text, '[\s\x{{00A0}}\x{{3000}}\x0B\x{{0085}}\x{{2028}}\x{{2029}}、。，．！？!?…・「」『』()（）\-—]+', '', 'g')) AS normal FROM documents")
def norm_for_match(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.sha2(X.norm_for_match(F.col("text")), 256).alias("normal"))


@query(r"""WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT doc_id, count(*) AS lines, count(*) FILTER (WHERE length(line) < 2 OR regexp_matches(line, '(?i)(FullName|mso-|MsoNormal|st1:|\d{4}-\d{2}-\d{2}T\d{2}:|false false|behavior:url)') OR NOT regexp_matches(line, '[\p{L}\p{M}\p{N}_]')) AS junk FROM p GROUP BY doc_id""")
def is_junk(spark, sf_dir):
    lines = read(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.groupBy("doc_id").agg(F.count("*").alias("lines"), F.count_if(X.is_junk(F.col("line"))).alias("junk"))


@query(rf"SELECT doc_id, sha256(lower(regexp_replace(coalesce(nullif(text, ''), source), '{_UWS}+', '', 'g'))) AS key FROM documents")
def dedup_key(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.sha2(X.dedup_key(F.lit(""), F.col("text"), F.col("source")), 256).alias("key"))


_LEVELS_SQL = """l AS (SELECT d.doc_id, lang, CASE WHEN lang IN ('en', 'de') THEN 'ko' ELSE 'th' END AS language, 'level ' || (n_chars % 9) AS level FROM documents d),
n AS (SELECT doc_id, language, CASE language WHEN 'ko' THEN 'TOPIK' ELSE 'L' END || regexp_extract(level, '(\\d)', 1) AS level FROM l)"""


def _levels(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    rows = docs.select("doc_id", F.when(F.col("lang").isin("en", "de"), "ko").otherwise("th").alias("language"), F.concat(F.lit("level "), F.col("n_chars") % 9).alias("level"))
    return rows.withColumn("level", X.norm_level(F.col("language"), F.col("level")))


@query(f"WITH {_LEVELS_SQL.replace(chr(92) * 2, chr(92))} SELECT doc_id, language, level, CASE WHEN right(level, 1) BETWEEN '1' AND '6' THEN right(level, 1)::INTEGER END AS level_rank FROM n")
def norm_level(spark, sf_dir):
    return _levels(spark, sf_dir).withColumn("level_rank", X.level_rank(F.col("level")))


@query(f"WITH {_LEVELS_SQL.replace(chr(92) * 2, chr(92))} SELECT language, coalesce(level, 'all') AS bucket, count(*) AS n FROM n GROUP BY GROUPING SETS ((language, level), (language))")
def level_counts(spark, sf_dir):
    return publish.level_counts(_levels(spark, sf_dir))


_PAGES_SQL = f"""WITH {_LEVELS_SQL.replace(chr(92) * 2, chr(92))}, b AS (SELECT *, unnest(['all', level]) AS bucket FROM n),
p AS (SELECT doc_id, language, level, bucket, row_number() OVER (PARTITION BY language, bucket ORDER BY level, doc_id)::INTEGER AS pos FROM b)"""


@query(f"{_PAGES_SQL} SELECT *, ceil(pos / 12)::BIGINT AS page FROM p")
def pagination_grammar(spark, sf_dir):
    return publish.pages(_levels(spark, sf_dir), ["level", "doc_id"], 12, F.col("level"))


@query(f"{_PAGES_SQL} SELECT language, bucket, ceil(pos / 12)::BIGINT AS page, level, array_to_string(list(doc_id ORDER BY pos), ' ') AS items FROM p GROUP BY ALL")
def page_group_by_level(spark, sf_dir):
    paged = publish.pages(_levels(spark, sf_dir), ["level", "doc_id"], 12, F.col("level"))
    return publish.grouped_page(paged, "doc_id").withColumn("items", F.array_join(F.col("items").cast("array<string>"), " "))


@query("SELECT doc_id, lang AS language, 'all' AS bucket, row_number() OVER (PARTITION BY lang ORDER BY n_chars, doc_id)::INTEGER AS pos, ceil(row_number() OVER (PARTITION BY lang ORDER BY n_chars, doc_id) / 24)::BIGINT AS page FROM documents")
def pagination_vocab(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("language"), "n_chars")
    return publish.pages(docs, ["n_chars", "doc_id"], 24).drop("n_chars")


@query("""SELECT language, coalesce(n, 0)::BIGINT AS items, greatest(1, ceil(coalesce(n, 0) / 24))::BIGINT AS pages
FROM (VALUES ('en'), ('de'), ('fr'), ('es'), ('vi')) v(language) LEFT JOIN (SELECT lang AS language, count(*) AS n FROM documents GROUP BY 1) USING (language)""")
def page_counts(spark, sf_dir):
    langs = spark.createDataFrame([(x,) for x in ("en", "de", "fr", "es", "vi")], "language string")
    return publish.page_counts(langs, read(spark, sf_dir, "documents").select(F.col("lang").alias("language")), 24)


@query("""WITH c AS (SELECT lang, ceil(count(*) / 24)::BIGINT AS pages FROM documents GROUP BY lang), p AS (SELECT lang, pages, unnest(range(1, pages + 1)) AS page FROM c)
SELECT lang AS language, page, array_to_string(list_filter(range(1, pages + 1), lambda x: x = 1 OR x = pages OR abs(x - page) <= 2), ' ') AS shown FROM p""")
def pager_window(spark, sf_dir):
    c = read(spark, sf_dir, "documents").groupBy(F.col("lang").alias("language")).agg(F.ceil(F.count("*") / 24).alias("pages"))
    c = c.withColumn("page", F.explode(F.sequence(F.lit(1).cast("long"), "pages")))
    return c.select("language", "page", F.array_join(publish.pager_window(F.col("page"), F.col("pages")).cast("array<string>"), " ").alias("shown"))


@query("""SELECT language, coalesce(g, 0)::BIGINT AS documents, coalesce(q, 0)::BIGINT AS good FROM (VALUES ('en'), ('de'), ('fr'), ('es'), ('vi')) v(language)
LEFT JOIN (SELECT lang AS language, count(*) AS g FROM documents GROUP BY 1) USING (language) LEFT JOIN (SELECT lang AS language, count(*) AS q FROM documents JOIN labels USING (doc_id) WHERE quality = 1 GROUP BY 1) USING (language)""")
def lang_counts(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("language"))
    good = docs.join(read(spark, sf_dir, "labels").filter("quality = 1"), "doc_id")
    langs = spark.createDataFrame([(x,) for x in ("en", "de", "fr", "es", "vi")], "language string")
    return publish.language_counts(langs, documents=docs, good=good)


@query("SELECT source AS value, count(*) AS n FROM documents WHERE source <> '' GROUP BY 1")
def facet_counts(spark, sf_dir):
    return search.facet_counts(read(spark, sf_dir, "documents"), "source")


@query("""SELECT conv_id, turn, role, substr(text, 1, 120) AS text FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) <= 2""")
def sanitize_examples(spark, sf_dir):
    return publish.first_examples(read(spark, sf_dir, "conversations"), "conv_id", "turn", "text")


@query("SELECT d.doc_id FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.toxic IS NULL OR l.toxic <> 1")
def drop_status(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select("doc_id").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    return publish.visible(rows.select("doc_id", F.when(F.col("toxic") == 1, "deprecated").when(F.col("toxic") == 0, "draft").alias("status"))).select("doc_id")


@query("SELECT doc_id, coalesce('q' || quality, source) AS source FROM documents LEFT JOIN labels USING (doc_id)")
def book_title_lookup(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("b"), "source")
    titles = read(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("book_id"), F.concat(F.lit("q"), "quality").alias("title_orig"))
    found = books.with_title(docs, titles, "b")
    return found.select("doc_id", F.when(F.col("b") == F.col("doc_id").cast("string"), F.col("source")).otherwise(F.col("b")).alias("source"))


@query("SELECT doc_id AS id, doc_id IN (SELECT doc_id FROM labels) AS has_tutorial FROM documents")
def tutorial_exists(spark, sf_dir):
    return publish.with_tutorials(read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id")), read(spark, sf_dir, "labels").select(F.col("doc_id").alias("id")))


@query("SELECT doc_id AS id, coalesce(quality, 0) AS level_rank FROM documents LEFT JOIN labels USING (doc_id)")
def tutorial_to_grammar(spark, sf_dir):
    return publish.tutorial_levels(read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id")), read(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("level_rank")))


def _linked(spark, sf_dir):
    """Documents as entries that refer to the next one (other language) and to their double (same language)."""
    docs = read(spark, sf_dir, "documents")
    same = F.array(F.struct((F.col("doc_id") * 2).cast("string").alias("id"), F.lit("base").alias("relation")))
    return docs.select(F.lit("p").alias("path"), F.col("doc_id").cast("string").alias("id"), F.struct(F.array((F.col("doc_id") + 1).cast("string")).alias("cross_lang"), same.alias("same_lang")).alias("related"))


@query("""WITH r AS (SELECT doc_id, unnest([doc_id + 1, doc_id * 2]) AS ref FROM documents)
SELECT doc_id::VARCHAR AS id, ref::VARCHAR AS detail FROM r WHERE ref NOT IN (SELECT doc_id FROM labels)""")
def dangling_refs(spark, sf_dir):
    ids = read(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"))
    return validate.dangling_refs(_linked(spark, sf_dir), ids).select("id", "detail")


@query("""SELECT d.doc_id::VARCHAR AS id, (d.doc_id + 1) || ':' || coalesce(a.quality::VARCHAR, '?') AS "cross", CASE WHEN b.quality IS NULL THEN '' ELSE (d.doc_id * 2) || ':' || b.quality END AS same
FROM documents d LEFT JOIN labels a ON a.doc_id = d.doc_id + 1 LEFT JOIN labels b ON b.doc_id = d.doc_id * 2""")
def related_resolve(spark, sf_dir):
    titles = read(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"), F.col("quality").cast("string").alias("title"))
    r = publish.related(_linked(spark, sf_dir), titles)
    shown = lambda c: F.array_join(F.transform(F.coalesce(c, F.array().cast(dict(r.dtypes)[c])), lambda x: F.concat(x["ref"], F.lit(":"), F.coalesce(x["title"], F.lit("?")))), " ")
    return r.select("id", shown("cross").alias("cross"), shown("same").alias("same"))


@query("WITH n AS (SELECT doc_id, text, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS n FROM documents) SELECT doc_id FROM n WHERE n > 1")
def dup_ids(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), F.sha2("text", 256).alias("id"))
    return validate.duplicate_ids(rows).select(F.col("path").alias("doc_id"))


@query("WITH m AS (SELECT source, doc_id FROM documents) SELECT source AS id, doc_id::VARCHAR AS detail FROM m WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def dangling_members(spark, sf_dir):
    own = read(spark, sf_dir, "documents").groupBy(F.col("source").alias("group_id"), "lang", (F.col("doc_id") % 64).alias("part")).agg(F.collect_list(F.col("doc_id").cast("string")).alias("m"))
    groups = own.select("group_id", F.lit("p").alias("path"), F.create_map("lang", "m").alias("members"))
    ids = read(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"))
    return validate.dangling_members(groups, ids).select("id", "detail")


@query("SELECT lang AS language, 'x' || max(doc_id) AS last, lang || '-grm-' || printf('%05d', max(doc_id) + 1) AS next_id FROM documents GROUP BY lang".replace("'x' || max(doc_id) AS last, ", ""))
def id_allocation(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select(F.col("lang").alias("language"), F.format_string("%s-grm-%05d", "lang", "doc_id").alias("id"))
    return validate.next_ids(rows, "grm")


def _chunk_sql(book: str, chapter: str) -> str:
    """Chunks by a recursive walk over the paragraphs of a book, target 2000, one paragraph of overlap."""
    return f"""WITH RECURSIVE d AS (SELECT {book} AS book_id, {chapter} AS ch, doc_id, string_split(text, chr(10)) AS l FROM documents),
e AS (SELECT book_id, ch, unnest(l) AS line, generate_subscripts(l, 1) AS a FROM d),
p AS (SELECT book_id, ch, line, length(line) AS n, row_number() OVER (PARTITION BY book_id ORDER BY ch, a) AS i FROM e),
w AS (SELECT book_id, i, 0 AS k, i AS start, n::BIGINT AS len, n, ch AS from_ch FROM p WHERE i = 1
 UNION ALL SELECT p.book_id, p.i, CASE WHEN w.len + p.n > 2000 THEN k + 1 ELSE k END, CASE WHEN w.len + p.n > 2000 THEN w.i ELSE start END, CASE WHEN w.len + p.n > 2000 THEN w.n ELSE w.len END + p.n, p.n,
  CASE WHEN w.len + p.n > 2000 THEN (SELECT ch FROM p q WHERE q.book_id = w.book_id AND q.i = w.i) ELSE from_ch END FROM w JOIN p ON p.book_id = w.book_id AND p.i = w.i + 1),
c AS (SELECT book_id, k, min(start) AS a, max(i) AS b, max(len) AS char_count, min(from_ch) AS from_chapter FROM w GROUP BY book_id, k)
SELECT c.book_id, k::INTEGER AS chunk_idx, from_chapter::INTEGER AS from_chapter, max(p.ch)::INTEGER AS to_chapter, char_count, string_agg(line, chr(10) ORDER BY i) AS text FROM c JOIN p ON p.book_id = c.book_id AND p.i BETWEEN a AND b GROUP BY ALL"""


def _paragraphs(spark, sf_dir, book: str, chapter: F.Column):
    docs = read(spark, sf_dir, "documents")
    return docs.select(F.col(book).alias("book_id"), chapter.cast("int").alias("chapter_idx"), F.posexplode(F.split("text", "\n")).alias("para_idx", "text"))


@query(_chunk_sql("doc_id", "0"))
def chunker(spark, sf_dir):
    return chunk.chunks(_paragraphs(spark, sf_dir, "doc_id", F.lit(0)))


@query(_chunk_sql("source", "doc_id"))
def chunker_cross_doc(spark, sf_dir):
    return chunk.chunks_of_long_books(_paragraphs(spark, sf_dir, "source", F.col("doc_id")))


@query("""WITH p AS (SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS ch, text FROM documents QUALIFY ch <= 3),
l AS (SELECT source, ch, replace(unnest(string_split(text, chr(10))), ' ', '') AS t, generate_subscripts(string_split(text, chr(10)), 1) AS a FROM p)
SELECT source AS book_id, substr(arg_min(t, (4 - ch, a)), 11, 40) AS canary FROM l WHERE length(t) BETWEEN 50 AND 200 GROUP BY source""")
def canary_pick(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").withColumn("ch", F.row_number().over(W.partitionBy("source").orderBy("doc_id"))).filter("ch <= 3")
    rows = docs.select(F.col("source").alias("book_id"), F.col("ch").alias("chapter_idx"), F.posexplode(F.split("text", "\n")).alias("para_idx", "text"))
    return canary.pick(rows)


@query("""WITH c AS (SELECT item_id, substr(text, 11, 40) AS canary FROM benchmark), p AS (SELECT item_id, unnest([canary, substr(canary, 1, 20), substr(canary, 11, 20)]) AS probe FROM c)
SELECT DISTINCT item_id, doc_id FROM p JOIN documents ON contains(text, probe) WHERE probe <> ''""")
def canary_check(spark, sf_dir):
    items = read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("book_id"), F.substring("text", 11, 40).alias("canary"))
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return canary.containment(docs, canary.probes(items)).select(F.col("book_id").alias("item_id"), "doc_id").distinct()


@query("SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events")
def json_field(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query()
def paragraphs(spark, sf_dir):
    rows = read(spark, sf_dir, "pages").select("page_id", H.document("html").alias("d"))
    return rows.select("page_id", "d.title", F.posexplode("d.paras").alias("para_idx", "p")).select("page_id", "title", "para_idx", "p.text", "p.annot")


@query(r"""WITH w AS (SELECT doc_id, list_filter(string_split_regex(text, '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w FROM documents), t AS (SELECT doc_id, lower(unnest(w)) AS term, generate_subscripts(w, 1) - 1 AS pos FROM w)
SELECT term, doc_id AS id, count(*) AS tf, sha256(string_agg(pos, ' ' ORDER BY pos)) AS positions FROM t GROUP BY ALL""")
def index_build(spark, sf_dir):
    rows = search.index(read(spark, sf_dir, "documents"), "doc_id", "text")
    return rows.select("term", "id", "tf", F.sha2(F.array_join(F.col("positions").cast("array<string>"), " "), 256).alias("positions"))


@query(r"""WITH w AS (SELECT doc_id, lang, source, list_transform(list_filter(string_split_regex(text, '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> ''), lambda x: lower(x)) AS w FROM documents),
n AS (SELECT count(*) AS n, avg(len(w)) AS mean FROM w WHERE len(w) > 0), h AS (SELECT doc_id, lang, source, len(w) AS dl, unnest(w) AS term FROM w),
g AS (SELECT doc_id, lang, source, dl, term, count(*) AS tf FROM h WHERE term IN ('the', 'tion') GROUP BY ALL), f AS (SELECT term, count(*) AS df FROM g GROUP BY term),
s AS (SELECT doc_id, lang, source, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / mean))), 6) AS score, count(*) AS terms FROM g JOIN f USING (term), n GROUP BY ALL),
k AS (SELECT doc_id, score, lang FROM s WHERE terms = 1 AND lang IN ('en', 'de') AND source IN ('src1', 'src2'))
SELECT doc_id, score, lang, (SELECT count(*) FROM k) AS total FROM k ORDER BY score DESC, doc_id LIMIT 8""".replace("IN ('the', 'tion')", "IN ('the')"))
def search_page(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    postings, n, mean = search.lookup(docs, "doc_id", "text", "the")
    found = search.search(postings, docs.select("doc_id", "lang", "source"), "the", {"lang": ["en", "de"], "source": ["src1", "src2"]}, "doc_id", n_docs=n, mean_len=mean)
    return found.select("doc_id", "score", "lang", "total")


# Modules that register more queries in the same tables.
from lexiforge.plans import function_queries, knowledge_queries, source_queries  # noqa: E402, F401
