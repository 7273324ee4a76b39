"""Queries of the knowledge base: adoption, validation, lookups, rewrites, tasks and search, each against SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiforge.functions import text as X
from lexiforge.operators import adopt, chunk, lookup, search, validate, vocab
from lexiforge.plans.function_queries import _ANNOT_SQL, _NORM, _PLAIN_SQL, _annotated, _plain
from lexiforge.plans.queries import _CAND_SQL, _candidates, _chunk_sql, _paragraphs, query, read

_LANG = "CASE lang WHEN 'en' THEN 'ko' WHEN 'de' THEN 'ja' WHEN 'fr' THEN 'th' ELSE 'vi' END"


def _lang() -> F.Column:
    return F.when(F.col("lang") == "en", "ko").when(F.col("lang") == "de", "ja").when(F.col("lang") == "fr", "th").otherwise("vi")


def _points(spark, sf_dir) -> DataFrame:
    """Documents as extracted points: all lines as examples, keys that some share, one that is empty, levels of all kinds.

    The source is the whole text, a text that lacks the lines, or none.
    """
    docs = read(spark, sf_dir, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    examples = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("text"), F.lit("").alias("annot"), F.lit("").alias("reading"), F.lit("t").alias("translation_zh")))
    level = F.when(_lang() == "ja", F.concat(F.lit(" n"), F.col("n_chars") % 6)).otherwise(F.concat(F.lit("L"), F.col("n_chars") % 8))
    structure = F.when(F.col("doc_id") % 6 == 0, "").otherwise(F.concat("source", F.lit(" "), F.col("n_chars") % 5))
    chunk_text = F.when(F.col("doc_id") % 7 == 0, F.concat("source", "lang")).when(F.col("doc_id") % 11 == 0, "").otherwise(F.col("text"))
    point = F.struct(F.lit("").alias("title_zh"), structure.alias("structure"), F.lit("").alias("structure_pattern"), level.alias("level"), F.lit("").alias("explanation_zh"), examples.alias("examples"), F.array("lang").alias("tags"), F.lit("1").alias("frequency_hint"))
    return docs.select(F.format_string("%09d", "doc_id").alias("path"), _lang().alias("language"), F.col("source").alias("book_id"), chunk_text.alias("chunk_text"), F.array(point).alias("points"))


def _stored(spark, sf_dir) -> DataFrame:
    """Every thirteenth document as an entry with one example, its language."""
    docs = read(spark, sf_dir, "documents").filter("doc_id % 13 = 0")
    example = F.struct(F.col("lang").alias("text"), F.lit("").alias("reading"), F.lit("").alias("annot"), F.lit("").alias("translation_zh"), F.lit("").alias("source_book"))
    return docs.select(F.format_string("%09d", "doc_id").alias("path"), _lang().alias("language"), F.format_string("%s-grm-%05d", _lang(), "doc_id").alias("id"), F.concat("source", F.lit(" "), F.col("n_chars") % 5).alias("structure"), F.lit("").alias("structure_pattern"), F.array(example).cast(adopt.EXAMPLES).alias("examples"))


def _adopted(spark, sf_dir, dedup: bool = True) -> adopt.Adopted:
    kept = adopt.screened(adopt.points(_points(spark, sf_dir)), annotate=False)
    return adopt.adopt(kept, adopt.kb_index(_stored(spark, sf_dir)), dedup=dedup)


_WS = r"[\s\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{0085}\x0B]"
_SCREENED_SQL = rf"""d AS (SELECT doc_id, {_LANG} AS language, coalesce(text, '') AS text, n_chars, CASE WHEN doc_id % 6 = 0 THEN '' ELSE lower(source || (n_chars % 5)) END AS key,
 CASE WHEN doc_id % 7 = 0 THEN source || lang WHEN doc_id % 11 = 0 THEN '' ELSE coalesce(text, '') END AS chunk FROM documents),
v AS (SELECT *, CASE WHEN language = 'ja' THEN CASE WHEN n_chars % 6 > 0 THEN (6 - n_chars % 6)::INTEGER END WHEN n_chars % 8 BETWEEN 1 AND 6 THEN (n_chars % 8)::INTEGER END AS rank FROM d WHERE language <> 'ja' OR n_chars % 6 > 0),
u AS (SELECT doc_id, chunk, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM v),
t AS (SELECT doc_id, i, {_NORM('chunk')} AS chunk, regexp_replace(raw, '^{_WS}+|{_WS}+$', '', 'g') AS t FROM u),
n AS (SELECT *, {_NORM('t')} AS n FROM t WHERE t <> '' AND length(t) <= 120),
a AS (SELECT doc_id, t, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS nth FROM n WHERE chunk = '' OR n = '' OR contains(chunk, substr(n, 1, greatest(8, floor(0.6 * length(n))::INTEGER)))),
x AS (SELECT doc_id, list(t ORDER BY nth) AS ex, list(regexp_replace(t, '{_WS}+', '', 'g') ORDER BY nth) AS sq FROM a WHERE nth <= 2 GROUP BY doc_id),
p AS (SELECT v.doc_id, v.language, v.key, v.rank, x.ex, x.sq, row_number() OVER (PARTITION BY v.language, v.key ORDER BY v.doc_id) AS n FROM v JOIN x USING (doc_id)),
kb AS (SELECT {_LANG} AS language, lower(source || (n_chars % 5)) AS key, arg_max({_LANG} || '-grm-' || printf('%05d', doc_id), doc_id) AS id, arg_max(lang, doc_id) AS ex FROM documents WHERE doc_id % 13 = 0 GROUP BY ALL),
top AS (SELECT {_LANG} AS language, max(doc_id) AS last FROM documents WHERE doc_id % 13 = 0 GROUP BY ALL),
g AS (SELECT language, key, kb.id, kb.ex FROM (SELECT DISTINCT language, key FROM p UNION SELECT language, key FROM kb) LEFT JOIN kb USING (language, key)),
w AS (SELECT language, key, 0::BIGINT AS n, id IS NOT NULL AS open, CASE WHEN id IS NULL THEN []::VARCHAR[] ELSE [ex] END AS ex, CASE WHEN id IS NULL THEN []::VARCHAR[] ELSE [ex] END AS sq, NULL::BIGINT AS doc_id, NULL::VARCHAR AS outcome FROM g
 UNION ALL SELECT w.language, w.key, p.n, w.open OR p.rank IS NOT NULL,
  CASE WHEN w.open THEN w.ex || CASE WHEN len(w.sq) >= 2 THEN [] WHEN list_contains(w.sq, p.sq[1]) THEN CASE WHEN len(p.sq) < 2 OR list_contains(w.sq, p.sq[2]) THEN [] ELSE [p.ex[2]] END
    ELSE CASE WHEN len(w.sq) = 1 OR len(p.sq) < 2 OR p.sq[1] = p.sq[2] OR list_contains(w.sq, p.sq[2]) THEN [p.ex[1]] ELSE p.ex END END WHEN p.rank IS NOT NULL THEN p.ex ELSE w.ex END,
  CASE WHEN w.open THEN w.sq || CASE WHEN len(w.sq) >= 2 THEN [] WHEN list_contains(w.sq, p.sq[1]) THEN CASE WHEN len(p.sq) < 2 OR list_contains(w.sq, p.sq[2]) THEN [] ELSE [p.sq[2]] END
    ELSE CASE WHEN len(w.sq) = 1 OR len(p.sq) < 2 OR p.sq[1] = p.sq[2] OR list_contains(w.sq, p.sq[2]) THEN [p.sq[1]] ELSE p.sq END END WHEN p.rank IS NOT NULL THEN p.sq ELSE w.sq END,
  p.doc_id, CASE WHEN NOT w.open AND p.rank IS NULL THEN 'rejected' WHEN NOT w.open THEN 'created' WHEN len(w.sq) >= 2 OR (list_contains(w.sq, p.sq[1]) AND (len(p.sq) < 2 OR list_contains(w.sq, p.sq[2]))) THEN 'no-op' ELSE 'merged' END
  FROM w JOIN p ON p.language = w.language AND p.key = w.key AND p.n = w.n + 1),
made AS (SELECT language, key, language || '-grm-' || printf('%05d', coalesce(last, 0) + row_number() OVER (PARTITION BY language ORDER BY doc_id)) AS id FROM w LEFT JOIN top USING (language) WHERE outcome = 'created'),
e AS (SELECT language, key, coalesce(g.id, made.id) AS id, g.id IS NULL AS is_new FROM g LEFT JOIN made USING (language, key))"""


@query(f"WITH RECURSIVE {_SCREENED_SQL} SELECT language, printf('%09d', doc_id) AS path, id, outcome FROM w JOIN e USING (language, key) WHERE outcome IS NOT NULL")
def adopt_all(spark, sf_dir):
    """Every point's outcome, against a walk over each key's points in order."""
    return adopt.outcomes(_adopted(spark, sf_dir)).select("language", "path", "id", "outcome")


@query(f"WITH RECURSIVE {_SCREENED_SQL} SELECT language, count(*) FILTER (WHERE outcome = 'created') AS created, count(*) FILTER (WHERE outcome = 'merged') AS merged FROM w WHERE outcome IS NOT NULL GROUP BY language")
def adopt_counts(spark, sf_dir):
    return adopt.counts(_adopted(spark, sf_dir))


@query(f"""WITH RECURSIVE {_SCREENED_SQL}, f AS (SELECT language, key, arg_max(ex, n) AS ex, bool_or(outcome IN ('created', 'merged')) AS changed FROM w GROUP BY language, key)
SELECT language, key, id, is_new, coalesce(changed, false) AS changed, sha256(array_to_string(ex, chr(31))) AS examples FROM f JOIN e USING (language, key) WHERE id IS NOT NULL""")
def adopt_entries(spark, sf_dir):
    """The entries after adoption: stored ones, grown or not, and new ones (adopt, dedup_hit)."""
    rows = _adopted(spark, sf_dir).entries
    return rows.select("language", "key", "id", "is_new", "changed", F.sha2(F.array_join(F.transform("examples", lambda e: e["text"]), "\x1f"), 256).alias("examples"))


@query(f"""WITH RECURSIVE {_SCREENED_SQL} SELECT p.language, printf('%09d', doc_id) AS path, CASE WHEN rank IS NOT NULL THEN p.language || '-grm-' || printf('%05d', coalesce(last, 0) + row_number() OVER (PARTITION BY p.language, rank IS NULL ORDER BY doc_id)) END AS id,
CASE WHEN rank IS NULL THEN 'rejected' ELSE 'created' END AS outcome FROM p LEFT JOIN top USING (language)""")
def adopt_single_file(spark, sf_dir):
    """Without dedup every legal point is an entry of its own."""
    return adopt.outcomes(_adopted(spark, sf_dir, dedup=False)).select("language", "path", "id", "outcome")


@query(f"WITH RECURSIVE {_SCREENED_SQL} SELECT language, key, id, ex AS example FROM kb")
def load_kb_index(spark, sf_dir):
    """Stored entries by key: of equal keys the last file stands."""
    index = adopt.kb_index(_stored(spark, sf_dir)).groupBy("language", "key").agg(F.max_by(F.struct("id", "examples"), "path").alias("e"))
    return index.select("language", "key", "e.id", F.col("e.examples")[0]["text"].alias("example"))


def _faulty(spark, sf_dir, kind: str) -> DataFrame:
    """Documents as entries with faults of every kind; all lines are examples of every fourth, up to two short ones of others."""
    docs = read(spark, sf_dir, "documents").filter((F.col("doc_id") % 5 == 0) if kind == "voc" else (F.col("doc_id") % 5 != 0)).withColumn("text", F.coalesce("text", F.lit("")))
    d = lambda n: F.col("doc_id") % n == 0
    lines = F.split("text", "\n")
    shown = F.when(d(4), lines).otherwise(F.slice(F.filter(lines, lambda x: (F.length(x) <= 100) & (x.rlike(r"\S"))), 1, 2))
    number = F.col("doc_id") - F.when(d(19), 1).otherwise(0)
    language = F.when(d(23), "xx").otherwise(_lang())
    rank = (F.col("n_chars") % 5 + 1).cast("int")
    level = F.when(language == "ja", F.concat(F.lit("N"), 6 - rank)).when(language == "ko", F.concat(F.lit("TOPIK"), rank)).otherwise(F.concat(F.lit("L"), rank))
    level = F.when(d(41), "N9").otherwise(level)
    ident = F.when(d(17), F.concat(F.lit("bad-"), "doc_id")).otherwise(F.format_string(f"%s-{kind}-%05d", _lang(), number))
    related = F.struct(F.array(F.format_string("%s-grm-%05d", _lang(), F.col("doc_id") + 5)).alias("cross_lang"), F.array(F.struct(ident.alias("id"), F.lit("base").alias("relation"))).alias("same_lang"))
    return docs.select(
        F.format_string(f"{kind}/%09d", "doc_id").alias("path"), ident.alias("id"), language.alias("language"), F.when(d(31), "strange").otherwise("grammar").alias("type"), level.alias("level"),
        (rank + F.when(d(37), 1).otherwise(0)).alias("level_rank"), F.transform(shown, lambda x: F.struct(x.alias("text"))).alias("examples"), related.alias("related"), F.when(d(29), "odd").otherwise("draft").alias("status"),
    )


def _violations(spark, sf_dir) -> DataFrame:
    return validate.validate(_faulty(spark, sf_dir, "grm"), _faulty(spark, sf_dir, "voc"))


_VALID_SQL = rf"""b AS (SELECT *, coalesce(text, '') AS t, CASE WHEN doc_id % 5 = 0 THEN 'voc' ELSE 'grm' END AS kind, {_LANG} AS l, (n_chars % 5 + 1)::INTEGER AS r FROM documents),
c AS (SELECT doc_id, kind, kind || '/' || printf('%09d', doc_id) AS path, CASE WHEN doc_id % 17 = 0 THEN 'bad-' || doc_id ELSE l || '-' || kind || '-' || printf('%05d', doc_id - CASE WHEN doc_id % 19 = 0 THEN 1 ELSE 0 END) END AS id,
 CASE WHEN doc_id % 23 = 0 THEN 'xx' ELSE l END AS language, l, r, CASE WHEN doc_id % 4 = 0 THEN string_split(t, chr(10)) ELSE list_filter(string_split(t, chr(10)), lambda x: length(x) <= 100 AND regexp_matches(x, '[^\s\x0B]'))[1:2] END AS ex FROM b),
f AS (SELECT *, CASE WHEN doc_id % 41 = 0 THEN 'N9' WHEN language = 'ja' THEN 'N' || (6 - r) WHEN language = 'ko' THEN 'TOPIK' || r ELSE 'L' || r END AS level, r + CASE WHEN doc_id % 37 = 0 THEN 1 ELSE 0 END AS level_rank,
 list_transform(ex, lambda x: length(regexp_replace(x, '^{_WS}+|{_WS}+$', '', 'g'))) AS len FROM c),
h AS (SELECT path, id, 'id' AS rule, id AS detail FROM f WHERE doc_id % 17 = 0 UNION ALL SELECT path, id, 'language', 'xx' FROM f WHERE language = 'xx' UNION ALL SELECT path, id, 'status', 'odd' FROM f WHERE doc_id % 29 = 0
 UNION ALL SELECT path, id, 'example_count', len(ex)::VARCHAR FROM f WHERE len(ex) > 2 UNION ALL SELECT path, id, 'example_empty', '' FROM f WHERE list_contains(len, 0) UNION ALL SELECT path, id, 'example_length', list_max(len)::VARCHAR FROM f WHERE list_max(len) > 120
 UNION ALL SELECT path, id, 'type', 'strange' FROM f WHERE kind = 'grm' AND doc_id % 31 = 0 UNION ALL SELECT path, id, 'level', level FROM f WHERE kind = 'grm' AND (level = 'N9' OR language = 'xx')
 UNION ALL SELECT path, id, 'level_rank', level_rank::VARCHAR FROM f WHERE kind = 'grm' AND level <> 'N9' AND language <> 'xx' AND doc_id % 37 = 0),
s AS (SELECT f.* FROM f ANTI JOIN h USING (path)),
u AS (SELECT path, id, unnest([l || '-grm-' || printf('%05d', doc_id + 5), id]) AS ref FROM s),
y AS (SELECT * FROM h UNION ALL SELECT path, id, 'duplicate_id', id FROM (SELECT path, id, row_number() OVER (PARTITION BY id ORDER BY path) AS n FROM s) WHERE n > 1
 UNION ALL SELECT path, id, 'dangling_ref', ref FROM u WHERE ref NOT IN (SELECT id FROM s))"""


@query(f"WITH {_VALID_SQL} SELECT path, id, rule, detail FROM y")
def validate_kb(spark, sf_dir):
    """All violations of a knowledge base with faults of every kind, vocabulary included (field validators, id-set union)."""
    return _violations(spark, sf_dir)


@query(f"WITH {_VALID_SQL} SELECT path, id, rule, detail FROM y ORDER BY path, id, rule, detail LIMIT 50")
def first_errors(spark, sf_dir):
    return validate.first_errors(_violations(spark, sf_dir), 50)


_LOOKUP_SQL = rf"""src AS (SELECT doc_id, {_ANNOT_SQL} AS annot, {_PLAIN_SQL} AS plain FROM documents),
ex AS (SELECT doc_id AS id, regexp_replace(string_split({_PLAIN_SQL}, chr(10))[-1], '^{_WS}+|{_WS}+$', '', 'g') AS goal FROM documents WHERE doc_id % 3 = 0),
ha AS (SELECT id, goal, substr(goal, 1, greatest(10, length(goal) // 2)) AS half FROM ex WHERE goal <> ''),
hit AS (SELECT id, doc_id, annot, CASE WHEN contains(plain, goal) THEN instr(plain, goal) - 1 ELSE instr(plain, half) - 1 END AS lo, CASE WHEN contains(plain, goal) THEN length(goal) ELSE length(half) END AS n FROM ha JOIN src ON contains(plain, half)),
pa AS (SELECT id, doc_id, lo, lo + n AS hi, unnest(regexp_extract_all(annot, '([^\[\]]+)(?:\[([^\[\]]+)\])?', 1)) AS base, unnest(regexp_extract_all(annot, '([^\[\]]+)(?:\[([^\[\]]+)\])?', 2)) AS reading, generate_subscripts(regexp_extract_all(annot, '([^\[\]]+)(?:\[([^\[\]]+)\])?', 1), 1) AS i FROM hit),
off AS (SELECT *, coalesce(sum(length(base)) OVER (PARTITION BY id, doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM pa),
cu AS (SELECT id, doc_id, i, base, coalesce(reading, '') AS reading, substr(base, (greatest(lo - ahead, 0) + 1)::BIGINT, greatest(least(hi - ahead, length(base)) - greatest(lo - ahead, 0), 0)::BIGINT) AS shown FROM off),
an AS (SELECT id, doc_id, string_agg(shown || CASE WHEN reading <> '' AND shown = base THEN '[' || reading || ']' ELSE '' END, '' ORDER BY i) AS annot FROM cu GROUP BY id, doc_id)"""


def _examples_and_chunks(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    docs = read(spark, sf_dir, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    examples = docs.filter("doc_id % 3 = 0").select(F.col("doc_id").alias("id"), F.element_at(F.split(_plain(), "\n"), -1).alias("text"))
    return examples, docs.select(F.format_string("%09d", "doc_id").alias("path"), _annotated().alias("chunk_text"))


@query(f"WITH {_LOOKUP_SQL} SELECT id, sha256(arg_min(annot, doc_id)) AS annot FROM an WHERE contains(annot, '[') GROUP BY id")
def annotate_book_lookup(spark, sf_dir):
    """Last lines of a third of the documents looked up in all annotated texts: the first that gives a reading."""
    return lookup.first_annotation(*_examples_and_chunks(spark, sf_dir)).select("id", F.sha2("annot", 256).alias("annot"))


@query(f"WITH {_LOOKUP_SQL} SELECT id, sha256(arg_min(annot, doc_id)) AS annot FROM an WHERE annot <> '' GROUP BY id")
def backfill_lookup(spark, sf_dir):
    return lookup.first_annotation(*_examples_and_chunks(spark, sf_dir), need_reading=False).select("id", F.sha2("annot", 256).alias("annot"))


def _turns(spark, sf_dir) -> DataFrame:
    """Conversations as entries, their turns as examples."""
    rows = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))
    han = lambda c: F.translate(F.coalesce(c, F.lit("")), "kwz", "漢字山")
    examples = F.transform("t", lambda x: F.struct(F.replace(F.replace(han(x["text"]), F.lit("["), F.lit("(")), F.lit("]"), F.lit(")")).alias("text"), F.lit("").alias("annot")))
    return rows.select(F.format_string("%06d", "conv_id").alias("path"), F.col("conv_id").alias("id"), F.lit("t").alias("title"), F.lit("s").alias("structure"), F.lit("p").alias("structure_pattern"), F.lit("e").alias("explanation_zh"), F.array(F.lit("tag")).alias("tags"), examples.alias("examples"))


_TURNS_SQL = "t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i, translate(translate(coalesce(text, ''), 'kwz', '漢字山'), '[]', '()') AS text FROM conversations)"


@query(f"""WITH {_TURNS_SQL}, a AS (SELECT *, regexp_replace(text, '([漢字山]+)', '\\1[よみ]', 'g') || CASE WHEN i % 3 = 2 THEN '?' ELSE '' END AS annot FROM t),
v AS (SELECT *, i % 4 <> 3 AND annot <> '' AND regexp_replace(annot, '\\[[^\\]]*\\]', '', 'g') = text AS ok FROM a)
SELECT conv_id AS id, count(*) FILTER (WHERE ok) AS n_ok, sha256(string_agg(CASE WHEN ok THEN annot ELSE '' END, chr(31) ORDER BY i)) AS annots FROM v GROUP BY conv_id""".replace("\\\\", "\\"))
def annotate(spark, sf_dir):
    """Answered annotations: those that fit are taken and counted (n_ok), some are of another text, some are missing."""
    entries = _turns(spark, sf_dir)
    given = entries.select("id", F.posexplode("examples").alias("i", "e")).filter("i % 4 <> 3")
    answers = given.select("id", "i", F.concat(F.lit(" "), F.regexp_replace("e.text", "([漢字山]+)", "$1[よみ]"), F.when(F.col("i") % 3 == 2, "?").otherwise("")).alias("annot"))
    done = adopt.annotate(entries.withColumn("examples", F.transform("examples", lambda e: F.struct(X.strip(e["text"]).alias("text"), e["annot"].alias("annot")))), answers)
    return done.select("id", "n_ok", F.sha2(F.array_join(F.transform("examples", lambda e: e["annot"]), "\x1f"), 256).alias("annots"))


_RESTYLE = """SELECT conv_id AS id, CASE WHEN conv_id % 2 = 0 THEN 'new ' || conv_id ELSE 't' END AS title, CASE WHEN conv_id % 4 = 0 THEN 'other' ELSE 's' END AS structure, CASE WHEN conv_id % 2 = 0 THEN 5 ELSE 1 END AS tags FROM conversations GROUP BY conv_id"""


def _restyled(spark, sf_dir):
    entries = _turns(spark, sf_dir)
    new = entries.filter("id % 2 = 0").select("id", F.concat(F.lit("new "), "id").alias("title"), F.when(F.col("id") % 4 == 0, "other").alias("structure"), F.lit(None).cast("string").alias("structure_pattern"), F.lit(None).cast("string").alias("explanation_zh"), F.transform(F.sequence(F.lit(1), F.lit(7)), lambda x: x.cast("string")).alias("tags"))
    return adopt.rewrite(entries, new)


@query(_RESTYLE)
def restyle(spark, sf_dir):
    """Rewritten fields where an answer has them, five tags at most."""
    return _restyled(spark, sf_dir).select("id", "title", "structure", F.size("tags").alias("tags"))


@query(_RESTYLE + " ORDER BY conv_id LIMIT 7")
def restyle_limit(spark, sf_dir):
    """The limit is the feature: the first seven entries in order of their files."""
    return adopt.first_entries(_restyled(spark, sf_dir), 7).select("id", "title", "structure", F.size("tags").alias("tags"))


@query(f"WITH {_CAND_SQL} SELECT language, count(*) AS words, ceil(count(*) / 20)::BIGINT AS batches FROM c GROUP BY language")
def batch_total_words(spark, sf_dir):
    b = vocab.batches(_candidates(spark, sf_dir))
    return b.groupBy("language").agg(F.sum(F.size("words")).cast("long").alias("words"), F.count("*").alias("batches"))


@query(f"SELECT book_id, chunk_idx, char_count, sha256(text) AS text FROM ({_chunk_sql('doc_id', '0')}) WHERE chunk_idx BETWEEN 1 AND 3")
def extract_slice(spark, sf_dir):
    """Chunks one to three of every book: the slice is the feature."""
    rows = chunk.window_of(chunk.chunks(_paragraphs(spark, sf_dir, "doc_id", F.lit(0))), 1, 3)
    return rows.select("book_id", "chunk_idx", "char_count", F.sha2("text", 256).alias("text"))


_TEMPLATE = "Book {{ book_id }}, part {{chunk_idx}}:\n{{ text }}\n(end of {{book_id}})"
_PROMPT_SQL = f"""k AS (SELECT * FROM ({_chunk_sql('doc_id', '0')})),
q AS (SELECT book_id, chunk_idx, 's4_extract:' || book_id || ':' || substr(sha256('6' || chr(31) || chunk_idx || chr(31) || substr(text, 1, 200) || chr(31)), 1, 16) AS task_id, 'Book ' || book_id || ', part ' || chunk_idx || ':' || chr(10) || text || chr(10) || '(end of ' || book_id || ')' AS prompt FROM k)"""


@query(f"WITH {_PROMPT_SQL} SELECT task_id, book_id, chunk_idx, sha256(prompt) AS prompt FROM q")
def prepare_tasks(spark, sf_dir):
    """Extraction tasks with their rendered prompts (render, task ids)."""
    chunked = chunk.chunks(_paragraphs(spark, sf_dir, "doc_id", F.lit(0)))
    return chunk.prompts(chunked, _TEMPLATE, "6").select("task_id", "book_id", "chunk_idx", F.sha2("prompt", 256).alias("prompt"))


@query(f"""WITH {_PROMPT_SQL} SELECT task_id, CASE (book_id + chunk_idx) % 3 WHEN 0 THEN '{{"points": [' || chunk_idx || ']}}' END AS json, CASE (book_id + chunk_idx) % 3 WHEN 1 THEN 'no JSON' WHEN 2 THEN 'no answer' END AS error FROM q""")
def load_results(spark, sf_dir):
    """Answers loaded back by task: JSON, text without any, or nothing."""
    asked = chunk.prompts(chunk.chunks(_paragraphs(spark, sf_dir, "doc_id", F.lit(0))), _TEMPLATE, "6")
    third = (F.col("book_id") + F.col("chunk_idx")) % 3
    text = F.when(third == 0, F.concat(F.lit('Sure.\n```json\n{"points": ['), "chunk_idx", F.lit("]}\n```"))).otherwise("I can't")
    return chunk.results(asked.filter(third != 2).select("task_id", text.alias("text")), asked).select("task_id", "json", "error")


@query("SELECT source AS value, count(*) AS n, row_number() OVER (ORDER BY min(n_chars), source)::INTEGER AS place FROM documents WHERE source <> '' GROUP BY source")
def facets(spark, sf_dir):
    """Facet values in the order of a sort key: the least length of their documents."""
    from pyspark.sql import Window as W

    rows = search.facet_counts(read(spark, sf_dir, "documents"), "source", "n_chars")
    return rows.withColumn("place", F.row_number().over(W.orderBy(F.monotonically_increasing_id())))  # a row a value


_SORT_SQL = r"""WITH w AS (SELECT doc_id, n_chars, list_transform(list_filter(string_split_regex(text, '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> ''), lambda x: lower(x)) AS w FROM documents),
k AS (SELECT doc_id, n_chars FROM w WHERE list_contains(w, 'the') AND list_contains(w, 'of'))"""


@query(_SORT_SQL + " SELECT doc_id, n_chars, (SELECT count(*) FROM k) AS total FROM k ORDER BY n_chars DESC, doc_id LIMIT 8 OFFSET 8")
def search_sorted(spark, sf_dir):
    """The second page of hits of two terms by falling length, with the total."""
    docs = read(spark, sf_dir, "documents")
    postings, n, mean = search.lookup(docs, "doc_id", "text", "the OF")
    found = search.search(postings, docs.select("doc_id", "n_chars"), "the OF", id_col="doc_id", sort="-n_chars", page=2, n_docs=n, mean_len=mean)
    return found.select("doc_id", "n_chars", "total")


@query(_SORT_SQL + " SELECT doc_id, n_chars, (SELECT count(*) FROM k) AS total FROM k ORDER BY n_chars, doc_id LIMIT 8")
def search_sorted_up(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    postings, n, mean = search.lookup(docs, "doc_id", "text", "of the")
    return search.search(postings, docs.select("doc_id", "n_chars"), "of the", id_col="doc_id", sort="n_chars", n_docs=n, mean_len=mean).select("doc_id", "n_chars", "total")
