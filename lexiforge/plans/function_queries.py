"""Queries of the scalar functions over whole texts: letters of the documents become kana, ideographs, annotations and answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexiforge.functions import annotate as A
from lexiforge.functions import text as X
from lexiforge.functions.tokenizers import token_source
from lexiforge.operators import adopt
from lexiforge.plans.queries import query, read

# Rare letters become ideographs, others kana: the texts keep their lengths, and readings have something to stand on.
_LETTERS, _SIGNS = "kwzvbp", "漢字山々〆ヶ"
_LATIN, _KANA = "abcdefghijklmnopqrstuvwxyz", "アカサタナハマヤラワイキシチニヒミリウクスツヌオコー"
_KATA = "".join(map(chr, range(0x30A1, 0x30F7)))
_HIRA = "".join(chr(ord(c) - 0x60) for c in _KATA)
_HAN = "[一-鿿]"


def _docs(spark, sf_dir):
    return read(spark, sf_dir, "documents").withColumn("text", F.coalesce("text", F.lit("")))


def _plain() -> Column:
    return F.translate(F.replace(F.replace("text", F.lit("["), F.lit("(")), F.lit("]"), F.lit(")")), _LETTERS, _SIGNS)


def _annotated() -> Column:
    return F.regexp_replace(_plain(), f"({_HAN}+)", "$1[よみ]")


_PLAIN_SQL = f"translate(translate(coalesce(text, ''), '[]', '()'), '{_LETTERS}', '{_SIGNS}')"
_ANNOT_SQL = f"regexp_replace({_PLAIN_SQL}, '({_HAN}+)', '\\1[よみ]', 'g')"


@query(f"""WITH a AS (SELECT doc_id, {_PLAIN_SQL} AS plain, {_ANNOT_SQL} AS annot FROM documents),
b AS (SELECT doc_id, CASE doc_id % 3 WHEN 1 THEN annot || 'x[x]' ELSE annot END AS annot, CASE doc_id % 3 WHEN 0 THEN plain WHEN 1 THEN plain || 'x' ELSE plain || 'y' END AS plain FROM a)
SELECT doc_id, annot <> '' AND regexp_replace(annot, '\\[[^\\]]*\\]', '', 'g') = plain AND NOT regexp_matches(annot, '(^|[^㐀-鿿豈-﫿])\\[') AS valid FROM b""".replace("\\\\", "\\"))
def valid_annot(spark, sf_dir):
    """Annotations of whole texts: right, with a reading behind a letter, or of another text."""
    third = F.col("doc_id") % 3
    annot = F.when(third == 1, F.concat(_annotated(), F.lit("x[x]"))).otherwise(_annotated())
    plain = F.when(third == 0, _plain()).when(third == 1, F.concat(_plain(), F.lit("x"))).otherwise(F.concat(_plain(), F.lit("y")))
    return _docs(spark, sf_dir).select("doc_id", X.valid_annot(annot, plain).alias("valid"))


_PARTS_SQL = r"regexp_extract_all(annot, '([^\[\]]+)(?:\[([^\[\]]+)\])?', 1) AS base, regexp_extract_all(annot, '([^\[\]]+)(?:\[([^\[\]]+)\])?', 2) AS reading"


@query(f"""WITH a AS (SELECT doc_id, {_ANNOT_SQL} AS annot FROM documents), p AS (SELECT doc_id, {_PARTS_SQL} FROM a)
SELECT doc_id, len(base)::INTEGER AS n, sha256(array_to_string(list_transform(list_zip(base, reading), lambda x: x[1] || '/' || coalesce(x[2], '')), ' ')) AS parts FROM p""")
def parse_annot(spark, sf_dir):
    rows = _docs(spark, sf_dir).select("doc_id", X.parse_annot(_annotated()).alias("p"))
    return rows.select("doc_id", F.size("p").alias("n"), F.sha2(F.array_join(F.transform("p", lambda p: F.concat(p["base"], F.lit("/"), p["read"])), " "), 256).alias("parts"))


_RUN = "[㐀-鿿豈-﫿々〆ヶ]"


@query(f"""WITH a AS (SELECT doc_id, {_ANNOT_SQL} AS annot FROM documents),
p AS (SELECT doc_id, list_zip(regexp_extract_all(annot, '({_RUN}+)\\[([^\\[\\]]+)\\]|([^\\[\\]㐀-鿿豈-﫿々〆ヶ]+|{_RUN}+)', 0), regexp_extract_all(annot, '({_RUN}+)\\[([^\\[\\]]+)\\]|([^\\[\\]㐀-鿿豈-﫿々〆ヶ]+|{_RUN}+)', 1), regexp_extract_all(annot, '({_RUN}+)\\[([^\\[\\]]+)\\]|([^\\[\\]㐀-鿿豈-﫿々〆ヶ]+|{_RUN}+)', 2)) AS p FROM a)
SELECT doc_id, sha256(array_to_string(list_transform(p, lambda x: CASE WHEN coalesce(x[2], '') <> '' THEN x[2] ELSE x[1] END || '/' || coalesce(x[3], '')), ' ')) AS shown FROM p""".replace("\\\\", "\\"))
def ruby_render_split(spark, sf_dir):
    """Every reading here stands right behind its run, so the pattern needs no look ahead in SQL."""
    rows = _docs(spark, sf_dir).select("doc_id", X.display_ruby(_annotated()).alias("p"))
    return rows.select("doc_id", F.sha2(F.array_join(F.transform("p", lambda p: F.concat(p["base"], F.lit("/"), p["read"])), " "), 256).alias("shown"))


@query(f"""WITH a AS (SELECT doc_id, {_ANNOT_SQL} AS annot, string_split({_PLAIN_SQL}, chr(10)) AS l FROM documents),
x AS (SELECT doc_id, annot, l[doc_id % len(l) + 1] || CASE WHEN doc_id % 4 = 0 THEN '?!' ELSE '' END AS line FROM a),
e AS (SELECT doc_id, regexp_replace(line, '^[\\s\\x{{3000}}\\x{{00A0}}\\x0B]+|[\\s\\x{{3000}}\\x{{00A0}}\\x0B]+$', '', 'g') AS goal, {_PARTS_SQL} FROM x),
h AS (SELECT doc_id, goal, substr(goal, 1, greatest(10, length(goal) // 2)) AS half, base, reading, array_to_string(base, '') AS plain FROM e),
g AS (SELECT *, CASE WHEN goal <> '' AND instr(plain, goal) > 0 THEN instr(plain, goal) - 1 WHEN goal <> '' AND instr(plain, half) > 0 THEN instr(plain, half) - 1 END AS lo,
 CASE WHEN instr(plain, goal) > 0 THEN length(goal) ELSE length(half) END AS n FROM h),
p AS (SELECT doc_id, lo, lo + n AS hi, unnest(base) AS base, unnest(reading) AS reading, generate_subscripts(base, 1) AS i FROM g WHERE lo IS NOT NULL),
o AS (SELECT *, coalesce(sum(length(base)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM p),
c AS (SELECT doc_id, i, base, coalesce(reading, '') AS reading, substr(base, (greatest(lo - ahead, 0) + 1)::BIGINT, greatest(least(hi - ahead, length(base)) - greatest(lo - ahead, 0), 0)::BIGINT) AS shown FROM o),
j AS (SELECT doc_id, string_agg(shown || CASE WHEN reading <> '' AND shown = base THEN '[' || reading || ']' ELSE '' END, '' ORDER BY i) AS annot FROM c GROUP BY doc_id)
SELECT d.doc_id, sha256(coalesce(j.annot, '')) AS annot, contains(coalesce(j.annot, ''), '[') AS read FROM documents d LEFT JOIN j USING (doc_id)""".replace("\\\\", "\\"))
def annot_for_example(spark, sf_dir):
    """A line of each document looked up in the annotated whole; a fourth of the lines stand there in their first half only."""
    lines = F.split(_plain(), "\n")
    line = F.concat(F.element_at(lines, (F.col("doc_id") % F.size(lines) + 1).cast("int")), F.when(F.col("doc_id") % 4 == 0, "?!").otherwise(""))
    rows = _docs(spark, sf_dir).select("doc_id", line.alias("example"), _annotated().alias("source"))
    rows = rows.select("doc_id", A.annot_for_example("example", "source").alias("annot"))
    return rows.select("doc_id", F.sha2("annot", 256).alias("annot"), F.contains("annot", F.lit("[")).alias("read"))


@query(f"SELECT doc_id, sha256(translate(translate(lower(coalesce(text, '')), '{_LATIN}', '{_KANA}'), '{_KATA}', '{_HIRA}')) AS hira FROM documents")
def kata_to_hira(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.sha2(X.kata_to_hira(F.translate(F.lower("text"), _LATIN, _KANA)), 256).alias("hira"))


_LONG_SQL = f"regexp_replace(regexp_replace(translate(translate(lower(coalesce(text, '')), '{_LATIN}', '{_KANA}'), '{_KATA}', '{_HIRA}'), '([{A.O_ROW}])ー', '\\1う', 'g'), '([{A.E_ROW}])ー', '\\1い', 'g')"


@query(f"SELECT doc_id, sha256({_LONG_SQL}) AS hira FROM documents")
def kata_to_hira_long(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.sha2(A.kata_to_hira_long(F.translate(F.lower("text"), _LATIN, _KANA)), 256).alias("hira"))


@query(f"""WITH w AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), ' ')) AS w, generate_subscripts(string_split(coalesce(text, ''), ' '), 1) AS i FROM documents),
t AS (SELECT doc_id, i, translate(w, '{_LETTERS}', '{_SIGNS}') AS s, CASE WHEN i % 3 = 0 THEN '*' WHEN i % 3 = 1 THEN w ELSE translate(lower(w), '{_LATIN}', '{_KANA}') END AS text, i % 3 = 1 AS book FROM w),
r AS (SELECT doc_id, i, s, CASE WHEN book THEN text ELSE {_LONG_SQL.replace(f"translate(lower(coalesce(text, '')), '{_LATIN}', '{_KANA}')", "text")} END AS r FROM t)
SELECT doc_id, sha256(string_agg(CASE WHEN regexp_matches(s, '[一-鿿㐀-䶿]') AND r <> '' AND r <> s AND r <> '*' THEN s || '[' || r || ']' ELSE s END, '' ORDER BY i)) AS annot FROM r GROUP BY doc_id""")
def synthesize_ruby(spark, sf_dir):
    """Words as tokens: their readings are the book's own, a dictionary's in katakana, or missing."""
    words = F.split("text", " ")
    reading = lambda w, i: F.when((i + 1) % 3 == 0, "*").when((i + 1) % 3 == 1, w).otherwise(F.translate(F.lower(w), _LATIN, _KANA))
    token = lambda w, i: F.struct(F.translate(w, _LETTERS, _SIGNS).alias("s"), reading(w, i).alias("r"), F.when((i + 1) % 3 == 1, "book").otherwise("dict").alias("rs"))
    return _docs(spark, sf_dir).select("doc_id", F.transform(words, token).alias("t")).select("doc_id", F.sha2(A.synthesize_ruby("t"), 256).alias("annot"))


_ANSWER_SQL = """CASE doc_id % 5 WHEN 0 THEN text || chr(10) || '```json' || chr(10) || o || chr(10) || '```' || chr(10) || text WHEN 1 THEN o || ', ' || o WHEN 2 THEN '[' || o || ', ' || o || ']' WHEN 3 THEN 'well: [' || o || '] ' ELSE text END"""


@query(f"""WITH j AS (SELECT doc_id, text, '{{"id": ' || doc_id || ', "lang": "' || lang || '", "list": [1, 2.5, null, true]}}' AS o FROM documents), a AS (SELECT doc_id, {_ANSWER_SQL} AS answer FROM j),
b AS (SELECT doc_id, coalesce(nullif(regexp_extract(answer, '(?s)```(?:json)?\\s*([\\{{\\[].*?[\\}}\\]])\\s*```', 1), ''), answer) AS body FROM a),
c AS (SELECT doc_id, regexp_extract(body, '(?s)\\{{.*\\}}') AS o, regexp_extract(body, '(?s)\\[.*\\]') AS l FROM b)
SELECT doc_id, CASE WHEN o <> '' AND json_valid(o) THEN o WHEN l <> '' AND json_valid(l) THEN l END AS json FROM c""".replace("\\\\", "\\"))
def extract_json(spark, sf_dir):
    """Answers with a fenced object inside a whole text, two objects, a list of two, a list of one, and none."""
    o = F.concat(F.lit('{"id": '), "doc_id", F.lit(', "lang": "'), "lang", F.lit('", "list": [1, 2.5, null, true]}'))
    fifth = F.col("doc_id") % 5
    rows = read(spark, sf_dir, "documents").withColumn("o", o)
    answer = (
        F.when(fifth == 0, F.concat("text", F.lit("\n```json\n"), "o", F.lit("\n```\n"), "text")).when(fifth == 1, F.concat("o", F.lit(", "), "o"))
        .when(fifth == 2, F.concat(F.lit("["), "o", F.lit(", "), "o", F.lit("]"))).when(fifth == 3, F.concat(F.lit("well: ["), "o", F.lit("] "))).otherwise(F.col("text"))
    )
    return rows.select("doc_id", A.extract_json(answer).alias("json"))


_MATCH = r"[\s\x{00A0}\x{3000}\x0B\x{0085}\x{2028}\x{2029}、。，．！？!?…・「」『』()（）\-—]+"
_NORM = lambda s: f"regexp_replace({s}, '{_MATCH}', '', 'g')"
_PROBE = lambda s: f"substr({_NORM(s)}, 1, greatest(8, floor(0.6 * length({_NORM(s)}))::INTEGER))"
_ACCEPT = lambda e, t: f"({_NORM(t)} = '' OR {_PROBE(e)} = '' OR contains({_NORM(t)}, {_PROBE(e)}))"


@query(f"""WITH l AS (SELECT doc_id, coalesce(text, '') AS t, source, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
SELECT doc_id, {_ACCEPT('l[-1]', 't')} AS own, {_ACCEPT("l[-1] || source || l[1] || source", 't')} AS part, {_ACCEPT('source || t', 't')} AS other, {_ACCEPT('t', "''")} AS none FROM l""")
def provenance_probe(spark, sf_dir):
    """A document's last line, that line with others behind it, a text of another beginning, and any text against no source."""
    lines = F.split("text", "\n")
    last = F.element_at(lines, -1)
    rows = _docs(spark, sf_dir)
    ok = lambda e, t: X.provenance_probe(e, t)
    return rows.select("doc_id", ok(last, F.col("text")).alias("own"), ok(F.concat(last, F.col("source"), lines[0], F.col("source")), F.col("text")).alias("part"), ok(F.concat("source", "text"), F.col("text")).alias("other"), ok(F.col("text"), F.lit("")).alias("none"))


@query(f"SELECT doc_id, regexp_matches({_PLAIN_SQL}, '{_HAN}') AS kanji, CASE WHEN doc_id % 2 = 0 THEN '汉字词源：' || text ELSE '' END AS detail FROM documents")
def has_kanji(spark, sf_dir):
    """has_kanji, and hanja_detail of a text or none."""
    return _docs(spark, sf_dir).select("doc_id", X.has_kanji(_plain()).alias("kanji"), X.hanja_detail(F.when(F.col("doc_id") % 2 == 0, F.col("text"))).alias("detail"))


@query(r"SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'v' || doc_id ELSE '0' END AS version FROM documents")
def template_version(spark, sf_dir):
    head = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit(" \nversion:  v"), "doc_id", F.lit("\n"), "text")).otherwise(F.concat(F.lit("x version: 3\n"), "text"))
    return _docs(spark, sf_dir).select("doc_id", X.template_version(head).alias("version"))


_TAGS_JA, _TAGS_KO = [*X.POS_JA, "新しい"], ["NNG", "NP", "VV-I", "VA", "VX", "VCP", "MM", "MAG", "IC", "JKS", "EC", "EP", "ETM", "XSN", "SF", "SN", "QQ", "J"]


def _tag_sql(tags: list, table: dict, prefix: bool) -> str:
    pick = "[" + ", ".join(f"'{t}'" for t in tags) + f"][doc_id % {len(tags)} + 1]"
    case = lambda c: "CASE " + c + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + " END"
    return f"SELECT doc_id, tag, coalesce({case('tag')}, {case('substr(tag, 1, 2)') if prefix else 'NULL'}, 'other') AS class FROM (SELECT doc_id, {pick} AS tag FROM documents)"


def _tag(tags: list) -> Column:
    return F.element_at(F.array(*map(F.lit, tags)), (F.col("doc_id") % len(tags) + 1).cast("int"))


@query(_tag_sql(_TAGS_JA, X.POS_JA, False))
def pos_map_ja(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", _tag(_TAGS_JA).alias("tag")).withColumn("class", X.pos_class_ja(F.col("tag")))


@query(_tag_sql(_TAGS_KO, X.POS_KO, True))
def pos_map_ko(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", _tag(_TAGS_KO).alias("tag")).withColumn("class", X.pos_class_ko(F.col("tag")))


_CLASSES = [*X.POS_LABEL, "zzz"]


@query("SELECT doc_id, CASE c " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in X.POS_LABEL.items()) + " ELSE c END AS label FROM (SELECT doc_id, [" + ", ".join(f"'{c}'" for c in _CLASSES) + f"][doc_id % {len(_CLASSES)} + 1] AS c FROM documents)")
def pos_label(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", X.pos_label(_tag(_CLASSES)).alias("label"))


@query("""SELECT doc_id, CASE lang WHEN 'de' THEN 'JLPT N' || (n_chars % 5 + 1) WHEN 'en' THEN 'TOPIK ' || (n_chars % 6 + 1) ELSE '入门 L' || (n_chars % 6 + 1) END AS label FROM documents""")
def level_label(spark, sf_dir):
    lang = F.when(F.col("lang") == "de", "ja").when(F.col("lang") == "en", "ko").otherwise("th")
    level = F.when(lang == "ja", F.concat(F.lit("N"), F.col("n_chars") % 5 + 1)).when(lang == "ko", F.concat(F.lit("TOPIK"), F.col("n_chars") % 6 + 1)).otherwise(F.concat(F.lit("L"), F.col("n_chars") % 6 + 1))
    return _docs(spark, sf_dir).select("doc_id", X.level_label(lang, level).alias("label"))


@query("SELECT doc_id, sha256(regexp_replace(text, '^[\\s\\x{00A0}\\x{3000}\\x0B]+|[\\s\\x{00A0}\\x{3000}\\x0B]+$', '', 'g')) AS token FROM documents")
def clean_token(spark, sf_dir):
    """Zero-width signs between the letters and wide blanks around the whole go."""
    dirty = F.concat(F.lit("​　"), F.regexp_replace("text", "e", "e​"), F.lit(" ﻿　"))
    return read(spark, sf_dir, "documents").filter("text is not null").select("doc_id", F.sha2(X.clean_token(dirty), 256).alias("token"))


@query("SELECT doc_id, sha256(CASE WHEN lang = 'de' AND doc_id % 3 <> 0 THEN text || '!' ELSE text END) AS source FROM documents")
def token_source_select(spark, sf_dir):
    annot = F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.concat("text", F.lit("!")))
    lang = F.when(F.col("lang") == "de", "ja").otherwise("ko")
    return read(spark, sf_dir, "documents").select("doc_id", F.sha2(token_source(lang, F.col("text"), annot), 256).alias("source"))


_UWS = r"[\s\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{0085}\x0B]"


@query(rf"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
j AS (SELECT doc_id, string_agg(x, '' ORDER BY i) AS plain, string_agg(x || CASE WHEN i % 2 = 0 AND i % 4 <> 0 THEN '[r' || i || ']' ELSE '' END, '' ORDER BY i) AS annot FROM l GROUP BY doc_id)
SELECT doc_id, sha256(regexp_replace(regexp_replace(plain, '{_UWS}+', ' ', 'g'), '^ | $', '', 'g')) AS plain, sha256(regexp_replace(regexp_replace(annot, '{_UWS}+', ' ', 'g'), '^ | $', '', 'g')) AS annot FROM j""")
def seg_annot(spark, sf_dir):
    """seg_plain and seg_annot: lines as segments, every second one ruby, every fourth without its reading."""
    kind = lambda i: F.when((i + 1) % 2 == 0, "ruby").otherwise("plain")
    read_of = lambda i: F.when((i + 1) % 4 == 0, "").otherwise(F.concat(F.lit("r"), i + 1))
    segments = F.transform(F.split("text", "\n"), lambda x, i: F.struct(kind(i).alias("t"), x.alias("text"), read_of(i).alias("read")))
    rows = read(spark, sf_dir, "documents").select("doc_id", segments.alias("s"))
    return rows.select("doc_id", F.sha2(X.seg_plain(F.col("s")), 256).alias("plain"), F.sha2(X.seg_annot(F.col("s")), 256).alias("annot"))


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN n_chars::INTEGER WHEN 1 THEN n_chars::INTEGER WHEN 2 THEN -3 END AS hint FROM documents")
def frequency_hint(spark, sf_dir):
    """A number counts, cut to a whole one; a quoted number or null doesn't."""
    kind = F.col("doc_id") % 4
    raw = F.when(kind == 0, F.col("n_chars").cast("string")).when(kind == 1, F.concat("n_chars", F.lit(".75"))).when(kind == 2, F.lit("-3.9")).otherwise(F.concat(F.lit('"'), "n_chars", F.lit('"')))
    return read(spark, sf_dir, "documents").select("doc_id", adopt.frequency_hint(raw).alias("hint"))


@query("""WITH e AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations),
h AS (SELECT a.conv_id, list(b.text ORDER BY b.turn) FILTER (WHERE b.n <= a.conv_id % 3) AS have, any_value(a.text) AS new FROM (SELECT conv_id, arg_max(text, turn) AS text FROM conversations GROUP BY conv_id) a JOIN e b USING (conv_id) GROUP BY a.conv_id),
s AS (SELECT conv_id, coalesce(have, []) AS have, new, regexp_replace(new, '[\\s\\x{00A0}\\x{3000}\\x0B]+', '', 'g') AS k FROM h)
SELECT conv_id, len(CASE WHEN len(have) >= 2 OR k = '' OR list_contains(list_transform(have, lambda x: regexp_replace(x, '[\\s\\x{00A0}\\x{3000}\\x0B]+', '', 'g')), k) THEN have ELSE list_append(have, new) END)::BIGINT AS n,
 sha256(array_to_string(CASE WHEN len(have) >= 2 OR k = '' OR list_contains(list_transform(have, lambda x: regexp_replace(x, '[\\s\\x{00A0}\\x{3000}\\x0B]+', '', 'g')), k) THEN have ELSE list_append(have, new) END, chr(31))) AS examples FROM s""")
def merge_example_into(spark, sf_dir):
    """The last turn of a conversation merged into the first none, one or two."""
    turns = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))
    texts = F.transform("t", lambda x: F.struct(x["text"].alias("text")))
    have = F.slice(texts, 1, (F.col("conv_id") % 3).cast("int"))
    rows = turns.select("conv_id", X.merge_example(have, F.element_at(texts, -1)).alias("e"))
    return rows.select("conv_id", F.size("e").cast("long").alias("n"), F.sha2(F.array_join(F.transform("e", lambda x: x["text"]), "\x1f"), 256).alias("examples"))

