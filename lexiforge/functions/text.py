"""Scalar text functions as column expressions: JVM-side, Unicode-aware where the semantics are."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexiforge.schemas import LEVEL_RANK, LEVELS

SPACE = r"(?U)\s+"
#: Signs that a comparison of an example with its source ignores besides white space.
IGNORED = r"(?U)[\s、。，．！？!?…・「」『』()（）\-—]+"
#: Zero-width code points that tokens lose.
ZERO_WIDTH = "​‌‍﻿⁠"
#: Fixed value: remains of word-processor exports.
EXPORT_NOISE = r"(?i)(FullName|mso-|MsoNormal|st1:|\d{4}-\d{2}-\d{2}T\d{2}:|false false|behavior:url)"
#: Fixed value: what makes a line worth keeping: a word sign of any script that the corpus has.
WORD_SIGN = r"(?U)[\w฀-๿぀-ヿ㐀-鿿가-힯]"
#: Ideographs, and base[reading].
HAN = r"[一-鿿]"
ANNOTATED = r"([^\[\]]+)(?:\[([^\[\]]+)\])?"


def strip(c: Column) -> Column:
    """Trims Unicode white space, not only blanks."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def norm_ws(c: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(c, "　", " "), SPACE, " "))


def squeeze(c: Column) -> Column:
    """Without any white space."""
    return F.regexp_replace(c, SPACE, "")


def norm_for_match(c: Column) -> Column:
    return F.regexp_replace(c, IGNORED, "")


def is_junk(c: Column) -> Column:
    return (F.length(c) < 2) | c.rlike(EXPORT_NOISE) | ~c.rlike(WORD_SIGN)


def clean_token(c: Column) -> Column:
    return strip(F.translate(c, ZERO_WIDTH, ""))


def dedup_key(pattern: Column, structure: Column, title: Column) -> Column:
    full = lambda c: F.nullif(c, F.lit(""))
    return F.lower(squeeze(F.coalesce(full(pattern), full(structure), full(title), F.lit(""))))


def norm_level(language: Column, level: Column) -> Column:
    """The canonical level, or null; a digit outside the language's range stays, see level_rank."""
    clean = F.replace(F.upper(strip(level)), F.lit("급"), F.lit(""))
    digit = F.nullif(F.regexp_extract(clean, r"(\d)", 1), F.lit(""))
    return (
        F.when(F.coalesce(level, F.lit("")) == "", None)
        .when(language == "ko", F.concat(F.lit("TOPIK"), digit))
        .when(language.isin("th", "vi"), F.concat(F.lit("L"), digit))
        .when((language == "ja") & clean.isin(*LEVELS["ja"]), clean)
    )


def level_rank(level: Column) -> Column:
    """1..6, or null for a level that doesn't exist."""
    ranks = F.create_map(*[F.lit(x) for pair in LEVEL_RANK.items() for x in pair])
    return F.try_element_at(ranks, level)


def valid_annot(annot: Column, text: Column) -> Column:
    plain = F.regexp_replace(annot, r"\[[^\]]*\]", "") == text
    bare = annot.rlike(r"(^|[^㐀-鿿豈-﫿])\[")
    return F.coalesce((annot != "") & plain & ~bare, F.lit(False))


def probe_in(text: Column, source: Column) -> Column:
    """Whether the first 60 % (8 code points at least) of the example stand in its normalised source; an empty source accepts all."""
    norm = norm_for_match(text)
    probe = F.left(norm, F.greatest(F.lit(8), F.floor(F.length(norm) * F.lit(0.6)).cast("int")))
    return (source == "") | (probe == "") | F.contains(source, probe)


def provenance_probe(text: Column, chunk: Column) -> Column:
    return probe_in(text, norm_for_match(F.coalesce(chunk, F.lit(""))))


def parse_annot(annot: Column) -> Column:
    """array<struct<base, read>>; read is '' where there is none.  The base takes all text since the last bracket."""
    bases, reads = (F.regexp_extract_all(annot, F.lit(ANNOTATED), F.lit(k)) for k in (1, 2))
    return F.zip_with(bases, reads, lambda b, r: F.struct(b.alias("base"), F.coalesce(r, F.lit("")).alias("read")))


def let(value: Column, body) -> Column:
    """Evaluates value once and hands it to body; a plain column could be inlined into a lambda and run per element."""
    return F.transform(F.array(value), body)[0]


def display_ruby(annot: Column) -> Column:
    """array<struct<base, read>> as shown: a base is a run of ideographs only."""
    # fixed value: base[reading], else a run without a reading
    pattern = r"([㐀-鿿豈-﫿々〆ヶ]+)\[([^\[\]]+)\]|([^\[\]㐀-鿿豈-﫿々〆ヶ]+|[㐀-鿿豈-﫿々〆ヶ]+(?!\[))"
    # only what has a reading holds brackets, so that one pass is enough
    def shown(w):
        base = F.substring_index(w, "[", 1)
        return F.struct(base.alias("base"), F.when(F.endswith(w, F.lit("]")), F.substring_index(F.substring_index(w, "]", 1), "[", -1)).otherwise("").alias("read"))

    return F.transform(F.regexp_extract_all(annot, F.lit(pattern), F.lit(0)), shown)


def kata_to_hira(c: Column) -> Column:
    kata = "".join(map(chr, range(0x30A1, 0x30F7)))
    return F.translate(c, kata, "".join(chr(ord(x) - 0x60) for x in kata))


def content_hash(*parts: Column) -> Column:
    """First 16 hex digits of SHA-256 over the parts, each followed by a unit separator."""
    return F.substring(F.sha2(F.concat(*[x for p in parts for x in (p.cast("string"), F.lit("\x1f"))]), 256), 1, 16)


def template_version(c: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(c, r"^\s*version:\s*(\S+)", 1), F.lit("")), F.lit("0"))


def render(template: str, **values: Column) -> Column:
    """The template with every {{ name }} filled in; a null value is empty, a name without a value is refused."""
    parts, end = [], 0
    for m in re.finditer(r"\{\{\s*(\w+)\s*\}\}", template):
        parts += [F.lit(template[end : m.start()]), F.coalesce(values[m[1]].cast("string"), F.lit(""))]
        end = m.end()
    return F.concat(*parts, F.lit(template[end:]))


def has_kanji(c: Column) -> Column:
    return c.rlike(HAN)


def hanja_detail(hanja: Column) -> Column:
    return F.when(F.coalesce(hanja, F.lit("")) != "", F.concat(F.lit("汉字词源："), hanja)).otherwise("")


def level_label(language: Column, level: Column) -> Column:
    return F.when(language == "ja", F.concat(F.lit("JLPT "), level)).when(language == "ko", F.replace(level, F.lit("TOPIK"), F.lit("TOPIK "))).otherwise(F.concat(F.lit("入门 "), level))


# Word classes, their labels, and the tags of two tokenizers.
POS_LABEL = {"noun": "名词", "verb": "动词", "adj": "形容词", "adv": "副词", "func": "功能词", "affix": "词缀", "other": "其他"}
POS_JA = {
    "名詞": "noun", "固有名詞": "noun", "代名詞": "noun", "動詞": "verb", "形容詞": "adj", "形状詞": "adj", "副詞": "adv", "助詞": "func",
    "助動詞": "func", "接続詞": "func", "接頭辞": "affix", "接尾辞": "affix", "記号": "punct", "補助記号": "punct", "感動詞": "other",
    "フィラー": "other", "連体詞": "other",
}
POS_KO = {
    "NN": "noun", "NP": "noun", "VV": "verb", "VA": "adj", "VX": "verb", "VCP": "func", "VCN": "func", "MM": "other", "MAG": "adv",
    "MAJ": "adv", "IC": "other", "JK": "func", "EC": "func", "EF": "func", "EP": "func", "ET": "func", "XS": "affix", "SF": "punct",
    "SE": "punct", "SS": "punct", "SP": "punct", "SO": "punct", "SL": "other", "SN": "other", "SW": "other", "NF": "other",
    "NV": "other", "NA": "other",
}


def _mapped(table: dict, key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def pos_label(c: Column) -> Column:
    return F.coalesce(_mapped(POS_LABEL, c), c)


def pos_class_ja(tag: Column) -> Column:
    return F.coalesce(_mapped(POS_JA, tag), F.lit("other"))


def pos_class_ko(tag: Column) -> Column:
    """By the whole tag, else by its first two letters."""
    return F.coalesce(_mapped(POS_KO, tag), _mapped(POS_KO, F.left(tag, F.lit(2))), F.lit("other"))


def seg_plain(segments: Column) -> Column:
    """segments: array<struct<t, text, read>>."""
    return norm_ws(F.array_join(F.transform(segments, lambda s: s["text"]), ""))


def seg_annot(segments: Column) -> Column:
    read = lambda s: F.when((s["t"] == "ruby") & (F.coalesce(s["read"], F.lit("")) != ""), F.concat(F.lit("["), s["read"], F.lit("]"))).otherwise("")
    return norm_ws(F.array_join(F.transform(segments, lambda s: F.concat(s["text"], read(s))), ""))


def merge_example(examples: Column, new: Column, most: int = 2) -> Column:
    """examples with the new one appended where there is room and its text, without white space, is new and not empty."""
    text = squeeze(new["text"])
    known = F.exists(examples, lambda e: squeeze(e["text"]) == text)
    return F.when((F.size(examples) >= most) | known | (text == ""), examples).otherwise(F.concat(examples, F.array(new)))
