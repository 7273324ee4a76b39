"""Schemas, enumerations and limits of the knowledge base; never inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v, True) for k, v in fields.items()])


S, I, L, B = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()

# Languages, levels, statuses, types, relations and limits of the knowledge base.
LANGUAGES = ("ja", "ko", "th", "vi")
LEVELS = {
    "ja": ("N5", "N4", "N3", "N2", "N1"),
    "ko": ("TOPIK1", "TOPIK2", "TOPIK3", "TOPIK4", "TOPIK5", "TOPIK6"),
    "th": ("L1", "L2", "L3", "L4", "L5", "L6"),
    "vi": ("L1", "L2", "L3", "L4", "L5", "L6"),
}
LEVEL_RANK = {level: rank for levels in LEVELS.values() for rank, level in enumerate(levels, 1)}
STATUSES = ("candidate", "draft", "review", "published", "deprecated")
GRAMMAR_TYPES = ("grammar", "particle", "conjugation", "expression", "honorific")
RELATIONS = ("contrast", "base", "derivative", "synonym", "other")
MAX_EXAMPLES, MAX_EXAMPLE_CHARS = 2, 120
MIN_CHAPTER_CHARS = 80
MIN_COUNT, MIN_DOCS, MAX_CANDIDATES = 30, 3, 20_000
CHUNK_TARGET, CHUNK_OVERLAP = 2000, 1
GLOSS_BATCH, VOCAB_TOP = 20, 1500
PAGE_GRAMMAR, PAGE_VOCAB, PAGE_SEARCH = 12, 24, 8
CANARY_CHARS = 40
ID_PATTERN = r"^(ja|ko|th|vi)-(grm|voc)-\d{5,}$"

BOOK = _struct(book_ord=I, book_id=S, title_orig=S, language=S, epub_path=S, sha256=S, chapter_count=I, total_chars=L, has_ruby=B, script=S, status=S)
PARAGRAPH = _struct(book_id=S, chapter_idx=I, para_idx=I, text=S, annot=S)
CHAPTER = _struct(book_id=S, chapter_idx=I, title=S, paras=T.ArrayType(_struct(text=S, annot=S)), char_count=L)
TOKEN = _struct(book_id=S, c=I, a=I, i=I, s=S, b=S, r=S, p=S, rs=S)
FREQ = _struct(language=S, rank=I, key=S, reading=S, pos=S, count=L, doc_count=L)
CHUNK = _struct(book_id=S, chunk_idx=I, from_chapter=I, to_chapter=I, char_count=L, text=S)
EXAMPLE = _struct(text=S, reading=S, annot=S, translation_zh=S, source_book=S, source_chapter=I, pointer=T.MapType(S, S))
RELATED = _struct(cross_lang=T.ArrayType(S), same_lang=T.ArrayType(_struct(id=S, relation=S)))
PROVENANCE = _struct(discovered_in=T.ArrayType(S), discovered_is_scalar=B, first_seen_chapter=I, frequency_hint=I, extracted_by=S, extracted_at=S)
GRAMMAR = _struct(
    path=S, id=S, language=S, type=S, level=S, level_rank=I, title=S, structure=S, structure_pattern=S, explanation_zh=S,
    examples=T.ArrayType(EXAMPLE), related=RELATED, tags=T.ArrayType(S), provenance=PROVENANCE, status=S, review_note=S,
)
VOCAB = _struct(
    path=S, id=S, language=S, type=S, word=S, reading=S, pos=S, gloss_zh=S, gloss_detail_zh=S, level=S, level_rank=I,
    frequency=_struct(rank=I, count=I, doc_count=I), examples=T.ArrayType(EXAMPLE), related=RELATED, tags=T.ArrayType(S),
    provenance=PROVENANCE, status=S,
)
XLANG = _struct(path=S, group_id=S, concept_zh=S, members=T.MapType(S, T.ArrayType(S)), note_zh=S, status=S)
TUTORIAL = _struct(id=S, level=S, status=S, body=S)
TASK_EVENT = _struct(seq=L, id=S, event=S, ts=L, stage=S, book_id=S, item_key=S, executor=S, max_attempts=I, prompt_tokens=L, completion_tokens=L, output_path=S, error=S)
GLOSS = _struct(file=S, words=T.ArrayType(S), gloss=T.ArrayType(_struct(word=S, gloss_zh=S, pos=S, hanja=S)))
#: frequency_hint: a variant in the files, since only a number counts, not a quoted one; its JSON text afterwards.
POINT = _struct(
    title_zh=S, structure=S, structure_pattern=S, level=S, explanation_zh=S,
    examples=T.ArrayType(_struct(text=S, annot=S, reading=S, translation_zh=S)), tags=T.ArrayType(S), frequency_hint=T.VariantType(),
)
RESULT = _struct(grammar_points=T.ArrayType(POINT))
CANDIDATE = T.StructType([*_struct(book_id=S, chunk_idx=I, chunk_text=S, result=RESULT).fields, *RESULT.fields])


def _json_type(kind: T.DataType) -> dict:
    if isinstance(kind, T.StructType):
        return {"type": "object", "properties": {f.name: _json_type(f.dataType) for f in kind}}
    if isinstance(kind, T.ArrayType):
        return {"type": "array", "items": _json_type(kind.elementType)}
    if isinstance(kind, T.MapType):
        return {"type": "object", "additionalProperties": _json_type(kind.valueType)}
    return {"type": {"string": "string", "boolean": "boolean"}.get(kind.typeName(), "integer")}


def json_schema(kind: str) -> dict:
    """The JSON Schema of an entry: kinds of its fields with enumerations, patterns, limits and what is required."""
    entry = GRAMMAR if kind == "grammar" else VOCAB
    made = _json_type(T.StructType([f for f in entry if f.name != "path"]))
    own = made["properties"]
    own["id"]["pattern"] = ID_PATTERN
    own["language"]["enum"], own["status"]["enum"] = list(LANGUAGES), list(STATUSES)
    own["examples"]["maxItems"] = MAX_EXAMPLES
    own["examples"]["items"]["properties"]["text"] |= {"minLength": 1, "maxLength": MAX_EXAMPLE_CHARS}
    own["examples"]["items"]["required"] = ["text"]
    own["related"]["properties"]["same_lang"]["items"]["properties"]["relation"]["enum"] = list(RELATIONS)
    required = ["id", "language", "status"]
    if kind == "grammar":
        own["type"]["enum"] = list(GRAMMAR_TYPES)
        own["level"]["enum"] = list(dict.fromkeys(level for levels in LEVELS.values() for level in levels))
        own["level_rank"] |= {"minimum": 1, "maximum": max(LEVEL_RANK.values())}
        made["allOf"] = [{"if": {"properties": {"language": {"const": lang}}}, "then": {"properties": {"level": {"enum": list(levels)}}}} for lang, levels in LEVELS.items()]
        required += ["type", "level", "level_rank", "title"]
    else:
        required += ["word", "gloss_zh"]
    return {"$schema": "https://json-schema.org/draft/2020-12/schema", "title": f"{kind}_entry", **made, "required": required}


def json_schemas() -> dict[str, str]:
    """The published schemas as JSON text."""
    import json

    return {f"{kind}_entry": json.dumps(json_schema(kind), indent=2) for kind in ("grammar", "vocab")}
