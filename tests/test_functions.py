"""Golden vectors of the scalar functions."""

import itertools
import json
import re

import pytest
from pyspark.sql import functions as F

from lexiforge import schemas
from lexiforge.functions import annotate as A
from lexiforge.functions import html as H
from lexiforge.functions import text as X


def one(spark, expression, **values):
    kinds = ", ".join(f"{k} string" for k in values) or "x string"
    return spark.createDataFrame([tuple(values.values()) or (None,)], kinds).select(expression).first()[0]


@pytest.mark.parametrize(
    ("annot", "parts"),
    [("財布[サイフ]を落とす", [("財布", "サイフ"), ("を落とす", "")]), ("彼は財布[サイフ]を落とす", [("彼は財布", "サイフ"), ("を落とす", "")]), ("", [])],
)
def test_parse_annot(spark, annot, parts):
    assert [tuple(p) for p in one(spark, X.parse_annot(F.col("a")), a=annot)] == parts


def test_display_ruby_takes_ideographs_only(spark):
    got = one(spark, X.display_ruby(F.col("a")), a="彼は財布[サイフ]を落とす")
    assert ("財布", "サイフ") in [tuple(p) for p in got]
    assert "".join(p.base for p in got) == "彼は財布を落とす"


def cut_by_hand(example, source):
    """Every code point of the source with its part; the match is looked for in the code points."""
    wanted, points = (example or "").strip(), []
    for k, m in enumerate(re.finditer(r"([^\[\]]+)(?:\[([^\[\]]+)\])?", source or "")):
        points += [(c, k, m[1], m[2] or "") for c in m[1]]
    plain = "".join(p[0] for p in points)
    for goal in (wanted, wanted[: max(10, len(wanted) // 2)]):
        at = plain.find(goal)
        if goal and plain and at >= 0:
            out = ""
            for k, run in itertools.groupby(points[at : at + len(goal)], key=lambda p: p[1]):
                run = list(run)
                out += "".join(p[0] for p in run) + (f"[{run[0][3]}]" if run[0][3] and len(run) == len(run[0][2]) else "")
            return out
    return ""


ANNOTATED = [
    ("財布を落とす", "財布[サイフ]を落とす"), ("財布を落とす", "彼は財布[サイフ]を落とす"), ("", "x"), ("x", ""), (None, "x"), ("x", None), ("zzz", "財布"), ("  財布 ", "[x]財布[サイフ]"),
    ("財布を落としたので帰れない。そして", "私は 財布[サイフ]を落としたので帰[かえ]れない"), ("ab", "a[1]b[2]c"), ("b", "a[1]b[2]c"), ("abc", "a[1]b[2]c"), ("𠮷野家", "𠮷[よし]野家[のや]"), ("a" * 30 + "b", "a" * 40), ("aa", "aaa[x]aa[y]"),
]


def test_annot_for_example(spark):
    rows = spark.createDataFrame(ANNOTATED, "e string, s string").repartition(1)
    got = rows.select("e", "s", A.annot_for_example("e", "s").alias("a")).collect()
    assert {(r.e, r.s): r.a for r in got} == {(e, s): cut_by_hand(e, s) for e, s in ANNOTATED}
    assert cut_by_hand(*ANNOTATED[0]) == "財布[サイフ]を落とす" and cut_by_hand(*ANNOTATED[1]) == "財布を落とす"


@pytest.mark.parametrize(("annot", "text", "ok"), [("至[いた]って", "至って", True), ("至って[いたって]", "至って", False), ("[x]至って", "至って", False), ("", "", False), (None, "x", False)])
def test_valid_annot(spark, annot, text, ok):
    assert one(spark, X.valid_annot(F.col("a"), F.col("t")), a=annot, t=text) is ok


def test_norm_for_match(spark):
    assert one(spark, X.norm_for_match(F.col("a")), a="「あ、い」 — う…") == "あいう"
    assert one(spark, X.norm_for_match(F.col("a")), a="彼は財布[サイフ]を落とした。") == "彼は財布[サイフ]を落とした"


def test_provenance_probe(spark):
    e = X.provenance_probe(F.col("t"), F.col("c"))
    assert one(spark, e, t="財布を落とした", c="彼は財布[サイフ]を落とした。") is False
    assert one(spark, e, t="anything", c="") is True
    assert one(spark, e, t="abcdefghijKLMN", c="x abcde fgh y") is True


@pytest.mark.parametrize(("p", "s", "t", "key"), [("V-て + しまう", "", "", "v-て+しまう"), ("", "", "甲 乙", "甲乙"), (None, "A B", "x", "ab"), ("", "", "", ""), (None, None, None, "")])
def test_dedup_key(spark, p, s, t, key):
    assert one(spark, X.dedup_key(F.col("p"), F.col("s"), F.col("t")), p=p, s=s, t=t) == key


@pytest.mark.parametrize(
    ("lang", "level", "want", "rank"),
    [("ko", "3급", "TOPIK3", 3), ("ko", "TOPIK 2", "TOPIK2", 2), ("th", "l2", "L2", 2), ("vi", "3", "L3", 3), ("ja", "n4", "N4", 2), ("ja", "JLPT N4", None, None), ("ja", "", None, None), ("ko", "고급", None, None), ("ko", "7", "TOPIK7", None), ("th", "9", "L9", None), ("ko", "10", "TOPIK1", 1), ("vi", None, None, None)],
)
def test_norm_level(spark, lang, level, want, rank):
    e = X.norm_level(F.col("g"), F.col("v"))
    got = one(spark, F.struct(e.alias("l"), X.level_rank(e).alias("r")), g=lang, v=level)
    assert (got.l, got.r) == (want, rank)


def test_kana(spark):
    assert one(spark, X.kata_to_hira(F.col("a")), a="スーパーヴヶ") == "すーぱーゔゖ"
    assert one(spark, A.kata_to_hira_long("a"), a="コーヒー") == "こうひー"
    assert one(spark, A.kata_to_hira_long("a"), a="ケーキおーーー") == "けいきおうーー"
    tokens = spark.createDataFrame([([("財布", "サイフ", None), ("を", "ヲ", None), ("落", "*", None), ("目", "もく", "book"), ("猫", None, None)],)], "t array<struct<s:string,r:string,rs:string>>")
    assert tokens.select(A.synthesize_ruby("t")).first()[0] == "財布[さいふ]を落目[もく]猫"


def test_content_hash(spark):
    assert one(spark, X.content_hash(F.lit("6"), F.lit(0), F.lit("abc"))) == "4dfc240a0af34a56"
    assert one(spark, X.content_hash(F.lit("1"), F.lit("a|b"))) == "c6483995c07f6882"


def test_white_space(spark):
    assert one(spark, X.norm_ws(F.col("a")), a="　a  b") == "a b"
    assert one(spark, X.clean_token(F.col("a")), a="​ a﻿　") == "a"


@pytest.mark.parametrize(("text", "junk"), [("x", True), ("***", True), ("MsoNormal foo", True), ("12", False), ("ああ", False)])
def test_is_junk(spark, text, junk):
    assert one(spark, X.is_junk(F.col("a")), a=text) is junk
    assert H.junk(text) is junk


@pytest.mark.parametrize(("tag", "kind"), [("NNG", "noun"), ("VCP", "func"), ("VV-I", "verb"), ("JX", "other"), ("MAG", "adv")])
def test_pos_ko(spark, tag, kind):
    assert one(spark, X.pos_class_ko(F.col("a")), a=tag) == kind


def test_labels(spark):
    assert one(spark, X.pos_class_ja(F.col("a")), a="名詞") == "noun"
    assert one(spark, X.pos_label(F.col("a")), a="zzz") == "zzz"
    assert one(spark, X.level_label(F.col("g"), F.col("l")), g="ko", l="TOPIK3") == "TOPIK 3"
    assert one(spark, X.hanja_detail(F.col("a")), a=None) == ""
    assert one(spark, X.has_kanji(F.col("a")), a="か漢") is True
    assert one(spark, X.template_version(F.col("a")), a="version: 6\nx") == "6"
    assert one(spark, X.template_version(F.col("a")), a="x") == "0"


JSON = [
    ('[{"a":1}]', {"a": 1}), ('[{"a":1},{"a":2}]', [{"a": 1}, {"a": 2}]), ('x ```json\n{"b": 2}\n``` y {"c": 3}', {"b": 2}), ("none", None), ("", None), (None, None), ("{bad} [1, 2]", [1, 2]),
    ('say {"a": {"b": [1, 2]}} there', {"a": {"b": [1, 2]}}), ('{"a":1} and {"a":2}', None), ('{"a":1},"x":{"a":2}', None), ("``` [1] ```", [1]), ('{"a":1}]', {"a": 1}), ("[1] x [2]", None), ('```json\n[{"w":"猫"}]\n```', {"w": "猫"}),
]


def test_extract_json(spark):
    got = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(JSON)], "k int, t string").select("k", A.extract_json("t").alias("j")).collect()
    assert {r.k: None if r.j is None else json.loads(r.j) for r in got} == {k: want for k, (_, want) in enumerate(JSON)}


def test_merge_example(spark):
    kind = "have array<struct<text:string>>, new struct<text:string>"
    for have, new, want in ((["a b"], "ab", ["a b"]), (["a b"], "c", ["a b", "c"]), (["a", "b"], "c", ["a", "b"]), (["a"], " ", ["a"])):
        row = spark.createDataFrame([([(x,) for x in have], (new,))], kind).select(X.merge_example(F.col("have"), F.col("new"))).first()[0]
        assert [r.text for r in row] == want


def test_html_paragraphs(spark):
    page = "<h2>題</h2><p>彼は<ruby>財布<rp>(</rp><rt>サイフ</rt><rp>)</rp></ruby>を<br/>落とす</p><p>***</p><p>ああ</p>"
    root = H.parse(page)
    assert H.title_of(root) == "題"
    assert H.paragraphs_of(root) == [{"text": "彼は財布を 落とす", "annot": "彼は財布[サイフ]を 落とす"}, {"text": "ああ", "annot": "ああ"}]
    two = H.paragraphs_of(H.parse("<div><p>ab<p>cd</div><div>xx</div><!-- no -->"))
    assert [p["text"] for p in two] == ["ab", "cd", "xx"]
    assert H.paragraphs_of(H.parse(None)) == [] and H.title_of(H.parse("")) is None
    row = spark.createDataFrame([(page,), ("",)], "html string").select(H.paragraphs("html"), H.chapter_title("html")).collect()
    assert len(row[0][0]) == 2 and row[1][0] == [] and row[1][1] is None


def test_schemas_export():
    assert set(schemas.json_schemas()) == {"grammar_entry", "vocab_entry"}
    assert schemas.LEVEL_RANK["N1"] == 5 and schemas.LEVEL_RANK["TOPIK6"] == 6


def test_shown_ruby_takes_one_pass(spark):
    from lexiforge.functions import text as X

    texts = ["食べ物[もの]を山々[やまやま]へ", "漢[a][b]c", "[x]漢字]か漢", "漢字[かん", "𠀋漢[か]𠀋", "x[y]z", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", X.display_ruby(F.col("t")).alias("p"))
    run = "㐀-鿿豈-﫿々〆ヶ"
    for r in df.collect():
        want = [(m[1] or m[0], m[2] or "") for m in re.finditer(rf"([{run}]+)\[([^\[\]]+)\]|([^\[\]{run}]+|[{run}]+(?!\[))", r.t)]
        assert [(p.base, p.read) for p in r.p] == want
    assert df._jdf.queryExecution().analyzed().toString().count("regexp_extract_all") == 1


def test_pages_are_parsed_in_slices(monkeypatch):
    import pyarrow as pa

    from lexiforge.functions import html as H

    made, own = [], pa.array
    monkeypatch.setattr(H, "SLICE", 30)
    monkeypatch.setattr(H.pa, "array", lambda rows, kind: made.append(len(rows)) or own(rows, kind))
    pages = ["<h1>T</h1><p>one two</p><p>b3</p>", None, "<p>q1</p>", "<p><ruby>漢<rt>かん</rt></ruby>字字</p>"] * 5
    got = H.document.func(own(pages)).to_pylist()
    assert [len(x["paras"]) for x in got] == [2, 0, 1, 1] * 5 and got[3]["paras"] == [{"text": "漢字字", "annot": "漢[かん]字字"}]
    assert max(made) <= 4
