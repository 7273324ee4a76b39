"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a regular expression with the literal tokens (runs of letters and digits) that any url it matches must hold.
How often those tokens stand in the urls is counted once over the whole table; each rule is filed under its rarest token.
A url's tokens fetch candidate rules, and only those run their regular expression; rules without a token always run.

Host rules (host, path, verdict) fit a host with its subdomains and paths that start with the rule's; the longest wins
(of equal ones the blocking one).  Where none fits, the method's own patterns decide: block if one matches, else allow.

The rules go to the workers in shards of at most SHARD_RULES; a longer list makes several passes over the rows, so that
no worker ever holds more than one shard.

Defined results: a null url or one without "://" has an empty host and path, fits no rule and gets the method's verdict;
repeated rows are judged each; of rules that fit at equal length the blocking one wins, then the last by text; urls of any
length are read whole; an empty table gives an empty result; an empty rule list leaves all to the patterns; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiforge.llm._shared import read_table, sized_broadcast

#: (host, path, verdict)
HOST_RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
#: (name, regular expression, tokens that any match holds): the method's own blocking patterns
PATTERNS = (
    ("ad-server", r"://[^/?#]*\b(adserver)\b", ("adserver",)),
    ("double-click", r"://(?:[^/?#]*\.)?doubleclick\.", ("doubleclick",)),
    ("casino", r"[/.\-]casino[/.\-]", ("casino",)),
    ("xxx", r"[/.\-]xxx[/.\-]", ("xxx",)),
    ("phishing", r"/phishing/", ("phishing",)),
)
SHARD_RULES = 100_000
TOKEN = "[A-Za-z0-9]+"


def compiled(host_rules=HOST_RULES, patterns=PATTERNS) -> list[tuple]:
    """(text, expression, tokens, length, verdict) of each rule; length 0 for the method's patterns."""
    out = []
    for host, path, verdict in host_rules:
        ends = re.search(TOKEN + "$", path)  # the last token of a path may go on in the url
        whole = path[: ends.start()] if ends else path
        expression = r"^[^:]*?://(?:[^/?#]*\.)?" + re.escape(host) + re.escape(path)
        out.append((host + path, expression, tuple(re.findall(TOKEN, host + " " + whole)), len(host + path), verdict))
    return out + [(name, expression, tuple(tokens), 0, "block") for name, expression, tokens in patterns]


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path) as the contract has them; A-Z of the host become lower case."""
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    cut = re.search("[/?#]", rest)
    host = rest[: cut.start()] if cut else rest
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return lowered, path


def token_counts(urls: DataFrame, tokens: list[str]) -> dict[str, int]:
    """In how many urls each of the rules' tokens stands: one row per token of the rules at most, which are here already."""
    wanted = urls.sparkSession.createDataFrame([(t,) for t in tokens], "t string")
    rows = urls.select(F.explode(F.array_distinct(F.regexp_extract_all("url", F.lit(TOKEN), F.lit(0)))).alias("t"))
    return {r[0]: r[1] for r in rows.join(sized_broadcast(wanted, len(tokens)), "t", "left_semi").groupBy("t").count().collect()}


def _judge(rules: list[tuple], counts: dict[str, int], first: bool):
    index: dict[str, list] = {}
    for text, expression, tokens, length, verdict in rules:
        rarest = min(tokens, key=lambda t: (counts.get(t, 0), t)) if tokens else ""
        index.setdefault(rarest, []).append((length, verdict == "block", text, expression, verdict))

    def judge(batches):
        import pyarrow as pa

        ready = {t: sorted((n, b, x, re.compile(e), v) for n, b, x, e, v in own) for t, own in index.items()}
        for batch in batches:
            cols = {name: batch.column(k).to_pylist() for k, name in enumerate(batch.schema.names)}
            out = []
            for k, (page, url) in enumerate(zip(cols["page_id"], cols["url"], strict=True)):
                host, path = split_url(url)
                clean = f"x://{host}{path}"
                best = (-1, False, None, None) if first else (cols["length"][k], cols["blocks"][k], cols["rule"][k], cols["verdict"][k])
                if host or path:
                    for token in {"", *re.findall(TOKEN, clean)}:
                        for length, blocks, text, pattern, verdict in ready.get(token, ()):
                            if (length, blocks, text) > (*best[:2], best[2] or "") and pattern.search(clean):
                                best = (length, blocks, text, verdict)
                out.append((page, url, host, path, *best))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.bool_(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 8, kinds, strict=True)], COLUMNS)

    return judge


COLUMNS = ["page_id", "url", "host", "path", "length", "blocks", "rule", "verdict"]
KINDS = "page_id long, url string, host string, path string, length int, blocks boolean, rule string, verdict string"


def judge(pages: DataFrame, host_rules=HOST_RULES, patterns=PATTERNS, id_col: str = "page_id", url_col: str = "url", shard: int = SHARD_RULES) -> DataFrame:
    """One row per page: (page_id, host, path, rule, verdict, pattern); pattern is the method's own pattern that matched."""
    rules = compiled(host_rules, patterns)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    # the host is lower-cased before it is cut into tokens, so are the urls that are counted
    counts = token_counts(rows.select(F.lower("url").alias("url")), sorted({t for r in rules for t in r[2]}))
    for k in range(0, max(1, len(rules)), shard):
        rows = rows.mapInArrow(_judge(rules[k : k + shard], counts, not k), KINDS)
    return rows.select(
        "page_id", "host", "path", F.when(F.col("length") > 0, F.col("rule")).alias("rule"), F.coalesce("verdict", F.lit("allow")).alias("verdict"),
        F.when(F.col("length") == 0, F.col("rule")).alias("pattern"),
    )


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "pages"))


def _oracle() -> str:
    ranked = sorted(HOST_RULES, key=lambda r: (-len(r[0] + r[1]), r[2] != "block"))
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    rule = " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for h, p, _ in ranked)
    verdict = " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for h, p, v in ranked)
    pattern = " ".join(f"WHEN regexp_matches('x://' || host || path, '{e}') THEN '{n}'" for n, e, _ in sorted(PATTERNS, reverse=True))
    return f"""
WITH u AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u),
r AS (SELECT page_id, host, path, CASE {rule} END AS rule, CASE {verdict} END AS fixed, CASE {pattern} END AS own FROM h)
SELECT page_id, host, path, rule, coalesce(fixed, CASE WHEN own IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, CASE WHEN rule IS NULL THEN own END AS pattern FROM r"""


OP2_SQL = _oracle()
