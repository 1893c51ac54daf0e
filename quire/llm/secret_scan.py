"""Secret scan with corpus-wide ownership frequency.

Candidates are found in every whole text by fixed patterns. Each candidate's
value is hashed, and the corpus tells in how many distinct repositories and
under how many owners that hash stands: a value copied widely is an example
from some documentation, one that keeps to a single owner and looks random is
a credential that may be live. A private key's value is its body, so keys of
one type are not taken for copies of each other. Base spans are reported whatever the verdict.

Built-in functions only. Positions count code points, the end is exclusive.
Null or empty texts have no spans; a null repository or owner counts as one
of its own. Repeated rows are reported each by itself; extra columns are
ignored. Equal values in one document count once for ownership.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import land

# The kinds in their listed order, with pattern, the group that
# holds the value and the least length of that value.
BASE_KINDS = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
)
# A private key: its header lines and everything up to the END line, or without
# one the base64 lines that follow (line breaks may be written as \n). Possessive,
# so that long keys need neither stack nor a second try.
_BREAK = r"(?:\s|\\[nrt])"
_FIELDS = _BREAK + r"*+(?:[A-Za-z0-9-]++:[^\r\n\\]*+" + _BREAK + "*+)*+"
_PEM = (r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----(?:" + _FIELDS
        + r"""[A-Za-z0-9+/=\s\\"',]*+-----END [A-Z0-9 ]*PRIVATE KEY-----|""" + _FIELDS
        + r"(?:[A-Za-z0-9+/=]{16,}+" + _BREAK + r"*+)++(?:(?:[A-Za-z0-9+/=]{4})++(?![^\s\\\x22\x27]))?+)?+")
MORE_KINDS = (
    ("pem", _PEM, 0, 1),
    ("url", r"://[^\s/:@]++:([^\s/@]{3,}+)@", 1, 3),
)


def _key_body(match: Column) -> Column:
    """A private key without header, END line, line breaks and quotes, so that
    wrapping does not matter; of a header alone the header."""
    body = F.regexp_replace(match, F.lit(r"""-----(?:BEGIN|END) [A-Z0-9 ]*PRIVATE KEY-----|\s|\\[nrt]|["',\\]"""), F.lit(""))
    return F.when(body == "", match).otherwise(body)


@dataclass(frozen=True)
class Params:
    copied_repos: int = 3         # repositories from which a value counts as copied
    copied_owners: int = 2        # owners, likewise
    random_chars: int = 8         # distinct characters a live-looking value has


def _worth_it(kind: str, text: Column, low: Column) -> Column:
    """A cheap necessary condition of a match."""
    if kind == "assign":
        hits = [low.contains(w) for w in ("passw", "secret", "token", "apikey", "api_key")]
        any_hit = hits[0]
        for h in hits[1:]:
            any_hit = any_hit | h
        return any_hit
    return {"access": text.contains("AKIA"), "hex": text.rlike("[0-9a-f]{32}"),
            "pem": text.contains("PRIVATE KEY-----"), "url": text.contains("://")}[kind]


PIECE = 256


def _spans(text: Column, number: int, kind: str, pattern: str, group: int, least: int) -> Column:
    """Array of (start, kind number, kind, end, value) of a pattern's leftmost
    non-overlapping matches: the lengths of what lies between the matches and of
    the matches add up to the positions, in pieces of ``PIECE`` matches."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    if kind == "pem":
        value = F.transform(whole, _key_body)
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("m"), value.alias("v"))
    none = F.expr("cast(array() as array<struct<start:int,no:int,kind:string,end:int,value:string>>)")

    def length(x):
        return F.length(x["gap"]) + F.coalesce(F.length(x["m"]), F.lit(0))

    def step(acc, x):
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.coalesce(F.length(x["m"]), F.lit(0))
        span = F.struct(begin.alias("start"), F.lit(number).alias("no"), F.lit(kind).alias("kind"),
                        end.alias("end"), x["v"].alias("value"))
        keep = x["m"].isNotNull() & (F.length(x["v"]) >= least)
        return F.struct(end.alias("at"), F.when(keep, F.concat(acc["s"], F.array(span))).otherwise(acc["s"]).alias("s"))

    def bound(value, use):
        """``use`` of a value that is computed once, as the variable of a lambda."""
        return F.transform(F.array(value), use)[0]

    def spread(all_):
        # an array grows by copying, so it is built in pieces of bounded length
        pieces = F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / PIECE).cast("int"))
        piece = lambda c: F.slice(all_, c * PIECE + 1, PIECE)
        sizes = F.transform(pieces, lambda c: F.aggregate(piece(c), F.lit(0), lambda t, x: t + length(x)))
        begins = F.aggregate(sizes, F.array(F.lit(0)), lambda t, n: F.concat(t, F.array(F.element_at(t, -1) + n)))
        return bound(begins, lambda at: F.flatten(F.transform(pieces, lambda c: F.aggregate(
            piece(c), F.struct(F.get(at, c).alias("at"), none.alias("s")), step, lambda done: done["s"]))))

    return bound(parts, spread)


def find_spans(text: Column, low: Column, kinds) -> Column:
    """All spans of ``kinds`` sorted by start, then kind as listed."""
    none = F.expr("cast(array() as array<struct<start:int,no:int,kind:string,end:int,value:string>>)")
    found = [F.when(_worth_it(k, text, low), _spans(text, i, k, p, g, n)).otherwise(none)
             for i, (k, p, g, n) in enumerate(kinds)]
    return F.array_sort(F.concat(*found))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_findings(docs: DataFrame, params: Params = Params(), id_col: str = "doc_id",
                    text_col: str = "text", repo: Column | None = None,
                    owner: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(landed rows ``uid, doc_id, spans``; findings ``uid, kind, start, end,
    value_sha256, n_repos, n_owners, verdict``), verdict one of ``copied``,
    ``live``, ``unclear``."""
    p = params
    repo = F.col("source") if repo is None else repo
    owner = F.col("source") if owner is None else owner
    kinds = BASE_KINDS + MORE_KINDS
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"),
                      F.coalesce(repo, F.lit("")).alias("repo"), F.coalesce(owner, F.lit("")).alias("owner"))
    rows = land(src.withColumn("low", F.lower("text"))
                   .select(F.monotonically_increasing_id().alias("uid"), "doc_id", "repo", "owner",
                           find_spans(F.col("text"), F.col("low"), kinds).alias("spans")), "secret-spans")
    one = (rows.where(F.size("spans") > 0).select("uid", "repo", "owner", F.explode("spans").alias("s"))
               .select("uid", "repo", "owner", "s.kind", "s.start", "s.end",
                       F.sha2("s.value", 256).alias("value_sha256"),
                       F.size(F.array_distinct(F.split("s.value", ""))).alias("chars")))
    # one row a value, repository and owner, so a value copied everywhere is
    # combined before its group meets
    owned = (one.select("value_sha256", "repo", "owner").distinct().groupBy("value_sha256")
                .agg(F.count_distinct("repo").alias("n_repos"), F.count_distinct("owner").alias("n_owners")))
    verdict = (F.when((F.col("n_repos") >= p.copied_repos) & (F.col("n_owners") >= p.copied_owners), F.lit("copied"))
                .when((F.col("n_owners") == 1) & (F.col("chars") >= p.random_chars), F.lit("live"))
                .otherwise(F.lit("unclear")))
    found = one.join(owned, "value_sha256").select(
        "uid", "kind", "start", "end", "value_sha256", "n_repos", "n_owners", verdict.alias("verdict"))
    return rows.select("uid", "doc_id", "spans"), found


def scan_secrets(docs: DataFrame, params: Params = Params(), **columns) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live,
    n_copied`` of every document."""
    rows, found = secret_findings(docs, params, **columns)
    verdicts = found.groupBy("uid").agg(F.count_if(F.col("verdict") == "live").alias("n_live"),
                                        F.count_if(F.col("verdict") == "copied").alias("n_copied"))
    base = F.filter("spans", lambda s: s["no"] < len(BASE_KINDS))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    zero = F.lit(0).cast("long")
    return (rows.join(verdicts, "uid", "left")
                .select("doc_id", *[count(k).alias(f"n_{k}") for k, *_ in BASE_KINDS],
                        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
                        F.coalesce("n_live", zero).alias("n_live"), F.coalesce("n_copied", zero).alias("n_copied")))
