"""Secret scan that links the parts of credentials, with DataFrame functions alone.

Strong patterns report by themselves. Weak ones (user names, short passwords, mixed tokens,
endpoints) are common in clean texts; they are parts of a credential, and are reported only if a
complementary part stands in the same scope and within reach: a secret beside an identifier or an
endpoint, an identifier beside a secret, an endpoint beside both. A scope ends at a blank line.

One pass finds the matches: a text split by a pattern gives the lengths of the gaps, and running
sums of gaps and matches give positions. Texts stay behind; only lengths of matches are shuffled,
by row. Parts are then joined by interval: an axis of scopes and bins as wide as the reach holds the
first and last start of each role in a bin, so a part meets three rows at most, however many parts
lie around it.

Null and empty texts hold nothing and give a row with zeros; repeated rows give a row each, whatever
their doc_id. Other columns are not read. Positions count code points. Where a weak part begins
inside a strong span it is that span's and not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from pulcra.llm.common import table
from pulcra.operators.lookup import materialize


def _either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


_IS = r"""["']?\x20*[:=]\x20*["']?"""
_VALUE = r"([A-Za-z0-9+/_.=-]+)"
ASSIGN, ACCESS, HEX, IDENTIFIER, PASS, BLOB, ENDPOINT, BREAK = range(8)
KINDS = ("assign", "access", "hex", "identifier", "pass", "blob", "endpoint")
# Pattern, group that is measured, least code points of it. A strong pattern whose failing matches
# cannot hide a good one asks for the length itself.
PATTERNS = {
    ASSIGN: (f"({_either_case('password|passwd|secret|token|api_?key')}){_IS}{_VALUE}", 2, 8),
    ACCESS: ("AKIA[A-Z0-9]{12,}", 0, 16),
    HEX: ("[0-9a-f]{32,}", 0, 32),
    IDENTIFIER: (f"({_either_case('user_?name|user_?id|client_?id|access_?key_?id|account_?id|login')}){_IS}([A-Za-z0-9@._+-]+)", 2, 3),
    PASS: (f"({_either_case('pwd|pass|passphrase|secret_?key|private_?key|access_?key|signing_?key|credentials?')}){_IS}{_VALUE}", 2, 4),
    BLOB: ("[A-Za-z0-9+/=_-]{20,}", 0, 20),
    ENDPOINT: (
        "(?:https?|ftps?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|amqps?|rediss?|s3)://[A-Za-z0-9._~:/?#@!$&*+,;=%-]+"
        f"|(?:{_either_case('host|hostname|endpoint|base_?url')}){_IS}[A-Za-z0-9._:/-]+",
        0,
        10,
    ),
    BREAK: (r"\n[\x20\t\r]*\n", 0, 0),
}
IDENTIFIERS, SECRETS, ENDPOINTS = (ACCESS, IDENTIFIER), (ASSIGN, HEX, PASS, BLOB), (ENDPOINT,)
ROLES = {"identifier": IDENTIFIERS, "secret": SECRETS, "endpoint": ENDPOINTS}


@dataclass(frozen=True)
class Settings:
    reach: int = 400  # code points between the starts of complementary parts


def _lengths(texts: Column) -> Column:
    return F.transform(texts, lambda t: F.char_length(t))


def _found(kind: int) -> Column:
    """kind, and for each match the gap before it, its length and what is measured of it; the gap
    after the last match has no length."""
    pattern, group, _ = PATTERNS[kind]
    matches = F.col(f"_m{kind}")
    measured = _lengths(matches if group == 0 else F.regexp_extract_all("text", F.lit(pattern), F.lit(group)))
    if kind == BLOB:  # mixed of three kinds of characters, else not measured
        mixed = lambda t: t.rlike("[a-z]") & t.rlike("[A-Z]") & t.rlike("[0-9]")
        measured = F.transform(matches, lambda t: F.when(mixed(t), F.char_length(t)).otherwise(0))
    gaps = _lengths(F.split("text", pattern, -1))
    found = F.struct(F.lit(kind).alias("kind"), gaps.alias("gap"), _lengths(matches).alias("length"), measured.alias("measured"))
    return F.when(F.size(matches) > 0, found)


def _matched(docs: DataFrame) -> DataFrame:
    """(row, doc_id, found): the matches of each text, as lengths."""
    texts = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    matches = {f"_m{k}": F.regexp_extract_all("text", F.lit(PATTERNS[k][0]), F.lit(0)) for k in range(BREAK)}
    texts = texts.select("*", *[m.alias(name) for name, m in matches.items()])
    weak = F.greatest(*[F.size(f"_m{k}") for k in (ASSIGN, IDENTIFIER, PASS, BLOB, ENDPOINT)]) > 0
    breaks = F.when(weak, F.regexp_extract_all("text", F.lit(PATTERNS[BREAK][0]), F.lit(0))).otherwise(F.array().cast("array<string>"))
    texts = texts.withColumn(f"_m{BREAK}", breaks)
    return texts.select("row", "doc_id", F.array_compact(F.array(*[_found(k) for k in PATTERNS])).alias("found"))


def _spans(matched: DataFrame) -> DataFrame:
    """(row, doc_id, kind, start, end, good) of every match, breaks included."""
    kinds = matched.select("row", "doc_id", F.explode("found").alias("f"))
    parts = kinds.select("row", "doc_id", "f.kind", F.posexplode(F.arrays_zip("f.gap", "f.length", "f.measured")).alias("at", "m"))
    parts = parts.where("m.length IS NOT NULL")
    end = F.sum(F.col("m.gap").cast("long") + F.col("m.length")).over(Window.partitionBy("row", "kind").orderBy("at"))
    least = F.element_at(F.array(*[F.lit(PATTERNS[k][2]) for k in PATTERNS]), F.col("kind") + 1)
    short = (F.col("kind") == ASSIGN) & (F.col("m.measured") < PATTERNS[ASSIGN][2]) & (F.col("m.measured") >= PATTERNS[PASS][2])
    parts = parts.select("row", "doc_id", F.when(short, PASS).otherwise(F.col("kind")).alias("kind"), (end - F.col("m.length")).alias("start"), end.alias("end"), (short | (F.col("m.measured") >= least)).alias("good"))
    before = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    strong_end = F.max(F.when(F.col("good") & (F.col("kind") <= HEX), F.col("end"))).over(before)
    scope = F.count(F.when(F.col("kind") == BREAK, 1)).over(before)
    return parts.select("*", F.coalesce(strong_end > F.col("start"), F.lit(False)).alias("covered"), scope.alias("scope"))


def linked_parts(parts: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The weak ones of ``parts`` (row, doc_id, kind, start, end, scope) with their complement near."""
    binned = parts.withColumn("bin", F.floor(F.col("start") / s.reach))
    held = {}
    for role, kinds in ROLES.items():
        start = F.when(F.col("kind").isin(*kinds), F.col("start"))
        held |= {f"{role}_first": F.min(start), f"{role}_last": F.max(start)}
    axis = binned.groupBy("row", "scope", "bin").agg(*[c.alias(name) for name, c in held.items()])
    weak = binned.where(F.col("kind") > HEX)
    reached = weak.withColumn("bin", F.explode(F.sequence(F.col("bin") - 1, F.col("bin") + 1))).join(axis, ["row", "scope", "bin"])
    near = {
        role: F.max(F.coalesce((F.col(f"{role}_last") >= F.col("start") - s.reach) & (F.col(f"{role}_first") <= F.col("start") + s.reach), F.lit(False)))
        for role in ROLES
    }
    found = reached.groupBy("row", "doc_id", "kind", "start", "end").agg(*[c.alias(role) for role, c in near.items()])
    complement = (
        F.when(F.col("kind") == IDENTIFIER, F.col("secret"))
        .when(F.col("kind") == ENDPOINT, F.col("secret") & F.col("identifier"))
        .otherwise(F.col("identifier") | F.col("endpoint"))
    )
    return found.where(complement).select("row", "doc_id", "kind", "start", "end")


def secret_spans(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(doc_id, spans) per row of ``docs`` (doc_id, text); spans is an array of kind, start, end, in
    the order of starts. ``strong`` says which of them were reported by their pattern alone."""
    matched = materialize(_matched(docs))
    spans = materialize(_spans(matched.where(F.size("found") > 0)))
    strong = F.col("good") & (F.col("kind") <= HEX)
    parts = spans.where(F.col("good") & (F.col("kind") != BREAK) & (strong | ~F.col("covered")))
    said = spans.select("row", "doc_id", "kind", "start", "end", strong.alias("reported"))
    said = said.unionByName(linked_parts(parts, s).withColumn("reported", F.lit(True)))
    span = F.struct("start", "kind", "end")
    some = said.groupBy("row", "doc_id").agg(F.sort_array(F.collect_list(F.when(F.col("reported"), span))).alias("spans"))
    none = matched.where(F.size("found") == 0).select("row", "doc_id", F.array().cast(some.schema["spans"].dataType).alias("spans"))
    names = F.array(*map(F.lit, KINDS))
    named = lambda x: F.struct(F.element_at(names, x["kind"] + 1).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), (x["kind"] <= HEX).alias("strong"))
    return some.unionByName(none).select("doc_id", F.transform("spans", named).alias("spans"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    listed = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(kind) for kind in KINDS[: HEX + 1]],
        F.sha2(listed(F.filter("spans", lambda x: x["strong"])), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
